"""Deterministic sharded WARC archives of pages, and their reader.

Shards are ranges of page_id and payload digest that hold equally many bytes. They are cut at
fixed shares of the running sum of bytes in that order, so they depend on the rows alone: the
same pages give the same files, byte by byte, whatever the partitions, and no id, however far
from the others, and no crowd of pages without one makes a shard fuller. A task sorts its shards, writes one gzip member per record and
starts the next file once the compressed size is reached. Record headers and the payload and
block digests are made anew from the payload.

Files are written under temporary names that carry the attempt. What a task finished is a row of
the manifest, which Spark's own committer keeps once per task; only then are the files of the
manifest renamed, in tasks, and the list of final names is written last. A lost executor leaves
temporary files that no manifest names. Readers open what that list names and nothing else.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage

SHARD_BYTES, ROLL_BYTES, BATCH_BYTES, RECORD_BYTES = 32 << 20, 8 << 20, 8 << 20, 512
MAX_SHARDS, MAX_TASKS = 1 << 17, 20_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard bigint, part int, name string, temporary string, records bigint, bytes bigint, sha256 string"
PAGE = "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint"


@dataclass(frozen=True)
class Layout:
    """Raw bytes per shard, compressed bytes per file, smallest payload to revisit, and the record date."""

    shard_bytes: int = SHARD_BYTES
    roll_bytes: int = ROLL_BYTES
    revisit_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, '|'.join(map(str, parts)))}>"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as one gzip member."""
    lines = [f"{k}: {v}" for k, v in (*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", len(block)))]
    head = "\r\n".join(["WARC/1.1", *lines]).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, ordinal: int, date: str) -> bytes:
    """A response, or where ``first`` is given a revisit that names the page with the payload."""
    mark, key = digest(payload), "-" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers: list[tuple[str, object]] = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(key, mark, ordinal)),
        ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{mark}")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("Page-ID", page_id))
    if first is None:
        return record(headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, mark, 0)), ("Page-Refers-To", first)]
    return record(headers, http)


class _Files:
    """The open file of a shard: temporary name, size, digest."""

    def __init__(self, folder: str, layout: Layout):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.layout, self.attempt, self.out = layout, uuid.uuid4().hex, None
        self.shard, self.part, self.done = None, 0, []

    def add(self, shard: int, data: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        if self.out is None:
            self.name = f"pages-{shard:07d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}")
            self.records, self.size, self.hash = 0, 0, hashlib.sha256()
            self._put(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", self.name)),
                              ("WARC-Date", self.layout.date), ("WARC-Filename", self.name),
                              ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(data)
        self.records += 1
        if self.size >= self.layout.roll_bytes:
            self.close()
            self.part += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.hash.update(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.name, self.temporary, self.records, self.size, self.hash.hexdigest()))
            self.out = None


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys with the bytes held before each of them in this task."""
    task, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        held = np.cumsum(batch.column("held").to_numpy())
        yield pa.record_batch({**{c: batch.column(c) for c in ("none", "page_id", "sha1", "held")},
                               "task": pa.array(np.full(len(held), task, np.int32)),
                               "before": pa.array(before + held - batch.column("held").to_numpy())})
        before += int(held[-1]) if len(held) else 0


def shard_starts(marks: DataFrame, shard_bytes: int, stage: Stage) -> list[tuple[bool, int, str]]:
    """The first (no id, page_id, sha1) of each shard, in order, from (page_id, sha1, bytes).

    Keys are put in order over all tasks, null ids last, and a shard begins with the first key at
    which its share of bytes is reached: whatever the ids, shards are equally full, up to the
    bytes of one key. At most ``MAX_SHARDS`` of them.
    """
    keys = marks.groupBy(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "sha1") \
        .agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("held"))
    order = ("none", "page_id", "sha1")
    rows = stage("keys", keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _running, "none boolean, page_id bigint, sha1 string, held bigint, task int, before bigint"))
    tasks = rows.groupBy("task").agg(F.max(F.col("before") + F.col("held")).alias("all"))  # one row per task
    upto = tasks.select("task", F.coalesce(F.sum("all").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    total = tasks.agg(F.sum("all")).first()[0] or 0
    size = max(shard_bytes, -(-total // MAX_SHARDS))
    shard = F.floor((F.col("earlier") + F.col("before")) / size)
    first = rows.join(upto, "task").groupBy(shard.alias("shard")).agg(F.min(F.struct(*order)).alias("first"))
    return sorted((r.first.none, r.first.page_id, r.first.sha1) for r in first.select("first").collect())


def _sharded(pages: DataFrame, layout: Layout, stage: Stage) -> tuple[DataFrame, int]:
    """(shard, page_id, url, payload, sha1, first) of every page, and the number of shards; ``first`` only for repeated payloads."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    marks = stage("digests", rows.select("page_id", "sha1", F.octet_length("payload").cast("bigint").alias("bytes")))
    starts = shard_starts(marks, layout.shard_bytes, stage)
    shared = pages.sparkSession.sparkContext.broadcast(starts)

    @F.arrow_udf("bigint")
    def shard(page_id: pa.Array, sha1: pa.Array) -> pa.Array:
        keys = ((p is None, p or 0, s) for p, s in zip(page_id.to_pylist(), sha1.to_pylist()))
        return pa.array([bisect.bisect_right(shared.value, key) - 1 for key in keys], pa.int64())

    repeats = stage("repeats", marks.where(F.col("bytes") >= layout.revisit_bytes).groupBy("sha1")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"))
    return rows.join(repeats, "sha1", "left").select(
        shard("page_id", "sha1").alias("shard"), "page_id", "url", "payload", "sha1", "first"), len(starts)


def write_archives(pages: DataFrame, folder: str, stage: Stage, layout: Layout = Layout()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into a new shared folder; returns the committed manifest.

    A null html is an empty payload. Of records with equal payloads of at least
    ``layout.revisit_bytes`` bytes the one with the smallest page_id is the response and the
    others revisit it; rows that repeat page_id and payload are one response and revisits of the
    same page. A page without page_id is a response of its own; such pages fill the last shards
    by payload digest; a null url is left out. Other columns are ignored. An empty table gives an empty
    manifest. ``folder`` is a path or URI that every executor can write to.
    """
    rows, shards = _sharded(pages, layout, stage)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, before, ordinal = _Files(folder, layout), None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, page_id, url, payload, sha1, first = (c[i].as_py() for c in batch.columns)
                ordinal = ordinal + 1 if (page_id, sha1) == before else 0
                before = (page_id, sha1)
                own = page_id is None or first is None or (page_id == first and ordinal == 0)
                files.add(shard, page_record(page_id, url, payload, None if own else first, ordinal, layout.date))
        files.close()
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        for done in files.done:
            yield pa.record_batch([[v] for v in done], names=names).cast(_schema)

    _schema = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("name", pa.string()), ("temporary", pa.string()),
                         ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
    # A task for every shard, or for some neighbouring ones.
    tasks = max(1, min(shards, MAX_TASKS))
    dealt = rows.repartitionById(tasks, F.expr(f"cast(shard * {tasks} div {max(1, shards)} as int)")) \
        .sortWithinPartitions("shard", "page_id", "sha1", "url")
    manifest = stage("manifest", dealt.mapInArrow(write, MANIFEST))

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist()):
                if files.get_file_info(f"{path}/{temporary}").type != fs.FileType.NotFound:
                    files.move(f"{path}/{temporary}", f"{path}/{name}")
                elif files.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{path}/{temporary}")
            yield batch

    return stage("committed", manifest.mapInArrow(commit, MANIFEST))


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, one gzip member at a time."""
    while data:
        member = zlib.decompressobj(31)
        text = member.decompress(data) + member.flush()
        data = member.unused_data
        head, _, rest = text.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        block = rest[:int(headers["Content-Length"])]
        if not first.startswith("WARC/") or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        yield headers, block


def _page(headers: dict[str, str], block: bytes) -> dict[str, object]:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
    mark, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
    if not revisit and (length != len(payload) or mark != digest(payload)):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    number = lambda name: int(headers[name]) if name in headers else None
    return {"page_id": number("Page-ID"), "url": headers.get("WARC-Target-URI"), "record_type": headers["WARC-Type"],
            "payload": None if revisit else payload, "payload_bytes": length, "payload_digest": mark,
            "refers_to": number("Page-Refers-To")}


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The page records of the archives that a committed manifest names.

    Digests are checked while reading. A revisit has no payload; its length and digest are those
    of the payload that it stands for.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for headers, block in records_of(content.as_py()):
                    if headers["WARC-Type"] in ("response", "revisit"):
                        held.append(_page(headers, block))
                        size += len(block)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    if manifest.isEmpty():
        return spark.createDataFrame([], PAGE)
    files = spark.read.format("binaryFile").load(folder) \
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.join(manifest.select("name"), "name", "left_semi").select("content").mapInArrow(read, PAGE)
