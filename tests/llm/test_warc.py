"""WARC archives: round trip, revisits, determinism, commit."""

from __future__ import annotations

import base64
import hashlib
import os

import duckdb
import pytest

from forecourt.llm import oracle, queries, warc
from forecourt.llm.stages import new_folder, written
from conftest import SF

SMALL = warc.Layout(shard_bytes=20_000, roll_bytes=3_000)


def files_of(folder):
    path = folder.removeprefix("file://")
    return {n: hashlib.sha256(open(f"{path}/{n}", "rb").read()).hexdigest() for n in os.listdir(path) if n.endswith(".gz")}


def test_same_files_from_any_partitions(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = []
    for parts in (1, 7):
        folder = new_folder(spark, "warc-test")
        manifest = warc.write_archives(pages.repartition(parts), folder, written(spark, "t"), SMALL)
        rows = manifest.collect()
        found.append(files_of(folder))
        assert found[-1] == {r.name: r.sha256 for r in rows} and sum(r.records for r in rows) == pages.count()
        assert len({r.shard for r in rows}) > 1 and max(r.part for r in rows) > 0
        stray = folder.removeprefix("file://") + "/pages-0000000-99999.warc.gz"
        open(stray, "wb").write(b"left by a lost task")
        back = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, folder, manifest).collect()}
        assert back == {r.page_id: r.html for r in pages.collect()}
    assert found[0] == found[1]


def test_revisits_and_odd_rows(spark):
    html = "<p>é</p>"
    rows = [(7, "http://a/", html, 1), (3, None, html, 1), (3, None, html, 1), (9, "u\n v", None, 1), (4, "u", "", 1),
            (None, "n", html, 1), (-(1 << 62), "far", "x" * 200_000, 1), (1 << 62, "far", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, shard int")
    folder = new_folder(spark, "warc-test")
    manifest = warc.write_archives(pages, folder, written(spark, "t"), SMALL)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, folder, manifest).collect())
    n = len(html.encode())
    assert got == sorted([(7, "revisit", 3, n), (3, "response", None, n), (3, "revisit", 3, n), (9, "revisit", 4, 0),
                          (4, "response", None, 0), (0, "response", None, n), (-(1 << 62), "response", None, 200_000),
                          (1 << 62, "response", None, 1)])
    large = warc.write_archives(pages, new_folder(spark, "w"), written(spark, "t"), warc.Layout(revisit_bytes=n + 1))
    assert sum(r.records for r in large.collect()) == 8
    nothing = warc.write_archives(pages.limit(0), new_folder(spark, "w"), written(spark, "t"))
    assert warc.read_archives(spark, "unused", nothing).count() == 0


@pytest.mark.parametrize("far", [[], [1 << 60], [-(1 << 62), None, None] + [None] * 400])
def test_shards_are_equally_full_whatever_the_ids(spark, far):
    rows = [(i, "u", f"{i}" + "x" * 900) for i in range(1500)] + [(p, "u", f"far {i}" + "x" * 900) for i, p in enumerate(far)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    layout = warc.Layout(shard_bytes=100_000)
    found, shards = warc._sharded(pages, layout, written(spark, "t"))
    held = {r.shard: r.n for r in found.groupBy("shard").agg({"*": "count"}).toDF("shard", "n").collect()}
    assert sorted(held) == list(range(shards)) and max(held.values()) <= 72 and min(list(held.values())[:-1]) > 0
    assert shards == -(-sum(len(h) + 512 for *_, h in rows) // 100_000)
    manifest = warc.write_archives(pages, new_folder(spark, "w"), written(spark, "t"), layout)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) and manifest.select("shard").distinct().count() == shards


def test_damage_is_seen():
    data = bytearray(warc.page_record(1, "u", b"payload", None, 0, "2024-01-01T00:00:00Z"))
    assert [b for _, b in warc.records_of(bytes(data))][0].endswith(b"payload")
    import gzip

    text = gzip.decompress(bytes(data)).replace(b"payload\r\n", b"paylOad\r\n")
    with pytest.raises(ValueError):
        list(warc.records_of(gzip.compress(text)))


def test_whole_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({oracle.SQL['op1_warc_archives']})").fetchall())
    assert sorted(map(tuple, queries.warc_archives(spark, SF).select(names).collect())) == want
    page = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").first()
    assert base64.b32encode(hashlib.sha1(page.html.encode()).digest()).decode() in {w[2] for w in want}
