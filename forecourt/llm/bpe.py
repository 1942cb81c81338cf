"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

Two tiers. Tier one is a minimal perfect hash over the vocabulary (buckets placed largest first
by a displacement each; every token has exactly one of the n slots), which resolves a whole
pre-token that is a token itself. Tier two merges the bytes of a missing pre-token: neighbouring
symbols are linked, candidate pairs wait in a heap by (rank, position), and stale pairs are
skipped when popped, so a pre-token of n bytes costs n log n whatever its length.

Results of both tiers are kept per task for the pre-tokens seen last; the vocabulary is read on
the driver and sent once to each executor (its size is checked).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.stages import released

MAX_VOCABULARY_BYTES = 256 << 20
REMEMBERED, OUTPUT_ROWS = 1 << 18, 256
_MASK, _STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, one displacement per bucket."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.m = n, max(1, n // 4)
        digests = [xxhash.xxh3_64_intdigest(k) for k in keys]
        whole = np.array(digests, dtype=np.uint64)
        buckets: dict[int, list[int]] = {}
        for i, d in enumerate(digests):
            buckets.setdefault(d % self.m, []).append(i)
        shift, slots, free = [0] * self.m, [0] * n, np.ones(n, dtype=bool)
        tries = np.arange(1024, dtype=np.uint64)[:, None]
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                break
            start = 0
            while True:
                at = (whole[members] + (tries + np.uint64(start)) * np.uint64(_STEP) >> np.uint64(17)) % np.uint64(n)
                fits = free[at].all(axis=1)
                for row in np.flatnonzero(fits):
                    if len(set(at[row].tolist())) == len(members):
                        break
                else:
                    start += len(tries)
                    continue
                shift[b] = start + int(row)
                for i, s in zip(members, at[row].tolist()):
                    slots[i], free[s] = s, False
                break
        spare = iter(np.flatnonzero(free).tolist())
        for b, members in buckets.items():
            if len(members) == 1:
                slots[members[0]] = s = next(spare)
                shift[b] = -1 - s
        self.shift, self.slots = shift, slots

    def slot(self, key: bytes) -> int:
        digest = xxhash.xxh3_64_intdigest(key)
        d = self.shift[digest % self.m]
        return -1 - d if d < 0 else ((digest + d * _STEP & _MASK) >> 17) % self.n


class _Remembered(dict):
    """Packed ids of the pre-tokens seen last, in two generations; kept by a worker from task to task."""

    vocabulary: Vocabulary
    old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = np.array(self.vocabulary.encode(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Vocabulary:
    """Tokens by perfect hash (bytes -> rank), and the pairs of tokens that form one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.hash = PerfectHash(list(ranks))
        self.tokens, self.ranks = [b""] * len(ranks), [0] * len(ranks)
        for slot, (token, rank) in zip(self.hash.slots, ranks.items()):
            self.tokens[slot], self.ranks[slot] = token, rank
        self.hash.slots = []
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        self.pairs: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if token[:i] in ranks and token[i:] in ranks:
                    self.pairs[ranks[token[:i]]][ranks[token[i:]]] = rank
        self.remembered = _Remembered()

    def rank(self, token: bytes) -> int | None:
        slot = self.hash.slot(token)
        return self.ranks[slot] if self.tokens[slot] == token else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token: merge the pair of lowest rank, leftmost first."""
        pairs, ids, n = self.pairs, list(map(self.bytes.__getitem__, piece)), len(piece)
        after, before, shift = list(range(1, n + 1)), list(range(-1, n - 1)), n.bit_length()
        heap = [rank << shift | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := pairs[a].get(b)) is not None]
        heapq.heapify(heap)
        while heap:
            best = heapq.heappop(heap)
            rank = best >> shift
            i = best - (rank << shift)
            if (j := after[i]) >= n or ids[i] < 0 or pairs[ids[i]].get(ids[j]) != rank:  # a symbol is gone since
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (more := pairs[rank].get(ids[k])) is not None:
                    heapq.heappush(heap, more << shift | i)
            if (h := before[i]) >= 0 and (more := pairs[ids[h]].get(rank)) is not None:
                heapq.heappush(heap, more << shift | h)
        return [x for x in ids if x >= 0]

    def encode(self, piece: bytes) -> list[int]:
        rank = self.rank(piece)
        return [rank] if rank is not None else self.merge(piece)


def pre_tokens(pattern: str):
    """The function that lists the matches of a pre-token pattern."""
    import regex

    return regex.compile(pattern).findall


class BytePairCodec:
    """Column functions that encode text to ids and decode ids to bytes.

    Null text or null ids encode and decode as empty; every text, also the longest, is taken
    whole. A null id or one outside the vocabulary fails the job.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        if (size := sum(map(len, ranks)) + 16 * len(ranks)) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"a vocabulary of {size} bytes is too large to send to every executor")
        self.pattern = pattern
        self.shared = spark.sparkContext.broadcast(Vocabulary(ranks))
        by_rank: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_rank[rank] = token
        self.tokens = spark.sparkContext.broadcast(pa.array(by_rank, pa.binary()))

    def encode(self, text: Column) -> Column:
        """Ids as ``array<int>``."""
        shared, pattern = self.shared, self.pattern

        @F.arrow_udf("array<int>")
        def encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            split, remembered = pre_tokens(pattern), shared.value.remembered
            remembered.vocabulary = shared.value
            for batch in released(texts):
                ids, ends = bytearray(), [0]
                for text in batch:
                    ids += b"".join(map(remembered.__getitem__, split(text.as_py() or "")))
                    ends.append(len(ids) // 4)
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(ids)])
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """The bytes of an id array as ``binary``."""
        tokens = self.tokens

        @F.arrow_udf("binary")
        def decoded(batch: pa.Array) -> pa.Array:
            return _joined(tokens.value, batch.flatten(), batch.offsets.to_numpy() - batch.offsets[0].as_py())

        return decoded(F.coalesce(ids, F.array().cast("array<int>")))


def _joined(tokens: pa.Array, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """The bytes of consecutive runs of ids, cut at the given ends: one take over the token table."""
    taken = tokens.take(ids)
    if taken.null_count:
        raise ValueError("an id is null or not in the vocabulary")
    places = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset:] if len(ids) else np.zeros(1, np.int32)
    offsets = places[ends]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), taken.buffers()[2] or pa.py_buffer(b"")])


def encode_documents(documents: DataFrame, codec: BytePairCodec) -> DataFrame:
    """The rows with ``ids`` (``array<int>``) and ``n_tokens``; columns of these names are replaced."""
    return documents.withColumn("ids", codec.encode("text")) \
        .withColumn("n_tokens", F.size("ids").cast("bigint"))


def round_trip(documents: DataFrame, codec: BytePairCodec) -> DataFrame:
    """The rows with ``packed``, ``n_tokens`` and ``decoded``: texts encoded, and their ids decoded again, in one pass.

    ``packed`` holds the ids as little-endian unsigned 32-bit integers, ``decoded`` the bytes
    that they stand for. Columns of these names are replaced. Output goes out in small batches,
    so a task holds the texts of one input batch and little else.
    """
    names = [c for c in documents.columns if c.lower() not in ("packed", "n_tokens", "decoded")]
    rows = documents.select(*[F.col(f"`{c}`") for c in names])
    kinds = T.StructType([*rows.schema.fields, T.StructField("packed", T.BinaryType()),
                          T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.BinaryType())])
    shared, tokens, pattern, at = codec.shared, codec.tokens, codec.pattern, [c.lower() for c in names].index("text")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, remembered = pre_tokens(pattern), shared.value.remembered
        remembered.vocabulary = shared.value
        for batch in released(batches):
            for start in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(start, OUTPUT_ROWS)
                packed = [b"".join(map(remembered.__getitem__, split(t.as_py() or ""))) for t in part.column(at)]
                sizes = np.array([len(p) // 4 for p in packed], np.int64)
                ids = pa.array(np.frombuffer(b"".join(packed), "<u4"))
                decoded = _joined(tokens.value, ids, np.concatenate(([0], np.cumsum(sizes))))
                more = [pa.array(packed, pa.binary()), pa.array(sizes), decoded]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "packed", "n_tokens", "decoded"])

    return rows.mapInArrow(coded, kinds)
