"""Temperature mixing of sources to target weights, with DataFrame functions only.

The share p of a source's tokens is raised to an exponent a in [0, 1] and normalised. A smaller
exponent gives flatter weights: more entropy, and more repetitions of small sources. Both are
monotone in the exponent, so it is bisected (``SECTIONS`` parts at a time, one small aggregate
each): the largest exponent whose entropy reaches the target, raised if need be until no source
is repeated more often than allowed. The limit wins over the target.

The weights are then realised under a token budget. Each source is dealt into blocks by a hash;
it is drawn in whole epochs as often as its quota holds, and one more epoch is cut: its blocks
follow in hashed order while they fit, and the block on the edge gives the documents of its own
hashed order that still fit. Only totals of blocks are ever ordered over a whole source; a
source with a third of all rows is many blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage

SECTIONS, ROUNDS = 16, 5
ENTROPY_SHARE, REPETITIONS, BLOCK_TOKENS, SEED = 0.998, 4.0, 1 << 20, 7
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Target entropy as a share of the largest possible one, and the most epochs of any source."""

    entropy_share: float = ENTROPY_SHARE
    repetitions: float = REPETITIONS
    budget: int | None = None  # tokens; the total of the input by default
    block_tokens: int = BLOCK_TOKENS
    seed: int = SEED


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def hashed(*parts: Column) -> Column:
    """60 bits of an MD5 over the parts: the same order in every engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _curve(shares: DataFrame, exponents: list[float], stretch: float) -> list[tuple[float, float, float]]:
    """(exponent, entropy, most repetitions) for each exponent; ``stretch`` is budget over total."""
    powered = shares.select("p", F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a")) \
        .withColumn("x", F.pow("p", "a"))
    rows = powered.groupBy("a").agg(
        F.sum("x").alias("z"), F.sum(F.col("x") * F.log("x")).alias("s"), F.max(F.col("x") / F.col("p")).alias("r"))
    return sorted((r.a, math.log(r.z) - r.s / r.z, stretch * r.r / r.z) for r in rows.collect())


def exponent(shares: DataFrame, mix: Mix, stretch: float) -> float:
    """The exponent for shares ``p`` that add up to 1; 1 where there is no source."""
    n = shares.count()
    if n == 0:
        return 1.0
    target = mix.entropy_share * math.log(n)

    def section(fits, rising: bool) -> float:
        """The last exponent that fits (rising: the first); the nearest end where none or all do."""
        low, high = 0.0, 1.0
        ends = {a: fits(h, r) for a, h, r in _curve(shares, [low, high], stretch)}
        if ends[low] == ends[high]:
            return high if ends[high] != rising else low
        for _ in range(ROUNDS):
            width = (high - low) / SECTIONS
            inner = _curve(shares, [low + width * i for i in range(1, SECTIONS)], stretch)
            before = [a for a, h, r in inner if fits(h, r) != rising]
            low = max(before, default=low)
            high = low + width
        return high if rising else low

    by_entropy = section(lambda h, r: h >= target - 1e-12, rising=False)
    by_limit = section(lambda h, r: r <= mix.repetitions + 1e-12, rising=True)
    return max(by_entropy, by_limit)


def source_plan(documents: DataFrame, mix: Mix, stage: Stage) -> DataFrame:
    """(source, tokens, weight, quota, epochs, rest, blocks) per source with tokens."""
    tokens = stage("sources", documents.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    budget = total if mix.budget is None else mix.budget
    shares = tokens.withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    a = exponent(shares, mix, budget / total if total else 0.0)
    norm = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    quota = F.floor(F.round(F.pow("p", F.lit(a)) / F.lit(norm) * F.lit(float(budget)), 3)).cast("bigint")
    return shares.select(
        "source", "tokens", (F.pow("p", F.lit(a)) / F.lit(norm)).alias("weight"), quota.alias("quota"),
        F.lit(budget).alias("budget")) \
        .withColumn("epochs", F.floor(F.col("quota") / F.col("tokens")).cast("bigint")) \
        .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")) \
        .withColumn("blocks", F.ceil(F.col("tokens") / F.lit(mix.block_tokens)).cast("bigint"))


def mixed(documents: DataFrame, stage: Stage, mix: Mix = Mix()) -> DataFrame:
    """The drawn rows of ``documents`` (doc_id, source, n_tokens and others) with ``epoch`` and ``block``.

    A row comes once per epoch that draws it, numbered from 0. Each source gets at most its
    quota: its whole epochs, and from one more epoch the longest prefix of its order that fits.
    A null source is a source of its own. Rows without tokens (null or 0) have no weight and are
    never drawn. Rows with equal doc_id in one block follow in order of their tokens, then
    arbitrarily; equal rows are drawn each. Columns ``epoch`` and ``block`` are replaced. An
    empty table gives an empty result. The number of sources may grow; no source is collected.
    """
    passed = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in ("epoch", "block")]
    plan = stage("plan", source_plan(documents, mix, stage))
    seed = F.lit(mix.seed)
    rows = documents.where("n_tokens > 0") \
        .select(F.struct(*passed).alias("row"), F.col("source").alias("s"), F.col("doc_id").alias("d"), F.col("n_tokens").alias("n")) \
        .join(plan.select("source", "epochs", "rest", "blocks"), F.col("s").eqNullSafe(F.col("source"))) \
        .withColumn("block", F.pmod(hashed(seed, F.lit("block"), F.col("d")), F.col("blocks")))

    totals = stage("blocks", rows.groupBy("s", "rest", "epochs", "block").agg(F.sum("n").alias("held")))
    order = Window.partitionBy("s").orderBy(hashed(seed, F.col("epochs"), F.col("s"), F.col("block")), "block")
    cut = totals.withColumn("left", F.col("rest") - F.sum("held").over(order) + F.col("held")) \
        .where("left > 0").select(F.col("s").alias("of"), F.col("block").alias("at"), "left", "held")

    placed = rows.join(cut, F.col("s").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left")
    whole = F.when(F.col("left") >= F.col("held"), F.col("epochs") + 1).otherwise(F.col("epochs"))
    full = placed.where("epochs > 0 or left >= held") \
        .select("row", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("epoch"), "block")
    inside = Window.partitionBy("of", "at").orderBy(hashed(seed, F.col("epochs"), F.col("d")), "d", "n") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.where("left < held").withColumn("sofar", F.sum("n").over(inside)) \
        .where("sofar <= left").select("row", F.col("epochs").alias("epoch"), "block")
    return full.union(edge).select("row.*", "epoch", "block")
