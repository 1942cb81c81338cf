"""Conversation repair against an edit search over whole conversations, and its SQL twin."""

from __future__ import annotations

import hashlib
import heapq
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from forecourt.llm import dialogue, oracle, queries
from conftest import SF

NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("folder", [SF, SF.replace("0.001", "0.1")])
def test_twin(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = sorted(con.sql(f"SELECT {', '.join(NAMES)} FROM ({oracle.OP12})").fetchall())
    assert sorted(map(tuple, queries.conversation_repair(spark, folder).select(*NAMES).collect())) == want


def searched(rows):
    """(cost, audit, repaired) of rows (role, must go, cut, text) by search over edits in order of (cost, audit)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        if (i, last) in done:
            continue
        done.add((i, last))
        for letter, role in (("u", "user"), ("a", "assistant")):
            if letter in after[last]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, letter, (*out, (role, ""))))
                if i < len(rows) and not rows[i][1]:
                    heapq.heappush(heap, (cost + 2 + rows[i][2], audit + "R", i + 1, letter, (*out, (role, rows[i][3]))))
        if i < len(rows):
            role, gone, cut, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if not gone and role[:1] and role[:1] in after[last]:
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role[0], (*out, (role, text))))


def expected(rows):
    """The result for one conversation of (turn, role, text), sorted."""
    seen, faulty, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        faulty.append((role, fault in ("blank", "duplicate"), int(fault == "truncated"), text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = searched(faulty)
    return dict(gaps=gaps, **counts, illegal=illegal, cost=cost, audit=audit), out


ROLES, TEXTS = ["user", "assistant", "system", "tool", "User", "", "usurper", "sales", " "], ["Yes.", "No", "", " \n", "Why? ", "a. b", "Ünï!\v", "\xa0"]


def random_rows(rng, n, turns):
    rows = [(rng.choice([None, *range(turns)]) if rng.random() < .2 else i, rng.choice(ROLES[:3] if rng.random() < .8 else ROLES),
             rng.choice(TEXTS) if rng.random() < .5 else f"t{rng.randrange(9 * n)}.") for i in range(n)]
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))


def test_cells_as_search():
    rng = random.Random(4)
    for n in [*range(12)] * 60:
        rows = [(rng.choice(["s", "u", "a", "o"]), rng.random() < .15, int(rng.random() < .2), "") for _ in range(n)]
        tokens = "".join("x" if gone else role.upper() if cut else role for role, gone, cut, _ in rows)
        spans = dialogue.Spans()
        spans.push(tokens)
        cells = spans.cells()
        got = min(cells[i] for i in dialogue.ACCEPTED if cells[i]) if cells else (0, "")
        assert got == searched(rows)[:2], tokens


def test_splits_agree():
    rng = random.Random(8)
    for _ in range(200):
        tokens = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(2, 7)))
        k = rng.randint(1, len(tokens) - 1)
        assert dialogue.joined(dialogue.parsed(tokens[:k]), dialogue.parsed(tokens[k:])) == dialogue.parsed(tokens)


def test_repaired_turns(spark):
    rng = random.Random(1)
    made = {c: random_rows(rng, rng.randint(1, 14), 6) for c in [*range(60), None]}
    made[7] = random_rows(rng, 900, 900)  # one long conversation beside the short ones, over several tasks
    made[8] = [(t, "user", "Same.") for t in range(300)]
    rows = [(c, t, r, x, 1) for c, conv in made.items() for t, r, x in conv]
    rng.shuffle(rows)
    rows += [(500, 1, "user", "Dropped.", 0), (0, 99, "user", "Dropped.", 0)]
    frame = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string, copies int").withColumn("audit", F.lit(1))
    out = dialogue.repair(frame)
    got: dict = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == {*made, 500}
    for c, conv in made.items():
        report, turns = expected(conv)
        head, *rest = sorted(got[c], key=lambda r: r.at)
        assert head.report.asDict() == report, c
        assert [(r.role, r.text) for r in rest] == turns and [r.at for r in rest] == list(range(1, len(rest) + 1))
        assert "".join(r.edit for r in rest) == report["audit"].replace("D", "")
    assert len(got[500]) == 1 and got[500][0].report.audit == "" and got[500][0].report.cost == 0
    lines = {r.conv_id: r.repaired_sha256 for r in dialogue.digests(out).collect()}
    for c, conv in made.items():
        said = "\n".join(f"{role}:{text}" for role, text in expected(conv)[1])
        assert lines[c] == hashlib.sha256(said.encode()).hexdigest()
    assert lines[500] == hashlib.sha256(b"").hexdigest()


def test_long_conversation_is_parsed_by_several_tasks(spark):
    frame = spark.range(4000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.concat(F.lit("Text "), "id", F.lit(".")).alias("text"), F.lit(1).alias("copies"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert dialogue.runs(frame).select("task").distinct().count() > 1
        assert dialogue.repair(frame).where("at = 0").first().report.audit == "K" * 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_damage_and_nulls(spark):
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 1, None, "Hi."), (1, None, "system", "Be nice."), (2, 5, "user", "x" * 300_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {"copies": F.lit("own"), "digest": F.lit(1), "report": F.lit(2)})
    out = dialogue.digests(dialogue.repair(dialogue.damage(frame))).collect()
    assert {r.conv_id for r in out} == {None, 1, 2}
    con = duckdb.connect()
    con.register("conversations", frame.select("conv_id", "turn", "role", "text").toArrow())
    want = con.sql(f"SELECT {', '.join(NAMES)} FROM ({oracle.OP12})").fetchall()
    got = [(r.conv_id, *(r.report[n] for n in NAMES[1:-1]), r.repaired_sha256) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert dialogue.digests(dialogue.repair(dialogue.damage(frame.limit(0)))).count() == 0
