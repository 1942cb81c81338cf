"""Identifiers, amounts and files beyond the usual sizes keep their values or fail loudly."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS
from forecourt.functions import parsing
from forecourt.functions.keys import snapshot_key, surrogate_key
from forecourt.operators import clean, profile
from forecourt.sources import files


def test_prefixes_do_not_share_keys(spark):
    ids = ["EMP000001", "STF000001", "EMP000002", "AAA000001", "ZZZ99999999999999", "EMP123456789012345678", "x", "y", "", None]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select(
        "id", surrogate_key("id", "EMP").alias("k"), snapshot_key("id", F.lit(20240131), "EMP").alias("s")).collect()
    keys = {r.id: r.k for r in rows}
    assert keys["EMP000001"] == 1 and keys["EMP000002"] == 2 and keys[None] is None
    assert len({r.k for r in rows}) == len(ids) and len({r.s for r in rows if r.id is not None}) == len(ids) - 1
    assert {r.id: int(r.s) for r in rows if r.id}["EMP000001"] == 120240131


def cleaned(spark, sample, **changes):
    tables = {n: f for n, f in sample.items()}
    tables["sales"] = tables["sales"].withColumns({c: F.lit(v) for c, v in changes.items()})
    return clean.clean_datasets(tables)


def test_large_amounts_are_never_lost(spark, sample):
    with pytest.raises(Exception, match="sales.list_price holds a number outside"):
        cleaned(spark, sample, list_price="1500000000000.00")[1].collect()
    assert cleaned(spark, sample, list_price="no number")[1].where("action = 'invalid number coerced to null'").count() == 1


def test_small_fractions_reach_the_whole_number_guard(spark, sample):
    tables = dict(sample)
    tables["vehicles"] = tables["vehicles"].withColumn("model_year", F.lit("2020.0000001"))
    out = clean.clean_datasets(tables)[0]["vehicles"]
    assert out.select(F.col("model_year") % 1 == 0).distinct().collect() == [(False,)]


def test_large_wrong_sales_are_seen(spark, sample):
    wrong = sample["sales"].withColumns({"list_price": F.lit("300000000000000.00"), "discount_amount": F.lit("0"),
                                         "sale_price": F.lit("100000000000000.00")})
    report = profile.validation_report({**sample, "sales": wrong})
    row = report.where("check = 'sale_price equals list_price minus discount'").first()
    assert row.status == "FAIL" and row.invalid_count == wrong.count()


def test_files_in_pieces_have_the_same_digest(spark, sample, tmp_path):
    files.write_datasets({n: sample[n] for n in DATASETS}, str(tmp_path))
    whole, pieces = files.input_manifest(spark, str(tmp_path)), files.input_manifest(spark, str(tmp_path), 10)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.collect())) and whole.count() > 0


def test_pointer_is_replaced_at_once(spark, tmp_path):
    from forecourt.sources.store import TableStore

    for _ in range(2):
        store = TableStore.create(spark, str(tmp_path), {"sales": 3})
        store.publish(["dim_date"])
        found, tables = TableStore.current(spark, str(tmp_path))
        assert (found.version, tables, found.row_counts) == (store.version, ["dim_date"], {"sales": 3})
    assert [p.name for p in tmp_path.iterdir() if p.name.endswith(".json")] == ["current.json"]


def test_lost_rows_between_source_and_staging_stop_the_load(sample):
    counts = {name: frame.count() for name, frame in sample.items()}
    files.require_staged_rows(counts, sample)
    with pytest.raises(files.SourceError, match="sales 50 / 49"):
        files.require_staged_rows(counts, {**sample, "sales": sample["sales"].limit(49)})


def test_numbers_are_tried_only_where_a_cast_can_succeed(spark):
    """The guard changes no result: every text that a cast takes passes it; names, dates, times and phone numbers do not."""
    texts = ["1", " 1.5 ", "-2", "+3", ".5", "5.", "1e-3", "1E+3", "-1.5e-07", "0x1p-3", "1d", "2.5F", "inf", "-Infinity", "NaN", "\t7\n", "00123",
             "", " ", None, "x", "INV000001", "Name", "1996-01-02", "12:30:00", "555-0123", "1-2", "1e5-", "--1", "1 2", "1,000", "infant", "e5", "-", "१२", "1" * 20_000 + "-", "9-" * 9_000]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.col("t").try_cast("double")
    exact = F.coalesce(F.col("t").try_cast("decimal(38,10)"), F.col("t").try_cast("double").try_cast("decimal(38,10)"))
    rows = frame.select("t", parsing.number(F.col("t")).alias("n"), F.when(~F.isnan(plain), plain).alias("n0"),
                        parsing.amount(F.col("t")).alias("a"), exact.alias("a0"), F.col("t").rlike(parsing.NUMERIC_FORM).alias("tried")).collect()
    assert [r.t for r in rows if r.n != r.n0 or r.a != r.a0] == [] and sum(r.n is not None for r in rows) >= 15
    assert not any(r.tried for r in rows if r.t in ("INV000001", "Name", "1996-01-02", "12:30:00", "555-0123"))


def test_row_rules_are_compiled(spark, sample):
    """No lambda over the rules, which Spark would interpret for every row."""
    frame, contract = sample["inventory"], DATASETS["inventory"]
    plan = profile._row_problems("inventory", frame, profile._row_checks(contract, frame))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_profile_parses_its_files_once(spark, sample, tmp_path, monkeypatch):
    files.write_datasets({n: sample[n] for n in DATASETS}, str(tmp_path / "in"))
    seen, real = [], files.validation_report
    monkeypatch.setattr(files, "validation_report", lambda datasets: seen.append(datasets) or real(datasets))
    files.profile_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert len(seen[0]) == len(DATASETS)
    assert all("/stages-" in f.inputFiles()[0] for f in seen[0].values())
