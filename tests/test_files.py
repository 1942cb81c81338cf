"""Files in and out, sample data, the gated run, and pages."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS
from forecourt.functions.keys import key_date, date_key, surrogate_key
from forecourt.functions.parsing import instant
from forecourt.operators import profile
from forecourt.operators.scoring import CheckFailure
from forecourt.plans import pages
from forecourt.plans.run import clean_folder, load_folder
from forecourt.plans.warehouse import Warehouse
from forecourt.sources import files
from forecourt.sources.generate import SampleConfig, generate_datasets


@pytest.fixture(scope="module")
def folder(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    for name, frame in sample.items():
        frame.coalesce(1).write.option("header", True).csv(f"{path}/{name}.csv")
    return path


def changed(sample, tmp_path, dataset, edit):
    for name, frame in sample.items():
        (edit(frame) if name == dataset else frame).coalesce(1).write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    return str(tmp_path)


def test_preflight_counts(spark, folder):
    counts = files.preflight(spark, folder)
    assert sum(counts.values()) == 332


def test_missing_folder_and_dataset(spark, tmp_path, sample):
    with pytest.raises(files.SourceError, match="no CSV files"):
        files.load_datasets(spark, str(tmp_path))
    sample["sales"].write.option("header", True).csv(f"{tmp_path}/sales.csv")
    with pytest.raises(files.SourceError, match="missing dataset files"):
        files.preflight(spark, str(tmp_path))


@pytest.mark.parametrize(("value", "ok"), [("0.0", True), ("0.5", False), ("2147483648", False), ("inf", False), ("-1", False)])
def test_whole_numbers(sample, value, ok):
    vehicles = sample["vehicles"].withColumn("mileage_at_acquisition", F.lit(value))
    row = files.whole_number_errors({**sample, "vehicles": vehicles}).where("column = 'vehicles.mileage_at_acquisition'").first()
    assert (row["invalid_count"] == 0) is ok


def test_dropped_column_breaks_the_contract(spark, sample, tmp_path):
    path = changed(sample, tmp_path, "customers", lambda f: f.drop("phone"))
    with pytest.raises(files.SourceError, match="staging contract"):
        files.preflight(spark, path)


def test_manifest_notices_changes(spark, sample, tmp_path):
    path = changed(sample, tmp_path, None, None)
    files.input_manifest(spark, path).write.parquet(f"{tmp_path}/manifest")
    manifest = spark.read.parquet(f"{tmp_path}/manifest")
    assert manifest.count() == 8
    files.require_unchanged(spark, path, manifest)
    sample["sales"].limit(10).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/sales.csv")
    with pytest.raises(files.SourceError, match="sales"):
        files.require_unchanged(spark, path, manifest)


def test_clean_load_publish_and_failed_gate(spark, folder, sample, tmp_path):
    cleaned, audit = clean_folder(spark, folder, f"{tmp_path}/clean")
    assert set(cleaned) == set(DATASETS) and spark.read.option("header", True).csv(audit).count() == 0
    root = f"{tmp_path}/warehouse"
    result = load_folder(spark, f"{tmp_path}/clean", root)
    assert sum(result.source_rows.values()) == 332 and result.quality_checks == 28
    published = Warehouse.current(spark, root)
    assert published.table("fact_sales").count() == 50 and published.table("customer_detail").count() == 40

    with pytest.raises(CheckFailure, match="future"):
        load_folder(spark, f"{tmp_path}/clean", root, as_of="2000-01-01")
    assert Warehouse.current(spark, root).table("fact_sales").inputFiles() == published.table("fact_sales").inputFiles()


def test_profile_reports_are_written(spark, folder, tmp_path):
    manifest = files.profile_folder(spark, folder, str(tmp_path))
    assert manifest["passed"] and manifest["rows_profiled"] == 332 and manifest["datasets_profiled"] == 8
    assert spark.read.option("header", True).csv(manifest["reports"]["column_profile"]).count() == 83


def test_profile_checks_run_once(spark, sample, tmp_path, monkeypatch):
    one = {"dealerships": sample["dealerships"]}
    files.write_datasets(one, f"{tmp_path}/plain")
    read = []
    monkeypatch.setattr(files, "summary", lambda datasets, *checks: read.extend(checks) or profile.summary(datasets, *checks))
    files.profile_folder(spark, f"{tmp_path}/plain", f"{tmp_path}/reports")
    assert len(read) == 2
    assert not any(f"{tmp_path}/plain" in path for frame in read for path in frame.inputFiles())


# -- sample data ----------------------------------------------------------------------------
@pytest.mark.parametrize("bad", [
    {"customers": 0}, {"vehicles": 10}, {"service_orders": 20_000}, {"employees": 20},
    {"start_date": date(2030, 1, 1)}])
def test_sample_config_is_validated(bad):
    with pytest.raises(ValueError):
        SampleConfig(**bad).validate()


def test_sample_is_reproducible_and_follows_the_rules(spark, sample):
    config = SampleConfig(customers=40, vehicles=80, dealerships=2, employees=20, sales=50, inventory=30,
                          service_appointments=60, service_orders=50)
    again = generate_datasets(spark, config)
    for name, contract in DATASETS.items():
        assert sample[name].exceptAll(files.as_file_text(contract, again[name])).count() == 0, name
    other = generate_datasets(spark, SampleConfig(**{**config.__dict__, "seed": 7}))
    assert sample["sales"].exceptAll(files.as_file_text(DATASETS["sales"], other["sales"])).count() > 0
    sold, stock = again["sales"].select("vehicle_id"), again["inventory"].select("vehicle_id")
    assert sold.intersect(stock).count() == 0
    early = again["sales"].join(again["customers"], "customer_id").where("sale_date < customer_since_date")
    assert early.count() == 0
    staff = again["employees"].select("employee_id", "role", F.col("dealership_id").alias("home"))
    wrong = again["sales"].join(staff, F.col("salesperson_id") == F.col("employee_id")) \
        .where("role <> 'Sales Consultant' OR home <> dealership_id")
    assert wrong.count() == 0
    assert again["vehicles"].where("length(vin) <> 17").count() == 0


# -- pages -------------------------------------------------------------------------------------
def test_page_envelope_and_limits(loaded):
    got = pages.fetch(loaded, "sales", limit=3, offset=2)
    assert (got["limit"], got["offset"], got["returned"], len(got["items"])) == (3, 2, 3, 3)
    assert tuple(got["items"][0]) == pages.SALES_FIELDS
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(pages.QueryError):
            pages.page(loaded, "sales", **bad)


@pytest.mark.parametrize(("name", "filters"), [
    ("sales_performance", {"date_from": date(2024, 2, 1), "date_to": date(2024, 1, 1)}),
    ("sales_performance", {"payment_type": "Barter"}),
    ("sales", {"brand": "X"}),
    ("customer_value", {"minimum_value": Decimal(-1)}),
])
def test_bad_filters_are_rejected(loaded, name, filters):
    with pytest.raises(pages.QueryError):
        pages.page(loaded, name, **filters)


def test_keyset_page_equals_offset_page(loaded):
    first = pages.page(loaded, "inventory_slow_moving", limit=40).collect()
    by_offset = pages.page(loaded, "inventory_slow_moving", limit=40, offset=40).collect()
    last = first[-1]
    by_key = pages.page(loaded, "inventory_slow_moving", limit=40,
                        after=(last["days_in_inventory"], last["inventory_id"], last["snapshot_date"])).collect()
    assert by_key == by_offset


def test_empty_summary_has_zero_totals_and_null_ratios(loaded):
    row = pages.sales_summary(loaded, brand="nobody").first()
    assert (row["sales_transactions"], row["revenue"], row["gross_margin_percent"]) == (0, 0, None)
    row = pages.service_revenue(loaded, dealership_id="nowhere").first()
    assert (row["appointments"], row["service_revenue"], row["average_repair_order"]) == (0, 0, None)


# -- small functions ------------------------------------------------------------------------------
def test_keys(spark):
    rows = spark.sql("SELECT * FROM VALUES ('CUS000012'), ('CUS1234567'), ('CUS12'), ('x'), (NULL) AS t(id)") \
        .select(surrogate_key("id").alias("k")).collect()
    assert [r["k"] for r in rows[:2]] == [12, 1234567] and all(r["k"] < 0 for r in rows[2:4]) and rows[4]["k"] is None
    day = spark.sql("SELECT DATE '2024-02-29' AS d").select(date_key("d").alias("k")).select("k", key_date("k").alias("d")).first()
    assert (day["k"], day["d"]) == (20240229, date(2024, 2, 29))


@pytest.mark.parametrize(("text", "expected"), [
    ("2024-01-05", "2024-01-05 00:00:00"), ("2024-01-05 10:11:12", "2024-01-05 10:11:12"), ("1/5/2024", "2024-01-05 00:00:00"),
    ("2024/01/05", "2024-01-05 00:00:00"), ("5-Jan-2024", "2024-01-05 00:00:00"), ("January 5, 2024", "2024-01-05 00:00:00"),
    ("31/31/2024", None), ("not-a-date", None)])
def test_dates_in_several_layouts(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(instant(F.col("t")).alias("d")).first()["d"]
    assert (None if got is None else str(got)) == expected


# -- physical plans ----------------------------------------------------------------------------------
def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_grouped_sales_views_shuffle_only_groups(loaded):
    """The exact distinct count uses the buckets: one exchange, of partial groups, and no join."""
    from forecourt.plans import sales

    for view in sales.GROUPED:
        plan = plan_of(sales.grouped(loaded, view))
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, view
        assert "Bucketed: true" in plan, view


def test_orders_join_appointments_without_shuffling_them(spark, loaded):
    visits = loaded.table("service_appointments").select("appointment_id", "service_type")
    orders = loaded.table("fact_service").select("appointment_id", "service_revenue")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(visits.join(orders, "appointment_id", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_stock_meets_its_vehicles_without_being_shuffled(spark, loaded):
    from forecourt.plans import sales

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(loaded.table("fact_inventory").join(sales.vehicle_attributes(loaded), "vehicle_key"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_filters_and_columns_reach_the_scan(spark, loaded):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(pages.sales_summary(loaded, date_from=date(1996, 1, 1), payment_type="Cash"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(payment_type,Cash)" in plan and "GreaterThanOrEqual(sale_date,1996-01-01)" in plan
    assert "ReadSchema: struct<sale_date:date,payment_type:string" in plan and "customer_key" not in plan
