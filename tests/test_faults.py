"""One fault at a time: cleaning repairs or removes it, and the right checks notice it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS
from forecourt.operators import profile, quality, reconcile
from forecourt.operators.clean import clean_datasets, cleaning, require_clean
from forecourt.operators.constraints import require_constraints, violations
from forecourt.operators.scoring import CheckFailure, require_all_pass
from forecourt.plans import customer
from forecourt.plans.warehouse import DETAILS, DIMENSIONS, FACTS, Warehouse


def with_fault(sample, dataset, column, value, where):
    frame = sample[dataset]
    changed = frame.withColumn(column, F.when(F.expr(where), F.lit(value)).otherwise(F.col(column)))
    return {**sample, dataset: changed}


@pytest.fixture(scope="module")
def faulty(sample):
    tables = with_fault(sample, "customers", "first_name", "  Pat ", "customer_id = 'CUS000001'")
    tables = with_fault(tables, "customers", "customer_type", " individual ", "customer_id = 'CUS000001'")
    tables["customers"] = tables["customers"].unionByName(tables["customers"].where("customer_id = 'CUS000002'"))
    tables = with_fault(tables, "vehicles", "manufacturer_msrp", "not-a-number", "vehicle_id = 'VEH000080'")
    tables = with_fault(tables, "sales", "gross_profit", "999999", "sale_id = 'SAL000001'")
    tables = with_fault(tables, "sales", "customer_id", "CUS999999", "sale_id = 'SAL000002'")
    tables = with_fault(tables, "inventory", "days_in_inventory", "-5", "inventory_id = 'INV000001'")
    tables = with_fault(tables, "service_orders", "customer_id", "CUS000003", "service_order_id = 'SRO000001'")
    tables = with_fault(tables, "service_appointments", "appointment_date", "no date", "appointment_id = 'APT000005'")
    return with_fault(tables, "employees", "dealership_id", "DLR999", "employee_id = 'EMP000020'")


@pytest.fixture(scope="module")
def cleaned(faulty):
    return clean_datasets(faulty)


def ids(frame, column, value):
    return frame.where(F.col(column) == value).count()


def test_values_are_standardized(cleaned):
    row = cleaned[0]["customers"].where("customer_id = 'CUS000001'").first()
    assert (row["first_name"], row["customer_type"]) == ("Pat", "Individual")
    assert ids(cleaned[0]["customers"], "customer_id", "CUS000002") == 1


def test_bad_rows_are_removed(cleaned):
    tables, _ = cleaned
    for dataset, column, value in (("vehicles", "vehicle_id", "VEH000080"), ("sales", "sale_id", "SAL000002"),
                                   ("inventory", "inventory_id", "INV000001"), ("employees", "employee_id", "EMP000020"),
                                   ("service_appointments", "appointment_id", "APT000005"),
                                   ("service_orders", "appointment_id", "APT000005")):
        assert ids(tables[dataset], column, value) == 0, dataset


def test_derived_values_are_recomputed(cleaned):
    sale = cleaned[0]["sales"].where("sale_id = 'SAL000001'").first()
    assert sale["gross_profit"] == sale["sale_price"] - sale["vehicle_cost"]
    order = cleaned[0]["service_orders"].where("service_order_id = 'SRO000001'").first()
    visit = cleaned[0]["service_appointments"].where("appointment_id = 'APT000001'").first()
    assert order["customer_id"] == visit["customer_id"]


def test_cleaned_data_passes_the_gate(cleaned):
    require_clean(cleaned[0])


def test_audit_holds_only_actions_that_happened(cleaned):
    audit = {(r["dataset"], r["action"]): r["affected_rows"] for r in cleaned[1].collect()}
    assert audit[("customers", "removed duplicate rows")] == 1
    assert audit[("sales", "recalculated gross_profit")] == 1
    assert min(audit.values()) > 0


def test_first_of_two_rows_with_one_key_wins(spark):
    rows = spark.createDataFrame(
        [("DLR001", "Second", 2), ("DLR001", "First", 1), ("DLR001", "First", 3)],
        "dealership_id string, dealership_name string, _row_order int")
    full = rows.select("dealership_id", "dealership_name", *[F.lit("x").alias(c) for c in ("city", "state", "postal_code", "region")],
                       F.lit("2020-01-01").alias("opened_date"), "_row_order")
    tables, audit = clean_datasets({"dealerships": full})
    assert [r["dealership_name"] for r in tables["dealerships"].collect()] == ["First"]
    counts = {r["action"]: r["affected_rows"] for r in audit.collect()}
    assert counts["removed duplicate rows"] == 1 and counts["removed duplicate primary keys"] == 1


def failed(report, key):
    return {r[key] for r in report.where("status = 'FAIL'").collect()}


def test_clean_sample_passes_every_report(sample):
    assert failed(profile.validation_report(sample), "check") == set()
    assert failed(profile.foreign_key_report(sample), "child_column") == set()


def test_orphan_customer_is_reported(sample):
    broken = with_fault(sample, "sales", "customer_id", "CUS-LOST", "sale_id = 'SAL000003'")
    row = profile.foreign_key_report(broken).where("status = 'FAIL'").first()
    assert (row["child_dataset"], row["child_column"], row["orphan_count"], row["details"]) == ("sales", "customer_id", 1, "CUS-LOST")


def test_negative_profit_and_repeated_key_fail_three_checks(sample):
    broken = with_fault(sample, "sales", "gross_profit", "-1", "sale_id = 'SAL000004'")
    broken = with_fault(broken, "sales", "sale_id", "SAL000006", "sale_id = 'SAL000005'")
    assert failed(profile.validation_report({"sales": broken["sales"]}), "check") - {"required dataset exists"} == {
        "gross_profit is nonnegative numeric", "gross_profit equals sale_price minus vehicle_cost", "sale_id is unique"}


def test_unparseable_date_is_counted(sample):
    broken = with_fault(sample, "inventory", "acquired_date", "not-a-date", "inventory_id = 'INV000002'")
    row = profile.validation_report({"inventory": broken["inventory"]}) \
        .where("check = 'acquired_date contains valid dates'").first()
    assert (row["invalid_count"], row["status"], row["examples"]) == (1, "FAIL", "not-a-date")


def test_missing_dataset_and_columns(sample):
    partial = {"sales": sample["sales"].drop("sale_id", "sale_date")}
    checks = failed(profile.validation_report(partial), "check")
    assert {"required dataset exists", "primary key column sale_id exists", "sale_date exists"} <= checks
    assert {r["status"] for r in profile.foreign_key_report(partial).collect()} == {"NOT_CHECKED"}


# -- warehouse checks -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def w(sample):
    lazy = Warehouse(sample)
    return Warehouse({**sample, **{n: lazy.table(n).cache() for n in (*DIMENSIONS, *FACTS, *DETAILS)}})


def test_generated_warehouse_passes_every_gate(w):
    require_constraints(w)
    assert reconcile.require_all_suites(w) == 28 + 33 + 6 + 29 + 20 + 12 + 16


BREAKS = [
    ("fact_sales", {"sale_price": "CAST(-5 AS DECIMAL(14,2))"}, {"dq_24", "dq_27"}),
    ("fact_sales", {"unit_quantity": "CAST(-1 AS SMALLINT)"}, {"dq_19"}),
    ("fact_sales", {"customer_key": "CAST(NULL AS BIGINT)"}, {"dq_09", "dq_13"}),
    ("fact_sales", {"vehicle_key": "CAST(-7 AS BIGINT)"}, {"dq_13"}),
    ("fact_sales", {"dealership_key": "dealership_key % 2 + 1"}, {"dq_16"}),
    ("fact_sales", {"sale_id": "'SAL000001'"}, {"dq_06"}),
    ("fact_inventory", {"days_in_inventory": "days_in_inventory + 1"}, {"dq_22"}),
    ("fact_inventory", {"carrying_cost": "CAST(-1 AS DECIMAL(14,2))"}, {"dq_25"}),
    ("fact_inventory", {"vehicle_key": "CAST(1 AS BIGINT)", "dealership_key": "CAST(1 AS BIGINT)"}, {"dq_07"}),
    ("fact_service", {"completed_at": "opened_at - INTERVAL '1' DAY"}, {"dq_23"}),
    ("fact_service", {"service_revenue": "CAST(-1 AS DECIMAL(14,2))"}, {"dq_26", "dq_28"}),
    ("fact_service", {"technician_key": "service_advisor_key"}, {"dq_17"}),
    ("fact_service", {"appointment_id": "'APT000001'"}, {"dq_08"}),
    ("dim_customer", {"customer_since_date": "DATE '2999-01-01'"}, {"dq_20"}),
    ("dim_customer", {"customer_id": "'CUS000001'"}, {"dq_01"}),
    ("dim_vehicle", {"vin": "'SAME'"}, {"dq_02"}),
    ("dim_employee", {"dealership_key": "CAST(99 AS BIGINT)"}, {"dq_12", "dq_16", "dq_17"}),
    ("service_orders", {"vehicle_id": "'VEH000009'"}, {"dq_18"}),
]


@pytest.mark.parametrize(("table", "changes", "expected"), BREAKS, ids=[f"{t}-{'-'.join(c)}" for t, c, _ in BREAKS])
def test_quality_checks_notice(w, table, changes, expected):
    broken = w.table(table).withColumns({c: F.expr(e) for c, e in changes.items()})
    faulty = w.replace(**{table: broken})
    for check_id in expected:
        row = quality.check(faulty, check_id).first()
        assert row["status"] == "FAIL" and row["failed_count"] > 0, check_id


def more_dq(w):
    """Breaks that change rows rather than values."""
    return {
        "dq_03": {"dim_employee": w.table("dim_employee").withColumn("employee_id", F.lit("EMP000001"))},
        "dq_04": {"dim_dealership": w.table("dim_dealership").withColumn("dealership_id", F.lit("DLR001"))},
        "dq_05": {"dim_service": w.table("dim_service").unionByName(w.table("dim_service"))},
        "dq_10": {"fact_inventory": w.table("fact_inventory").withColumn("vehicle_key", F.lit(None).cast("bigint"))},
        "dq_11": {"fact_service": w.table("fact_service").withColumn("technician_key", F.lit(None).cast("bigint"))},
        "dq_14": {"dim_vehicle": w.table("dim_vehicle").limit(1)},
        "dq_15": {"dim_customer": w.table("dim_customer").limit(1)},
    }


@pytest.mark.parametrize("check_id", ["dq_03", "dq_04", "dq_05", "dq_10", "dq_11", "dq_14", "dq_15"])
def test_quality_checks_notice_rows(w, check_id):
    assert quality.check(w.replace(**more_dq(w)[check_id]), check_id).first()["status"] == "FAIL"


def model_breaks(w):
    sold, stock, visits, days = (w.table(n) for n in ("sales_detail", "inventory_detail", "service_detail", "dim_date"))
    return {
        "dimension_key_uniqueness": {"dim_vehicle": w.table("dim_vehicle").unionByName(w.table("dim_vehicle").limit(1))},
        "fact_grain_uniqueness": {"sales_detail": sold.unionByName(sold.limit(2))},
        "required_foreign_keys_and_role_alignment": {"sales_detail": sold.withColumn("salesperson_key", F.lit(999999).cast("bigint"))},
        "inventory_composite_grain": {"inventory_detail": stock.unionByName(stock.limit(2))},
        "repair_order_unique_within_appointments": {"service_detail": visits.withColumn(
            "service_order_id", F.when(F.col("service_order_id").isNotNull(), F.lit("SRO000001")))},
        "service_status_enrichment_preserves_grain": {"fact_service": w.table("fact_service").unionByName(w.table("fact_service"))},
        "appointments_not_lost": {"service_detail": visits.where("appointment_id <> 'APT000001'")},
        "sales_eligible_rows_preserved": {"sales_detail": sold.where("sale_id <> 'SAL000001'")},
        "inventory_rows_preserved": {"inventory_detail": stock.where("inventory_id <> 'INV000001'")},
        "calendar_source_unique_contiguous": {"dim_date": days.where("full_date <> (DATE '2024-03-05')")},
        "calendar_bounds_available": {n: w.table(n).limit(0) for n in ("dim_date", "fact_service", "dim_customer")},
        "date_key_matches_date": {"dim_date": days.withColumn("date_key", F.col("date_key") + 1)},
        "signed_return_values": {"sales_detail": sold.withColumn("units_sold", F.lit(-1).cast(sold.schema["units_sold"].dataType))},
        "slow_moving_and_bucket_boundaries": {"inventory_detail": stock.withColumn("is_slow_moving", ~F.col("is_slow_moving"))},
    }


def test_model_checks_notice(w):
    for name, changes in model_breaks(w).items():
        row = reconcile.model_checks(w.replace(**changes), only=name).first()
        assert (row["status"], row["failed_count"] > 0) == ("FAIL", True), name


def test_future_dates_depend_on_the_reporting_day(w):
    assert quality.check(w, "dq_21", as_of="2000-01-01").first()["status"] == "FAIL"
    assert quality.check(w, "dq_21", as_of="2100-01-01").first()["status"] == "PASS"


def test_reconciliation_notices_lost_and_repeated_rows(w):
    lost = w.replace(sales_detail=w.table("sales_detail").where("sale_id <> 'SAL000001'"))
    assert "detail_vs_fact_row_count" in failed(reconcile.sales_checks(lost), "check_name")
    doubled = w.replace(service_detail=w.table("service_detail").unionByName(w.table("service_detail").limit(3)))
    assert "detail_appointment_uniqueness" in failed(reconcile.service_checks(doubled), "check_name")
    stock = w.table("inventory_detail").withColumn("aging_bucket", F.lit("0-30"))
    assert "aging_bucket_assignment" in failed(reconcile.inventory_checks(w.replace(inventory_detail=stock)), "check_name")
    people = w.table("customer_detail").withColumn("lifecycle_segment", F.lit("Prospect"))
    assert "lifecycle_segments_are_exclusive" in failed(
        reconcile.customer_checks(w.replace(customer_detail=people)), "check_name")
    cost = w.table("service_detail").withColumn("service_cost", F.lit(1).cast("decimal(16,2)"))
    faulty = w.replace(service_detail=cost)
    assert "service_cost_not_fabricated" in failed(reconcile.service_checks(faulty), "check_name")
    assert "service_costs_not_fabricated" in failed(reconcile.model_checks(faulty), "check_name")


def test_gate_rejects_empty_and_failing_results(spark):
    rows = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "check_name string, status string")
    with pytest.raises(CheckFailure, match="no check results"):
        require_all_pass(rows.limit(0), "empty")
    with pytest.raises(CheckFailure, match="failed checks: b"):
        require_all_pass(rows, "suite")
    assert require_all_pass(rows.where("status = 'PASS'"), "suite") == 1


def test_constraints_count_violations(w):
    broken = w.replace(fact_sales=w.table("fact_sales").withColumn("payment_type", F.lit("Barter")))
    counts = {(r["table"], r["constraint"]): r["violations"] for r in violations(broken).collect()}
    assert counts[("fact_sales", "payment_type")] == 50
    with pytest.raises(CheckFailure, match="payment_type"):
        require_constraints(broken)


def test_returns_are_signed_but_are_no_interaction(spark):
    sales = spark.createDataFrame(
        [(1, 20240101, "Completed", 1, 100), (1, 20240201, "Returned", -1, 100),
         (2, 20240201, "Returned", -1, 50), (3, 20240101, "Cancelled", 1, 999)],
        "customer_key bigint, sale_date_key int, sale_status string, unit_quantity int, sale_price int") \
        .withColumn("sale_price", F.col("sale_price").cast("decimal(14,2)"))
    rows = {r["customer_key"]: tuple(r)[1:] for r in customer.sales_by_customer(Warehouse({"fact_sales": sales})).collect()}
    assert set(rows) == {1, 2}
    assert [str(v) for v in rows[1]] == ["1", "0", "0.00", "2024-01-01", "2024-01-01"]
    assert [str(v) for v in rows[2]] == ["0", "-1", "-50.00", "None", "None"]


def test_contracts_are_complete():
    assert sum(len(d.columns) for d in DATASETS.values()) == 83


def test_the_audit_of_values_parses_nothing_again(spark, capsys):
    row = {"vehicle_id": " veh000001 ", "vin": "V1", "make": "A", "model": "B", "model_year": "2020", "body_type": "C", "fuel_type": "Hybrid",
           "color": "Red", "vehicle_condition": "NEW", "mileage_at_acquisition": "0", "manufacturer_msrp": "dear"}
    names = list(row)
    raw = spark.createDataFrame([tuple(row.values()), tuple({**row, "vehicle_id": "VEH000002\t", "manufacturer_msrp": "12.5"}.values())],
                                ", ".join(f"{c} string" for c in names))
    tables, audit = clean_datasets({"vehicles": raw})
    found = {(r.action, r.details): r.affected_rows for r in audit.collect()}
    assert found[("standardized string values", "vehicle_id")] == 2
    assert found[("invalid number coerced to null", "manufacturer_msrp")] == 1
    assert found[("standardized category", "vehicle_condition")] == 2
    assert tables["vehicles"].columns == names
    capsys.readouterr()
    audit.explain(True)
    assert "raise_error" not in capsys.readouterr().out


def test_cleaning_runs_the_steps_asked_for(spark, sample):
    def recorded():
        written = []

        def stage(name, frame):
            written.append(name)
            return frame.localCheckpoint()

        return written, cleaning(with_fault(sample, "inventory", "slow_moving_flag", "maybe", "inventory_id = 'INV000001'"), stage=stage)

    whole = {tuple(r) for r in recorded()[1].audit().collect()}
    for action, needed in (("invalid boolean coerced to null", set()), ("removed duplicate primary keys", {"_repeated_keys"}),
                           ("recalculated slow_moving_flag", {"inventory_repeated_keys"})):
        written, job = recorded()
        assert {tuple(r) for r in job.audit(action).collect()} == {r for r in whole if r[1] == action}
        assert all(any(name.endswith(n) for n in needed) for name in written), (action, written)
    written, job = recorded()
    assert job.table("customers").count() == 40
    assert set(written) == {"customers_standard", "customers_repeated_keys", "customers_first_rows"}
    assert job.audit("no such action").count() == 0 and job.audit("no such action").columns == list(job.audit().columns)


def test_a_model_check_builds_only_what_it_reads(spark):
    days = spark.createDataFrame([(20240105, "2024-01-05"), (20240107, "2024-01-06")], "date_key int, full_date string") \
        .withColumn("full_date", F.col("full_date").cast("date"))
    rows = reconcile.model_checks(Warehouse({"dim_date": days}), only="date_key_matches_date").collect()
    assert [tuple(r) for r in rows] == [("date_key_matches_date", 1, "FAIL")]
