"""Dataset, column, validation and foreign-key reports over the source datasets.

Every report is a DataFrame. Values are first counted per (column, value) or per
(check, example), which map-side aggregation collapses; examples come from a bounded top-5
that Spark evaluates before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.contracts import (
    DATASETS,
    EMAIL_PATTERN,
    MONEY_TOLERANCE,
    SHARED_ORDER_COLUMNS,
    SLOW_DAYS,
    Dataset,
    foreign_keys,
)
from forecourt.functions.parsing import amount, instant, number
from forecourt.operators.scoring import union_all

EXAMPLES = 5
SEPARATOR = " | "
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _is_text(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, T.StringType)


def _parsed_day(frame: DataFrame, column: str) -> Column:
    return instant(F.col(column), _is_text(frame, column))


def dataset_profile(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset: size, repeats after the first, NULLs and repeated keys."""
    rows = []
    for name in sorted(datasets):
        frame, key = datasets[name], DATASETS[name].key if name in DATASETS else None
        nulls = sum((F.col(c).isNull().cast("bigint") for c in frame.columns), F.lit(0).cast("bigint"))
        grouped = frame.groupBy(*frame.columns).agg(F.count("*").alias("n"))
        numbers = grouped.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_row_count"),
            F.coalesce(F.sum(nulls * F.col("n")), F.lit(0)).alias("total_null_count"),
        )
        if key in frame.columns:
            repeats = frame.groupBy(key).agg(F.count("*").alias("n")).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_primary_key_count"))
            numbers = numbers.unionByName(repeats, allowMissingColumns=True)
        else:
            numbers = numbers.withColumn("duplicate_primary_key_count", F.lit(None).cast("bigint"))
        rows.append(numbers.agg(*[F.max(c).alias(c) for c in numbers.columns]).select(
            F.lit(name).alias("dataset"), "row_count", F.lit(len(frame.columns)).alias("column_count"),
            "duplicate_row_count", "total_null_count", F.lit(key or "").alias("primary_key"),
            "duplicate_primary_key_count"))
    return union_all(rows)


def _value_counts(frame: DataFrame) -> DataFrame:
    """(column, value, n) over all columns, values as text."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in frame.columns
    ])
    return frame.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("n"))


def _smallest(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the smallest distinct values, joined; Spark limits each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    top = values.where(F.col(value).isNotNull()).select(*keys, value).withColumn("rank", rank) \
        .where(F.col("rank") <= EXAMPLES)
    return top.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(value)), SEPARATOR).alias("examples"))


def column_profile(datasets: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """One row per column; ``approximate`` replaces exact distinct counts by a sketch."""
    return union_all([_column_profile(name, datasets[name], approximate) for name in sorted(datasets)])


def _column_profile(name: str, frame: DataFrame, approximate: bool) -> DataFrame:
    dates = [f.name for f in DATASETS[name].dates if f.name in frame.columns] if name in DATASETS else []
    order = F.array(*[F.lit(c) for c in frame.columns])
    counts = _value_counts(frame)
    value, n, is_date = F.col("value"), F.col("n"), F.col("column").isin(*dates) if dates else F.lit(False)
    present, as_number, as_day = value.isNotNull(), F.col("as_number"), F.col("as_day")
    weighted = F.sum(as_number * n)
    # Each distinct value is parsed once.
    parsed = counts.select("column", "value", "n", amount(value).alias("as_number"), number(value).isNull().alias("word"),
                           F.when(is_date, instant(value)).alias("as_day"))
    stats = parsed.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("null_count"),
        (F.approx_count_distinct("value") if approximate else F.count("value")).alias("unique_count"),
        F.count_if(present & F.col("word")).alias("words"),
        F.count_if(present & ~F.lower(value).isin("true", "false")).alias("not_flags"),
        F.count_if(present & (as_number % 1 != 0)).alias("fractions"),
        F.min(as_number).alias("low"), F.max(as_number).alias("high"),
        (weighted / F.nullif(F.sum(F.when(as_number.isNotNull(), n)), F.lit(0))).alias("mean"),
        F.min(as_day).alias("first"), F.max(as_day).alias("last"),
        F.coalesce(F.sum(F.when(is_date & present & as_day.isNull(), n)), F.lit(0)).alias("bad_dates"),
    )
    numeric = (F.col("words") == 0) & (F.col("unique_count") > 0)
    kind = (F.when(F.col("unique_count") == 0, "void")
            .when(numeric, F.when(F.col("fractions") == 0, "whole number").otherwise("decimal number"))
            .when(F.col("not_flags") == 0, "boolean").otherwise("text"))
    timestamp = "yyyy-MM-dd'T'HH:mm:ss"
    dated = F.col("column").isin(*dates) if dates else F.lit(False)
    samples = _smallest(counts, ["column"], "value").withColumnRenamed("examples", "sample_unique_values")
    # Both sides hold one row per column.
    return stats.join(samples, "column", "left").select(
        F.lit(name).alias("dataset"), "column",
        F.array_position(order, F.col("column")).cast("int").alias("position"),
        kind.alias("data_type"), "row_count", "null_count",
        F.round(F.col("null_count").cast("decimal(20,0)") * 100 / F.col("row_count"), 4)
        .cast("decimal(9,4)").alias("null_percent"),
        "unique_count", F.coalesce("sample_unique_values", F.lit("")).alias("sample_unique_values"),
        F.when(numeric, F.col("low")).alias("numeric_min"),
        F.when(numeric, F.col("high")).alias("numeric_max"),
        F.when(numeric, F.round("mean", 6)).alias("numeric_mean"),
        F.date_format("first", timestamp).alias("date_min"),
        F.date_format("last", timestamp).alias("date_max"),
        F.when(dated, F.col("bad_dates")).alias("invalid_date_count"),
    )


# -- foreign keys ------------------------------------------------------------------
def foreign_key_report(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per declared relation; NULL children are not checked."""
    return union_all([_relation(datasets, *relation) for relation in foreign_keys()])


def _relation(datasets, child: str, column: str, parent: str, key: str) -> DataFrame:
    label = [F.lit(child).alias("child_dataset"), F.lit(column).alias("child_column"),
             F.lit(parent).alias("parent_dataset"), F.lit(key).alias("parent_column")]
    problem = None
    if child not in datasets or parent not in datasets:
        problem = "Required dataset is missing"
    elif column not in datasets[child].columns or key not in datasets[parent].columns:
        problem = "Required column is missing"
    if problem:
        any_frame = next(iter(datasets.values()))
        return any_frame.agg(F.count("*").alias("n")).select(
            *label, F.lit(0).cast("bigint").alias("checked_rows"), F.lit(None).cast("bigint").alias("orphan_count"),
            F.lit("NOT_CHECKED").alias("status"), F.lit(problem).alias("details"))
    # Children are counted per key before the lookup, so a hot key is looked up once.
    used = datasets[child].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")) \
        .agg(F.count("*").alias("n"))
    known = datasets[parent].where(F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct() \
        .withColumn("known", F.lit(True))
    looked_up = used.join(known, "k", "left").select("n", F.when(F.col("known").isNull(), F.col("k")).alias("orphan"))
    totals = looked_up.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
                           F.coalesce(F.sum(F.when(F.col("orphan").isNotNull(), F.col("n"))), F.lit(0))
                           .alias("orphan_count"))
    top = looked_up.select("orphan").where(F.col("orphan").isNotNull()).orderBy("orphan").limit(EXAMPLES)
    examples = top.agg(F.array_join(F.array_sort(F.collect_list("orphan")), SEPARATOR).alias("details"))
    both = totals.unionByName(examples, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("checked_rows", "orphan_count", "details")]).select(
        *label, "checked_rows", "orphan_count",
        F.when(F.col("orphan_count") == 0, "PASS").otherwise("FAIL").alias("status"), "details")


# -- validation ----------------------------------------------------------------------
@dataclass(frozen=True)
class RowCheck:
    """A row-level rule: when it is broken, and which column illustrates it."""

    check: str
    broken: Column
    example: Column | None = None


def _row_checks(dataset: Dataset, frame: DataFrame) -> list[RowCheck]:
    c, has = F.col, set(frame.columns)
    checks: list[RowCheck] = []
    if dataset.key in has:
        checks.append(RowCheck(f"{dataset.key} is populated", c(dataset.key).isNull(), c(dataset.key)))
    for field in dataset.dates:
        if field.name in has:
            checks.append(RowCheck(f"{field.name} contains valid dates",
                                   c(field.name).isNotNull() & _parsed_day(frame, field.name).isNull(), c(field.name)))
    for field in dataset.where(lambda f: f.nonnegative):
        if field.name in has:
            value = number(c(field.name))
            checks.append(RowCheck(f"{field.name} is nonnegative numeric", value.isNull() | (value < 0), c(field.name)))
    for field in dataset.where(lambda f: f.domain is not None):
        if field.name in has:
            allowed = F.coalesce(c(field.name).isin(*field.domain), F.lit(False))
            checks.append(RowCheck(f"{field.name} uses allowed values", ~allowed, c(field.name)))
    return checks + _rule_checks(dataset.name, frame, has)


def _off(expected: Column, actual: Column) -> Column:
    """More than two cents apart; unknown counts as equal."""
    return F.coalesce(F.abs(expected - actual) > F.lit(MONEY_TOLERANCE).cast("decimal(3,2)"), F.lit(False))


def _rule_checks(name: str, frame: DataFrame, has: set[str]) -> list[RowCheck]:
    c = F.col

    def later(first: str, second: str) -> Column:
        return F.coalesce(_parsed_day(frame, first) > _parsed_day(frame, second), F.lit(False))

    def shown(column: str) -> Column:
        return c(column) if column in has else F.lit(None).cast("string")

    def money(column: str) -> Column:
        return amount(c(column))

    if name == "customers" and "email" in has:
        return [RowCheck("email has a valid basic format",
                         ~F.coalesce(c("email").rlike(EMAIL_PATTERN), F.lit(False)), c("email"))]
    if name == "inventory" and {"acquired_date", "snapshot_date", "days_in_inventory", "slow_moving_flag"} <= has:
        age = F.datediff(_parsed_day(frame, "snapshot_date"), _parsed_day(frame, "acquired_date"))
        flag_text = F.lower(c("slow_moving_flag").cast("string"))
        flag = F.when(flag_text == "true", True).when(flag_text == "false", False)
        # An unknown age is not "more than 90", so a NULL date still compares with the flag.
        slow = F.coalesce(age > SLOW_DAYS, F.lit(False))
        return [
            RowCheck("acquired_date is on or before snapshot_date", later("acquired_date", "snapshot_date")),
            RowCheck("days_in_inventory matches dates",
                     F.coalesce(number(c("days_in_inventory")) != age, F.lit(True)), shown("inventory_id")),
            RowCheck("slow_moving_flag matches 90-day rule",
                     F.coalesce(flag != slow, F.lit(True)), shown("inventory_id")),
        ]
    if name == "sales" and {"list_price", "discount_amount", "sale_price", "vehicle_cost", "gross_profit"} <= has:
        return [
            RowCheck("sale_price equals list_price minus discount",
                     _off(money("list_price") - money("discount_amount"), money("sale_price")), shown("sale_id")),
            RowCheck("gross_profit equals sale_price minus vehicle_cost",
                     _off(money("sale_price") - money("vehicle_cost"), money("gross_profit")), shown("sale_id")),
        ]
    checks = []
    if name == "service_orders" and {"opened_at", "promised_at", "completed_at"} <= has:
        checks += [
            RowCheck("opened_at is on or before promised_at", later("opened_at", "promised_at"), shown("service_order_id")),
            RowCheck("opened_at is on or before completed_at", later("opened_at", "completed_at"), shown("service_order_id")),
        ]
    if name == "service_orders" and {"labor_revenue", "parts_revenue", "discount_amount", "service_revenue"} <= has:
        parts = money("labor_revenue") + money("parts_revenue") - money("discount_amount")
        checks.append(RowCheck("service_revenue matches components", _off(parts, money("service_revenue")),
                               shown("service_order_id")))
    return checks


PROBLEM = ("dataset", "check", "example", "n")


def _row_problems(name: str, frame: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """Broken rules as (dataset, check, example, n): one pass, only failing rows are exploded."""
    found = F.array(*[
        F.when(k.broken, F.struct(F.lit(k.check).alias("check"),
                                  (k.example.cast("string") if k.example is not None else F.lit(None).cast("string"))
                                  .alias("example")))
        for k in checks
    ])
    # Compiled expressions only: a lambda over the array has every rule interpreted row by row, and a chain of ORs
    # becomes one method too large to compile, which the greatest of many flags is not.
    flags = [F.coalesce(k.broken, F.lit(False)) for k in checks]
    return frame.where(F.greatest(*flags) if len(flags) > 1 else flags[0]).select(F.explode(found).alias("p")).where(F.col("p").isNotNull()).groupBy(
        F.lit(name).alias("dataset"), F.col("p.check").alias("check"), F.col("p.example").alias("example")
    ).agg(F.count("*").alias("n"))


def _repeat_problems(name: str, frame: DataFrame, check: str, keys: list[str], example: str | None) -> DataFrame:
    """Every member of a repeated group counts."""
    return frame.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(
        F.lit(name).alias("dataset"), F.lit(check).alias("check"),
        (F.col(example).cast("string") if example else F.lit(None).cast("string")).alias("example"), "n")


def _appointment_problems(datasets: dict[str, DataFrame]) -> tuple[list[str], DataFrame | None]:
    orders, visits = datasets.get("service_orders"), datasets.get("service_appointments")
    if orders is None or visits is None:
        return [], None
    needed = {"appointment_id", *SHARED_ORDER_COLUMNS}
    if not (needed <= set(orders.columns) and needed <= set(visits.columns)):
        return [], None
    expected = visits.select("appointment_id", *[F.col(c).alias(f"visit_{c}") for c in SHARED_ORDER_COLUMNS])
    merged = orders.select("service_order_id", "appointment_id", *SHARED_ORDER_COLUMNS) \
        .join(expected, "appointment_id", "left")
    checks = [
        RowCheck(f"{c} matches appointment", F.coalesce(F.col(c) != F.col(f"visit_{c}"), F.lit(True)),
                 F.col("service_order_id"))
        for c in SHARED_ORDER_COLUMNS
    ]
    return [k.check for k in checks], _row_problems("service_orders", merged, checks)


def validation_report(datasets: dict[str, DataFrame], contracts: dict[str, Dataset] | None = None) -> DataFrame:
    """One row per check: invalid count, status and up to five example values."""
    contracts = contracts or DATASETS
    listed: list[tuple[str, str, int, str]] = []
    problems: list[DataFrame] = []
    for name in sorted(set(contracts) - set(datasets)):
        listed.append((name, "required dataset exists", 1, "missing CSV"))
    for name in sorted(datasets):
        frame, contract = datasets[name], contracts.get(name)
        checks = _row_checks(contract, frame) if contract else []
        listed += [(name, k.check, 0, "") for k in checks]
        if checks:
            problems.append(_row_problems(name, frame, checks))
        listed.append((name, "rows are unique", 0, ""))
        problems.append(_repeat_problems(name, frame, "rows are unique", frame.columns, None))
        if contract and contract.key in frame.columns:
            check = f"{contract.key} is unique"
            listed.append((name, check, 0, ""))
            problems.append(_repeat_problems(name, frame, check, [contract.key], contract.key))
        elif contract:
            listed.append((name, f"primary key column {contract.key} exists", 1, "missing column"))
        for field in contract.dates if contract else []:
            if field.name not in frame.columns:
                listed.append((name, f"{field.name} exists", 1, "missing column"))
    matched, mismatches = _appointment_problems(datasets)
    listed += [("service_orders", check, 0, "") for check in matched]
    if mismatches is not None:
        problems.append(mismatches)

    every = F.array(*[
        F.struct(F.lit(d).alias("dataset"), F.lit(k).alias("check"), F.lit(n).cast("bigint").alias("known_bad"),
                 F.lit(e).alias("known_example")) for d, k, n, e in listed
    ])
    any_frame = next(iter(datasets.values()))
    names = any_frame.agg(F.count("*").alias("n")).select(F.inline(every))
    found = union_all([p.select(*PROBLEM) for p in problems])
    counts = found.groupBy("dataset", "check").agg(F.sum("n").alias("bad"))
    examples = _smallest(found, ["dataset", "check"], "example")
    invalid = F.coalesce("bad", "known_bad")
    # At most one row per check on either side.
    return names.join(counts, ["dataset", "check"], "left").join(examples, ["dataset", "check"], "left").select(
        "dataset", "check", F.lit("ERROR").alias("severity"), invalid.alias("invalid_count"),
        F.when(invalid == 0, "PASS").otherwise("FAIL").alias("status"),
        F.coalesce("examples", "known_example").alias("examples"))


# -- outcome -----------------------------------------------------------------------
def outcome(validation: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: error_count (failed rows plus failed relations) and passed."""
    failed = validation.where((F.col("severity") == "ERROR") & (F.col("status") == "FAIL")).agg(
        F.coalesce(F.sum("invalid_count"), F.lit(0)).alias("n"))
    broken = relations.where(F.col("status") != "PASS").agg(F.count("*").alias("n"))
    return failed.unionAll(broken).agg(F.sum("n").alias("error_count")).select(
        "error_count", (F.col("error_count") == 0).alias("passed"))


def summary(datasets: dict[str, DataFrame], validation: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: datasets, rows, columns, validation errors, failed relations, status."""
    rows = union_all([frame.agg(F.count("*").alias("rows_profiled")) for frame in datasets.values()]).agg(
        F.sum("rows_profiled").alias("rows_profiled"))
    errors = validation.where((F.col("severity") == "ERROR") & (F.col("status") == "FAIL")).agg(
        F.coalesce(F.sum("invalid_count"), F.lit(0)).alias("validation_errors"))
    broken = relations.where(F.col("status") != "PASS").agg(F.count("*").alias("failed_foreign_keys"))
    merged = rows.unionByName(errors, allowMissingColumns=True).unionByName(broken, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns]).select(
        F.lit(len(datasets)).alias("datasets_profiled"), "rows_profiled",
        F.lit(sum(len(f.columns) for f in datasets.values())).alias("columns_profiled"),
        "validation_errors", "failed_foreign_keys",
        F.when((F.col("validation_errors") == 0) & (F.col("failed_foreign_keys") == 0), "PASS").otherwise("FAIL")
        .alias("status"))
