"""Ordered cleaning of the source datasets with an audit of every action.

Rows are never dropped step by step. Each phase computes flags next to the data in one
projection, so its audit is one aggregate over the phase and its result one filter. Phases
are handed to ``stage`` (for example a table writer) so that audits do not recompute them.

Steps run when their rows or their audit are asked for: one dataset needs the steps of the
datasets that it refers to only, and one audited action only the steps before it. The audit of
values, first rows and repairs reads the written rows where there are some, else the columns
that it counts.

Order of rows: ``_row_order`` when the reader supplied it, else the row's own values.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import (
    DATASETS,
    INSTANT,
    MONEY,
    MONEY_TOLERANCE,
    ROLE_LINKS,
    SHARED_ORDER_COLUMNS,
    SLOW_DAYS,
    TEXT,
    Dataset,
    Field,
    foreign_keys,
)
from forecourt.functions.parsing import canonical, exact_amount, instant, truth
from forecourt.operators.keysets import Dangling, Link
from forecourt.operators.profile import foreign_key_report, validation_report
from forecourt.operators.scoring import CheckFailure, union_all
from forecourt.sources.store import written_stages

ORDER = "_row_order"
BLANKS = " \t\n\x0b\f\r"
CONCURRENT_JOBS = 4
Stage = Callable[[str, DataFrame], DataFrame]
AUDIT_SCHEMA = ("dataset", "action", "affected_rows", "details")


Count = tuple[str, str, Column]  # action, details, count aggregate


class Once:
    """A value made when it is first asked for."""

    def __init__(self, make: Callable[[], object]):
        self._make, self._lock, self._value, self.made = make, threading.RLock(), None, False

    def __call__(self):
        with self._lock:
            if not self.made:
                self._value, self.made = self._make(), True
            return self._value


@dataclass
class Step:
    """The rows of a dataset after a step, and the audit of the step under the actions that it can count.

    ``rows`` come from written files; ``view`` are the same rows, as a plan over the source where
    nothing is written yet.
    """

    dataset: str
    actions: tuple[str, ...]
    rows: Callable[[], DataFrame]
    view: Callable[[], DataFrame]
    audit: Callable[[], object]


@dataclass
class Cleaning:
    """The last step of every dataset by name, all steps, and what their audits count."""

    contracts: dict[str, Dataset]
    stage: Stage
    tables: dict[str, Step] = field(default_factory=dict)
    steps: list[Step] = field(default_factory=list)
    audits: list[tuple[str, Callable[[], DataFrame], list[Count]]] = field(default_factory=list)

    def add(self, step: Step) -> None:
        self.steps.append(step)
        self.tables[step.dataset] = step

    def then(self, name: str, action: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """A step that writes its rows to count them."""
        rows = Once(partial(_changed_rows, self.tables[name], change))
        self.add(Step(name, (action,), rows, rows, rows))

    def record(self, dataset: str, view: Callable[[], DataFrame], counts: list[Count]) -> None:
        """Add one audit row per (action, details, count aggregate), all from one pass over the frame."""
        self.audits.append((dataset, view, counts))

    def table(self, name: str) -> DataFrame:
        """A cleaned dataset."""
        return _in_order(self.contracts.get(name) or Dataset(name, "", ()), self.tables[name].rows())

    def audit(self, action: str | None = None) -> DataFrame:
        """The non-zero counts of all actions, or of one."""
        for step in self.steps:
            if action is None or action in step.actions:
                step.audit()
        frames = []
        for dataset, view, counts in list(self.audits):
            wanted = [k for k in counts if action in (None, k[0])]
            if wanted:
                frames.append(_counted(dataset, view(), wanted))
        if frames:
            return union_all(frames).select(*AUDIT_SCHEMA)
        any_frame = next(iter(self.tables.values())).view()
        return any_frame.limit(0).select(F.lit("").alias("dataset"), F.lit("").alias("action"),
                                         F.lit(0).cast("bigint").alias("affected_rows"), F.lit("").alias("details"))


def _changed_rows(before: Step, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return change(before.rows())


def _counted(dataset: str, frame: DataFrame, counts: list[Count]) -> DataFrame:
    numbers = frame.agg(*[F.coalesce(count, F.lit(0)).cast("bigint").alias(f"n{i}")
                          for i, (_, _, count) in enumerate(counts)])
    rows = F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(action).alias("action"),
                 F.col(f"n{i}").alias("affected_rows"), F.lit(details).alias("details"))
        for i, (action, details, _) in enumerate(counts)
    ])
    return numbers.select(F.inline(rows)).where("affected_rows > 0")


# -- phase 1: values of one dataset ---------------------------------------------------
def _standard_text(contract: Dataset, name: str, column: Column) -> Column:
    text = F.nullif(F.btrim(column, F.lit(BLANKS)), F.lit(""))
    if contract.knows(name) and contract.field(name).identifier:
        return F.upper(text)
    return F.lower(text) if name == "email" else text


def _changed(before: Column, after: Column) -> Column:
    return F.coalesce(before, F.lit("")) != F.coalesce(after, F.lit(""))


VALUE_ACTIONS = ("standardized string values", "invalid date coerced to null", "invalid number coerced to null",
                 "invalid boolean coerced to null", "standardized category")


def _standardize(contract: Dataset, raw: DataFrame) -> tuple[DataFrame, list[Count]]:
    """Trimmed text, typed dates, numbers and flags, canonical categories; and the counts of what changed.

    What happened to a row is written beside its values, so the audit reads flags and parses nothing again.
    """
    order = [F.col(ORDER)] if ORDER in raw.columns else []
    given = [c for c in raw.columns if c != ORDER]
    renamed = raw.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in given], *order)
    known = [contract.field(c) if contract.knows(c) else Field(c) for c in renamed.columns if c != ORDER]
    text = {c: renamed.schema[c].dataType == TEXT for c in renamed.columns}
    wordy = [f for f in known if text[f.name] and f not in contract.numbers + contract.flags]

    standard = {f.name: _standard_text(contract, f.name, F.col(f.name)) for f in wordy}
    marks = [("standardized string values", f.name, _changed(F.col(f.name), standard[f.name])) for f in wordy]
    columns: dict[str, Column] = {}
    for f in known:
        before = standard.get(f.name, F.col(f.name))
        if f in contract.dates:
            parsed = instant(before, text[f.name])
            after, action = (parsed if f.type == INSTANT else parsed.cast(f.type)), "invalid date coerced to null"
        elif f in contract.numbers:
            # Money is rounded to cents; whole-number columns keep a fraction for the preflight to reject.
            kind = MONEY if f.type == MONEY else "decimal(38,10)"
            after, action = exact_amount(before, kind, f"{contract.name}.{f.name}"), "invalid number coerced to null"
        elif f in contract.flags:
            after, action = truth(before), "invalid boolean coerced to null"
        else:
            after, action = before, None
        if action:
            marks.append((action, f.name, before.isNotNull() & after.isNull()))
        if f.domain:
            after = canonical(before, f.domain)
            marks.append(("standardized category", f.name, _changed(before, after)))
        columns[f.name] = after
    flags = [f"_mark{i}" for i in range(len(marks))]
    marked = renamed.select(
        *[columns[f.name].alias(f.name) for f in known], *order,
        *[mark.alias(flag) for flag, (_, _, mark) in zip(flags, marks)])
    return marked, [(action, details, F.count_if(flag)) for flag, (action, details, _) in zip(flags, marks)]


def _repeated_keys(contract: Dataset, frame: DataFrame) -> DataFrame:
    key = contract.key
    return frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1") \
        .select(F.col(key).alias("_key"))


def _first_rows(contract: Dataset, frame: DataFrame, repeated_keys: Callable[[], DataFrame]) -> DataFrame:
    """First row of every key, carrying how many rows (_copies) and distinct rows (_rivals) it stands for.

    A scan of the key column alone finds the keys that repeat. Only their rows, and rows without
    a key, are compared as wholes; the others pass by the list of repeated keys and are never
    shuffled while that list is small enough for Spark to send it to them.
    """
    key, names = contract.key, [c for c in frame.columns if c != ORDER]
    if key not in names:
        return _compared(contract, frame)
    repeated = repeated_keys()
    one = F.lit(1).cast("bigint")
    alone = frame.where(F.col(key).isNotNull()).join(repeated, F.col(key) == F.col("_key"), "left_anti") \
        .select(*names, one.alias("_copies"), one.alias("_rivals"))
    several = frame.join(repeated, F.col(key) == F.col("_key"), "left_semi").unionByName(frame.where(F.col(key).isNull()))
    return alone.unionByName(_compared(contract, several))


def _compared(contract: Dataset, frame: DataFrame) -> DataFrame:
    """The first rows by comparing whole rows.

    Both steps are aggregates with map-side combine, so a key or a row repeated a billion
    times is reduced before the shuffle.
    """
    names = [c for c in frame.columns if c != ORDER]
    order = F.min(ORDER) if ORDER in frame.columns else F.min(F.struct(*names))
    unique = frame.groupBy(*names).agg(order.alias(ORDER), F.count("*").alias("_copies"))
    key = contract.key
    if key not in names:
        return unique.select(*names, "_copies", F.lit(1).cast("bigint").alias("_rivals"))
    others = [c for c in names if c != key]
    keyed = unique.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(F.struct(*others, ORDER), ORDER).alias("first"),
        F.sum("_copies").alias("_copies"), F.count("*").alias("_rivals"))
    kept = keyed.select(key, "first.*", "_copies", "_rivals").select(*names, "_copies", "_rivals")
    return kept.unionByName(unique.where(F.col(key).isNull()).select(*names, "_copies", F.lit(1).cast("bigint").alias("_rivals")))


FAULT_ACTIONS = ("removed duplicate rows", "removed duplicate primary keys", "invalid negative value set to null",
                 "removed rows missing critical values", "filled missing descriptive values")


def _without_faults(contract: Dataset, firsts: DataFrame) -> tuple[DataFrame, list[Count]]:
    """Duplicates, negative values, missing critical values and missing descriptions; and their counts."""
    names = [c for c in firsts.columns if c not in ("_copies", "_rivals")]
    nonnegative = [f.name for f in contract.where(lambda f: f.nonnegative) if f.name in names]
    critical = [c for c in contract.critical if c in names]
    cleared = {c: F.when(F.col(c) >= 0, F.col(c)) for c in nonnegative}
    missing = F.lit(False)
    for c in critical:
        missing = missing | cleared.get(c, F.col(c)).isNull()
    described = [c for c in names if firsts.schema[c].dataType == TEXT and c not in critical]
    counts = [
        ("removed duplicate rows", "", F.sum(F.col("_copies") - F.col("_rivals"))),
        *([("removed duplicate primary keys", contract.key, F.sum(F.col("_rivals") - 1))] if contract.key else []),
        *[("invalid negative value set to null", c, F.count_if(F.col(c) < 0)) for c in nonnegative],
        *([("removed rows missing critical values", ", ".join(critical), F.count_if(missing))] if critical else []),
        *[("filled missing descriptive values", c, F.count_if(~missing & F.col(c).isNull())) for c in described],
    ]
    filled = {c: F.coalesce(F.col(c), F.lit("Unknown")) for c in described}
    return firsts.where(~missing).select(
        *[{**cleared, **filled}.get(c, F.col(c)).alias(c) for c in names]), counts


def _first_phase(job: Cleaning, name: str, datasets: Mapping[str, DataFrame]) -> None:
    """The steps of one dataset that need no other."""
    contract = job.contracts.get(name) or Dataset(name, "", ())
    standard = Once(lambda: _standardize(contract, datasets[name]))
    written = Once(lambda: job.stage(f"{contract.name}_standard", standard()[0]))

    def values() -> DataFrame:
        return written() if written.made else standard()[0]

    def plain(frame: DataFrame) -> DataFrame:
        return frame.drop(*[f"_mark{i}" for i in range(len(standard()[1]))])

    repeated = Once(lambda: job.stage(f"{contract.name}_repeated_keys", _repeated_keys(contract, plain(values()))))
    firsts = Once(lambda: job.stage(f"{contract.name}_first_rows", _first_rows(contract, plain(written()), repeated)))

    def first_rows() -> DataFrame:
        return firsts() if firsts.made else _first_rows(contract, plain(values()), repeated)

    job.add(Step(name, VALUE_ACTIONS, written, values, Once(lambda: job.record(name, values, standard()[1]))))
    job.add(Step(name, FAULT_ACTIONS, Once(lambda: _without_faults(contract, firsts())[0]),
                 lambda: _without_faults(contract, first_rows())[0],
                 Once(lambda: job.record(name, first_rows, _without_faults(contract, first_rows())[1]))))


# -- phase 2: derived values ------------------------------------------------------------
def _off(actual: Column, expected: Column) -> Column:
    return F.abs(actual - expected) > F.lit(MONEY_TOLERANCE).cast("decimal(3,2)")


def _repair_sales(frame: DataFrame) -> tuple[DataFrame, list[Count]]:
    price_due = F.round(F.col("list_price") - F.col("discount_amount"), 2).cast(MONEY)
    bad_price = _off(F.col("sale_price"), price_due)
    price = F.when(bad_price, price_due).otherwise(F.col("sale_price"))
    profit_due = F.round(price - F.col("vehicle_cost"), 2).cast(MONEY)
    bad_profit = _off(F.col("gross_profit"), profit_due)
    fixed = frame.withColumns({
        "sale_price": price, "gross_profit": F.when(bad_profit, profit_due).otherwise(F.col("gross_profit"))})
    return fixed, [("recalculated sale_price", "", F.count_if(bad_price)),
                   ("recalculated gross_profit", "", F.count_if(bad_profit))]


def _repair_inventory(frame: DataFrame) -> tuple[DataFrame, list[Count]]:
    reversed_dates = F.col("acquired_date") > F.col("snapshot_date")
    age = F.datediff("snapshot_date", "acquired_date")
    bad_age, bad_flag = F.col("days_in_inventory") != age, F.col("slow_moving_flag") != (age > SLOW_DAYS)
    fixed = frame.where(~reversed_dates).withColumns(
        {"days_in_inventory": age.cast("decimal(20,6)"), "slow_moving_flag": age > SLOW_DAYS})
    return fixed, [
        ("removed rows with acquisition after snapshot", "", F.count_if(reversed_dates)),
        ("recalculated days_in_inventory", "", F.count_if(~reversed_dates & bad_age)),
        ("recalculated slow_moving_flag", "", F.count_if(~reversed_dates & bad_flag)),
    ]


def _repair_orders(frame: DataFrame) -> tuple[DataFrame, list[Count]]:
    ordered = (F.col("opened_at") <= F.col("promised_at")) & (F.col("opened_at") <= F.col("completed_at"))
    due = F.round(F.col("labor_revenue") + F.col("parts_revenue") - F.col("discount_amount"), 2).cast(MONEY)
    wrong = _off(F.col("service_revenue"), due)
    fixed = frame.where(ordered).withColumn(
        "service_revenue", F.when(wrong, due).otherwise(F.col("service_revenue")))
    return fixed, [
        ("removed rows with invalid timestamp order", "", F.count_if(~ordered)),
        ("recalculated service_revenue", "", F.count_if(ordered & wrong)),
    ]


# dataset -> (its repair, the actions that it counts)
REPAIRS = {
    "sales": (_repair_sales, ("recalculated sale_price", "recalculated gross_profit")),
    "inventory": (_repair_inventory, ("removed rows with acquisition after snapshot", "recalculated days_in_inventory",
                                      "recalculated slow_moving_flag")),
    "service_orders": (_repair_orders, ("removed rows with invalid timestamp order", "recalculated service_revenue")),
}


def _repair(job: Cleaning, name: str) -> None:
    repair, actions = REPAIRS[name]
    before = job.tables[name]
    job.add(Step(name, actions, Once(lambda: repair(before.rows())[0]), lambda: repair(before.view())[0],
                 Once(lambda: job.record(name, before.view, repair(before.view())[1]))))


# -- phase 3: relations -------------------------------------------------------------------
def _first_failure(frame: DataFrame, tests: list[tuple[str, Column]]) -> DataFrame:
    """Add ``_fail``: the first test that a row fails, NULL when it passes all."""
    failing = F.lit(None).cast("string")
    for label, failed in reversed(tests):
        failing = F.when(failed, label).otherwise(failing)
    return frame.withColumn("_fail", failing)


def _keep_related(job: Cleaning, round_no: int, only_parents: Iterable[str] | None = None) -> None:
    """Remove rows without their parents, children after parents, NULL children included."""
    action = "removed broken foreign-key rows"
    for name in job.contracts:
        relations = [r for r in foreign_keys() if r[0] == name and (only_parents is None or r[2] in only_parents)]
        if name not in job.tables or not relations:
            continue
        parents = {parent: job.tables[parent] for _, _, parent, _ in relations if parent in job.tables}

        def related(frame: DataFrame, name=name, relations=relations, parents=parents) -> DataFrame:
            held = {parent: step.rows() for parent, step in parents.items()}
            return _without(job, name, frame, f"related_{round_no}", action, {
                f"{column} -> {parent}.{key}": Link(column, held[parent].select(key), key)
                for _, column, parent, key in relations
                if parent in held and column in frame.columns and key in held[parent].columns})

        job.then(name, action, related)


def _without(job: Cleaning, name: str, frame: DataFrame, step: str, action: str, links: dict[str, Link]) -> DataFrame:
    """Remove rows with a key that is NULL or not held; a row counts for the first of its links that fails.

    Distinct keys meet the held ones; rows meet the list of keys that are left over only.
    """
    if not links:
        return frame
    rows, wrong = Dangling(frame, list(links.values()), job.stage, f"{name}_{step}").marked(frame)
    tagged = job.stage(f"{name}_{step}", _first_failure(rows, list(zip(links, wrong))).select(*frame.columns, "_fail"))
    job.record(name, lambda: tagged, [(action, label, F.count_if(F.col("_fail") == label)) for label in links])
    return tagged.where(F.col("_fail").isNull()).drop("_fail")


def _enforce_roles(job: Cleaning) -> set[str]:
    """Remove rows whose employee has another role; returns the datasets that were filtered."""
    touched: set[str] = set()
    if "employees" not in job.tables:
        return touched
    employees, action = job.tables["employees"], "removed rows with invalid employee role"
    for name in dict.fromkeys(link[0] for link in ROLE_LINKS):
        if name not in job.tables:
            continue

        def in_role(frame: DataFrame, name=name) -> DataFrame:
            staff = employees.rows()
            return _without(job, name, frame, "roles", action, {
                f"{column} requires {role}":
                    Link(column, staff.where(F.col("role") == role).select("employee_id"), "employee_id")
                for of, column, role in ROLE_LINKS if of == name and column in frame.columns})

        job.then(name, action, in_role)
        touched.add(name)
    return touched


def _follow_appointments(job: Cleaning) -> None:
    """Orders take customer, vehicle, dealership and advisor from their appointment."""
    if not {"service_orders", "service_appointments"} <= set(job.tables):
        return
    appointments, action = job.tables["service_appointments"], "reconciled value to appointment"

    def followed(orders: DataFrame) -> DataFrame:
        visits = appointments.rows().select(
            "appointment_id", *[F.col(c).alias(f"_visit_{c}") for c in SHARED_ORDER_COLUMNS])
        joined = job.stage("service_orders_followed", orders.join(visits, "appointment_id", "left"))
        job.record("service_orders", lambda: joined, [
            (action, c, F.count_if(F.coalesce(F.col(c) != F.col(f"_visit_{c}"), F.lit(True))))
            for c in SHARED_ORDER_COLUMNS])
        return joined.withColumns({c: F.col(f"_visit_{c}") for c in SHARED_ORDER_COLUMNS}).select(*orders.columns)

    job.then("service_orders", action, followed)


def _drop_sold_stock(job: Cleaning) -> None:
    if not {"sales", "inventory"} <= set(job.tables):
        return
    sales, action = job.tables["sales"], "removed vehicles also present in sales"

    def unsold(stock: DataFrame) -> DataFrame:
        sold = sales.rows().select("vehicle_id").distinct().withColumn("_sold", F.lit(True))
        tagged = job.stage("inventory_sold", stock.join(sold, "vehicle_id", "left").select(*stock.columns, "_sold"))
        job.record("inventory", lambda: tagged, [(action, "", F.count("_sold"))])
        return tagged.where(F.col("_sold").isNull()).drop("_sold")

    job.then("inventory", action, unsold)


def _drop_impossible_sales(job: Cleaning) -> None:
    """Sales before the customer existed, or more than a year before the model year."""
    if not {"sales", "customers", "vehicles"} <= set(job.tables):
        return
    customers, vehicles, action = job.tables["customers"], job.tables["vehicles"], "removed rows with invalid relational dates"

    def possible(sales: DataFrame) -> DataFrame:
        since = customers.rows().select("customer_id", "customer_since_date")
        years = vehicles.rows().select("vehicle_id", "model_year")
        early = F.coalesce(F.col("sale_date") < F.col("customer_since_date"), F.lit(False)) | F.coalesce(
            F.year("sale_date") < F.col("model_year") - 1, F.lit(False))
        tagged = job.stage("sales_dated", sales.join(since, "customer_id", "left")
                           .join(years, "vehicle_id", "left").select(*sales.columns, early.alias("_early")))
        job.record("sales", lambda: tagged, [(action, "", F.count_if("_early"))])
        return tagged.where(~F.col("_early")).drop("_early")

    job.then("sales", action, possible)


# -- the whole run ----------------------------------------------------------------------------
def cleaning(
    datasets: Mapping[str, DataFrame],
    contracts: dict[str, Dataset] | None = None,
    stage: Stage | None = None,
) -> Cleaning:
    """All steps in order; none has run."""
    job = Cleaning(contracts or DATASETS, stage or written_stages(next(iter(datasets.values())).sparkSession))
    for name in datasets:
        _first_phase(job, name, datasets)
    for name in REPAIRS:
        if name in job.tables:
            _repair(job, name)
    _keep_related(job, 1)
    shrunk = _enforce_roles(job)
    _follow_appointments(job)
    _drop_sold_stock(job)
    _drop_impossible_sales(job)
    # Only parents that lost rows since the first round can leave new orphans.
    _keep_related(job, 2, only_parents=shrunk)
    return job


def run_all(job: Cleaning) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every cleaned dataset and the audit of non-zero actions."""
    # Datasets are independent in their first steps, so their writes run as concurrent jobs.
    own = [step for step in job.steps if step.actions == FAULT_ACTIONS]
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        list(pool.map(lambda step: step.rows(), own))
    tables = {name: job.table(name) for name in job.tables}
    return tables, job.audit()


def clean_datasets(
    datasets: Mapping[str, DataFrame],
    contracts: dict[str, Dataset] | None = None,
    stage: Stage | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean all datasets in order; returns (datasets, audit of non-zero actions)."""
    return run_all(cleaning(datasets, contracts, stage))


def _in_order(contract: Dataset, frame: DataFrame) -> DataFrame:
    """Contract column order; columns outside the contract come last."""
    return frame.select(*[f.name for f in contract.fields if f.name in frame.columns],
                        *[c for c in frame.columns if c not in contract.columns])


def require_clean(datasets: dict[str, DataFrame], contracts: dict[str, Dataset] | None = None) -> None:
    """Gate: raise when a validation check or a relation of the cleaned datasets fails."""
    bad_checks = validation_report(datasets, contracts).where(F.col("status") == "FAIL").count()
    bad_relations = foreign_key_report(datasets).where(F.col("status") != "PASS").count()
    if bad_checks or bad_relations:
        raise CheckFailure(f"cleaned datasets failed {bad_checks} checks and {bad_relations} foreign keys")
