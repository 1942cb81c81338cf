"""CSV and report files: reading the datasets, fingerprints, preflight, and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS, INSTANT, Dataset
from forecourt.functions.parsing import NULL_MARKERS, number
from forecourt.operators.clean import ORDER
from forecourt.operators.profile import (
    column_profile,
    dataset_profile,
    foreign_key_report,
    summary,
    validation_report,
)
from forecourt.operators.scoring import union_all
from forecourt.sources.store import written_stages


class SourceError(ValueError):
    """Input files are missing, changed, or not of the declared shape."""


def _csv_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Dataset name -> path of every ``*.csv`` file or directory of part files in the folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [status.getPath().toString() for status in found]
    return {path.rsplit("/", 1)[-1].removesuffix(".csv"): path for path in sorted(paths)}


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, in file order of columns; the header decides the names."""
    return spark.read.options(header=True, mode="FAILFAST", multiLine=False, escape='"').csv(path)


def dataset_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of the declared datasets that exist in the folder."""
    found = _csv_paths(spark, folder)
    return {name: found[name] for name in DATASETS if name in found}


def load_datasets(spark: SparkSession, folder: str, with_order: bool = False) -> dict[str, DataFrame]:
    """Every CSV of the folder as text columns, NULL markers applied; fail when there is none."""
    paths = _csv_paths(spark, folder)
    if not paths:
        raise SourceError(f"no CSV files in {folder}")
    return {name: _load(spark, path, with_order) for name, path in paths.items()}


def _load(spark: SparkSession, path: str, with_order: bool) -> DataFrame:
    frame = _csv(spark, path)
    names = frame.columns
    if with_order:
        # File, block, then position inside the block: the input order, without numbering the rows globally.
        frame = frame.withColumn(ORDER, F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line")))
    marked = [F.when(~F.col(f"`{c}`").isin(*NULL_MARKERS), F.col(f"`{c}`")).alias(c) for c in names]
    return frame.select(*marked, *([ORDER] if with_order else []))


# -- preflight -------------------------------------------------------------------------
# Largest whole number each integer column of the warehouse can hold.
WHOLE_LIMITS = (
    ("vehicles", "model_year", 32767),
    ("vehicles", "mileage_at_acquisition", 2147483647),
    ("inventory", "days_in_inventory", 2147483647),
)


def whole_number_errors(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows per integer column whose value is missing, fractional, negative or too large."""
    parts = []
    for name, column, largest in WHOLE_LIMITS:
        value = number(F.col(column))
        bad = value.isNull() | (value < 0) | (value > largest) | (value % 1 != 0)
        parts.append(datasets[name].agg(
            F.lit(f"{name}.{column}").alias("column"), F.count_if(F.coalesce(bad, F.lit(True))).alias("invalid_count")))
    return union_all(parts)


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        frame.agg(F.lit(name).alias("dataset"), F.count("*").alias("rows")) for name, frame in datasets.items()])


def preflight(spark: SparkSession, folder: str, contracts: dict[str, Dataset] | None = None) -> dict[str, int]:
    """Row counts of a complete, valid folder of cleaned files; raise otherwise."""
    found = dataset_paths(spark, folder)
    missing = [name for name in DATASETS if name not in found]
    if missing:
        raise SourceError(f"missing dataset files: {', '.join(missing)}")
    datasets = load_datasets(spark, folder)
    return check_datasets(datasets, contracts)


def check_datasets(datasets: dict[str, DataFrame], contracts: dict[str, Dataset] | None = None) -> dict[str, int]:
    """The preflight rules on loaded datasets: columns, whole numbers, checks, relations, emptiness."""
    for name, contract in DATASETS.items():
        if datasets[name].columns != contract.columns:
            raise SourceError(f"{name}.csv columns do not match the staging contract; "
                              f"expected {contract.columns}, got {datasets[name].columns}")
    wrong = [r["column"] for r in whole_number_errors(datasets).where("invalid_count > 0").collect()]
    if wrong:
        raise SourceError(f"{', '.join(sorted(wrong))} must contain valid whole numbers")
    checks = validation_report(datasets, contracts).where("status = 'FAIL'").count()
    relations = foreign_key_report(datasets).where("status <> 'PASS'").count()
    if checks or relations:
        raise SourceError(f"preflight failed: {checks} validation checks and {relations} foreign-key checks failed")
    counts = {r["dataset"]: r["rows"] for r in row_counts(datasets).collect()}
    empty = [name for name in DATASETS if not counts[name]]
    if empty:
        raise SourceError(f"datasets are empty: {', '.join(empty)}")
    return counts


# -- staging -------------------------------------------------------------------------------
def stage_datasets(spark: SparkSession, folder: str, target: str) -> dict[str, DataFrame]:
    """Full refresh of the staging tables: text columns, empty text as NULL, load time added."""
    staged = {}
    for name, path in dataset_paths(spark, folder).items():
        frame = _csv(spark, path)
        blanks = [F.nullif(F.col(c), F.lit("")).alias(c) for c in frame.columns]
        out = f"{target.rstrip('/')}/{name}"
        frame.select(*blanks, F.current_timestamp().alias("loaded_at")).write.mode("overwrite").parquet(out)
        staged[name] = spark.read.parquet(out)
    return staged


def require_staged_rows(expected: dict[str, int], staged: dict[str, DataFrame]) -> None:
    """Gate: every staged dataset has as many rows as its source file had at the preflight."""
    found = {r["dataset"]: r["rows"] for r in row_counts(staged).collect()}
    wrong = [f"{n} {expected[n]} / {found.get(n)}" for n in DATASETS if n in expected and expected[n] != found.get(n)]
    if wrong:
        raise SourceError(f"rows of source and staging differ: {', '.join(wrong)}")


# -- fingerprints ------------------------------------------------------------------------------
MANIFEST = "dataset string, file string, size_bytes bigint, modified_at timestamp, sha256 string"
WHOLE_FILE_BYTES = 256 << 20  # a larger file is read by its task in pieces


def _digest_in_pieces(batches):
    """SHA-256 of files too large for one row, read 4 MiB at a time."""
    import hashlib

    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            files, inner = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with files.open_input_stream(inner) as stream:
                while piece := stream.read(4 << 20):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield batch.drop_columns(["path"]).append_column("sha256", pa.array(digests, pa.string()))


def input_manifest(spark: SparkSession, folder: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Size, modification time and SHA-256 of every input file, of any size.

    A dataset may be a directory of part files; each part is hashed by one task.
    """
    paths = dataset_paths(spark, folder)
    missing = [name for name in DATASETS if name not in paths]
    if missing:
        raise SourceError(f"missing dataset files: {', '.join(missing)}")
    parts = []
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
        about = [F.lit(name).alias("dataset"), F.substring_index("path", "/", -1).alias("file"),
                 F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")]
        parts.append(files.where(F.col("length") <= whole_file_bytes).select(*about, F.sha2("content", 256).alias("sha256")))
        large = files.where(F.col("length") > whole_file_bytes)
        parts.append(large.select(*about, "path").mapInArrow(_digest_in_pieces, MANIFEST))
    return union_all(parts)


def require_unchanged(spark: SparkSession, folder: str, manifest: DataFrame) -> None:
    """Raise when a file of the manifest disappeared, changed or was added; reads each file once."""
    both = manifest.unionByName(input_manifest(spark, folder))
    odd = both.groupBy(*both.columns).agg(F.count("*").alias("times")).where("times <> 2")
    changed = sorted({r["dataset"] for r in odd.select("dataset").distinct().collect()})
    if changed:
        raise SourceError(f"input changed after extraction: {', '.join(changed)}")


# -- sinks -----------------------------------------------------------------------------------------
def as_file_text(contract: Dataset, frame: DataFrame) -> DataFrame:
    """Every column as file text: ISO dates, timestamps to the second, plain decimals, true/false."""
    columns = []
    for f in contract.fields:
        column = F.col(f.name)
        if f.name not in frame.columns:
            continue
        if f in contract.dates:
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss" if f.type == INSTANT else "yyyy-MM-dd")
        elif f in contract.numbers and f.type.typeName() != "decimal":
            # A whole value prints without a fraction, any other value keeps it.
            column = F.coalesce(F.when(column % 1 == 0, column.cast("bigint").cast("string")), column.cast("string"))
        columns.append(column.cast("string").alias(f.name))
    return frame.select(*columns)


def write_datasets(datasets: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV directory per dataset in the fixed file format."""
    paths = {}
    for name, frame in sorted(datasets.items()):
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        as_file_text(DATASETS[name], frame).write.mode("overwrite").options(header=True, escape='"').csv(paths[name])
    return paths


def write_audit(audit: DataFrame, folder: str) -> str:
    """The cleaning audit; it holds at most one row per dataset, action and column."""
    path = f"{folder.rstrip('/')}/cleaning_summary.csv"
    audit.where("affected_rows > 0").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def profile_folder(spark: SparkSession, folder: str, target: str) -> dict[str, object]:
    """Write the four profile reports and a manifest; return the manifest."""
    stage = written_stages(spark)
    # The text is parsed once; every report and check scans the columns that it reads.
    datasets = {name: stage(f"read_{name}", frame) for name, frame in load_datasets(spark, folder).items()}
    # The reports and the manifest read these; the checks themselves run once.
    validation = stage("validation", validation_report(datasets))
    relations = stage("relations", foreign_key_report(datasets))
    reports = {
        "dataset_profile": dataset_profile(datasets),
        "column_profile": column_profile(datasets),
        "validation_report": validation,
        "foreign_key_report": relations,
    }
    paths = {}
    for name, report in reports.items():
        paths[name] = f"{target.rstrip('/')}/{name}.csv"
        report.coalesce(1).write.mode("overwrite").option("header", True).csv(paths[name])
    totals = summary(datasets, validation, relations)
    manifest = totals.withColumn("error_count", F.col("validation_errors") + F.col("failed_foreign_keys")) \
        .withColumn("source_directory", F.lit(folder))
    paths["manifest"] = f"{target.rstrip('/')}/profiling_manifest.json"
    manifest.coalesce(1).write.mode("overwrite").json(paths["manifest"])
    row = spark.read.json(paths["manifest"]).first().asDict()
    return {**row, "passed": row["error_count"] == 0, "reports": paths}


def export_model(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """The semantic-model tables as parquet."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(paths[name])
    return paths
