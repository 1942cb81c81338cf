"""Written tables of one load, kept in a shared folder as (optionally bucketed) parquet.

Sales and visits are bucketed by their grain identifier: it is unique, so buckets stay even
whatever the skew of customers or dealerships, exact distinct counts over the identifier need
no shuffle, and orders join their appointments bucket to bucket. Inventory is bucketed by
vehicle: its detail meets the vehicles bucket to bucket, so the widest rows never move, and a
vehicle has at most one row per dealership and snapshot. Rows are sorted by date inside a
bucket, so a date filter skips row groups.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BUCKET = 4_000_000
MAX_BUCKETS = 65_536
POINTER = "current.json"


@dataclass(frozen=True)
class Layout:
    """Physical layout: bucket columns, sort columns, and the dataset whose row count sizes it."""

    buckets: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    sized_by: str | None = None


LAYOUTS: dict[str, Layout] = {
    "inventory": Layout(),
    "service_appointments": Layout(("appointment_id",), ("appointment_date",), "service_appointments"),
    "service_orders": Layout(("appointment_id",), ("completed_at",), "service_appointments"),
    "dim_date": Layout(),
    "dim_service": Layout(),
    "dim_dealership": Layout(),
    "dim_employee": Layout(),
    "dim_customer": Layout(("customer_key",), (), "customers"),
    "dim_vehicle": Layout(("vehicle_key",), (), "vehicles"),
    "fact_sales": Layout(("sale_id",), ("sale_date_key",), "sales"),
    "fact_inventory": Layout(("vehicle_key",), ("snapshot_date_key",), "inventory"),
    "fact_service": Layout(("appointment_id",), ("completed_date_key",), "service_appointments"),
    "sales_detail": Layout(("sale_id",), ("sale_date_key",), "sales"),
    "inventory_detail": Layout(("vehicle_key",), ("snapshot_date_key",), "inventory"),
    "service_detail": Layout(("appointment_id",), ("appointment_date_key",), "service_appointments"),
    "customer_detail": Layout(("customer_key",), (), "customers"),
}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="forecourt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written_stages(spark: SparkSession, folder: str | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """A stage that writes each frame once, under a folder every executor can reach, and reads it back."""
    root = f"{folder or shared_folder(spark) + '/forecourt'}/stages-{uuid.uuid4().hex[:12]}"

    def stage(name: str, frame: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        schema = frame.schema
        frame.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(schema).parquet(path)

    return stage


class TableStore:
    """One immutable version folder plus the catalog schema through which it is read."""

    def __init__(self, spark: SparkSession, root: str, version: str, row_counts: dict[str, int] | None = None):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        self.path = f"{self.root}/{version}"
        self.database = "forecourt_" + hashlib.md5(self.path.encode()).hexdigest()[:12]
        self.row_counts = dict(row_counts or {})
        self.buckets: dict[str, int] = {}
        # Joins on more keys than the bucket column still meet bucket by bucket, in any session.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        # HotSpot compiles no larger method; generated code beyond it would run in the bytecode interpreter.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.path}/_schema'")

    @classmethod
    def create(cls, spark: SparkSession, root: str, row_counts: dict[str, int] | None = None) -> TableStore:
        return cls(spark, root, f"v-{uuid.uuid4().hex[:12]}", row_counts)

    def bucket_count(self, layout: Layout) -> int:
        """Enough buckets for the rows, at least one wave of the usual shuffle width."""
        rows = self.row_counts.get(layout.sized_by or "", 0)
        floor = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        return min(MAX_BUCKETS, max(min(floor, 1000), -(-rows // ROWS_PER_BUCKET)))

    def save(self, name: str, frame: DataFrame) -> DataFrame:
        """Write the frame once and return the table that reads it back."""
        layout = LAYOUTS[name]
        writer = frame.write
        if layout.buckets:
            count = self.bucket_count(layout)
            writer = frame.repartition(count, *layout.buckets).write.bucketBy(count, *layout.buckets) \
                .sortBy(*(layout.sort or layout.buckets))
            self.buckets[name] = count
        writer.format("parquet").option("compression", "zstd").mode("overwrite").option("path", f"{self.path}/{name}") \
            .saveAsTable(f"{self.database}.{name}")
        return self.spark.table(f"{self.database}.{name}")

    def attach(self, name: str) -> DataFrame:
        """Register an already written table in this session and return it."""
        layout, table = LAYOUTS[name], f"{self.database}.{name}"
        if not self.spark.catalog.tableExists(table):
            path = f"{self.path}/{name}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                for f in self.spark.read.parquet(path).schema.fields)
            clustered = ""
            if name in self.buckets:
                clustered = (f"CLUSTERED BY ({', '.join(layout.buckets)}) "
                             f"SORTED BY ({', '.join(layout.sort or layout.buckets)}) INTO {self.buckets[name]} BUCKETS")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {clustered} LOCATION '{path}'")
        return self.spark.table(table)

    # -- publication -------------------------------------------------------
    def publish(self, tables: list[str]) -> None:
        """Point the root at this version: the new pointer is written beside the old one and renamed over it.

        A reader finds the old pointer or the new one, and a crash leaves the old one in place.
        """
        manifest = {"version": self.version, "tables": tables, "buckets": self.buckets, "rows": self.row_counts}
        _replace_file(self.spark, f"{self.root}/{POINTER}", json.dumps(manifest))

    @classmethod
    def current(cls, spark: SparkSession, root: str) -> tuple[TableStore, list[str]]:
        """The published version and its table names."""
        manifest = json.loads(spark.read.text(f"{root.rstrip('/')}/{POINTER}").first()[0])
        store = cls(spark, root, manifest["version"], manifest["rows"])
        store.buckets = manifest["buckets"]
        return store, manifest["tables"]


def _replace_file(spark: SparkSession, target: str, text: str) -> None:
    """Replace a small file at once, on any file system that Hadoop knows."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(target)
    beside = jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}.new")
    files = final.getFileSystem(conf)
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = overwrite
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(beside, final, options)
