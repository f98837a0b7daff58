"""Layered tables: replaceable copies, persisted layers, and the sinks of reports and runs.

Two homes for a layer: plain Parquet folders, or catalog databases. Catalog tables can be
bucketed by the key that later rollups and joins use, which removes their shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGED = "__staged"
LAYERS = ("raw", "staging", "intermediate", "marts")

_METADATA_SCHEMA = (
    "feature_cols array<string>, numeric_cols array<string>, categorical_cols array<string>, "
    "levels array<struct<column:string,values:array<string>>>, champion string"
)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str | None = None
    buckets: int = 0

    @property
    def in_catalog(self) -> bool:
        return self.root is None

    def create_namespaces(self, layers: Sequence[str] = LAYERS) -> None:
        """Layer names are used verbatim as database names; folders need no preparation."""
        if self.in_catalog:
            for layer in layers:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")

    def path(self, layer: str, name: str) -> str:
        return f"{str(self.root).rstrip('/')}/{layer}/{name}"

    def stage(
        self, df: DataFrame, layer: str, name: str, *, bucket_key: str | None = None,
        sort_by: str | None = None, partition_by: str | None = None,
    ) -> DataFrame:
        """Write the table beside the one in use, and return it as read back; ``publish`` puts it in place.

        ``sort_by`` range-sorts the rows, so that row-group statistics serve keyed lookups.
        ``partition_by`` lets a filter on that column skip the other partitions.
        """
        if sort_by:
            columns = [c for c in (partition_by, sort_by) if c]
            df = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        staged = f"{name}{STAGED}"
        if not self.in_catalog:
            writer.save(self.path(layer, staged))
        else:
            if bucket_key and self.buckets:
                writer = writer.bucketBy(self.buckets, bucket_key).sortBy(bucket_key)
            writer.saveAsTable(f"{layer}.{staged}")
        return self.read(layer, staged)

    def publish(self, layer: str, name: str) -> DataFrame:
        """Put the staged table in place of the older one, and return it as read there.

        A folder is renamed, not copied; the older one steps aside first and goes last, so that at
        no time neither is there.
        """
        staged = f"{name}{STAGED}"
        if self.in_catalog:
            self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
            self.spark.sql(f"ALTER TABLE {layer}.{staged} RENAME TO {layer}.{name}")
            return self.read(layer, name)
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        new, target, old = (hadoop.Path(self.path(layer, n)) for n in (staged, name, f"{name}__old"))
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(new):
            raise FileNotFoundError(f"nothing staged for {layer}.{name}")
        if files.exists(target):
            files.delete(old, True)
            files.rename(target, old)
        if not files.rename(new, target):
            raise OSError(f"could not publish {layer}.{name}")
        files.delete(old, True)
        self.spark.catalog.refreshByPath(self.path(layer, name))
        return self.read(layer, name)

    def replace(self, df: DataFrame, layer: str, name: str, **layout: str | None) -> DataFrame:
        """Write the table in place of an older one without a check, and return it as read back."""
        self.stage(df, layer, name, **layout)
        return self.publish(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        if self.in_catalog:
            return self.spark.table(f"{layer}.{name}")
        return self.spark.read.parquet(self.path(layer, name))


def load_mart(warehouse: Warehouse, name: str, split_flag: str) -> DataFrame:
    """The mart. A split flag kept as a folder name comes back as text, so it is cast; filters
    on it still prune folders."""
    mart = warehouse.read("marts", name)
    return mart.withColumn(split_flag, F.col(split_flag).cast("boolean"))


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV folder with one header line per part file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """Feature list, type split, levels and champion as one JSON row."""
    levels = metadata["levels"]
    row = {**metadata, "levels": [{"column": c, "values": v} for c, v in levels.items()]}
    spark.createDataFrame([row], _METADATA_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    row = spark.read.schema(_METADATA_SCHEMA).json(path).first().asDict(recursive=True)
    return {**row, "levels": {e["column"]: e["values"] for e in row["levels"]}}


RUNS_SCHEMA = "model string, fold int, metric string, value double, run_id string, section string"


def record_run(metrics: DataFrame, run_id: str, section: str, path: str) -> None:
    """Put one section of a run, (model, fold, metric, value) rows, into the table of runs.

    A section is a folder that is overwritten as a whole, so a repeated or retried run leaves what
    a single one leaves, and other runs are not touched.
    """
    metrics.select(
        "model", "fold", "metric", F.col("value").cast("double"), F.lit(run_id).alias("run_id"), F.lit(section).alias("section")
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "section").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The table of runs; ids stay text even where all of them look like numbers."""
    return spark.read.schema(RUNS_SCHEMA).parquet(path)
