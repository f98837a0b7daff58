"""Source catalogue and checked CSV loading.

Declared columns are read with their types in FAILFAST mode, so a value that does not parse stops
the load; columns nobody declared get the type that fits the whole file. What a table must hold is
checked by the rules of the quality operators, and one report names every fault of a table.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from grainmart.operators import quality
from grainmart.operators.quality import QualityError
from grainmart.operators.rollup import union_all
from grainmart.sources.warehouse import Warehouse

logger = logging.getLogger(__name__)


class AbsentInputs(RuntimeError):
    """Files of the catalogue that are not there; ``files`` lists all of them."""

    def __init__(self, directory: str, files: Sequence[str]):
        self.files = list(files)
        super().__init__(f"{directory} lacks {', '.join(files)}")


class RejectedTable(RuntimeError):
    """A loaded table broke rules; ``failed`` lists (rule, column, failures) of all of them."""

    def __init__(self, table: str, error: QualityError):
        self.failed = error.failed
        super().__init__(f"{table}: {error}")


@dataclass(frozen=True)
class TableSpec:
    """One raw table: file name, columns that must be filled, and the key that must be unique.

    ``types`` maps name patterns to types, first match wins; the type of a column that matches
    none is inferred. ``bucket_key`` is the column later joins and groupings use.
    """

    name: str
    file_name: str
    required: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    types: tuple[tuple[str, T.DataType], ...] = ()
    bucket_key: str | None = None
    description: str = ""

    def declared(self, column: str) -> T.DataType | None:
        for pattern, data_type in self.types:
            if re.fullmatch(pattern, column):
                return data_type
        return None


def _join(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list the path, on any file system it can read."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def missing_inputs(spark: SparkSession, directory: str, specs: Sequence[TableSpec]) -> list[str]:
    """Every absent input, not just the first one."""
    return [s.file_name for s in specs if not path_exists(spark, _join(directory, s.file_name))]


def read_csv(spark: SparkSession, directory: str, spec: TableSpec) -> DataFrame:
    """The file as typed columns in header order.

    Only the header line is read up front, unless a column is undeclared: inferring its type is one
    more pass over the whole file.
    """
    path = _join(directory, spec.file_name)
    reader = spark.read.option("header", True).option("escape", '"')
    header = reader.csv(path).columns
    types = {c: spec.declared(c) for c in header}
    if None in types.values():
        inferred = {f.name: f.dataType for f in reader.option("inferSchema", True).csv(path).schema.fields}
        types = {c: t or inferred[c] for c, t in types.items()}
    schema = T.StructType([T.StructField(c, types[c]) for c in header])
    return reader.option("inferSchema", False).schema(schema).option("mode", "FAILFAST").csv(path)


def load_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every rule of the spec on a loaded table: columns, rows, filled columns, unique key."""
    present = [c for c in spec.required if c in df.columns]
    parts = [quality.check_schema(df, spec.required), quality.check_not_empty(df)]
    if present:
        parts.append(quality.check_rows(df, [quality.not_null(c) for c in present], present[0]))
    if spec.unique_key and set(spec.unique_key) <= set(df.columns):
        parts.append(quality.check_unique(df, spec.unique_key))
    return union_all(parts)


def load_table(spark: SparkSession, directory: str, spec: TableSpec, warehouse: Warehouse) -> int:
    """Copy one CSV beside the raw table, gate the copy, then publish it; returns its row count.

    The rules read the columnar copy, so they touch the key columns only. A copy that breaks one stays
    staged, and the table of the last good load stays in use.
    """
    copy = warehouse.stage(
        read_csv(spark, directory, spec), "raw", spec.name, bucket_key=spec.bucket_key)
    try:
        quality.gate(load_report(copy, spec))
    except QualityError as error:
        raise RejectedTable(spec.name, error) from error
    return warehouse.publish("raw", spec.name).count()


def ingest(
    spark: SparkSession, directory: str, specs: Sequence[TableSpec], warehouse: Warehouse
) -> Mapping[str, int]:
    """Load every table in catalogue order; nothing is loaded while an input is missing."""
    absent = missing_inputs(spark, directory, specs)
    if absent:
        raise AbsentInputs(directory, absent)
    warehouse.create_namespaces(("raw",))
    rows = {}
    for spec in specs:
        rows[spec.name] = load_table(spark, directory, spec, warehouse)
        logger.info("%s: %s rows, checks passed", spec.name, f"{rows[spec.name]:,}")
    return rows
