"""Data-quality rules that report every violation as a table.

All row-level rules of a frame share one aggregation pass. Key rules count groups after a
map-side combine, so a key that holds most rows costs no more than another.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmart.functions.sqltext import ident, literal, rows, struct
from grainmart.operators.rollup import union_all

REPORT_SCHEMA = "`rule` string, `column` string, failures bigint, sample string"


class QualityError(RuntimeError):
    """One or more rules failed; ``failed`` lists (rule, column, failures)."""

    def __init__(self, failed: list[tuple[str, str, int]]):
        self.failed = failed
        super().__init__("; ".join(f"{r}({c}): {n} failure(s)" for r, c, n in failed))


@dataclass(frozen=True)
class RowRule:
    """A rule on one row; ``violation`` is SQL that is true for an offending row."""

    rule: str
    column: str
    violation: str
    where: str | None = None

    @property
    def broken(self) -> str:
        """SQL that is true for an offending row in scope and never null."""
        scope = f" AND coalesce({self.where}, false)" if self.where else ""
        return f"(coalesce({self.violation}, false){scope})"


def not_null(column: str, where: str | None = None) -> RowRule:
    return RowRule("not_null", column, f"{ident(column)} IS NULL", where)


def at_least(column: str, low: float) -> RowRule:
    """A null passes; combine with ``not_null`` to forbid it."""
    return RowRule("at_least", column, f"{ident(column)} < {low}")


def accepted_values(column: str, values: Sequence, where: str | None = None) -> RowRule:
    """A null passes."""
    listed = ", ".join(literal(v) for v in values)
    return RowRule("accepted_values", column, f"{ident(column)} NOT IN ({listed})", where)


def label_matches_split(label: str, split_flag: str) -> RowRule:
    """Training rows carry a label and scoring rows carry none."""
    return RowRule(
        "label_matches_split", label, f"{ident(split_flag)} = ({ident(label)} IS NULL)")


def _entry(rule: str, column: str, failures: str, sample: str) -> str:
    return struct({
        "rule": literal(rule), "column": literal(column),
        "failures": f"CAST({failures} AS BIGINT)", "sample": f"CAST({sample} AS STRING)"})


def check_rows(df: DataFrame, rules: Sequence[RowRule], key: str) -> DataFrame:
    """Per rule the number of offending rows and the smallest offending key: one pass."""
    aggregates = []
    for i, rule in enumerate(rules):
        aggregates.append(f"count_if({rule.broken}) AS n{i}")
        aggregates.append(f"min(CASE WHEN {rule.broken} THEN {ident(key)} END) AS k{i}")
    return df.selectExpr(*aggregates).selectExpr(rows(
        _entry(r.rule, r.column, f"n{i}", f"k{i}") for i, r in enumerate(rules)))


def violating_rows(df: DataFrame, rules: Sequence[RowRule], key: str) -> DataFrame:
    """Every offending (key, rule, column, value) as a row; no shuffle."""
    found = ", ".join(
        f"CASE WHEN {r.broken} THEN " + struct({
            "rule": literal(r.rule), "column": literal(r.column),
            "value": f"CAST({ident(r.column)} AS STRING)"}) + " END" for r in rules)
    return df.selectExpr(ident(key), f"inline(array_compact(array({found})))")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, and their sizes."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of duplicated non-null keys and the smallest of them."""
    keyed = df.dropna(subset=list(columns))
    shown = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    counted = duplicate_keys(keyed, columns).agg(
        F.count(F.lit(1)).alias("n"), F.min(shown).alias("k")
    )
    return counted.selectExpr(rows([_entry("unique", ",".join(columns), "n", "k")]))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values absent from the parent, with their row counts; null keys pass.

    Child rows are counted per key before the join, so a key with very many rows reaches the
    join as one row.
    """
    counted = (
        child.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias(column))
    return counted.join(known, column, "left_anti")


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Number of child rows whose key has no parent."""
    counted = orphan_keys(child, column, parent, parent_key).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), F.min(column).alias("k")
    )
    return counted.selectExpr(rows([_entry("relationship", column, "n", "k")]))


@dataclass(frozen=True)
class TableRules:
    """What must hold for one table of several; ``key`` samples the rows that break a row rule."""

    key: str
    rows: tuple[RowRule, ...] = ()
    unique: str | None = None
    parents: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, its key)


def check_tables(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """Every rule of every given table with its failures and smallest offending key, in one grouping.

    Each table is read once: a row gives a fact for each rule that it breaks, for its unique key, for each
    parent it needs and each child it may serve. Facts merge by (rule, key) before the shuffle, so a hot key
    sends one row per task; facts of row rules have no key there. An empty table breaks nothing, null keys
    are neither duplicates nor orphans, and a relationship to a table that is not given is not checked.
    Keys are whole numbers; those of other types are compared as text.
    """
    checks: list[tuple[str, str, str]] = []  # (table, rule, column)
    alike: dict[str, list[int]] = {"unique": [], "relationship": []}
    facts: dict[str, list[tuple[str, int, str, str, int]]] = {}  # table -> (condition, check, key, sample, as parent)

    def add(table: str, rule: str, column: str) -> int:
        checks.append((table, rule, column))
        if rule in alike:
            alike[rule].append(len(checks) - 1)
        return len(checks) - 1

    for table, wanted in rules.items():
        if table not in tables:
            continue
        own = facts.setdefault(table, [])
        for rule in wanted.rows:
            own.append((rule.broken, add(table, rule.rule, rule.column), "NULL", ident(wanted.key), 0))
        if wanted.unique:
            key = ident(wanted.unique)
            own.append((f"{key} IS NOT NULL", add(table, "unique", wanted.unique), key, key, 0))
        for column, parent, parent_key in wanted.parents:
            if parent not in tables:
                continue
            key, known, check = ident(column), ident(parent_key), add(table, "relationship", column)
            own.append((f"{key} IS NOT NULL", check, key, key, 0))
            facts.setdefault(parent, []).append((f"{known} IS NOT NULL", check, known, "NULL", 1))
    if not checks:
        raise ValueError("no rule for any of the tables")

    named = {(t, c) for t, w in rules.items() if t in tables
             for c in (w.key, w.unique, *(column for column, *_ in w.parents)) if c}
    named |= {(p, k) for t, w in rules.items() if t in tables for _, p, k in w.parents if p in tables}
    whole = all(isinstance(tables[t].schema[c].dataType, T.IntegralType) for t, c in named)
    kind = "BIGINT" if whole else "STRING"

    def emitted(table: str) -> DataFrame:
        found = ", ".join(
            f"CASE WHEN {condition} THEN " + struct({
                "check": str(check), "key": f"CAST({key} AS {kind})", "n": f"{1 - parent}L", "parents": f"{parent}L",
                "sample": f"CAST({sample} AS {kind})"}) + " END"
            for condition, check, key, sample, parent in facts[table])
        return tables[table].selectExpr(f"inline(array_compact(array({found})))")

    spark = next(iter(tables.values())).sparkSession
    # A fact without weight, so that a rule that nothing breaks is reported too.
    still = spark.range(len(checks)).selectExpr(
        "CAST(id AS INT) AS check", f"CAST(NULL AS {kind}) AS key", "0L AS n", "0L AS parents", f"CAST(NULL AS {kind}) AS sample")
    merged = union_all([*(emitted(t) for t in facts if facts[t]), still]).groupBy("check", "key").agg(
        F.sum("n").alias("n"), F.max("parents").alias("parents"), F.min("sample").alias("sample"))
    unique, orphan = (F.col("check").isin(*alike[r]) if alike[r] else F.lit(False) for r in ("unique", "relationship"))
    failures = (F.when(unique, (F.col("n") > 1).cast("long"))
                .when(orphan, F.when(F.col("parents") == 0, F.col("n")).otherwise(0)).otherwise(F.col("n")))
    counted = merged.withColumn("failures", failures).groupBy("check").agg(
        F.sum("failures").alias("failures"),
        F.min(F.when(F.col("failures") > 0, F.col("sample"))).cast("string").alias("first"),
        F.min(F.when(F.col("failures") > 0, F.col("sample").cast("string"))).alias("least"))
    labels = ", ".join(struct({"rule": literal(rule), "column": literal(column), "table": literal(table)})
                       for table, rule, column in checks)
    return counted.withColumn("label", F.expr(f"array({labels})[check]")).select(
        "label.rule", "label.column", "failures", F.when(unique, F.col("least")).otherwise(F.col("first")).alias("sample"),
        "label.table")


def check_not_empty(df: DataFrame) -> DataFrame:
    counted = df.selectExpr("count(1) AS n")
    return counted.selectExpr(rows([_entry("not_empty", "*", "n = 0", "NULL")]))


def check_schema(
    df: DataFrame, required: Sequence[str] = (),
    types: Sequence[tuple[str, tuple[type[T.DataType], ...]]] = (),
) -> DataFrame:
    """Absent columns (exact spelling) and columns of a wrong type; looks at the schema only.

    ``types`` pairs a full-match name pattern with the types it allows.
    """
    rows = [("column_exists", c, int(c not in df.columns), None) for c in required]
    for pattern, allowed in types:
        for f in df.schema.fields:
            if re.fullmatch(pattern, f.name):
                wrong = not isinstance(f.dataType, allowed)
                rows.append(("type", f.name, int(wrong), f.dataType.simpleString() if wrong else None))
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and null count per column in one pass."""
    counted = df.selectExpr(
        "count(1) AS n_rows", *[f"count({ident(c)}) AS v{i}" for i, c in enumerate(columns)])
    return counted.selectExpr(rows(
        struct({"column": literal(c), "n_rows": "n_rows", "n_null": f"n_rows - v{i}"})
        for i, c in enumerate(columns)))


@dataclass(frozen=True)
class Contract:
    """What must hold for a mart; columns that are not listed are free."""

    id_col: str
    label_col: str
    split_col: str
    count_columns: tuple[str, ...]
    flag_pattern: str = r"has_.*_history"
    label_values: tuple = (0, 1)

    def flags(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if re.fullmatch(self.flag_pattern, c)]

    def row_rules(self, df: DataFrame) -> list[RowRule]:
        present = set(df.columns)
        rules = [not_null(self.id_col), at_least(self.id_col, 0), not_null(self.split_col),
                 accepted_values(self.label_col, self.label_values)]
        rules += [not_null(c) for c in self.flags(df)]
        for c in self.count_columns:
            rules += [not_null(c), at_least(c, 0)]
        return [r for r in rules if r.column in present]

    def report(self, df: DataFrame) -> DataFrame:
        """All rules with their failures, the passing ones included."""
        required = (self.id_col, self.split_col, self.label_col, *self.count_columns)
        types = [(re.escape(self.id_col), (T.IntegralType,)),
                 (re.escape(self.split_col), (T.BooleanType,)),
                 (self.flag_pattern, (T.BooleanType,))]
        parts = [check_schema(df, required, types), check_rows(df, self.row_rules(df), self.id_col)]
        if self.id_col in df.columns:
            parts.append(check_unique(df, [self.id_col]))
        return union_all(parts)


def gate(report: DataFrame) -> None:
    """Raise with all failed rules. A report has one row per rule, so few rows are collected."""
    failed = report.filter("failures > 0").select("rule", "column", "failures").collect()
    if failed:
        raise QualityError(sorted(tuple(r) for r in failed))
