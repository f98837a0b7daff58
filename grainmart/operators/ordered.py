"""Exact order statistics without sorting everything in one task."""

from __future__ import annotations

import math
import struct as binary
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmart.functions.sqltext import ident, literal, struct
from grainmart.sources.scratch import stored

LEAF_ROWS = 1 << 20  # distinct values of a bracket that one task may rank
COLUMNS = 64  # whose quantiles are sought in the same passes
SKETCH, SKETCH_ERROR = 2048, 0.003  # size of a column's sketch; a share of the rows it rarely errs by
GRID = 1000  # equal shares of the rows at whose ends a sketch is read
FIRST_SHIFT = 52  # bits of a double's fraction


def running_totals(
    groups: DataFrame, by: Sequence[str], order: str, measures: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller ``order`` values of the same ``by`` group) and
    ``<m>_total`` (sum over the group) for each measure.

    ``groups`` must hold one row per (by, order) value. A distributed scan: rows are range
    partitioned by (by, order) and written with their partition's number; each partition is summed,
    and running sums inside a partition are shifted by the sums of the partitions before it. There
    are as many slices as Spark makes partitions, or ``slices``; no window spans more than one of
    them or, for their sums, more rows than there are of them.
    """
    ranged = groups.repartitionByRange(*([slices] if slices else []), *by, order)
    placed = stored(ranged.withColumn("__part", F.spark_partition_id()), "ranges")

    keys = [*by, "__part"]
    earlier = Window.partitionBy(*by, F.lit(0)).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by, F.lit(0))
    per_part = placed.groupBy(*keys).agg(*[F.sum(m).alias(f"__{m}") for m in measures])
    shifts = per_part.select(
        *keys,
        *[F.coalesce(F.sum(f"__{m}").over(earlier), F.lit(0)).alias(f"__{m}_shift") for m in measures],
        *[F.sum(f"__{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.select(
        *keys, *[c for c in groups.columns if c not in keys],
        *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"__{m}_inside") for m in measures],
    )
    return running.join(shifts, keys).select(
        *groups.columns,
        *[(F.col(f"__{m}_inside") + F.col(f"__{m}_shift")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def order_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with a 64-bit integer in the order of a double column: the number's own bits, negated below zero.

    Sign, exponent and fraction come from exact arithmetic, so equal numbers (0 and -0 too) have
    equal keys and ``key_value`` turns a key back into its number. Not for NaN.
    """
    a = F.abs(column)
    guess = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(a)).cast("double")))
    out = df.withColumn("__e", guess)
    power = F.pow(F.lit(2.0), F.col("__e"))
    out = out.withColumn("__e", F.when(power > a, F.col("__e") - 1).when(a >= power * 2, F.col("__e") + 1)
                         .otherwise(F.col("__e")))  # the logarithm may be off by one near a power of two
    whole = float(1 << FIRST_SHIFT)
    bits = (F.col("__e").cast("long") + 1023) * F.lit(1 << FIRST_SHIFT) \
        + ((a / F.pow(F.lit(2.0), F.col("__e")) - 1) * whole).cast("long")
    magnitude = F.when(a == 0, F.lit(0)).when(a == float("inf"), F.lit(2047 << FIRST_SHIFT)) \
        .when(a < 2.0 ** -1022, (a * 2.0 ** 537 * 2.0 ** 537).cast("long")).otherwise(bits)
    return out.withColumn(name, F.when(F.col(column) < 0, -magnitude).otherwise(magnitude)).drop("__e")


def key_value(key: int) -> float:
    value = binary.unpack(">d", binary.pack(">q", abs(key)))[0]
    return -value if key < 0 else value


def _number(value: float) -> str:
    return "CAST('Infinity' AS DOUBLE)" if value == math.inf else literal(value)


def _grown(sketch: list[float], share: float) -> tuple[float | None, float | None]:
    """[lo, hi) around a share of the rows, wider than a sketch errs; None where that is an end of the rows."""
    slack = 1 + GRID * SKETCH_ERROR
    low, high = math.floor(share * GRID - slack), math.ceil(share * GRID + slack)
    # The number after the upper one is the end, so that a value that fills the range is in it.
    beyond = math.nextafter(sketch[high], math.inf) if high < GRID else math.inf
    return sketch[low] if low > 0 and sketch[low] > -math.inf else None, beyond if beyond < math.inf else None


def _cut(lo: float | None, hi: float | None, ranges: Sequence[tuple]) -> list[tuple[float | None, float | None, bool]]:
    """[lo, hi) cut at the ends of ``ranges``: each piece in order, and whether a range covers it."""
    ends = sorted({e for r in ranges for e in r if e is not None and (lo is None or e > lo) and (hi is None or e < hi)})
    edges = [lo, *ends, hi]
    return [(a, b, any((r[0] is None or (a is not None and r[0] <= a)) and (r[1] is None or (b is not None and b <= r[1]))
                       for r in ranges)) for a, b in zip(edges, edges[1:])]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], leaf_rows: int = LEAF_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated exact quantiles of many columns, nulls and NaNs skipped.

    Two passes, for COLUMNS columns and all ranks at once. A mergeable sketch of every column brackets each
    wanted rank; then rows are counted by bracket, and by value inside brackets, combined before the
    shuffle. The counts are exact, so a rank that its bracket misses, or that shares it with more than
    ``leaf_rows`` distinct values, is sought again in the range that holds it. A value that fills many
    rows is one row of the counts. Collected are GRID numbers per column and a few counts per rank.
    """
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if probabilities:
        for begin in range(0, len(columns), COLUMNS):
            some = columns[begin:begin + COLUMNS]
            result.update(zip(some, _quantiles(df, some, probabilities, max(leaf_rows, SKETCH))))
    return result


def _quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], leaf_rows: int) -> list[list[float | None]]:
    spark = df.sparkSession
    numbers = df.selectExpr(*[
        f"nanvl(CAST({ident(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS c{i}" for i, c in enumerate(columns)])

    def pieces(cut: dict[int, list[tuple[float | None, float | None, bool]]]) -> DataFrame:
        """(i, s, x) of each number in piece s of column i, with the number as x in covered pieces."""
        def cases(i: int) -> str:
            parts = []
            for s, (lo, hi, covered) in enumerate(cut[i]):
                inside = [f"c{i} >= {_number(lo)}"] * (lo is not None) + [f"c{i} < {_number(hi)}"] * (hi is not None)
                fields = struct({"i": str(i), "s": str(s), "x": f"c{i}" if covered else "CAST(NULL AS DOUBLE)"})
                parts.append(f"WHEN {' AND '.join(inside or [f'c{i} IS NOT NULL'])} THEN {fields}")
            return f"CASE {' '.join(parts)} END"
        return numbers.selectExpr(f"inline(array_compact(array({', '.join(map(cases, cut))})))")

    grid = f"array({', '.join(literal(k / GRID) for k in range(GRID + 1))})"
    # (column, rank) -> the range that holds it, and its rank there; at first all rows.
    ranks: dict[tuple[int, int], float] = {}
    found: dict[tuple[int, int], float] = {}
    open_ranks: dict[tuple[int, int], tuple[tuple[float | None, float | None], int]] = {}
    ranges = {i: [(None, None, True)] for i in range(len(columns))}
    while ranges:
        sketches = {(r["i"], ranges[r["i"]][r["s"]][:2]): r for r in pieces(ranges).groupBy("i", "s").agg(
            F.count("x").alias("n"), F.kll_sketch_agg_double("x", SKETCH).alias("sketch")).selectExpr(
                "i", "s", "n", f"kll_sketch_get_quantile_double(sketch, {grid}) AS points").collect()}
        if not ranks:
            ranks = {(i, j): q * (r["n"] - 1) for (i, _), r in sketches.items() for j, q in enumerate(probabilities)}
            open_ranks = {(i, rank): ((None, None), rank) for (i, _), x in ranks.items() for rank in (math.floor(x), math.ceil(x))}
            if not ranks:
                break
        brackets: dict[tuple, list] = {}
        for (i, _), (held, inside) in open_ranks.items():
            r = sketches[i, held]
            brackets.setdefault((i, held), []).append(_grown(r["points"], inside / r["n"]))
        cut = {i: [piece for (at, held), b in brackets.items() if at == i for piece in _cut(*held, b)]
               for i in {i for i, _ in brackets}}
        counts = stored(pieces(cut).groupBy("i", "s", "x").agg(F.count(F.lit(1)).alias("n")), "quantile-counts")
        sizes = {(r["i"], r["s"]): r for r in counts.groupBy("i", "s").agg(
            F.sum("n").alias("n"), F.count("x").alias("distinct")).collect()}
        wanted, left = [], {}
        for (i, rank), (held, inside) in open_ranks.items():
            for s, (lo, hi, covered) in enumerate(cut[i]):
                size = sizes.get((i, s))
                if size is None or not _within(lo, hi, held):
                    continue
                if inside < size["n"]:
                    if covered and size["distinct"] <= leaf_rows:
                        wanted.append((i, rank, s, inside))
                    else:
                        left[i, rank] = ((lo, hi), inside)
                    break
                inside -= size["n"]
        if wanted:
            at = spark.createDataFrame(wanted, "i int, rank bigint, s int, inside bigint")
            upto = Window.partitionBy("i", "s").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
            ranked = counts.join(at.select("i", "s").distinct(), ["i", "s"], "left_semi").withColumn("last", F.sum("n").over(upto))
            for r in ranked.join(at, ["i", "s"]).where("inside >= last - n AND inside < last").select("i", "rank", "x").collect():
                found[r["i"], r["rank"]] = r["x"]
        open_ranks = left
        ranges = {i: sorted({(*held, True) for (at, _), (held, _) in left.items() if at == i}, key=lambda r: -math.inf if r[0] is None else r[0])
                  for i in {i for i, _ in left}}

    out: list[list[float | None]] = [[None] * len(probabilities) for _ in columns]
    for (i, j), x in ranks.items():
        low, high = found[i, math.floor(x)], found[i, math.ceil(x)]
        out[i][j] = low if low == high else low + (high - low) * (x - math.floor(x))
    return out


def _within(lo: float | None, hi: float | None, held: tuple[float | None, float | None]) -> bool:
    return (held[0] is None or (lo is not None and lo >= held[0])) and (held[1] is None or (hi is not None and hi <= held[1]))
