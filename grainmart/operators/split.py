"""Seeded, reproducible, exactly sized splits that do not depend on how rows are partitioned.

Rows are ranked by the hash of their id within a stratum, and a slice is a range of ranks. Only
the few (hash, id) values at the slice boundaries are needed: bucket counts over the leading hex
digits find the bucket of each boundary, and only those buckets are ranked. After that, a row's
slice is a plain expression on its own id, so applying a split moves no data.

Rows that share an id share a slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 3
BINARY = (0, 1)


def seeded_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def _boundaries(
    hashed: DataFrame, id_col: str, strata: Sequence, ranks_of: Callable[[int], Sequence[int]]
) -> dict:
    """Per stratum the (hash, id) found at each wanted 0-based rank that exists.

    Collected are at most len(strata) * 16 ** HASH_DIGITS counts and one row per boundary.
    """
    counts = hashed.groupBy("__stratum", "__bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    searches = []
    for stratum in strata:
        mine = sorted((r["__bucket"], r["n"]) for r in counts if r["__stratum"] == stratum)
        ends = list(accumulate(n for _, n in mine))
        for rank in ranks_of(ends[-1] if ends else 0):
            for (bucket, n), end in zip(mine, ends):
                if end - n <= rank < end:
                    searches.append((stratum, bucket, rank - (end - n)))
                    break
    if not searches:
        return {}
    in_bucket = {(s, b) for s, b, _ in searches}

    def any_of(conditions):
        combined = F.lit(False)
        for condition in conditions:
            combined = combined | condition
        return combined

    upto = Window.partitionBy("__stratum", "__bucket").orderBy("__hash", id_col).rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = (
        hashed.filter(any_of(
            (F.col("__stratum") == s) & (F.col("__bucket") == b) for s, b in sorted(in_bucket)))
        .groupBy("__stratum", "__bucket", "__hash", id_col).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("last", F.sum("n").over(upto))
    )
    at_boundary = any_of(
        (F.col("__stratum") == s) & (F.col("__bucket") == b)
        & (F.col("last") - F.col("n") <= r) & (F.col("last") > r)
        for s, b, r in searches)
    found: dict = {}
    for row in ranked.filter(at_boundary).select("__stratum", "__hash", id_col).collect():
        found.setdefault(row["__stratum"], []).append((row["__hash"], row[id_col]))
    return found


def _slices(
    df: DataFrame, id_col: str, stratum: Column, strata: Sequence, seed: int,
    ranks_of: Callable[[int], Sequence[int]], name: str,
) -> DataFrame:
    """Rows of the listed strata with the number of boundaries at or below each as ``name``."""
    kept = df.filter(stratum.isin(*strata))
    hashed = kept.select(
        stratum.alias("__stratum"), id_col, seeded_hash(id_col, seed).alias("__hash")
    ).withColumn("__bucket", F.substring("__hash", 1, HASH_DIGITS))
    passed = F.lit(0)
    for value, cuts in _boundaries(hashed, id_col, strata, ranks_of).items():
        for cut_hash, cut_id in cuts:
            beyond = (F.col("__hash") > cut_hash) | (
                (F.col("__hash") == cut_hash) & (F.col(id_col) >= F.lit(cut_id)))
            passed = passed + F.when((stratum == value) & beyond, 1).otherwise(0)
    return kept.withColumn("__hash", seeded_hash(id_col, seed)).withColumn(name, passed).drop("__hash")


def stratified_folds(
    df: DataFrame, id_col: str, label: str, folds: int, seed: int,
    strata: Sequence = BINARY, name: str = "fold",
) -> DataFrame:
    """Rows with a label in ``strata`` and their fold 0..folds-1: floor(rank * folds / size), so
    fold sizes differ by at most one row per class."""
    return _slices(
        df, id_col, F.col(label), strata, seed,
        lambda size: [-(-j * size // folds) for j in range(1, folds)], name)


def stratified_holdout(
    df: DataFrame, id_col: str, label: str, share: float, seed: int,
    strata: Sequence = BINARY, name: str = "is_holdout",
) -> DataFrame:
    """Rows with a label in ``strata`` and whether they are held out: ceil(share * size) per class."""
    split = _slices(
        df, id_col, F.col(label), strata, seed,
        lambda size: [math.ceil(share * size)], name)
    return split.withColumn(name, F.col(name) == 0)


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly min(n, row count) rows of a frame with unique ids, the same ones on every run."""
    chosen = _slices(df, id_col, F.lit(0), (0,), seed, lambda size: [n], "__passed")
    return chosen.filter(F.col("__passed") == 0).drop("__passed")
