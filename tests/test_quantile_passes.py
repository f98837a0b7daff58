import random

import numpy as np
import pytest

from grainmart.operators import ordered


def _collects(monkeypatch, df):
    seen = []
    kind = type(df)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (seen.append(self.columns), collect(self))[1])
    return seen


def test_values_that_fill_many_rows_need_no_more_passes(spark, monkeypatch):
    df = spark.range(4000).selectExpr("CAST(id % 7 AS DOUBLE) AS tied", "CAST(id * 7919 % 4001 AS DOUBLE) AS spread")
    at = [0.0, 0.1, 0.5, 1.0]
    seen = _collects(monkeypatch, df)
    got = ordered.exact_quantiles(df, ["tied", "spread"], at, leaf_rows=100)
    assert len(seen) == 3  # sketches, sizes, ranked values
    pandas = df.toPandas()
    for c in got:
        assert got[c] == pytest.approx(np.quantile(pandas[c], at), abs=1e-9)


def test_ranks_that_a_poor_sketch_misses_or_leaves_wide_are_sought_again(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SKETCH", 8)
    monkeypatch.setattr(ordered, "SKETCH_ERROR", 0.0)
    rng = random.Random(5)
    inf = float("inf")
    columns = {"wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(3000)],
               "half": [rng.choice([0.0, -0.0, rng.random()]) for _ in range(3000)],
               "ends": rng.choices([-inf, -1.0, 5e-324, 2.0, inf], k=3000)}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    ranks = [0, 1, 300, 1499, 1500, 2600, 2999]
    seen = _collects(monkeypatch, df)
    got = ordered.exact_quantiles(df, list(columns), [r / 2999 for r in ranks], leaf_rows=1)
    assert len(seen) > 3
    for c, values in columns.items():
        values = sorted(values)
        for r, x in zip(ranks, got[c], strict=True):
            assert values[max(0, r - 1)] <= x <= values[min(2999, r + 1)]
            assert x == pytest.approx(values[r], rel=1e-6)


def test_more_columns_than_one_pass_takes(spark, monkeypatch):
    monkeypatch.setattr(ordered, "COLUMNS", 2)
    df = spark.range(101).selectExpr("id AS a", "id * 2 AS b", "id * 3 AS c")
    assert ordered.exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [50.0], "b": [100.0], "c": [150.0]}
