"""The reduction tree of the monotone fit against the max-min formula."""

import random

import pytest

from grainmart.operators import isotonic


def brute(rows):
    scores = sorted({s for s, _ in rows})
    sums = [(sum(y for s, y in rows if s == x), sum(s == x for s, _ in rows)) for x in scores]

    def mean(a, b):
        return sum(t for t, _ in sums[a:b + 1]) / sum(w for _, w in sums[a:b + 1])

    n = len(scores)
    return {scores[i]: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)}


@pytest.mark.parametrize(("ranges", "fan"), [(1, 16), (7, 2), (40, 3)])
@pytest.mark.parametrize("shape", ["noise", "rising", "falling"])
def test_steps_equal_the_formula_for_any_ranges(spark, monkeypatch, ranges, fan, shape):
    monkeypatch.setattr(isotonic, "FAN", fan)
    rng = random.Random(ranges)
    share = {"noise": lambda s: 0.5, "rising": lambda s: s, "falling": lambda s: 1 - s}[shape]
    rows = [(s := round(rng.random(), 2), int(rng.random() < share(s))) for _ in range(400)] + [(0.31, 1)] * 150
    df = spark.createDataFrame([*rows, (None, 1), (0.5, None)], "s double, y int")
    steps = isotonic.monotone_steps(df, "s", "y", ranges).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] and a["value"] < b["value"] for a, b in zip(steps, steps[1:], strict=False))
    assert sum(r["weight"] for r in steps) == len(rows)
    for s, want in brute(rows).items():
        assert [r["value"] for r in steps if r["lo"] <= s <= r["hi"]] == [pytest.approx(want)]


def test_no_rows_have_no_steps(spark):
    assert isotonic.monotone_steps(spark.createDataFrame([], "s double, y int"), "s", "y").count() == 0
