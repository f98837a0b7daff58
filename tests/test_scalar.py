from pyspark.sql import functions as F

from grainmart.functions import scalar


def rows(spark, data, schema, **columns):
    return [r.asDict() for r in spark.createDataFrame(data, schema).select(
        *[c.alias(n) for n, c in columns.items()]).collect()]


def test_guarded_ratio_is_null_unless_the_denominator_is_positive(spark):
    got = rows(spark, [(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (None, 2.0), (1.0, None)],
               "a double, b double", r=scalar.guarded_ratio("a", "b"))
    assert [g["r"] for g in got] == [0.5, None, None, None, None]


def test_sentinel_becomes_null_and_its_flag_is_never_null(spark):
    got = rows(spark, [(365243,), (-10,), (None,)], "d int",
               v=scalar.days_since(scalar.without_sentinel("d")), f=scalar.is_sentinel("d"),
               y=scalar.years_since(scalar.without_sentinel("d")))
    assert [g["v"] for g in got] == [None, 10, None]
    assert [g["f"] for g in got] == [True, False, False]
    assert [g["y"] for g in got] == [None, 10 / 365.25, None]


def test_strict_sum_propagates_null_while_the_mean_fills_zero(spark):
    got = rows(spark, [(1, 2), (1, None), (None, None)], "a int, b int",
               s=scalar.strict_sum(["a", "b"]), m=scalar.zero_filled_mean(["a", "b"]),
               n=scalar.missing_share(["a", "b"]))
    assert [g["s"] for g in got] == [3, None, None]
    assert [g["m"] for g in got] == [1.5, 0.5, 0.0]
    assert [g["n"] for g in got] == [0.0, 0.5, 1.0]


def test_membership_and_digits(spark):
    got = rows(spark, [("3",), ("C",), ("12",), (None,)], "s string",
               m=scalar.is_one_of("s", ["1", "3"]), d=scalar.digit_or_null("s"))
    assert [g["m"] for g in got] == [True, False, False, False]
    assert [g["d"] for g in got] == [3, None, None, None]


def test_tiers_outcomes_and_rendering(spark):
    got = rows(spark, [(0.0799, 1.0), (0.08, 0.0), (0.2, None), (None, None)], "p double, y double",
               t=scalar.risk_tier("p"), o=scalar.outcome_label("y"), v=scalar.rendered("p"))
    assert [g["t"] for g in got] == ["Low", "Medium", "High", None]
    assert [g["o"] for g in got] == ["Default", "No default"] + ["Unknown (scoring set)"] * 2
    assert [g["v"] for g in got] == ["0.0799", "0.08", "0.2", None]


def test_nan_is_normalised_to_null(spark):
    got = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").select(
        scalar.normalise_nan("x").alias("x"))
    assert [r["x"] for r in got.collect()] == [None, 1.0]
    assert got.filter(F.col("x").isNull()).count() == 1
