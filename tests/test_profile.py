import pytest

from grainmart.operators import profile


def test_missing_rates(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in profile.missing_rates(df, ["a", "b"]).collect()] == [("a", 0.5), ("b", 0.0)]


def test_correlation_orders_by_magnitude_keeps_sign_and_drops_constants(spark):
    data = [(y, y + 0.1 * i, -y + 0.01 * i, (i * 3) % 5 * 1.0, 0.1, None if i % 2 else float(y))
            for i, y in enumerate([0, 1, 0, 1, 0, 1, 1, 0])]
    df = spark.createDataFrame(data, "y int, pos double, neg double, weak double, const double, half double")
    got = profile.label_correlations(df, ["pos", "neg", "weak", "const", "half"], "y").collect()
    pandas = df.toPandas()
    assert {r["feature"] for r in got} == {"pos", "neg", "weak", "half"}
    magnitudes = [abs(r["correlation"]) for r in got]
    assert magnitudes == sorted(magnitudes, reverse=True)
    for r in got:
        assert r["correlation"] == pytest.approx(pandas[r["feature"]].corr(pandas["y"]), abs=1e-12)
    assert next(r["correlation"] for r in got if r["feature"] == "neg") < 0


def test_level_spread_ignores_rare_and_null_levels(spark):
    rows = [(0, "a", "r") for _ in range(25)] + [(1, "b", "r") for _ in range(24)] + [(1, "c", None)]
    df = spark.createDataFrame(rows, "y int, wide string, flat string")
    got = profile.level_spread(df, ["wide", "flat"], "y").collect()
    assert [tuple(r) for r in got] == [("wide", 1.0, 2), ("flat", 0.0, 1)]


def test_report_text(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (1, 2.0, "a")] * 20, "y int, x double, c string")
    text = profile.render_markdown(
        profile.header(df, ["x"], ["c"], "y"), profile.missing_rates(df, ["x", "c"]),
        profile.label_correlations(df, ["x"], "y"), profile.level_spread(df, ["c"], "y"))
    assert "Label rate: 50.00%" in text and "| `x` | +1.000 |" in text and "Features: 2" in text
