import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from grainmart.operators import features as f

SCHEMA = "id int, target int, is_train boolean, amt double, age double, gender string, flag boolean"
ROWS = [(1, 1, True, 10.0, 30.0, "M", True), (2, 0, True, None, 40.0, "F", False),
        (3, 0, True, 30.0, 50.0, None, True), (4, None, False, 20.0, 60.0, "X", False)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def vectors(df):
    return [list(r["v"]) for r in df.orderBy("id").select(vector_to_array(f.FEATURES_COL).alias("v")).collect()]


def test_feature_list_and_types(frame):
    columns = f.feature_columns(frame, ("id", "target", "is_train"))
    assert columns == ["amt", "age", "gender", "flag"]
    assert f.split_types(frame, columns) == (["amt", "age", "flag"], ["gender"])


def test_levels_are_captured_on_the_training_pool_and_reused(frame):
    levels = f.capture_levels(frame.filter("is_train"), ["gender"])
    assert {tuple(r) for r in levels.collect()} == {("gender", "F", 0), ("gender", "M", 1)}
    assert f.level_lists(levels, ["gender", "none"]) == {"gender": ["F", "M"], "none": []}
    got = f.conform_levels(frame, levels, ["gender"]).orderBy("id")
    assert got.columns == frame.columns and [r["gender"] for r in got.collect()] == ["M", "F", None, None]
    one = f.conform_levels(frame.filter("id = 3"), levels, ["gender"])  # a single row whose level is null
    assert one.first()["gender"] is None
    assert f.capture_levels(frame, []).count() == 0
    unknown = f.conform_levels(frame, levels.limit(0), ["gender"])
    assert unknown.filter("gender IS NOT NULL").count() == 0 and unknown.count() == 4


def test_a_column_may_have_any_number_of_levels(spark):
    pool = spark.range(300_000).selectExpr("CAST(id % 150000 AS STRING) AS c", "CAST(id % 3 AS STRING) AS `odd name`")
    levels = f.capture_levels(pool, ["c", "odd name"])
    places = levels.groupBy("feature").agg(F.max("index"), F.count("level")).collect()
    assert {tuple(r) for r in places} == {("c", 149_999, 150_000), ("odd name", 2, 3)}
    order = sorted(map(str, range(150_000)))
    for i in (0, 77_777, 149_999):
        assert levels.filter(f"feature = 'c' AND index = {i}").first()["level"] == order[i]
    score = spark.range(149_000, 151_000).selectExpr("id", "CAST(id AS STRING) AS c", "'2' AS `odd name`")
    got = f.conform_levels(score, levels, ["c", "odd name"])
    assert got.filter("c IS NULL").count() == 1000 and got.filter("`odd name` = '2'").count() == 2000
    assert "IN (" not in got._jdf.queryExecution().toString()


def test_most_frequent_level_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", "y"), ("a", None)], "p string, q string")
    assert {tuple(r) for r in f.most_frequent(df, ["p", "q"]).collect()} == {("p", "a"), ("q", "y")}


def test_linear_preparation_fills_scales_and_ignores_unseen_levels(frame):
    prep = f.fit_linear_preparation(frame.filter("is_train"), ["amt", "age", "flag"], ["gender"])
    got = vectors(prep.transform(frame))
    amt = np.array([10.0, 20.0, 30.0])  # the null takes the median of 10 and 30
    for row, value in zip(got, [10.0, 20.0, 30.0, 20.0]):
        assert row[0] == pytest.approx((value - amt.mean()) / amt.std())
    assert [r[3:] for r in got] == [[0, 1], [1, 0], [1, 0], [0, 0]]  # null -> F, X -> zeros


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "id int, c double, e double")
    prep = f.fit_linear_preparation(df, ["c", "e"], [])
    assert vectors(prep.transform(df)) == [[0.0], [0.0]]


def test_tree_preparation_keeps_missingness_as_a_signal(frame):
    pool = frame.filter("is_train")
    prep = f.fit_tree_preparation(pool, ["amt", "age"], {"gender": ["F", "M"]})
    assert prep.slot_features == ["amt", "amt", "age", "gender"] and prep.max_categories == 3
    got = vectors(prep.transform(frame))
    assert got[1][0] < 10.0 and got[1][1] == 1.0 and got[0][:2] == [10.0, 0.0]
    assert [r[3] for r in got] == [1.0, 0.0, 2.0, 2.0]  # null and unseen share the extra number


def test_class_weights(frame):
    row = f.class_counts(frame, "target").first()
    assert (row["positive_weight"], row["balanced_negative"], row["balanced_positive"]) == (2.0, 0.75, 1.5)
    with pytest.raises(ValueError, match="both classes"):
        f.class_weight(frame.filter("target = 0"), "target", balanced=True)


def test_text_with_quotes_survives(spark):
    df = spark.createDataFrame([(1, "it's", 1.0), (2, "it's", 2.0), (3, None, 3.0), (4, 'a\\b"', 0.0)],
                               "id int, `odd name` string, v double")
    prep = f.fit_linear_preparation(df, ["v"], ["odd name"])
    assert [r[1:] for r in vectors(prep.transform(df))] == [[0, 1], [0, 1], [0, 1], [1, 0]]
