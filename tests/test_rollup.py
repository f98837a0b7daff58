from grainmart.functions.measures import (
    average, count_where, distinct_count, maximum, rate_where, ratio_of_totals, row_count, total,
)
from grainmart.operators.rollup import Rollup, enrich, feature_mart, split_pools, union_pools

CHILD = Rollup("k", (
    row_count("n").or_zero(), distinct_count("kinds", "kind"), count_where("big", "x > 5").or_zero(),
    rate_where("big_rate", "x > 5"), average("x_avg", "x"), maximum("x_max", "x"),
    total("x_sum", "x"), ratio_of_totals("ratio", "x", "w"),
), "has_child")


def child(spark):
    return spark.createDataFrame([
        (1, "a", 10.0, 4.0), (1, "b", None, 0.0), (1, "a", 2.0, None), (2, None, None, -1.0),
        (None, "a", 1.0, 1.0),
    ], "k int, kind string, x double, w double")


def test_measures_treat_nulls_as_declared(spark):
    got = {r["k"]: r.asDict() for r in CHILD.apply(child(spark)).collect()}
    assert got[1] == {"k": 1, "n": 3, "kinds": 2, "big": 1, "big_rate": 1 / 3, "x_avg": 6.0,
                      "x_max": 10.0, "x_sum": 12.0, "ratio": 3.0}
    assert got[2]["x_sum"] is None and got[2]["ratio"] is None and got[2]["big"] == 0
    assert got[2]["kinds"] == 0 and got[2]["big_rate"] == 0.0
    assert None in got  # rows without a key form their own group


def test_mart_keeps_every_spine_row_once(spark):
    spine = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "k int, name string")
    mart = feature_mart(spine, [(CHILD, CHILD.apply(child(spark)))], "k")
    got = {r["name"]: r.asDict() for r in mart.collect()}
    assert mart.columns == ["k", "name", *CHILD.names, "has_child"]
    assert len(got) == 4
    assert got["z"]["n"] == 0 and got["z"]["big"] == 0 and got["z"]["kinds"] is None
    assert got["z"]["has_child"] is False and got["x"]["has_child"] is True
    assert got["n"]["n"] == 0 and got["n"]["has_child"] is False


def test_a_key_with_most_rows_reaches_the_shuffle_as_partial_aggregates(spark):
    hot = spark.range(0, 100_000, 1, 8).selectExpr(
        "CAST(CASE WHEN id % 3 > 0 THEN 7 ELSE id END AS INT) AS k", "'a' AS kind",
        "1D AS x", "1D AS w")
    rolled = CHILD.apply(hot)
    assert rolled.filter("k = 7").first()["n"] == 66_666
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_rollup_joins_reuse_the_partitioning_of_the_aggregate(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = Rollup("k", (row_count("n"),))
        other = Rollup("k", (total("s", "x"),))
        spine = child(spark).select("k").distinct()
        mart = feature_mart(spine, [(plain, plain.apply(child(spark))), (other, other.apply(child(spark)))], "k")
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3  # spine and one per rollup
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_enrichment_keeps_children_without_history(spark):
    rolled = spark.createDataFrame([(1, 5)], "k int, m int")
    got = enrich(spark.createDataFrame([(1,), (1,), (9,)], "k int"), rolled, "k", ["m"]).collect()
    assert sorted((r["k"], r["m"]) for r in got if r["m"]) == [(1, 5), (1, 5)] and len(got) == 3


def test_pools_union_by_name_with_a_typed_null_label(spark):
    train = spark.createDataFrame([(1, 1.0, "a")], "id int, y double, c string")
    score = spark.createDataFrame([("b", 2)], "c string, id int")
    pool = union_pools(train, score, "y", "is_train")
    assert dict(pool.dtypes)["y"] == "double"
    fit, rest = split_pools(pool, "is_train")
    assert [r["id"] for r in fit.collect()] == [1]
    assert [(r["id"], r["y"], r["c"]) for r in rest.collect()] == [(2, None, "b")]
