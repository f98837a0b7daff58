import pytest

from grainmart.operators import quality as q

VALID = "id bigint, is_train boolean, target double, n bigint, m bigint, has_a_history boolean, other double"
CONTRACT = q.Contract("id", "target", "is_train", ("n", "m"))
ROWS = [(1, True, 1.0, 0, 2, True, None), (2, False, None, 3, 0, False, None)]


def failures(report):
    return {(r["rule"], r["column"]): r["failures"] for r in report.collect() if r["failures"]}


def test_a_valid_mart_passes_and_unlisted_nulls_are_tolerated(spark):
    report = CONTRACT.report(spark.createDataFrame(ROWS, VALID))
    assert failures(report) == {}
    q.gate(report)


def test_every_violation_is_collected_before_failing(spark):
    bad = ROWS + [(2, True, 2.0, -1, None, None, 0.0)]
    report = CONTRACT.report(spark.createDataFrame(bad, VALID))
    expected = {("unique", "id"): 1, ("accepted_values", "target"): 1, ("at_least", "n"): 1,
                ("not_null", "m"): 1, ("not_null", "has_a_history"): 1}
    assert failures(report) == expected
    with pytest.raises(q.QualityError) as error:
        q.gate(report)
    assert len(error.value.failed) == 5


def test_missing_columns_and_wrong_types_are_violations(spark):
    report = CONTRACT.report(spark.createDataFrame(
        [(1.5, "x", 1)], "id double, has_a_history string, n int"))
    found = failures(report)
    assert found[("type", "id")] == 1 and found[("type", "has_a_history")] == 1
    assert found[("column_exists", "is_train")] == 1 and found[("column_exists", "m")] == 1


def test_row_level_violations_name_key_rule_and_value(spark):
    df = spark.createDataFrame([(1, 5, None), (2, -1, "a"), (3, None, "b")], "id int, n int, s string")
    got = q.violating_rows(df, [q.at_least("n", 0), q.not_null("n"), q.accepted_values("s", ["a"])], "id")
    assert sorted(tuple(r) for r in got.collect()) == [
        (2, "at_least", "n", "-1"), (3, "accepted_values", "s", "b"), (3, "not_null", "n", None)]


def test_scoped_rules_and_label_consistency(spark):
    df = spark.createDataFrame(
        [(1, True, 5), (2, False, 5), (3, True, None), (4, False, None)], "id int, t boolean, y int")
    report = q.check_rows(df, [
        q.accepted_values("y", [0, 1], where="t"), q.label_matches_split("y", "t")], "id")
    assert [(r["failures"], r["sample"]) for r in report.collect()] == [(1, "1"), (2, "2")]


def test_composite_keys_and_orphans_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS INT) AS k",
                                      "CAST(id % 2 AS INT) AS v")
    report = q.check_unique(df, ["k", "v"])
    assert report.first()["failures"] == 2
    parent = spark.range(1, 3000).selectExpr("CAST(id AS INT) AS k")
    orphans = q.orphan_keys(df, "k", parent, "k").collect()
    assert [tuple(r) for r in orphans] == [(0, 1000)]
    assert q.check_relationship(df, "k", parent, "k").first()["failures"] == 1000


def test_null_child_keys_pass_and_empty_tables_fail(spark):
    child = spark.createDataFrame([(None,), (1,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert failures(q.check_relationship(child, "k", parent, "k")) == {}
    assert q.check_not_empty(child.filter("k > 9")).first()["failures"] == 1
    assert [tuple(r) for r in q.null_counts(child, ["k"]).collect()] == [("k", 2, 1)]


def _family(spark):
    parents = spark.createDataFrame([(1, 5), (2, 5), (2, 6), (None, 7)], "p long, v int")
    children = spark.createDataFrame(
        [(10, 1, "a"), (9, 1, "a"), (9, 3, "b"), (7, 3, None), (None, None, "b"), (None, 8, "a")], "c int, p long, s string")
    rules = {
        "parents": q.TableRules("p", (q.not_null("p"), q.at_least("v", 6)), "p"),
        "children": q.TableRules("c", (q.not_null("s"), q.accepted_values("s", ["a"])), "c", (("p", "parents", "p"),))}
    return {"parents": parents, "children": children}, rules


def test_one_grouping_gives_what_the_checks_of_each_table_give(spark):
    tables, rules = _family(spark)
    expected = set()
    for name, wanted in rules.items():
        df = tables[name]
        reports = [q.check_rows(df, wanted.rows, wanted.key), q.check_unique(df, [wanted.unique])]
        reports += [q.check_relationship(df, c, tables[p], k) for c, p, k in wanted.parents]
        expected |= {(*map(str, r), name) for report in reports for r in report.collect()}
    got = q.check_tables(tables, rules)
    assert got.columns == ["rule", "column", "failures", "sample", "table"]
    assert {tuple(map(str, r)) for r in got.collect()} == expected
    assert ("relationship", "p", "3", "3", "children") in expected


def test_one_grouping_reads_each_table_once(spark, tmp_path):
    tables, rules = _family(spark)
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    stored = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in tables}
    plan = q.check_tables(stored, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "Join" not in plan


def test_one_grouping_of_empty_tables_text_keys_and_absent_parents(spark):
    tables, rules = _family(spark)
    empty = {name: df.filter("false") for name, df in tables.items()}
    report = q.check_tables(empty, rules)
    assert report.count() == 7 and failures(report) == {}
    q.gate(report)
    texts = {name: df.withColumn("p", q.F.col("p").cast("string")) for name, df in tables.items()}
    assert failures(q.check_tables(texts, rules)) == failures(q.check_tables(tables, rules))
    alone = q.check_tables({"children": tables["children"]}, rules)
    assert {r["rule"] for r in alone.collect()} == {"not_null", "accepted_values", "unique"}


def test_one_grouping_survives_a_hot_key_that_breaks_rules(spark):
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN 4 ELSE id END AS k", "-id AS n")
    rules = {"t": q.TableRules("k", (q.at_least("n", 0),), "k", (("k", "u", "k"),))}
    report = q.check_tables({"t": df, "u": spark.range(4, 30000).toDF("k")}, rules)
    assert failures(report) == {("at_least", "n"): 19999, ("unique", "k"): 1, ("relationship", "k"): 2}
    assert {r["sample"] for r in report.collect()} == {"1", "4"}
