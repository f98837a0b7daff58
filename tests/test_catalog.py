import pytest
from pyspark.sql import types as T

from grainmart.sources.catalog import (
    AbsentInputs, RejectedTable, TableSpec, ingest, load_table, missing_inputs,
)
from grainmart.sources.warehouse import (
    Warehouse, load_mart, read_metadata, read_runs, record_run, write_csv, write_metadata,
)

SPEC = TableSpec("t", "t.csv", ("ID", "V"), ("ID",), (("ID", T.LongType()), ("C", T.StringType()), ("V|W", T.DoubleType())))


def load(spark, tmp_path, text, spec=SPEC):
    (tmp_path / "t.csv").write_text(text)
    return load_table(spark, str(tmp_path), spec, Warehouse(spark, str(tmp_path / "wh")))


def test_all_missing_inputs_are_named(spark, tmp_path):
    other = TableSpec("u", "u.csv")
    assert missing_inputs(spark, str(tmp_path), [SPEC, other]) == ["t.csv", "u.csv"]
    with pytest.raises(AbsentInputs) as caught:
        ingest(spark, str(tmp_path), [SPEC, other], Warehouse(spark, str(tmp_path / "wh")))
    assert caught.value.files == ["t.csv", "u.csv"]


def test_types_come_from_the_rules_and_not_from_the_data(spark, tmp_path):
    assert load(spark, tmp_path, 'C,ID,V,W\nYes,1,2,"3"\n"a, ""b""",2,2.5,\n') == 2
    got = Warehouse(spark, str(tmp_path / "wh")).read("raw", "t")
    assert dict(got.dtypes) == {"C": "string", "ID": "bigint", "V": "double", "W": "double"}
    assert sorted(r["C"] for r in got.collect()) == ["Yes", 'a, "b"']


def test_undeclared_columns_get_the_type_that_fits_the_whole_file(spark, tmp_path):
    assert load(spark, tmp_path, "ID,V,note,size,share\n1,2,7,1,1\n2,3,late text,2,0.5\n") == 2
    got = Warehouse(spark, str(tmp_path / "wh")).read("raw", "t")
    assert dict(got.dtypes) == {"ID": "bigint", "V": "double", "note": "string", "size": "int", "share": "double"}


@pytest.mark.parametrize("text, failed", [
    ("ID,v\n1,2\n", [("column_exists", "V", 1)]),
    ("ID,V\n", [("not_empty", "*", 1)]),
    ("ID,V\n1,\n2,3\n", [("not_null", "V", 1)]),
    ("ID,V\n1,2\n1,3\n2,2\n", [("unique", "ID", 1)]),
    ("ID,V\n1,\n1,3\n,2\n", [("not_null", "ID", 1), ("not_null", "V", 1), ("unique", "ID", 1)]),
])
def test_one_report_names_every_fault_of_a_table(spark, tmp_path, text, failed):
    with pytest.raises(RejectedTable, match="^t: ") as caught:
        load(spark, tmp_path, text)
    assert caught.value.failed == failed


def test_a_value_of_the_wrong_type_is_not_lost_silently(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        load(spark, tmp_path, "ID,V\n1,abc\n")


def test_replace_overwrites_and_the_mart_keeps_a_boolean_split(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    frame = spark.createDataFrame([(2, True), (1, False)], "id int, is_train boolean")
    warehouse.replace(frame, "marts", "m", sort_by="id", partition_by="is_train")
    warehouse.replace(frame.filter("id = 1"), "marts", "m", sort_by="id", partition_by="is_train")
    mart = load_mart(warehouse, "m", "is_train")
    assert [tuple(r) for r in mart.select("id", "is_train").collect()] == [(1, False)]
    plan = mart.filter("is_train")._jdf.queryExecution().executedPlan().toString()
    assert "cast(is_train" in plan.split("PushedFilters")[0].split("FileScan")[1]  # prunes folders


def test_catalog_tables_can_be_bucketed_so_that_rollups_do_not_shuffle(spark):
    warehouse = Warehouse(spark, buckets=4)
    warehouse.create_namespaces()
    table = warehouse.replace(
        spark.range(100).selectExpr("id % 7 AS k", "id AS v"), "raw", "bucketed", bucket_key="k")
    rolled = table.groupBy("k").count()
    assert "Exchange" not in rolled._jdf.queryExecution().executedPlan().toString()
    assert rolled.count() == 7
    for layer in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_sinks_can_be_read_back(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, 0.5)], "ID int, P double"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().asDict() == {
        "ID": "1", "P": "0.5"}
    meta = {"feature_cols": ["a", "b"], "numeric_cols": ["a"], "categorical_cols": ["b"],
            "levels": {"b": ["x", "y"]}, "champion": "boosted_deep"}
    write_metadata(spark, str(tmp_path / "meta"), meta)
    assert read_metadata(spark, str(tmp_path / "meta")) == meta
    metric = spark.createDataFrame([("m", 0, "roc_auc", 0.7)], "model string, fold int, metric string, value double")


def test_a_run_recorded_twice_is_there_once_and_leaves_others_alone(spark, tmp_path):
    def metric(value):
        return spark.createDataFrame([("m", None, "roc_auc", value)], "model string, fold int, metric string, value double")

    path = str(tmp_path / "runs")
    for run, section, value in [("1", "folds", 0.7), ("2e5", "folds", 0.6), ("1", "holdout", 0.5), ("1", "folds", 0.8)]:
        record_run(metric(value), run, section, path)
    got = {(r["run_id"], r["section"], r["value"]) for r in read_runs(spark, path).collect()}
    assert got == {("1", "folds", 0.8), ("1", "holdout", 0.5), ("2e5", "folds", 0.6)}
    assert read_runs(spark, path).count() == 3


def test_a_failing_load_leaves_the_table_in_use(spark, tmp_path):
    assert load(spark, tmp_path, "ID,V\n1,2\n2,3\n") == 2
    with pytest.raises(RejectedTable):
        load(spark, tmp_path, "ID,V\n1,2\n1,3\n")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert warehouse.read("raw", "t").count() == 2 and warehouse.read("raw", "t").filter("ID = 2").count() == 1
    assert load(spark, tmp_path, "ID,V\n7,1\n") == 1  # a good load takes the place of the rejected one
    assert [tuple(r) for r in warehouse.read("raw", "t").collect()] == [(7, 1.0)]
    with pytest.raises(FileNotFoundError):
        warehouse.publish("raw", "t")


def test_a_catalog_table_is_published_in_place_of_the_older_one(spark):
    warehouse = Warehouse(spark, buckets=2)
    warehouse.create_namespaces(("raw",))
    warehouse.replace(spark.range(3), "raw", "p", bucket_key="id")
    warehouse.stage(spark.range(5), "raw", "p", bucket_key="id")
    assert warehouse.read("raw", "p").count() == 3
    assert warehouse.publish("raw", "p").count() == 5
    spark.sql("DROP DATABASE raw CASCADE")
