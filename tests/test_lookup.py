"""Keyed lookups: exact whatever the ids, and only the row groups near the ids are read."""

import random

import pytest

from grainmart.operators.score import id_spans, lookup_requests, within_spans
from grainmart.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    home = Warehouse(spark, str(tmp_path_factory.mktemp("lookup")))
    rows = spark.range(80000).selectExpr("id * 10 AS id", "id % 7 AS v", "id % 5 = 0 AS t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return home.replace(rows, "marts", "m", sort_by="id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def asked(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def scanned_rows(df):
    """Rows that the scans of a collected frame let through."""
    rows, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        else:
            if name == "FileSourceScanExec":
                rows += plan.metrics().apply("numOutputRows").value()
            children = plan.children()
            plans += [children.apply(i) for i in range(children.size())]
    return rows


def test_few_requests_read_few_row_groups(spark, mart):
    got = lookup_requests(mart, asked(spark, [20, 50, 50, 55, 799990]), "id")
    assert {(r["id"], r["found"], r["v"]) for r in got.collect()} == {
        (20, True, 2), (50, True, 5), (55, False, None), (799990, True, 79999 % 7)}
    assert 0 < scanned_rows(got) <= 80000 // 3


def test_any_requests_are_answered_exactly(spark, mart):
    draw = random.Random(3)
    for ids in ([], [None], [None, 30, 30], [-2**63, 2**63 - 1, 70], [draw.randrange(900000) for _ in range(3000)]):
        got = {r["id"]: r["found"] for r in lookup_requests(mart, asked(spark, ids), "id").collect()}
        assert got == {i: i is not None and 0 <= i < 800000 and i % 10 == 0 for i in ids}


def test_spans_hold_every_id_and_are_bounded(spark):
    draw = random.Random(5)
    ids = [draw.choice([draw.randrange(1000), 10**12 + draw.randrange(1000), -draw.randrange(10**6)]) for _ in range(500)]
    spans = id_spans(asked(spark, ids), "id", 16)
    assert len(spans) <= 16 and all(any(a <= i <= b for a, b in spans) for i in ids)
    assert id_spans(asked(spark, [None]), "id") == []
    assert asked(spark, ids).filter(within_spans("id", [])).isEmpty()


def test_text_ids_are_looked_up_without_spans(spark):
    mart = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    got = lookup_requests(mart, spark.createDataFrame([("b",), ("c",)], "id string"), "id")
    assert {tuple(r) for r in got.collect()} == {("b", 2, True), ("c", None, False)}
