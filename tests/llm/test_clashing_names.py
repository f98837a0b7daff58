"""Operators that hand rows on, over tables whose other columns have the names that operators use themselves."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from grainmart.llm.exact_dedup import drop_exact_copies
from grainmart.llm.mix_sources import mix_sources, mixed
from grainmart.llm.ngram_join import drop_near_copies
from grainmart.llm.toxicity import toxicity, without_toxic

NAMES = ("_id", "_sha", "_size", "_key", "label", "shard", "slot", "doc", "id", "of", "sha", "digest", "points", "length", "key",
         "tie", "number", "words", "copy", "copies", "size", "set_key", "body", "score", "predicted", "a.b")
GOOD = "the quiet river runs past the old mill and the green field beyond it number"
BAD = "kxq kxq vile kxq words kxq again kxq kxq number"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{BAD if i % 4 == 0 else GOOD} {i * 7919 % 1000} {i}", "ab"[i % 2]) for i in range(80)]
    rows += [(3, rows[3][1] + "  ", "a"), (None, None, None), (None, "", "b"), (None, rows[5][1], None)]
    base = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return base.select("*", *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(80)], "doc_id long, toxic int, quality int")


def same_rows(out, docs):
    assert out.columns == docs.columns
    for row in out.collect():
        assert all(row[n] == f"{n}{'-' if row['doc_id'] is None else row['doc_id']}" for n in NAMES)


def test_rows_keep_all_their_columns(docs, labels):
    for out in (drop_exact_copies(docs), drop_near_copies(docs), mixed(docs), without_toxic(docs, labels)):
        same_rows(out, docs)
    assert drop_exact_copies(docs).count() == 81
    kept = without_toxic(docs, labels).select("doc_id").collect()
    assert {r[0] for r in kept} == {None} | {i for i in range(80) if i % 4}
    assert toxicity(docs, labels).count() == docs.count()


def test_stages_of_the_pipeline_on_clashing_names_and_no_rows(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in P.STAGES[:-1]:
        same_rows(stage(spark, docs, str(tmp_path)), docs)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert P.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_rows_that_repeat_id_and_size_meet_the_target_within_a_document(spark):
    text = " ".join(["w"] * 10)
    docs = spark.createDataFrame([(None, text, "a")] * 400 + [(i, text, "b") for i in range(200)], "doc_id long, text string, source string")
    got = mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n"))
    for row in got.collect():
        assert abs(row["taken"] - row["target"]) <= 10 and row["n"] == (400 if row["source"] == "a" else 200)
    copies = mixed(docs).groupBy("source").count().collect()
    assert {r[0]: 10 * r[1] for r in copies} == {r["source"]: r["taken"] for r in got.collect()}
    again = mix_sources(docs.repartition(7)).select("doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(map(str, mix_sources(docs).select("doc_id", "taken").collect()))
