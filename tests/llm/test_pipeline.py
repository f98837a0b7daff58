"""The pipeline's stages on the small tables: columns, effects and whole results."""

import hashlib
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from grainmart.llm import queries
from grainmart.llm.byte_bpe import read_ranks
from grainmart.llm.toxicity import toxicity

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(DATA)).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == columns
        assert out.select(columns).exceptAll(docs.select(columns).union(docs.select(columns))).count() == 0
        seen.append((name, docs, out))
        docs = out
    names = [s[0] for s in seen]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mix_sources"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    toxic = labels.where("toxic = 1").select("doc_id")
    before, after = (seen[0][i].join(toxic, "doc_id").count() for i in (1, 2))
    assert after <= .3 * before
    assert seen[0][2].join(labels.where("toxic = 0"), "doc_id").count() >= .98 * seen[0][1].join(labels.where("toxic = 0"), "doc_id").count()
    squeezed = F.regexp_replace("text", r"[ \t-\r]", "")
    assert seen[1][2].select(squeezed).distinct().count() == seen[1][2].count() == seen[1][1].select(squeezed).distinct().count()
    assert seen[2][2].count() < seen[2][1].count()
    words = {n: d.select(F.sum(F.regexp_count("text", F.lit(r"[^ \t-\r]+")))).first()[0] for n, d in (("in", seen[3][1]), ("out", seen[3][2]))}
    assert abs(words["out"] - 1.5 * words["in"]) < .1 * words["in"]
    name, stage = corpus_pipeline.STAGES[-1]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = sorted((r["doc_id"], len(ids := library.encode_ordinary(r["text"])), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                  for r in docs.collect())
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in stage(spark, docs, str(DATA)).collect())
    assert got == want


def test_a_toxic_row_takes_no_other_row_of_its_id_along(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scored = toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    bad, good = (docs.join(scored.where(f"predicted = {p}").select("doc_id").orderBy("doc_id").limit(3), "doc_id")
                 .select(docs.columns).orderBy("doc_id") for p in (1, 0))
    for i in (None, -7):
        for rows in (bad, good):
            docs = docs.unionByName(rows.withColumn("doc_id", F.lit(i).cast("bigint")))
    out = corpus_pipeline.not_toxic(spark, docs, str(DATA))
    texts = sorted(r["text"] for r in good.collect())
    assert sorted(r["text"] for r in out.where("doc_id IS NULL").collect()) == texts
    assert sorted(r["text"] for r in out.where("doc_id = -7").collect()) == texts


def test_run_gives_the_rows_of_the_last_stage(spark):
    out = corpus_pipeline.run(spark, str(DATA))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_queries_return_a_row_per_document(spark, name):
    out = queries.QUERIES[name](spark, str(DATA))
    ids = sorted(r["doc_id"] for r in out.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())
