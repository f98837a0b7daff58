"""Candidate groups of the near-copy join: alike sets always meet, and texts that only share phrases seldom do."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from grainmart.llm import ngram_join as N


def hashes(rng, n):
    return rng.integers(0, 2**64, n, dtype=np.uint64)


def test_alike_sets_have_a_key_in_common():
    rng = np.random.default_rng(1)
    frequency = rng.integers(0, 30, 1 << N.SKETCH_BITS).astype(np.uint16)
    alike = 0
    for trial in range(4000):
        n, crowd = int(rng.choice([1, 2, 4, 5, 9, 10, 16, 20, 50, 64, 100, 160, 400])), np.uint64(rng.integers(0, 6))
        a = np.unique(hashes(rng, n) >> crowd)
        b = np.unique(np.concatenate([a[rng.permutation(n)[rng.integers(0, n // 5 + 1):]], hashes(rng, rng.integers(0, n // 4 + 1)) >> crowd]))
        if N.alike(a, b):
            alike += 1
            assert np.intersect1d(N._keys(a, frequency, 36), N._keys(b, frequency, 36)).size
    assert alike > 1000


def test_texts_that_share_phrases_only_are_not_chained_even_where_all_counters_are_alike():
    rng = random.Random(2)
    phrases = [" ".join(f"p{i}x{j}" for j in range(5)) for i in range(800)]
    texts = [" ".join(x for k in range(8) for x in (rng.choice(phrases), *(f"d{d}k{k}w{j}" for j in range(12)))).encode() for d in range(400)]
    texts.append(texts[0] + b" one more")
    level = SimpleNamespace(value=np.full(1 << N.SKETCH_BITS, 300, np.uint16).tobytes())  # as of a very large table
    rows = pa.Table.from_batches(N._prefixes(level)([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])]))
    links = pa.Table.from_batches(N._chained(rows.sort_by(rows.column_names[0]).to_batches()))
    met = {frozenset(p) for p in zip(*links.to_pydict().values(), strict=True)}
    first, *_, last = (N._set_key(s) for s in N._sets(texts))
    assert frozenset((first, last)) in met and len(met) < 20


def test_texts_of_undisputed_sets_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"{'a b c d e f' if i < 3 else f't{i} of its own'}") for i in range(9)], "doc_id bigint, text string")
    out = N.drop_near_copies(docs)
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 3, 4, 5, 6, 7, 8]
    undisputed, disputed = (p.toString() for p in (out._jdf.queryExecution().optimizedPlan().children().apply(i) for i in range(2)))
    assert "Join" not in undisputed and "LeftSemi" in disputed
