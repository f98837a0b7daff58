"""Context-tree weighting against its definition; the classifier on planted words."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from grainmart.llm import lm_score as L
from grainmart.llm import toxicity as T


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % folds == 0


def coded(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


class Tree:
    """One decision's context tree, by the definition: half own estimate, half the children's product."""

    def __init__(self, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])

    def add(self, context, bit):
        for d in range(self.depth + 1):
            self.counts[context[len(context) - d:]][bit] += 1

    def weighted(self, context=b""):
        zeros, ones = self.counts[context]
        own = (math.lgamma(zeros + .5) + math.lgamma(ones + .5) - 2 * math.lgamma(.5) - math.lgamma(zeros + ones + 1))
        if len(context) == self.depth:
            return own
        children = [c for c in list(self.counts) if len(c) == len(context) + 1 and c.endswith(context)]
        return math.log(.5) + np.logaddexp(own, sum(self.weighted(c) for c in children))


def brute(rows, depth):
    trees = defaultdict(lambda: Tree(depth))

    def decisions(text):
        raw = b"\n" * depth + coded(text)
        for i in range(depth, len(raw)):
            for k in range(8):
                yield (1 << k) | (raw[i] >> (8 - k)), raw[i - depth:i], (raw[i] >> (7 - k)) & 1

    for doc_id, text in rows:
        if not held(doc_id, 10):
            for decision, context, bit in decisions(text):
                trees[decision].add(context, bit)
    cache = {}

    def log_p(decision, context, bit):
        if (decision, context, bit) not in cache:
            tree = trees[decision]
            before = tree.weighted()
            tree.add(context, bit)
            cache[decision, context, bit] = tree.weighted() - before
            for d in range(depth + 1):
                tree.counts[context[depth - d:]][bit] -= 1
        return cache[decision, context, bit]

    return [sum(log_p(*x) for x in decisions(text)) / math.log(10) for _, text in rows]


def test_scores_equal_the_definition(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choice("abBé") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 5))))
            for i in range(22)]
    rows += [(3, "again A"), (3, "again A"), (40, None), (41, ""), (None, "no id")]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id bigint, text string, n int, score double")
    got = sorted(L.lm_scores(docs, depth=4).collect(), key=lambda r: (str(r["doc_id"]), r["score"]))
    train = Counter()
    tokens = [[*coded(t).split(), b"\n"] for _, t in rows]
    for (doc_id, _), words in zip(rows, tokens, strict=True):
        if not held(doc_id, 10):
            train.update(words)
    n, v = sum(train.values()), len(train)
    want = sorted(((str(d), s, len(w), sum(train[x] > 0 for x in w), held(d, 10),
                    sum(math.log10((train[x] + .1) / (n + .1 * (v + 1))) for x in w))
                   for (d, _), s, w in zip(rows, brute(rows, 4), tokens, strict=True)), key=lambda x: x[:2])
    for r, w in zip(got, want, strict=True):
        assert (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"]) == (w[0], *w[2:5], n)
        assert r["score"] == pytest.approx(w[1], rel=1e-9) and r["base_score"] == pytest.approx(w[5], rel=1e-9)


def test_rare_grams_and_words_are_joined_to_the_same_scores(spark, monkeypatch):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["the", "of", f"w{i}", "漢"]) for _ in range(30))) for i in range(60)],
                                 "doc_id bigint, text string")
    columns = ("doc_id", "n_known", "base_score", "score")
    plain = sorted(map(tuple, L.lm_scores(docs).select(*columns).collect()))
    for name, value in (("HEAD_GRAMS", 20), ("HEAD_WORDS", 3), ("HELD", 50), ("CHUNK", 40)):
        monkeypatch.setattr(L, name, value)
    for a, b in zip(plain, sorted(map(tuple, L.lm_scores(docs).select(*columns).collect())), strict=True):
        assert a == pytest.approx(b, rel=1e-9)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.lm_scores(empty).count() == 0
    one = next(i for i in range(100) if held(i, 10))
    row = L.lm_scores(spark.createDataFrame([(one, "ab")], "doc_id bigint, text string")).first()
    assert row["score"] == pytest.approx(3 * 8 * math.log10(.5)) and (row["n_known"], row["train_tokens"]) == (0, 0)


def test_the_probabilities_of_all_next_bytes_sum_to_one():
    rng = np.random.default_rng(3)
    seen = rng.integers(97, 101, 300).astype(np.uint8).tobytes()
    context = b"abcd"
    code, _ = L.grams([seen], 4)
    asked = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
    unique, n = np.unique(np.concatenate([code, asked]), return_counts=True)
    n = n - np.isin(unique, asked)
    levels = L._trees(unique, n, 4)
    left, mixed = np.ones(len(levels[-1].keys)), np.zeros(len(levels[-1].keys))
    for level in reversed(levels):
        left, mixed = level.predict(left, mixed)
        left, mixed = left[level.up], mixed[level.up]
    one = mixed.reshape(8, -1)
    byte = unique & np.uint64(255)
    bits = np.array([(byte >> np.uint64(7 - k)) & np.uint64(1) for k in range(8)])
    p = np.where(bits == 1, one, 1 - one).prod(axis=0)
    assert p[np.isin(unique, asked)].sum() == pytest.approx(1)


def test_lookup_finds_all_and_only_its_keys():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    table = L.Lookup(keys, np.arange(len(keys), dtype=float))
    value, found = table.find(np.concatenate([keys, keys + np.uint64(1)]))
    assert found[:len(keys)].all() and (value[:len(keys)] == np.arange(len(keys))).all()
    assert (found[len(keys):] == np.isin(keys + np.uint64(1), keys)).all()


def labelled(spark, n=600):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < .3)
        words = [word() for _ in range(rng.randint(5, 60))]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["Zjerk", "qvile\n", "ZJERK", "xyfool."]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, toxic))
    return (spark.createDataFrame([*rows, (None, None, "en", "s"), (n, "", None, None), (n + 1, "zjerk " * 9000, "en", "s")],
                                  "doc_id bigint, text string, lang string, source string"),
            spark.createDataFrame([*labels, (None, 1, 1), (3, 0, None)], "doc_id bigint, quality int, toxic int"))


def test_planted_words_are_found_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    rows = T.toxicity(docs, labels).collect()
    assert len(rows) == 603
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    out = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in out) >= .95 * len(out) > 50
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .5)
        assert r["held_out"] == held(r["doc_id"], 5)


def test_scores_come_from_texts_alone_and_from_training_labels(spark):
    docs, labels = labelled(spark, 300)
    first = sorted(map(tuple, T.toxicity(docs, labels).select("doc_id", "score").na.fill(-1).collect()))
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 5) = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    other = docs.selectExpr("doc_id", "text", "'de' AS lang", "'t' AS source")
    second = sorted(map(tuple, T.toxicity(other, flipped).select("doc_id", "score").na.fill(-1).collect()))
    for a, b in zip(first, second, strict=True):
        assert a == pytest.approx(b, abs=1e-6)


def test_classes_that_are_missing(spark):
    docs, labels = labelled(spark, 50)
    clean = T.toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r["predicted"] for r in clean} == {0}
    assert T.toxicity(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in T.toxicity(docs, labels.limit(0)).collect()} == {.5}
