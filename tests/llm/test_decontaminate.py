"""The positional index against a search through all texts."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from grainmart.llm import decontaminate as D


def split(text):
    low = (text or "").translate(str.maketrans(D.UPPER, D.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, length):
    runs = []
    for item, text in items:
        words = split(text)
        if words:
            n = min(length, len(words))
            runs += [("" if item is None else str(item), words[i:i + n]) for i in range(len(words) - n + 1)]
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for item, run in runs:
            for i in range(len(words) - len(run) + 1):
                if words[i:i + len(run)] == run:
                    hit |= set(range(i, i + len(run)))
                    found.add(item)
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    """Tables with further columns whose names clash with the operator's own."""
    return (spark.createDataFrame([(*d, 1, "x", 2, "y") for d in docs], "doc_id long, text string, row int, term string, w int, window string"),
            spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, n int, item string"))


def test_hits_of_random_texts_equal_a_full_search(spark):
    draw = random.Random(5)
    vocabulary = ["der", "die", "É", "é", "x1", "Zwei", "drei", "the", "of"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 3, 8, 30, 200]))) for _ in range(60)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 2, 3, 4, 9])))) for i in range(25)]
    items += [(100, texts[-1][:80]), (100, "die die die die"), (None, "x1, zwei"), (7, None), (8, "  "), (9, items[3][1]), (10, items[3][1])]
    docs = list(enumerate(texts)) + [(3, texts[4]), (None, "Zwei! ZWEI drei"), (None, None), (61, ""), (62, "die " * 20_000), (62, "die " * 20_000)]
    for length in (4, 10):
        got = D.decontaminate(*frames(spark, docs, items), length=length)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, length)


def test_either_table_may_be_empty(spark):
    docs, items = frames(spark, [(1, "a b c"), (2, None)], [(1, "b")])
    assert D.decontaminate(docs.limit(0), items).count() == 0
    rows = D.decontaminate(docs, items.limit(0)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(3, 0, False), (0, 0, False)]


def test_a_window_of_frequent_words_only_and_one_in_a_third_of_all_rows(spark):
    passage = "we hold these truths to be self evident that all men are created equal"
    docs = [(i, f"word{i} {passage} end" if i % 3 == 0 else f"we hold word{i} to be that all") for i in range(300)]
    items = [(i, f"{passage} item{i}") for i in range(12)] + [(99, "to be that all")]
    assert sorted((tuple(r) for r in D.decontaminate(*frames(spark, docs, items)).collect()), key=repr) == brute(docs, items, 10)


def test_the_full_index_holds_every_word_and_a_limited_one_those_asked_for(spark):
    docs, _ = frames(spark, [(1, "a B, c a"), (2, None)], [(1, "b")])
    full = [(r.doc_id, r.pos, r.term) for r in D.build_index(docs).orderBy("doc_id", "pos").collect()]
    assert full == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, "a"), (2, None, None)]
    asked = spark.createDataFrame([("c",), ("c",)], "term string")
    assert [(r.doc_id, r.pos, r.term) for r in D.build_index(docs, asked).orderBy("doc_id", "pos").collect()] == \
        [(1, 0, None), (1, 2, "c"), (2, None, None)]


def test_proximity_matches_are_the_shortest_stretches_around_the_rarest_term(spark):
    draw = random.Random(3)
    docs = [(i, " ".join(draw.choices("abcdefgh", k=60))) for i in range(25)]
    items = [(1, "a b c"), (2, "d d h"), (3, "f"), (4, "zz a")]
    d, b = frames(spark, docs, items)
    windows = D.item_windows(b)
    index = D.build_index(d, windows.select(F.explode("window").alias("term")))
    ranked = D.ranked_windows(windows, index)
    rows = {r.row: r.doc_id for r in index.select("row", "doc_id").distinct().collect()}
    names = {r.w: (r.window, r.ranked[0].term) for r in ranked.collect()}
    got = sorted({(rows[r.row], " ".join(names[r.w][0]), r.start, r.span) for r in D.proximity_matches(index, ranked, slack=3).collect()})
    want, total = set(), Counter(w for _, t in docs for w in split(t))
    for doc, text in docs:
        words = split(text)
        for window, rare in names.values():
            reach = len(window) + 3
            for at in (i for i, w in enumerate(words) if w == rare):
                spans = [(e - s + 1, s) for s in range(max(0, at - reach), at + 1) for e in range(at, min(len(words), s + reach))
                         if set(window) <= set(words[s:e + 1]) and words[s] in window]
                if spans:
                    want.add((doc, " ".join(window), min(spans)[1], min(spans)[0]))
    assert total["zz"] == 0 and got == sorted(want) and len(got) > 50
