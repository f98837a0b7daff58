"""Exact dedup and source mixing against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from grainmart.llm import mix_sources as M
from grainmart.llm.exact_dedup import drop_exact_copies, exact_dedup

COLUMNS = "doc_id bigint, text string, source string, n bigint, prefix string, row string"


def frame(spark, rows):
    """Documents with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS)


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


ROWS = [(1, "a b\tc", "s"), (2, "abc", "s"), (3, "a  b  c ", "s"), (4, None, "s"), (5, "", "s"), (6, " \n", "s"),
        (7, "a bc", "s"), (8, "other", "t"), (9, "long " * 5000, "t"), (10, "long" * 5000, "t"),
        (11, "ab\u001cc", "t"), (12, "x" * 64 + "1", "t"), (13, "x" * 64 + "2", "t"), (8, "other", "t"), (None, "alone", None)]


def test_exact_dedup_keeps_the_longest_then_the_smallest(spark):
    got = [tuple(r) for r in exact_dedup(frame(spark, ROWS), digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    groups = defaultdict(list)
    for doc_id, text, _ in ROWS:
        groups[squeeze(text)].append((-len(text or ""), doc_id is None, doc_id))
    want = []
    for text, members in groups.items():
        members.sort()
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(m[2], members[0][2], len(members), i == 0, digest) for i, m in enumerate(members)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rows_that_are_alone_are_not_hashed_in_full(spark):
    got = {r["doc_id"]: r["text_sha256"] for r in exact_dedup(frame(spark, ROWS)).collect()}
    assert got[7] is None and got[11] is None and got[1] == got[2] is not None
    assert got[12] is not None  # same length and prefix as 13, so only the full hash tells them apart


def test_dropping_copies_keeps_the_columns_and_one_of_repeated_rows(spark):
    docs = frame(spark, ROWS)
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted([3, 6, 7, 8, 9, 11, 12, 13, None], key=str)


def test_dedup_of_an_empty_table(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    assert drop_exact_copies(frame(spark, [])).count() == 0


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_filled(sizes):
    """Targets by repeated resharing. sizes: {source: words}, null last."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in full)
        free -= full
    return target


def corpus(n=900):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "é", "c", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40, 200])) or rng.choice([None, "", " "]), source))
    return rows


@pytest.mark.parametrize("leaf", [4, 256])
def test_mix_meets_its_targets(spark, monkeypatch, leaf):
    monkeypatch.setattr(M, "LEAF", leaf)
    rows = corpus()
    got = [r.asDict() for r in M.mix_sources(frame(spark, rows)).collect()]
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    target = water_filled(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["copies"] in (int(r["target"] / r["source_size"]), int(r["target"] / r["source_size"]) + 1)
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1


def test_mix_does_not_depend_on_partitioning(spark):
    docs = frame(spark, corpus(300))
    first, second = (sorted(map(tuple, M.mix_sources(d).select("doc_id", "taken").collect()))
                     for d in (docs.repartition(1), docs.repartition(7)))
    assert first == second


def test_copies_are_unbiased(spark):
    rows = [(i, "w " * (1 + i % 50), "abc"[i % 3]) for i in range(600)]
    docs = frame(spark, rows)
    rate = [r["copies"] for seed in range(4) for r in M.mix_sources(docs, seed=seed).where("source = 'b'").collect()]
    share = M.mix_sources(docs).where("source = 'b'").selectExpr("target / source_size").first()[0]
    assert abs(sum(rate) / len(rate) - share) < 0.06


def test_mixed_rows_repeat_by_their_copies(spark):
    docs = frame(spark, [*corpus(200), (5, "w w w", "a"), (5, "w w w", "a")])
    copies = M.mix_sources(docs).groupBy("doc_id").sum("copies").collect()
    got = M.mixed(docs)
    assert got.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {r[0]: r[1] for r in copies if r[1]}


def test_mix_of_nothing(spark):
    assert M.mix_sources(frame(spark, [])).count() == 0
    only_empty = M.mix_sources(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [r["taken"] for r in only_empty] == [0, 0] and [r["target"] for r in only_empty] == [0.0, 0.0]
