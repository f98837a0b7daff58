"""Near-copy groups, license passages, shards and quality rules against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from grainmart.llm import hilbert_shards as H
from grainmart.llm import license_scan as S
from grainmart.llm import ngram_join as N
from grainmart.llm import quality_rules as Q

COLUMNS = "doc_id bigint, text string, source string, lang string, shard string, set_key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], COLUMNS)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def grouped(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted(((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=str)


def near_copies(seed, families, members):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 60, 300]))]
        if f % 3 == 0:
            base = passage + base
        for _ in range(rng.randint(1, members)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 45))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < .3:
                text = text[:len(text) - rng.randint(0, len(text) // 5)]
            rows.append((len(rows), (" \t" if rng.random() < .3 else " ").join(text).upper(), "s", "en"))
    rows += [(9001, None, "s", "en"), (9002, "", None, None), (9003, " \n", "s", "en"), (9004, "one two", "s", "en"),
             (9005, "One  two", "s", "en"), (9006, "one two three", "s", "en"), (None, rows[0][1], "s", "en"), (0, rows[0][1], "s", "en"),
             (None, "a b c d e f g", "s", "en")]
    return rows


@pytest.mark.parametrize("seed, block", [(1, 256), (2, 4), (3, 2)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(N, "BLOCK_SETS", block)
    monkeypatch.setattr(N, "LEAF_SETS", 2)
    rows = near_copies(seed, 30, 14)
    got = N.ngram_groups(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(rows)


@pytest.mark.parametrize("block", [256, 3])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK_SETS", block)
    monkeypatch.setattr(N, "LEAF_SETS", 2)
    rows = near_copies(2, 20, 12)
    rows += [(8000 + i, rows[0][1], "s", "en") for i in range(5)]
    sets = [shingles(t) for _, t, *_ in rows]

    def linked(a, b):
        both = len(a & b)
        return both and 100 * both >= 80 * (len(a) + len(b) - both)

    want = sorted(((r[0], sum(bool(linked(sets[i], s)) for j, s in enumerate(sets) if j != i)) for i, r in enumerate(rows)), key=str)
    docs = frame(spark, rows)
    got = N.ngram_groups(docs, count_links=True)
    assert sorted(map(tuple, got.select("doc_id", "n_links").collect()), key=str) == want
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == grouped(rows)
    pairs = N.ngram_links(docs).collect()
    links = {frozenset(r) for r in pairs}
    distinct = list({frozenset(s) for s in sets})
    assert len(links) == len(pairs) == sum(bool(linked(a, b)) for i, a in enumerate(distinct) for b in distinct[:i])


def test_the_boundary_of_similarity_is_a_link(spark):
    base = [f"w{i}" for i in range(13)]  # 9 shingles; one word more at the end makes 10
    rows = [(1, " ".join(base[:12]), "s", "en"), (2, " ".join(base[:12] + ["x", "y"]), "s", "en"),
            (3, " ".join(base[:11] + ["q", "r", "t"]), "s", "en")]
    got = N.ngram_groups(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == grouped(rows)
    assert {r["component_id"] for r in got if r["doc_id"] < 3} == {1}  # 8 of 10


def test_one_of_each_group_stays(spark):
    rows = near_copies(4, 12, 6)
    docs = frame(spark, rows)
    out = N.drop_near_copies(docs)
    assert out.columns == docs.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    want = {d for d, _, c in grouped(rows) if d == c}
    assert set(kept) == want and kept[0] == 2  # the repeated row of a document stays with it
    assert N.drop_near_copies(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_stay_by_group(spark):
    rows = near_copies(4, 12, 6)
    rows += [(None, rows[1][1], "s", "en"), (7001, "p q r s t u v", "s", "en"), (7001, rows[0][1], "s", "en"), (7001, "", "s", "en")]
    kept = Counter((r["doc_id"], r["text"]) for r in N.drop_near_copies(frame(spark, rows)).collect() if r["doc_id"] in (None, 7001))
    assert kept == {(None, "a b c d e f g"): 1, (7001, "p q r s t u v"): 1, (7001, ""): 1}


def test_pruning_never_loses_a_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2)
    sets = []
    for _ in range(60):
        keep = rng.random(400) > rng.choice([.02, .1, .2])
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**63, rng.integers(0, 60), dtype=np.uint64)])))
    sets.sort(key=len)
    for bits in (256, 4096):
        tree = N.SignatureTree(sets, bits)
        roots = N._Roots(len(sets))
        list(N.dual_links(tree, tree, 0, roots))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                assert N.alike(sets[i], sets[j]) == (100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both))
                assert not N.alike(sets[i], sets[j]) or roots.root(i) == roots.root(j)


def test_license_passages(spark):
    rng = random.Random(6)
    filler = lambda n: [rng.choice("lorem ipsum dolor sit amet".split()) + str(rng.randint(0, 99)) for _ in range(n)]
    rows, want = [(1, None, "s", "en"), (2, "", "s", "en"), (3, "licensed under the", "s", "en")], {1: set(), 2: set(), 3: set()}
    for i, (name, text) in enumerate(list(S.TEMPLATES) * 6, 10):
        template = text.split()
        if i % 3 == 0:
            template = [w.upper() for w in template]
        at = rng.randint(0, 300)
        body = filler(at) + template + filler(rng.randint(0, 300))
        rows.append((i, "\t\n".join(body), "s", "en"))
        want[i] = {name}
    plain = list(range(200, 230))
    rows += [(i, " ".join(filler(500)), "s", "en") for i in plain]
    want.update({i: set() for i in plain})
    mit = dict(S.TEMPLATES[1:2])["MIT"].split()
    rows.append((300, " ".join(mit[:len(mit) // 2]), "s", "en"))  # half a template is not enough
    want[300] = set()
    rows.append((301, " ".join(filler(40000) + mit + filler(9)), "s", "en"))
    want[301] = {"MIT"}
    got = {r["doc_id"]: r for r in S.license_scan(frame(spark, rows)).collect()}
    assert {i: set(r["licenses"]) for i, r in got.items()} == want
    passage = got[301]["passages"][0]
    assert (passage["first_word"], passage["last_word"]) == (40000, 40000 + len(mit) - 1) and passage["containment"] == 1
    assert S.license_scan(frame(spark, [])).count() == 0


def test_edited_passages_are_found_as_by_brute_force():
    rng = random.Random(7)
    templates = [(f"t{k}", " ".join(f"v{k}x{i}" for i in range(n))) for k, n in enumerate((6, 14, 40, 120))]
    known = S.Templates(templates)
    found = missed = 0
    for _ in range(400):
        k = rng.randrange(4)
        body = templates[k][1].split()
        for _ in range(rng.randint(0, 2)):
            body[rng.randrange(len(body))] = "edit"
        text = [f"f{rng.random()}" for _ in range(rng.randint(0, 90))] + body + [f"g{rng.random()}" for _ in range(rng.randint(0, 90))]
        block = S.Words([" ".join(text).encode()])
        sh = block.shingles(5)
        held = len(np.intersect1d(sh, known.sets[k]))
        if 5 * held >= 4 * len(known.sets[k]):
            hit = any(i == k for _, i, *_ in S._found(known, sh, block.starts))
            found, missed = found + hit, missed + (not hit)
    assert found > 150 and missed <= .01 * found
    assert S.miss_probability(0.6) < 0.001


def test_templates_beyond_one_part_are_still_looked_for(spark, monkeypatch):
    monkeypatch.setattr(S, "TEMPLATE_BYTES", 60)
    rows = [(1, "x " + S.TEMPLATES[0][1] + " y " + S.TEMPLATES[4][1], "s", "en")]
    assert S.license_scan(frame(spark, rows)).first()["licenses"] == ["GPL-3.0", "MIT"]
    with pytest.raises(ValueError):
        S.license_scan(frame(spark, rows), [])


def test_the_curve_visits_every_cell_by_single_steps():
    for bits, n in ((4, 3), (3, 2)):
        side = range(1 << bits)
        points = [(i,) for i in side]
        for _ in range(n - 1):
            points = [(*p, i) for p in points for i in side]
        at = {H.hilbert_index(p, bits): p for p in points}
        assert sorted(at) == list(range(len(points)))
        assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1], strict=True)) == 1 for i in range(len(at) - 1))


def sharded(seed=8):
    rng = random.Random(seed)
    rows = [(i, "é" * rng.choice([0, 1, 5, 300, 9000]), rng.choice(["hot", "hot", "s1", None]), rng.choice(["en", "de", None]))
            for i in range(777)]
    return rows + [(5, None, None, None), (5, None, None, None), (None, "x", "s1", "en")]


@pytest.mark.parametrize("law, bucket", [("rows", 4096), ("rows", 16), ("bytes", 4096), ("bytes", 16)])
def test_shards_keep_their_law(spark, monkeypatch, law, bucket):
    monkeypatch.setattr(H, "BUCKET_ROWS", bucket)
    rows = sharded()
    got = H.curve_shards(frame(spark, rows), law=law).collect()
    size = {r[0]: len((r[1] or "").encode()) + 1 for r in rows if r[0] != 5}
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    per = {}
    for r in got:
        assert r["doc_id"] == 5 or r["size"] == size[r["doc_id"]]
        per.setdefault(r["shard"], []).append(r)
    assert set(per) == set(range(16))
    for members in per.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    if law == "rows":
        assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    else:
        totals = [sum(r["size"] for r in m) for m in per.values()]
        assert max(totals) - min(totals) <= 2 * max(r["size"] for r in got)
    # Shards are runs of the curve.
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in got)
    text = {r[0]: r[1] for r in rows}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) for r in got if r["doc_id"] != 5)


def test_places_do_not_depend_on_partitioning(spark):
    docs = frame(spark, [r for r in sharded() if r[0] != 5])
    a, b = (sorted(map(tuple, H.curve_shards(d).select("doc_id", "shard", "slot").na.fill(-1).collect()))
            for d in (docs.repartition(1), docs.repartition(9)))
    assert a == b


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_rows_of_one_id_are_numbered_in_buckets_of_bounded_size(spark, monkeypatch, law):
    monkeypatch.setattr(H, "BUCKET_ROWS", 16)
    rows = [(None, f"t{i:04}", "hot", "en") for i in range(1000)] + [(None, "same", "hot", "en")] * 1000
    dealt, cut = [], H.in_buckets
    monkeypatch.setattr(H, "in_buckets", lambda rows: dealt.append(cut(rows)) or dealt[-1])
    got = H.curve_shards(frame(spark, rows), law=law).collect()
    assert max(r["count"] for r in dealt[0].groupBy(*H.BUCKET).count().collect()) <= 4 * 16
    per = {}
    for r in got:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 2000 and set(per) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in per.values())


def test_few_rows_and_written_shards(spark, tmp_path):
    assert H.curve_shards(frame(spark, [])).count() == 0
    few = H.curve_shards(frame(spark, sharded()[:3])).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    docs = frame(spark, sharded()[:200]).drop("shard")
    H.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 16
    with pytest.raises(ValueError):
        H.curve_shards(docs, law="none")


def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_base_measures_equal_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t", "a", "# $ %% \U0001f600 é < >", "l1\n l1\nl1\n\n\nl1 ", "x " * 7, "x " * 8, "x " * 9, "y " * 3000,
             "ab cd ef gh ij kl mn op " * 3, "w\x0bv\x0cu\x1ct"]
    for _ in range(60):
        base = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 60))]
        texts.append(rng.choice([" ", "\n", "  "]).join(base + base[:rng.randint(0, 20)] + base[5:30]))
    texts += ["same text here", "same text here"]
    rows = [(i, t, "s", "en") for i, t in enumerate(texts)]
    for r in Q.quality(frame(spark, rows)).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) \
            == plain_measures(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert 0 <= r["posterior"] <= 1 and r["kept"] == (not r["base_failed"] and r["posterior"] >= .5)
    assert Q.quality(frame(spark, [])).count() == 0


def test_posterior_keeps_prose_and_drops_junk(spark):
    rng = random.Random(10)
    common = ["the", "of", "and", "to", "in", "is"]

    def prose():
        return ". ".join(" ".join(rng.choice(common) if rng.random() < .4 else f"{rng.choice(['rain', 'house', 'green'])}{'a' * rng.randint(0, 3)}"
                                  for _ in range(rng.randint(6, 14))) for _ in range(12)) + "."

    rows = [(i, prose(), "s", "en") for i in range(400)]
    rows += [(1000 + i, prose().upper().replace(" ", "!! "), "s", "en") for i in range(30)]
    rows += [(2000 + i, " | ".join(f"cell{rng.randint(0, 999)}" for _ in range(60)), "s", "en") for i in range(30)]
    kept = {r["doc_id"]: r["kept"] for r in Q.quality(frame(spark, rows)).collect()}
    assert sum(kept[i] for i in range(400)) >= 396
    assert sum(v for k, v in kept.items() if k >= 1000) <= 3


def test_expectation_maximisation_recovers_accuracies(spark):
    rng = random.Random(11)
    votes = []
    for _ in range(6000):
        good = rng.random() < .7
        votes.append(tuple((1 if (rng.random() < a) == good else -1) if rng.random() < .8 else 0 for a in (.95, .9, .85, .9, .8)))
    names = list("abcde")
    counts = spark.createDataFrame([(*k, n) for k, n in Counter(votes).items()], [*names, "n"])
    share, rates = Q.estimate(counts, names, rounds=60)
    assert abs(share - .7) < .03
    for name, a in zip(names, (.95, .9, .85, .9, .8), strict=True):
        assert abs(rates[name][1][1] / (rates[name][1][1] + rates[name][1][-1]) - a) < .04


def test_window_minima_by_definition_also_for_blocks_shorter_than_a_window():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 17, 300):
        values = rng.integers(0, 2**63, n, dtype=np.uint64)
        for length in (1, 2, 3, 7, 8, 40, 63, 500):
            for stride in {1, max(1, length // 8)}:
                span = -(-length // stride) * stride
                want = [values[i:i + span].min() for i in range(0, n, stride)]
                assert (S._window_minima(values, length, stride) == want).all()


def test_short_texts_alone_are_scanned(spark):
    rows = [(1, "one two three four five six", "s", "en"), (2, None, "s", "en")]
    assert {tuple(r["licenses"]) for r in S.license_scan(frame(spark, rows)).collect()} == {()}
