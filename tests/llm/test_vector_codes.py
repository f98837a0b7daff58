"""Active-entry Lloyd against full rescans in Python integers."""

import math
import random

import numpy as np
import pytest

from grainmart.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, part int, ints string"


def frame(spark, rows, schema=SCHEMA):
    """Vectors with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)


def brute(rows, parts, entries, rounds):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(ints[0]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in ints]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i]))[:entries]
    book = [[cut[i][p] for i in first] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        at = [[nearest(v[p], p)[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for k in set(a[p] for a in at):
                mine = [v[p] for v, a in zip(cut, at, strict=True) if a[p] == k]
                book[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
    out = []
    for r, v in zip(kept, cut, strict=True):
        ends = [nearest(v[p], p) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{k:02x}" for _, k in ends), sum(d for d, _ in ends)))
    return out, book


@pytest.mark.parametrize("scale", [0.01, 1.0, 5000.0])
def test_codes_equal_full_rescans(spark, scale):
    draw = random.Random(scale)
    rows = [(i, [round(draw.gauss(0, scale), draw.choice([0, 3])) for _ in range(8)], draw.choice([0, 1, None])) for i in range(90)]
    rows += [rows[3], (5, rows[7][1], None), (None, rows[1][1], 1), (91, None, 1), (92, [None] * 8, 1), (93, [], 0),
             (94, [float("nan")] + [0.0] * 7, 1), (95, [float("inf")] * 8, None)] + [(100 + i, rows[0][1], 0) for i in range(60)]
    coded, book = V.vector_codes(frame(spark, rows).repartition(5), entries=16)
    want, want_book = brute(rows, 4, 16, 4)
    got = [(r.vec_id, r.label, bytes(r.codes).hex(), r.error) for r in coded.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert [[tuple(e) for e in part] for part in book.tolist()] == want_book
    report = V.code_report(frame(spark, rows), entries=16).collect()
    totals = {label: sum(r[3] for r in want if r[1] == label) for label in (0, 1, None)}
    labels = {(r[0], r[2], r[3]): {q[1] for q in want if (q[0], q[2], q[3]) == (r[0], r[2], r[3])} for r in want}
    assert all(r.label_error in {totals[x] for x in labels[r.vec_id, r.code, r.error]} for r in report) and len(report) == len(want)


def test_moved_entries_only_are_compared_and_ties_go_to_the_lower_index():
    draw = np.random.default_rng(0)
    for _ in range(200):
        x = draw.integers(-3, 4, (40, 2))
        old = draw.integers(-3, 4, (6, 2))
        code, distance = V.nearest(x, old)
        moved = draw.random(6) < 0.4
        new = np.where(moved[:, None], draw.integers(-3, 4, (6, 2)), old)
        got, want = V.reassigned(x, code, distance, new, moved), V.nearest(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_the_integer_and_the_float_way_agree():
    draw = np.random.default_rng(1)
    x, e = draw.integers(-V.LIMIT + 1, V.LIMIT, (50, 3)), draw.integers(-V.LIMIT + 1, V.LIMIT, (9, 3))
    index, distance = V.nearest(x, e)
    for i in range(50):
        assert (distance[i], index[i]) == min((sum((int(a) - int(b)) ** 2 for a, b in zip(x[i], y, strict=True)), k) for k, y in enumerate(e))


def test_few_or_no_vectors_and_vectors_that_have_no_code(spark):
    assert V.code_report(frame(spark, []), label_col=None).count() == 0
    one = V.code_report(frame(spark, [(1, [0.5] * 4, None)])).first()
    assert (one.code, one.error, one.label_error) == ("00000000", 0, 0)
    for bad in ([[1.0] * 8, [1.0] * 4], [[1.0] * 6], [[70_000.0] * 4]):
        with pytest.raises(ValueError):
            V.vector_codes(frame(spark, [(i, v, 0) for i, v in enumerate(bad)]))
