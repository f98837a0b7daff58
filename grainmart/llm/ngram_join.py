"""N-gram Jaccard self-join with signature trees.

Documents with the same shingle set are one set from the start. Sets are cut into parts by the first
bits of their shingles, some two shingles a part. Two sets of Jaccard similarity of 0.8 or more differ in
few shingles, hence in few parts: they have one of their first parts in any common order whole in common
(see ``_keys``), and sets that do are chained to a candidate group. The order puts parts of frequent
shingles and single shingles last, so that texts which merely share a phrase seldom meet, however many
there are. Within a group, sets are cut by size and hash into blocks of bounded size. Each pair of blocks is one unit of work: a signature tree per block, whose nodes hold
OR-combined bitmaps and size ranges, and a dual traversal that drops node pairs whose largest
possible overlap is too small, then tests the rest exactly.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmart.llm.common import Words, blocks, mix, packed, utf8, written
from grainmart.llm.components import connected_components

SHINGLE = 5
# Similarity of 0.8: 5 * intersection >= 4 * union. The prefixes in _keys follow from it.
SKETCH_BITS = 22  # counters of the frequency sketch that orders parts; only speed depends on it
SKETCH_SLICES = 64
HOT = 4  # times the middle of the counters: beyond, a part is of frequent shingles only
KEY_BITS = 12  # first bits of a key: its slice
ENTRY = np.dtype([("low", "<u4"), ("high", "u1"), ("rep", "<i8")])  # 40 more bits of a key, and a set
FILTER_BITS = 24
BLOCK_SETS = 256
LEAF_SETS = 8
HELD = 1 << 21


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; with fewer words than a shingle, the whole as one."""
    words = Words(texts)
    shingles = words.shingles(SHINGLE)
    for i in range(len(texts)):
        begin, end = words.starts[i], words.starts[i + 1]
        yield np.unique(shingles[begin:end - SHINGLE + 1]) if end - begin >= SHINGLE else words.whole(i)


def _set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)


def _describe(batches) -> Iterator[pa.RecordBatch]:
    """A row per document (slice null) and a row per slice of this task's shingle counts."""
    counts = np.zeros(1 << SKETCH_BITS, np.uint8)
    for keys, texts in blocks(batches):
        sizes, sets = [], []
        for shingles in _sets(texts):
            sizes.append(len(shingles))
            sets.append(_set_key(shingles))
            slot = np.unique((shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
            counts[slot] += counts[slot] < 255
        n = len(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["doc_id", "n_shingles", "set_key", "slice", "counts"])
    for k, part in enumerate(np.split(counts, SKETCH_SLICES)):
        if part.any():
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "slice", "counts"])


def _added(batches) -> Iterator[pa.RecordBatch]:
    """Sum the sketch slices of a partition, slice by slice."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(zlib.decompress(packed), np.uint8).astype(np.int32)
            total[k] = total[k] + part if k in total else part
    for k, part in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([np.minimum(part, 65535).astype(np.uint16).tobytes()], pa.binary())],
            names=["slice", "counts"])


def _level(n: int) -> int:
    """Sets of n shingles are cut into 2 ** level parts: 1.25 to 2.5 shingles each."""
    return max(0, (4 * n // 5).bit_length() - 1)


def _ranks(tokens, frequency, single, hot: int) -> np.ndarray:
    """A common order: parts of frequent shingles last, single shingles before them, then by frequency and hash."""
    return (frequency > hot).astype(np.uint64) << np.uint64(63) | np.uint64(1 << 62) * single \
        | frequency.astype(np.uint64) << np.uint64(46) | tokens >> np.uint64(18)


def _first(tokens: np.ndarray, ranks: np.ndarray, n: int) -> np.ndarray:
    return tokens if len(tokens) <= n else tokens[ranks <= np.partition(ranks, n - 1)[n - 1]]


def _keys(shingles: np.ndarray, frequency: np.ndarray, hot: int) -> np.ndarray:
    """Keys of a set of sorted shingles: sets of similarity 0.8 or more, of whatever sizes, have one in common.

    Sets of n and m shingles that are alike differ in (n + m) / 9 shingles at most, which is no more than
    `differ` below for either set, as neither is beyond 5/4 of the other. A differing shingle spoils one
    part, so either set has at most `differ` parts that the other lacks. Unless all parts are spoilt, the
    first common one is among the first differ + 1 of both. All can be spoilt only if the sets' parts
    together are no more than `differ`; then both see so, and their first fifth (and one) of single shingles meet.
    A set that may have alike ones on the next level has keys there too.
    """
    n = len(shingles)
    differ = (n + 5 * n // 4) // 9
    seen = frequency[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    out, short = [], False
    for level in range(_level(n), _level(5 * n // 4) + 1):
        part = shingles >> np.uint64(64 - level) if level else np.zeros(n, np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        tokens = mix(np.add.reduceat(shingles, starts) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        single = np.diff(starts, append=n) == 1
        out.append(_first(tokens, _ranks(tokens, np.minimum.reduceat(seen, starts), single, hot), differ + 1))
        short |= len(tokens) <= differ
    if short:
        out.append(_first(mix(shingles), _ranks(mix(shingles), seen, np.zeros(n, bool), hot), n // 5 + 1))
    return np.concatenate(out)


def _edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
    return both[:, 0], both[:, 1]


def _chains(key, rep) -> tuple[np.ndarray, ...]:
    """(key, lead) of each distinct key, and edges from its rows' reps to their lead, the smallest."""
    if not len(key):
        return key, rep, rep, rep
    order = np.lexsort((rep, key))
    key, rep = key[order], rep[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    lead = rep[first]
    return key[first], lead, *_edges(rep, lead[np.cumsum(first) - 1])


def _slices(place: np.ndarray, values: np.ndarray) -> dict[int, bytes]:
    """The bytes of values by their place; places are sorted."""
    cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
    return {int(place[i]): values[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)}


def _chain_rows(key, rep, a, b) -> Iterator[pa.RecordBatch]:
    """A row per slice of keys: its entries and, by their first set, edges, packed."""
    rest = key << np.uint64(KEY_BITS) >> np.uint64(24)
    entries = np.empty(len(key), ENTRY)
    entries["low"], entries["high"], entries["rep"] = rest & np.uint64(0xFFFFFFFF), rest >> np.uint64(32), rep
    packs = _slices((key >> np.uint64(64 - KEY_BITS)).astype(np.int64), entries)
    place = a & ((1 << KEY_BITS) - 1)
    order = np.argsort(place, kind="stable")
    links = _slices(place[order], np.stack([a, b], axis=1)[order]) if len(a) else {}
    names = sorted({*packs, *links})
    for i in range(0, len(names), 256):
        some = names[i:i + 256]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([packs.get(k) for k in some], pa.binary()),
             pa.array([links.get(k) for k in some], pa.binary())], names=["slice", "entries", "edges"])


def _prefixes(sketch):
    def run(batches) -> Iterator[pa.RecordBatch]:
        frequency = np.frombuffer(sketch.value, np.uint16)
        hot = HOT * int(np.median(frequency)) + 16
        held, rows, known = [], 0, set()

        def passed():
            nonlocal held, rows
            keys, names = [k for k, _ in held], [name for _, name in held]
            held, rows = [], 0
            yield from _chain_rows(*_chains(np.concatenate(keys), np.repeat(np.array(names, np.int64), [len(k) for k in keys])))

        for _, texts in blocks(batches):
            for shingles in _sets(texts):
                name = _set_key(shingles)
                if not len(shingles) or name in known:
                    continue
                if len(known) > HELD // 4:
                    known.clear()
                known.add(name)
                held.append((_keys(shingles, frequency, hot), name))
                rows += len(held[-1][0])
            if rows > HELD:
                yield from passed()
        if rows:
            yield from passed()

    return run


def _chained(batches) -> Iterator[pa.RecordBatch]:
    """Edges between the chains of a partition's keys; the partition is sorted by slice."""
    place, entries, edges = None, [], []

    def done():
        rows, known = np.frombuffer(b"".join(entries), ENTRY), np.frombuffer(b"".join(edges), np.int64).reshape(-1, 2)
        *_, a, b = _chains(rows["low"] | rows["high"].astype(np.uint64) << np.uint64(32), rows["rep"])
        a, b = _edges(np.concatenate([a, known[:, 0]]), np.concatenate([b, known[:, 1]]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        for at, entry, edge in zip(*batch.columns, strict=True):
            if at.as_py() != place and place is not None:
                yield done()
                entries, edges = [], []
            place = at.as_py()
            entries.append(entry.as_py() or b"")
            edges.append(edge.as_py() or b"")
    if place is not None:
        yield done()


def _wanted_sets(wanted):
    def run(batches) -> Iterator[pa.RecordBatch]:
        member = np.frombuffer(wanted.value, np.uint8)
        known = set()
        for _, texts in blocks(batches):
            names, sizes, out = [], [], []
            for shingles in _sets(texts):
                name = _set_key(shingles)
                slot = name & ((1 << FILTER_BITS) - 1)
                if len(shingles) and member[slot >> 3] >> (slot & 7) & 1 and name not in known:
                    if len(known) > HELD // 4:
                        known.clear()
                    known.add(name)
                    names.append(name)
                    sizes.append(len(shingles))
                    out.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                names=["set_key", "size", "shingles"])

    return run


class SignatureTree:
    """Sets in order of size under a hierarchy of OR-combined bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        marks = np.zeros((len(sets), bits), np.uint8)
        for i, s in enumerate(sets):
            marks[i, (s >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)] = 1
        self.signatures = np.packbits(marks, axis=1).view(np.uint64)
        # Members beyond the bits that they set: what a bitmap can hide.
        self.excess = self.sizes - np.bitwise_count(self.signatures).sum(axis=1)
        self.nodes: list[tuple[int, int, np.ndarray, int, int, int, tuple]] = []
        self.root = self._node(0, len(sets))

    def _node(self, begin: int, end: int) -> int:
        children: tuple = ()
        if end - begin > LEAF_SETS:
            middle = (begin + end) // 2
            children = (self._node(begin, middle), self._node(middle, end))
            union = self.nodes[children[0]][2] | self.nodes[children[1]][2]
        else:
            union = np.bitwise_or.reduce(self.signatures[begin:end], axis=0)
        self.nodes.append((begin, end, union, int(self.sizes[begin:end].min()), int(self.sizes[begin:end].max()),
                           int(self.excess[begin:end].max()), children))
        return len(self.nodes) - 1


class _Roots:
    """Union-find over set numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= 80 * union of two sorted arrays of distinct hashes."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 5 * both >= 4 * (len(a) + len(b) - both)


def dual_links(left: SignatureTree, right: SignatureTree, offset: int, roots: _Roots | None) -> Iterator[tuple[int, int]]:
    """Links (left number, right number + offset) that join sets not yet joined; roots keeps them joined.
    Without roots, all links.

    A pair can be alike only if its overlap is 4/9 of the sum of sizes or more; the overlap of any
    pair under two nodes is at most the common bits of their bitmaps plus the smaller excess.
    """
    stack = [(left.root, right.root)]
    while stack:
        x, y = stack.pop()
        a, b = left.nodes[x], right.nodes[y]
        if 5 * a[4] < 4 * b[3] or 5 * b[4] < 4 * a[3]:
            continue
        possible = int(np.bitwise_count(a[2] & b[2]).sum()) + min(a[5], b[5])
        if 9 * min(possible, a[4], b[4]) < 4 * (a[3] + b[3]):
            continue
        if a[6] and (not b[6] or a[1] - a[0] >= b[1] - b[0]):
            stack += [(child, y) for child in a[6] if left is not right or left.nodes[child][0] < b[1]]
            continue
        if b[6]:
            stack += [(x, child) for child in b[6] if left is not right or a[0] < right.nodes[child][1]]
            continue
        common = np.bitwise_count(left.signatures[a[0]:a[1], None] & right.signatures[None, b[0]:b[1]]).sum(axis=2)
        common = common + np.minimum(left.excess[a[0]:a[1], None], right.excess[None, b[0]:b[1]])
        need = left.sizes[a[0]:a[1], None] + right.sizes[None, b[0]:b[1]]
        for i, j in zip(*np.nonzero(9 * common >= 4 * need), strict=True):
            i, j = int(i) + a[0], int(j) + b[0]
            if (left is right and i >= j) or (roots and roots.root(i) == roots.root(j + offset)):
                continue
            if alike(left.sets[i], right.sets[j]):
                if roots:
                    roots.join(i, j + offset)
                yield i, j + offset


def _links(names: list[int], sides: list[int], packed: list[bytes], every: bool) -> Iterator[tuple[int, int]]:
    """Links of one unit: of side 0 with itself where there is no side 1, else between the sides.

    All of them if every is set, else enough to join what they join.
    """
    order = sorted(range(len(names)), key=lambda i: (len(packed[i]), names[i]))
    first = [i for i in order if sides[i] == 0]
    second = [i for i in order if sides[i] == 1]
    bits = 1 << max(8, min(16, (max(map(len, packed)) // 4).bit_length()))
    left = SignatureTree([np.frombuffer(packed[i], np.uint64) for i in first], bits)
    if not second:
        for i, j in dual_links(left, left, 0, None if every else _Roots(len(first))):
            yield names[first[i]], names[first[j]]
        return
    right = SignatureTree([np.frombuffer(packed[i], np.uint64) for i in second], bits)
    for i, j in dual_links(left, right, len(first), None if every else _Roots(len(first) + len(second))):
        yield names[first[i]], names[second[j - len(first)]]


def _linked(batches, every: bool = False) -> Iterator[pa.RecordBatch]:
    """Links of every unit of a partition that is sorted by unit."""
    unit, rows = None, ([], [], [])

    def done():
        # A unit between two blocks of which one is empty has nothing to do: a block's own pairs are of its own unit.
        place = unit.split(":")[1:]
        whole = 0 in rows[1] and (place[:2] == place[2:] or 1 in rows[1])
        links = list(_links(*rows, every)) if len(rows[0]) > 1 and whole else []
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()),
                                           pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

    for batch in batches:
        for u, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if u != unit and unit is not None:
                yield done()
                rows = ([], [], [])
            unit = u
            for held, value in zip(rows, row, strict=True):
                held.append(value)
    if unit is not None:
        yield done()


def _broadcast_bytes(df: DataFrame, order: str, column: str, slices: int, width: int):
    """One array of slices * width bytes, from rows that hold its slices."""
    out = bytearray(slices * width)
    for row in df.select(order, column).collect():
        out[row[0] * width:row[0] * width + len(row[1])] = row[1]
    return df.sparkSession.sparkContext.broadcast(bytes(out))


def _filter_of(df: DataFrame, column: str):
    """A broadcast bitmap of 2 ** FILTER_BITS bits at any input that has all hashes of the column; some others seem to be there."""
    slot = F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    member = df.groupBy(F.shiftright(slot, 15).cast("int").alias("slice")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    return _broadcast_bytes(member, "slice", "bits", 1 << FILTER_BITS - 15, 1 << 12)


def _all_linked(batches) -> Iterator[pa.RecordBatch]:
    return _linked(batches, every=True)


def ngram_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, set_key; n_links too if count_links is set.

    n_links is the number of other rows of similarity 0.8 or more, copies included.

    component_id is the smallest id reachable by links of similarity 0.8 or more, the row's own
    included. Rows with equal sets link; null, empty and wordless texts have the empty set and link
    with nothing. Rows repeating an id are rows of their own with that id; null ids come after all others. Ids
    are whole numbers; other columns are not read; an empty table gives an empty result. Shingles
    and sets are told apart by 64-bit hashes.
    """
    facts, n, units = _units(docs, id_col, text_col)
    links = units.mapInArrow(_all_linked if count_links else _linked, "a bigint, b bigint")
    if count_links:
        links = written(links, "ngram-all-links")
    classes = written(connected_components(links, "ngram-links").withColumnsRenamed(
        {"node": "set_key", "component": "class"}), "ngram-classes", n)

    classed = written(facts.join(classes, "set_key", "left").withColumn("class", F.coalesce("class", "set_key")), "ngram-classed", n)
    least = written(classed.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least")), "ngram-least", n)
    if count_links:
        rows = written(facts.where("n_shingles > 0").groupBy("set_key").agg(F.count(F.lit(1)).alias("rows")), "ngram-rows", n)
        beyond = links.union(links.select("b", "a")).join(rows.withColumnRenamed("set_key", "b"), "b") \
            .groupBy(F.col("a").alias("set_key")).agg(F.sum("rows").alias("beyond"))
        counted = rows.join(beyond, "set_key", "left").select(
            "set_key", (F.col("rows") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"))
        classed = classed.join(counted, "set_key", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    return classed.join(least, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "set_key", *(["n_links"] if count_links else []))


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The list of links between distinct sets, each once: a, b, the set_keys of ngram_groups.

    Rows with equal sets link too; their set_key says so, and no pair of them is listed.
    """
    *_, units = _units(docs, id_col, text_col)
    return units.mapInArrow(_all_linked, "a bigint, b bigint")


def _units(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, DataFrame]:
    """(doc_id, n_shingles, set_key) of every row, their number, and the units of work, each in one sorted piece.

    Every pair of sets that can be alike meets in exactly one unit.
    """
    texts = docs.select(utf8(text_col).alias("text"))
    described = written(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")).mapInArrow(
            _describe, "doc_id bigint, n_shingles bigint, set_key bigint, slice int, counts binary"), "ngram-sets")
    sketch = described.where("slice IS NOT NULL").select("slice", "counts").repartition("slice").mapInArrow(
        _added, "slice int, counts binary")
    facts = described.where("slice IS NULL").select("doc_id", "n_shingles", "set_key")
    n = facts.count()
    # The sketch is 2 ** SKETCH_BITS counters of two bytes at any input.
    order = _broadcast_bytes(sketch, "slice", "counts", SKETCH_SLICES, 2 << SKETCH_BITS >> int(math.log2(SKETCH_SLICES)))

    # Each of the next two reads the texts again: shingles are cheaper to make than to store.
    edges = texts.mapInArrow(_prefixes(order), "slice int, entries binary, edges binary") \
        .repartition("slice").sortWithinPartitions("slice").mapInArrow(_chained, "a bigint, b bigint")
    groups = written(connected_components(edges, "ngram-candidates"), "ngram-groups", n)

    wanted = _filter_of(groups, "node")
    sets = texts.mapInArrow(_wanted_sets(wanted), "set_key bigint, size bigint, shingles binary") \
        .groupBy("set_key").agg(F.first("shingles").alias("shingles"))

    # Sizes that are alike lie in one band or in neighbours: the step is above 1.25.
    meta = written(groups.withColumnRenamed("node", "set_key").join(
        facts.select("set_key", "n_shingles").distinct(), "set_key")
        .withColumn("band", F.floor(F.log("n_shingles") / math.log(1.26)).cast("int")), "ngram-meta", n)
    bands = meta.groupBy("component", "band").agg(F.count(F.lit(1)).alias("n"))
    total = bands.groupBy("component").agg(F.sum("n").alias("total"))
    counts = written(bands.join(total, "component").where(F.col("total") > BLOCK_SETS).select(
        "component", "band", F.ceil(F.col("n") / BLOCK_SETS).cast("int").alias("blocks")), "ngram-bands", n)

    def beside(step: int, name: str) -> DataFrame:
        return counts.select("component", (F.col("band") + step).alias("band"), F.col("blocks").alias(name))

    placed = meta.join(counts, ["component", "band"], "left").join(beside(-1, "above"), ["component", "band"], "left") \
        .join(beside(1, "below"), ["component", "band"], "left")
    mine = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")

    def unit(low_band, low, high_band, high):
        return F.concat_ws(":", "component", low_band, low, high_band, high)

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    band = F.col("band")
    same = F.transform(upto(F.col("blocks")), lambda j: F.struct(
        unit(band, F.least(F.col("block"), j), band, F.greatest(F.col("block"), j)).alias("unit"),
        (F.col("block") > j).cast("int").alias("side")))
    above = F.transform(upto(F.coalesce("above", F.lit(0))), lambda j: F.struct(
        unit(band, F.col("block"), band + 1, j).alias("unit"), F.lit(0).alias("side")))
    below = F.transform(upto(F.coalesce("below", F.lit(0))), lambda j: F.struct(
        unit(band - 1, j, band, F.col("block")).alias("unit"), F.lit(1).alias("side")))
    # A small group is one unit by itself.
    alone = F.array(F.struct(F.col("component").cast("string").alias("unit"), F.lit(0).alias("side")))
    units = placed.withColumn("block", mine).select("set_key", F.explode(
        F.when(F.col("blocks").isNull(), alone).otherwise(F.concat(same, above, below))).alias("u"))
    return facts, n, units.select("set_key", "u.unit", "u.side").join(sets, "set_key") \
        .select("unit", "set_key", "side", "shingles").repartition("unit").sortWithinPartitions("unit")


@F.arrow_udf(T.LongType())
def set_keys(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The set_key of ngram_groups for UTF-8 texts."""
    for part in texts:
        batch = pa.RecordBatch.from_arrays([part], names=["text"])
        yield pa.array([_set_key(s) for _, block in blocks([batch]) for s in _sets(block)], pa.int64())


def _among(bits):
    """Whether a set_key seems to be in a bitmap of _filter_of."""
    def run(keys: Iterator[pa.Array]) -> Iterator[pa.Array]:
        member = np.frombuffer(bits.value, np.uint8)
        for part in keys:
            slot = part.to_numpy(zero_copy_only=False) & ((1 << FILTER_BITS) - 1)
            yield pa.array((member[slot >> 3] >> (slot & 7) & 1).astype(bool))

    # Otherwise Spark would push the filter below the hashes and make them twice.
    return F.arrow_udf(run, T.BooleanType()).asNondeterministic()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one id of each group: the smallest. Rows without shingles all stay.

    Rows of a group that repeat an id are one document and stay or go together, whatever the id's rows in other
    groups do; a null id stays only if its whole group has none. Null and empty texts have no shingles. Columns may
    have any names. An empty table gives an empty result.
    """
    # A row's set decides with its id, so sets that lose no row need not meet the decisions: their texts are not shuffled.
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    groups = written(ngram_groups(docs, id_col, text_col).select("doc_id", "set_key", stays.alias("stays")), "ngram-stays")
    losing = _filter_of(groups.where("NOT stays"), "set_key")
    kept = groups.where("stays").where(_among(losing)("set_key")) \
        .select(F.col("doc_id").alias("id"), F.col("set_key").alias("of")).distinct()
    rows = packed(docs).withColumns({"set_key": set_keys(utf8("doc", text_col)), "doc_id": F.col("doc")[id_col].cast("bigint")}) \
        .withColumn("asked", _among(losing)("set_key"))
    asked = rows.where("asked").join(
        kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("set_key") == F.col("of")), "left_semi")
    return rows.where("NOT asked").select("doc.*").union(asked.select("doc.*"))
