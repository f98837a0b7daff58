"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is its token stream: A-Z lower-cased, words joined by one blank, then an end byte. Every
byte is eight binary decisions; each decision (a node of the byte's prefix tree) has a context tree
over the DEPTH bytes before it. A tree node keeps Krichevsky-Trofimov counts; its weighted probability is
half its own estimate, half the product of its children's, so predictions mix all depths. Training
text fixes the counts, and every text is scored by the predictions that follow from them.

The corpus is gathered as counts of (context, byte) grams. Trees are summed up and predictions
handed down in three shuffles: by three-byte context for the deep levels, by decision for the top.
Grams and words frequent enough that there can be few of them are looked up from a broadcast of
bounded size; the rare rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import Words, blocks, id_crc, mix, sorted_groups, utf8, written

DEPTH = 5  # context bytes; DEPTH + 1 bytes of a gram fit a long
TOP = 3  # levels up to here are summed per decision
HEAD_GRAMS = 1 << 21  # a gram is frequent if it is one in so many or more: so many at most
HEAD_WORDS = 1 << 19
HELD = 1 << 21  # grams or words a task holds before it passes them on
CHUNK = 1 << 18  # grams whose trees are worked on at once, cut between contexts
GRAM, WORD, DOC = 0, 1, 2
END_WORD = int(mix(np.array([1], np.uint64))[0])
NOTHING = np.uint64(2**64 - 1)
HALF = np.log(0.5)


def stream(text: bytes) -> bytes:
    """The bytes that the model codes: the words and an end that no word contains."""
    return b" ".join(text.lower().split()) + b"\n"


def grams(streams: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(gram of each byte of the streams, number of its text); contexts before a text are end bytes."""
    pad = b"\n" * depth
    raw = np.frombuffer(pad + pad[1:].join(streams), np.uint8).astype(np.uint64)
    code = np.zeros(len(raw) - depth, np.uint64)
    for k in range(depth + 1):
        code = (code << np.uint64(8)) | raw[k:len(raw) - depth + k]
    lengths = np.array([len(s) for s in streams])
    begin = np.cumsum(lengths + depth - 1) - (lengths + depth - 1)
    at = np.arange(lengths.sum()) + np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
    return code[at], np.repeat(np.arange(len(streams)), lengths)


def _tokens(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, number of its text), the end token of every text included."""
    words = Words(streams, lower=False)
    counts = np.diff(words.starts)
    return (np.concatenate([words.hashes, np.full(len(streams), END_WORD, np.uint64)]),
            np.concatenate([np.repeat(np.arange(len(streams)), counts), np.arange(len(streams))]))


class _Counts:
    """Counts by 64-bit key in bounded memory."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        self.parts = [(keys[first], np.add.reduceat(counts, first) if len(first) else counts)]
        self.held = len(first)
        return self.parts[0]


def _gather(depth: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        found = {GRAM: _Counts(), WORD: _Counts()}

        def passed(kind):
            keys, counts = found[kind].merged()
            found[kind] = _Counts()
            for i in range(0, len(keys), 1 << 16):
                part = keys[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), kind, np.int8)), pa.array(part.view(np.int64)),
                     pa.array(counts[i:i + (1 << 16)])], names=["kind", "key", "n"])

        for keys, texts in blocks(batches):
            train = np.array([k[0] for k in keys], bool)
            streams = [stream(t) for t in texts]
            code, text = grams(streams, depth)
            for learned in (True, False):
                unique, counts = np.unique(code[train[text] == learned], return_counts=True)
                found[GRAM].add(unique, counts if learned else np.zeros_like(counts))
            token, text = _tokens(streams)
            found[WORD].add(*np.unique(token[train[text]], return_counts=True))
            for kind, counts in found.items():
                if counts.held > HELD and len(counts.merged()[0]) > HELD // 2:
                    yield from passed(kind)
        for kind in (GRAM, WORD):
            yield from passed(kind)

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight places up."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (_log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - 2 * _log_gamma(np.array([0.5]))
            - _log_gamma(zeros + ones + 1))


class _Level:
    """The tree nodes of one depth: key = context << 8 | decision, in order."""

    def __init__(self, keys, zeros, ones, below, leaf: bool):
        self.keys, self.up = np.unique(keys, return_inverse=True)  # up: place of each input row's node
        n = len(self.keys)
        self.zeros = np.bincount(self.up, zeros, n)
        self.ones = np.bincount(self.up, ones, n)
        self.own = _kt(self.zeros, self.ones)
        self.weighted = self.own if leaf else HALF + np.logaddexp(self.own, np.bincount(self.up, below, n))
        self.leaf = leaf

    def parents(self, depth: int) -> _Level:
        """The level above, at depth."""
        context = (self.keys >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)
        keys = (context << np.uint64(8)) | (self.keys & np.uint64(255))
        return _Level(keys, self.zeros, self.ones, self.weighted, leaf=False)

    def predict(self, left: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight left for deeper levels, mixed probability of a one so far), this level taken in."""
        stop = np.ones(len(self.keys)) if self.leaf else np.exp(HALF + self.own - self.weighted)
        estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        return left * (1 - stop), mixed + left * stop * estimate


def _trees(code: np.ndarray, n: np.ndarray, depth: int) -> list[_Level]:
    """Levels depth, depth - 1, ... TOP of the grams' trees; the first has a row per decision and gram."""
    byte, context = code & np.uint64(255), code >> np.uint64(8)
    keys, bits = [], []
    for k in range(8):
        decision = np.uint64(1 << k) | (byte >> np.uint64(8 - k))
        keys.append((context << np.uint64(8)) | decision)
        bits.append((byte >> np.uint64(7 - k)) & np.uint64(1))
    keys, bits, n8 = np.concatenate(keys), np.concatenate(bits), np.tile(n.astype(float), 8)
    levels = [_Level(keys, n8 * (bits == 0), n8 * (bits == 1), np.zeros(len(keys)), leaf=True)]
    for d in range(depth - 1, TOP - 1, -1):
        levels.append(levels[-1].parents(d))
    return levels


def _bottom_up(depth: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for _, key, n in sorted_groups(batches, 0, CHUNK):
            top = _trees(key.view(np.uint64), n, depth)[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array((top.keys & np.uint64(255)).astype(np.int64)), pa.array((top.keys >> np.uint64(8)).astype(np.int64)),
                 pa.array(top.zeros), pa.array(top.ones), pa.array(top.weighted)],
                names=["decision", "context", "zeros", "ones", "weighted"])

    return run


def _top(batches) -> Iterator[pa.RecordBatch]:
    """Per decision: sum the levels above TOP and hand predictions down to it.

    A decision has 2**24 contexts of three bytes at most, and real text a small part of them.
    """
    for decision, context, zeros, ones, weighted in sorted_groups(batches, 0, 1):
        keys = (context.astype(np.uint64) << np.uint64(8)) | decision.astype(np.uint64)
        levels, level = [], None
        for d in range(TOP - 1, -1, -1):
            if level is None:
                below = (keys >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)
                level = _Level((below << np.uint64(8)) | (keys & np.uint64(255)), zeros, ones, weighted, leaf=False)
            else:
                level = level.parents(d)
            levels.append(level)
        left, mixed = np.ones(len(level.keys)), np.zeros(len(level.keys))
        for level in reversed(levels):
            left, mixed = level.predict(left, mixed)
            left, mixed = left[level.up], mixed[level.up]
        yield pa.RecordBatch.from_arrays(
            [pa.array(context), pa.array(decision), pa.array(left), pa.array(mixed)],
            names=["context", "key", "left", "mixed"])


def _top_down(depth: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for context, key, n, left, mixed in sorted_groups(batches, 0, CHUNK):
            gram = n >= 0
            code = key[gram].view(np.uint64)
            levels = _trees(code, n[gram], depth)
            node = (context[~gram].astype(np.uint64) << np.uint64(8)) | key[~gram].astype(np.uint64)
            order = np.argsort(node)
            at = order[np.searchsorted(node[order], levels[-1].keys)]
            left, mixed = left[~gram][at], mixed[~gram][at]
            for level in reversed(levels):
                left, mixed = level.predict(left, mixed)
                left, mixed = left[level.up], mixed[level.up]
            one = mixed.reshape(8, -1)
            byte = code & np.uint64(255)
            bits = np.array([(byte >> np.uint64(7 - k)) & np.uint64(1) for k in range(8)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(np.log10(np.where(bits == 1, one, 1 - one)).sum(axis=0))],
                names=["key", "value"])

    return run


class Lookup:
    """An open hash table from 64-bit keys to numbers, filled and read by whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, NOTHING, np.uint64)
        self.values = np.zeros(1 << self.bits)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == NOTHING
            self.keys[slot[free]] = keys[free]  # of several keys for one slot, one is written
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slot = (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value or 0, whether there is one) of each key."""
        slot = self._slot(keys)
        found = self.keys[slot] == keys
        values = np.where(found, self.values[slot], 0.0)
        open_ = np.flatnonzero(~found & (self.keys[slot] != NOTHING))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            hit = self.keys[slot] == keys[open_]
            values[open_[hit]], found[open_[hit]] = self.values[slot[hit]], True
            on = ~hit & (self.keys[slot] != NOTHING)
            open_, slot = open_[on], slot[on]
        return values, found


def _lookup(table: DataFrame) -> Lookup:
    """A broadcastable table of (key, value); the caller bounds its rows."""
    got = table.select("key", F.col("value").cast("double").alias("value")).toArrow()
    return Lookup(got.column("key").to_numpy().view(np.uint64), got.column("value").to_numpy())


def _sums(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Sum of value by group; floats even where nothing is summed."""
    return np.bincount(group, value, n).astype(float)


def _scored(depth: int, frequent_grams, frequent_words, n_train: int, n_distinct: int):
    denominator = n_train + 0.1 * (n_distinct + 1)
    schema = ["row", "kind", "key", "n", "tokens", "known", "base", "score"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        gram_table, word_table = frequent_grams.value, frequent_words.value

        def rare(kind, numbers, text, key):
            order = np.lexsort((key, text))
            text, key = text[order], key[order]
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])])) if len(key) else []
            counts = np.diff(np.concatenate([first, [len(key)]])).astype(float) if len(key) else np.empty(0)
            none = pa.nulls(len(counts), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers[text[first]] if len(key) else numbers[:0]), pa.array(np.full(len(counts), kind, np.int8)),
                 pa.array(key[first].view(np.int64) if len(key) else np.empty(0, np.int64)), pa.array(counts),
                 none, none, none, none], names=schema)

        for keys, texts in blocks(batches):
            numbers = np.array([k[0] for k in keys], np.int64)
            ids = pa.array([k[1] for k in keys], pa.int64())
            streams = [stream(t) for t in texts]
            code, text = grams(streams, depth)
            value, found = gram_table.find(code)
            score = _sums(text, value, len(texts))
            yield rare(GRAM, numbers, text[~found], code[~found])
            token, text = _tokens(streams)
            count, found = word_table.find(token)
            base = _sums(text[found], np.log10((count[found] + 0.1) / denominator), len(texts))
            known = _sums(text[found], count[found] > 0, len(texts))
            yield rare(WORD, numbers, text[~found], token[~found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(np.full(len(texts), DOC, np.int8)), ids,
                 pa.array([float(len(x)) for x in streams]),
                 pa.array(np.bincount(text, minlength=len(texts)).astype(float)), pa.array(known), pa.array(base),
                 pa.array(score)], names=schema)

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10,
              depth: int = DEPTH) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes_coded, bits_per_byte.

    Learned from rows whose crc32(id as text) is not divisible by folds; a null id counts as empty
    text there. score is log10 of the model's probability of the token stream; bits_per_byte its
    code length per byte of it. base_score is the smoothed unigram score. Null and empty texts are just
    an end. Repeated rows are learned and scored each. Ids are whole numbers. Without training rows
    every decision is even and every word unknown. An empty table gives an empty result.
    """
    if not TOP < depth <= 6:
        raise ValueError(f"depth is {TOP + 1} to 6")
    held_out = F.pmod(id_crc(F.col(id_col)), F.lit(folds)) == 0
    counts = written(
        docs.select((~held_out).alias("train"), utf8(text_col).alias("text"))
        .mapInArrow(_gather(depth), "kind tinyint, key bigint, n bigint")
        .groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    total = {r["kind"]: (r["n"], r["distinct"]) for r in counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("distinct")).collect()}
    n_grams = (total.get(GRAM) or (0, 0))[0]
    n_train, n_distinct = total.get(WORD) or (0, 0)

    context = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))
    deep = counts.where(F.col("kind") == GRAM).select(context.alias("context"), "key", "n")
    top = deep.repartition("context").sortWithinPartitions("context").mapInArrow(
        _bottom_up(depth), "decision bigint, context bigint, zeros double, ones double, weighted double")
    handed = top.repartition("decision").sortWithinPartitions("decision").mapInArrow(
        _top, "context bigint, key bigint, left double, mixed double")
    both = deep.select("context", "key", "n", F.lit(None).cast("double").alias("left"), F.lit(None).cast("double").alias("mixed")) \
        .unionByName(handed.select("context", "key", F.lit(-1).cast("bigint").alias("n"), "left", "mixed"))
    scores = written(both.repartition("context").sortWithinPartitions("context").mapInArrow(
        _top_down(depth), "key bigint, value double"), "lm-scores")

    # Those that are one in HEAD or more of the training text: HEAD rows at most, by that definition.
    frequent = {kind: counts.where((F.col("kind") == kind) & (F.col("n") * size >= max(n, 1)))
                for kind, size, n in ((GRAM, HEAD_GRAMS, n_grams), (WORD, HEAD_WORDS, n_train))}
    context_ = docs.sparkSession.sparkContext
    head_grams = context_.broadcast(_lookup(scores.join(frequent[GRAM].select("key"), "key", "left_semi")))
    head_words = context_.broadcast(_lookup(frequent[WORD].select("key", F.col("n").alias("value"))))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       utf8(text_col).alias("text")).mapInArrow(
        _scored(depth, head_grams, head_words, n_train, n_distinct),
        "row bigint, kind tinyint, key bigint, n double, tokens double, known double, base double, score double")
    values = scores.select(F.lit(GRAM).cast("tinyint").alias("kind"), "key", "value").unionByName(
        counts.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value")))
    is_word, is_gram, is_doc = (F.col("kind") == k for k in (WORD, GRAM, DOC))
    count = F.coalesce("value", F.lit(0.0))
    word_score = F.col("n") * F.log10((count + 0.1) / (n_train + 0.1 * (n_distinct + 1)))
    summed = rows.join(values, ["kind", "key"], "left").groupBy("row").agg(
        F.max(F.when(is_doc, F.col("key"))).alias("doc_id"),
        F.sum("tokens").cast("long").alias("n_tokens"),
        F.sum(F.coalesce(F.col("known"), F.when(is_word & (count > 0), F.col("n")))).cast("long").alias("n_known"),
        F.sum(F.coalesce(F.col("base"), F.when(is_word, word_score))).alias("base_score"),
        F.sum(F.coalesce(F.col("score"), F.when(is_gram, F.col("n") * F.col("value")))).alias("score"),
        F.max(F.when(is_doc, F.col("n"))).cast("long").alias("n_bytes_coded"))
    return summed.select(
        "doc_id", (F.pmod(id_crc(F.col("doc_id")), F.lit(folds)) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes_coded",
        (-F.col("score") / F.col("n_bytes_coded") * float(np.log2(10))).alias("bits_per_byte"))
