"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are bytes with A-Z lower-cased and white space as blanks. An n-gram is a feature (hashed into
fixed bins) that is present or not. Counts of documents per class give each feature its log-count
ratio; the strongest features are kept, scaled by it and fed to logistic regression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import blocks, id_crc, packed, utf8, written

GRAMS = (3, 4, 5, 6)
BINS = 22  # bits of a feature's number
FIT_ROWS = 20_000  # labelled rows to learn from at most, drawn by hash of id: the one bounded sample
FEATURES = 4096  # strongest features kept
MIN_DOCS = 5
SMOOTHING = 1.0
REGULARISATION = 1e-3
FIT_TASKS = 16
BLOCK_BYTES = 1 << 18  # of text worked on at once: its n-grams take some hundred times that

_FOLD = bytes(32 if b in b" \t\n\r\x0b\x0c" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAP = b"\0" * max(GRAMS)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Intercept, and the weight (coefficient times log-count ratio) of each kept feature."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def _grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each length n: (feature at each place, first and end place of every text, n)."""
    folded = [b" " + t.translate(_FOLD) + b" " for t in texts]
    raw = np.frombuffer(_GAP.join([*folded, b""]), np.uint8)
    lengths = np.array([len(t) for t in folded])
    begin = np.cumsum(lengths + len(_GAP)) - lengths - len(_GAP)
    code = raw.astype(np.uint64)
    held = code.copy()
    for n in range(2, max(GRAMS) + 1):
        held = (held[:-1] << np.uint64(8)) | code[n - 1:]
        if n in GRAMS:
            yield ((held + np.uint64(n)) * _SPREAD) >> np.uint64(64 - BINS), begin, begin + lengths - n + 1, n


def _present(texts: list[bytes], wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs of a block; wanted is a mask over the bins."""
    pairs = []
    for feature, begin, end, _ in _grams(texts):
        at = np.arange(len(feature)) if wanted is None else np.flatnonzero(wanted[feature])
        text = np.searchsorted(begin, at, side="right") - 1
        inside = at < end[text]
        pairs.append((text[inside].astype(np.uint64) << np.uint64(BINS)) | feature[at[inside]])
    both = np.unique(np.concatenate(pairs))
    return (both >> np.uint64(BINS)).astype(np.int64), (both & np.uint64((1 << BINS) - 1)).astype(np.int64)


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """(feature, toxic documents, clean documents) of a task's rows (label, text)."""
    counts = np.zeros((2, 1 << BINS), np.int32)
    for keys, texts in blocks(batches, BLOCK_BYTES):
        text, feature = _present(texts, None)
        label = np.array([k[0] for k in keys])[text]
        for y in (0, 1):
            np.add.at(counts[y], feature[label == y], 1)
    for part in np.array_split(np.flatnonzero(counts.any(axis=0)), 64):
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(counts[1][part].astype(np.int64)), pa.array(counts[0][part].astype(np.int64))],
            names=["feature", "toxic", "clean"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from up to fit_rows labelled rows. Labels other than 0 and 1 and null ids are passed over.

    An id labelled twice counts once, as toxic if either label is. Without rows of both classes the
    model has no features and gives the (smoothed) share of toxic rows as every score.
    """
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    # The chosen labels are fit_rows rows at most, so they may be broadcast at any input.
    texts = docs.select(F.col(id_col).alias("of"), utf8(text_col).alias("text"))
    rows = written(texts.join(F.broadcast(chosen), F.col("of") == F.col("_id"))
                   .select("label", "text").repartition(FIT_TASKS), "toxicity-fit")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not (toxic and clean):
        return Model(np.empty(0, np.int64), np.empty(0), prior)

    p, q = F.col("toxic") / toxic, F.col("clean") / clean
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    counts = rows.mapInArrow(_counted, "feature bigint, toxic bigint, clean bigint").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") + F.col("clean") >= MIN_DOCS)
    ratio = F.log((F.col("toxic") + SMOOTHING) / (toxic + 2 * SMOOTHING)) \
        - F.log((F.col("clean") + SMOOTHING) / (clean + 2 * SMOOTHING))
    strongest = counts.select("feature", ratio.alias("ratio"), (
        F.pow(p - q, F.lit(2.0)) / F.greatest(share * (1 - share), F.lit(1e-9))).alias("strength")) \
        .orderBy(F.desc("strength"), "feature").limit(FEATURES).collect()  # FEATURES rows at most
    if not strongest:
        return Model(np.empty(0, np.int64), np.empty(0), prior)
    features = np.array([r["feature"] for r in strongest])
    ratios = np.array([r["ratio"] for r in strongest])

    names = [str(f) for f in features]
    wanted = np.zeros(1 << BINS, bool)
    wanted[features] = True

    def tokens(batches) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches, BLOCK_BYTES):
            text, feature = _present(texts, wanted)
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(k[0]) for k in keys]),
                 pa.array([[str(f) for f in feature[a:b]] for a, b in zip(cut, cut[1:], strict=False)], pa.list_(pa.string()))],
                names=["label", "tokens"])

    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="tokens", outputCol="present") \
        .setBinary(True).transform(rows.mapInArrow(tokens, "label double, tokens array<string>"))
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="present", outputCol="features").transform(vectors)
    model = LogisticRegression(maxIter=60, regParam=REGULARISATION, standardization=False).fit(scaled.select("label", "features"))
    weights = model.coefficients.toArray() * ratios
    return Model(features[weights != 0], weights[weights != 0], model.intercept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carried: Sequence[str] = ()) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), and the row's own columns named in carried.

    Only the text counts; null is an empty text, which has a score too.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), *carried, utf8(text_col).alias("text"))
    names = ["doc_id", "score", *carried]
    types = dict(source.dtypes, score="double")
    features, weights, intercept = model.features, model.weights, model.intercept  # FEATURES numbers at most

    def run(batches) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BINS, bool)
        wanted[features] = True
        order = np.argsort(features)
        kinds: list = []

        def seen(stream):
            for batch in stream:
                kinds[:] = batch.schema.types[:-1]
                yield batch

        for keys, texts in blocks(seen(batches), BLOCK_BYTES):
            text, feature = _present(texts, wanted)
            weight = weights[order][np.searchsorted(features[order], feature)] if len(features) else np.empty(0)
            total = intercept + np.bincount(text, weight, len(texts))
            ids, *rest = (pa.array([k[i] for k in keys], kind) for i, kind in enumerate(kinds))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700)))), *rest], names=names)

    return source.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in names))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs, learned from the labels that are not held out.
    The row's own columns named in carried follow.

    held_out: crc32 of the id's decimal text is divisible by folds. A null id is scored like any other. Repeated rows
    are scored alike; columns not named here are never read; an empty table gives an empty result.
    """
    held_out = F.pmod(id_crc(F.col(id_col)), F.lit(folds)) == 0
    model = fit(docs, labels.where(~held_out), id_col, text_col, label_col)
    return score(docs, model, id_col, text_col, carried).select(
        "doc_id", (F.pmod(id_crc(F.col("doc_id")), F.lit(folds)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), *carried)


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that the classifier does not reject, with their columns.

    A row goes by its own text only: rows that share its id, or also have none, stay unless theirs is rejected too.
    Null and empty texts are scored as empty. Columns may have any names. An empty table gives an empty result.
    """
    rows = packed(docs).withColumns({"id": F.col("doc")[id_col], "body": F.col("doc")[text_col],
                                     "sha": F.sha2(utf8("doc", text_col), 256)})
    scored = toxicity(rows, labels.select(F.col(id_col).alias("id"), F.col(options.get("label_col", "toxic"))), id_col="id",
                      text_col="body", carried=["sha"], **options)
    verdicts = scored.where("predicted = 1").select(F.col("doc_id").alias("of"), F.col("sha").alias("digest")).distinct()
    return rows.join(verdicts, F.col("id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("digest")), "left_anti").select("doc.*")
