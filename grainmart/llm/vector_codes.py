"""Product-quantisation codes by active-entry Lloyd, exact in integers.

Vectors are cut into consecutive parts; each part position has a codebook of at most 256 entries. The state of
a vector, the entry of each part and its exact squared distance, is written with it after each
round. In the next round a part whose entry did not move is compared with the moved entries only,
against the stored distance: all other entries stood still and had lost already. A part whose entry
moved is compared with all. Ties go to the lower index in both cases. Each task adds up the parts of
its entries and writes one row of sums per entry beside its vectors, so a frequent vector, entry or
label gathers nowhere. Codebooks (entries x dimensions) are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import dropped, written

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
LIMIT = 1 << 26  # of an integer component: squares of differences of 512 components then fit 64 bits
FLOAT_LIMIT = 1 << 22  # up to here products and their sums are exact in float64 as well
SLICE = 1024  # vectors compared at once


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row, the lower index on ties; exact."""
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    small = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < FLOAT_LIMIT
    for at in range(0, len(x), SLICE):
        rows = x[at:at + SLICE]
        if small:
            a, b = rows.astype(np.float64), entries.astype(np.float64)
            d = (a * a).sum(1)[:, None] + ((b * b).sum(1)[None, :] - 2 * (a @ b.T))
        else:
            d = np.zeros((len(rows), len(entries)), np.int64)
            for k in range(x.shape[1]):
                d += (rows[:, k, None] - entries[None, :, k]) ** 2
        best = d.argmin(1)
        index[at:at + SLICE] = best
        distance[at:at + SLICE] = d[np.arange(len(rows)), best].astype(np.int64)
    return index, distance


def reassigned(x: np.ndarray, code: np.ndarray, distance: np.ndarray, entries: np.ndarray,
               moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The assignment of one part after the entries in the mask moved have moved."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = nearest(x[lost], entries)
    active, still = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(still):
        found, d = nearest(x[still], entries[active])
        found = active[found]
        wins = (d < distance[still]) | ((d == distance[still]) & (found < code[still]))
        code[still[wins]], distance[still[wins]] = found[wins], d[wins]
    return code, distance


def _pass(book: np.ndarray, moved: np.ndarray | None, sums: bool) -> Callable:
    """One round over a partition; book is (parts, entries, width), moved a mask of its entries or None at first."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, width)
            code, distance = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
            if moved is not None:
                before = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                stored = batch.column("distances").flatten().to_numpy(zero_copy_only=False).reshape(n, parts)
            for p in range(parts):
                if moved is None:
                    code[:, p], distance[:, p] = nearest(x[:, p], book[p])
                else:
                    code[:, p], distance[:, p] = reassigned(x[:, p], before[:, p], stored[:, p], book[p], moved[p])
                if sums:
                    np.add.at(total[p], code[:, p], x[:, p])
                    count[p] += np.bincount(code[:, p], minlength=entries)
            packed = code.astype(np.uint8)
            out = {"vec_id": batch.column("vec_id"), "label": batch.column("label"),
                   "codes": pa.array([row.tobytes() for row in packed], pa.binary()),
                   "distances": _lists(distance), "ints": batch.column("ints")}
            if sums:
                none = pa.nulls(n, pa.int64())
                out |= {"part": pa.nulls(n, pa.int32()), "entry": pa.nulls(n, pa.int32()), "n": none,
                        "total": pa.nulls(n, pa.list_(pa.int64()))}
            else:
                del out["ints"]
            ids = batch.schema.field("vec_id").type, batch.schema.field("label").type
            yield pa.RecordBatch.from_pydict(out)
        if sums and count.any():
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.nulls(len(p), ids[0]), "label": pa.nulls(len(p), ids[1]), "codes": pa.nulls(len(p), pa.binary()),
                "distances": pa.nulls(len(p), pa.list_(pa.int64())), "ints": pa.nulls(len(p), pa.list_(pa.int64())),
                "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e]),
                "total": _lists(total[p, e])})
    return run


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.reshape(-1)))


def _updated(book: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries replaced by the floor of the mean of their parts; entries without parts stay."""
    cells = sums.select("part", "entry", "n", F.posexplode("total").alias("k", "v")).groupBy("part", "entry", "k").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum(F.col("n")).alias("n")).collect()  # parts x entries x width
    new = book.copy()
    for cell in cells:
        new[cell["part"], cell["entry"], cell["k"]] = int(cell["v"]) // cell["n"]
    return new


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """The written (vec_id, label, ints) of vectors with components, all of them finite numbers."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return written(vectors.select(F.col(id_col).alias("vec_id"), label.alias("label"), v.alias("v"), finite.alias("ok"))
                   .where("ok AND size(v) > 0").select(
                       "vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("ints")), "codes-vectors")


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """(written table of vec_id, label, codes, error; the final codebooks as (parts, entries, width)).

    codes is one byte a part. Vectors that are null, empty, or hold a null, NaN or infinite component are
    dropped. Codebooks start from the parts of the vectors with the smallest ids, nulls last; rows that
    repeat an id are told apart by their components and are rows of their own. With fewer vectors than
    entries there are as many entries as vectors, with none an empty table and codebooks of no entries.
    Vectors of unlike length, a length that the parts do not divide, and components of 65536 or more are
    an error: they have no code. Other columns are not read, so no name can clash.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = kept_vectors(vectors, id_col, vector_col, label)
    shape = rows.agg(F.min(F.size("ints")).alias("least"), F.max(F.size("ints")).alias("most"), F.max(F.greatest(
        F.array_max("ints"), -F.array_min("ints"))).alias("reach")).first()
    width = (shape["most"] or 0) // parts
    if shape["least"] != shape["most"] or (shape["most"] or 0) % parts:
        raise ValueError(f"vectors of {shape['least']} to {shape['most']} components cannot be cut into {parts} equal parts")
    if (shape["reach"] or 0) >= LIMIT:
        raise ValueError(f"a component reaches {LIMIT // SCALE} or more")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    book = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()

    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "ints")
    state = "codes binary, distances array<bigint>"
    full = f"{held}, {state}, ints array<bigint>, part int, entry int, n bigint, total array<bigint>"
    moved, now, last = None, rows, None
    for _ in range(rounds):
        table = written(now.mapInArrow(_pass(book, moved, sums=True), full), "codes-round")
        new = _updated(book, table.where("part IS NOT NULL"))
        moved, book = (new != book).any(2), new
        if last is not None:
            dropped(last)  # the round that follows it is written
        last, now = table, table.where("part IS NULL").select("vec_id", "label", "codes", "distances", "ints")
    final = written(now.mapInArrow(_pass(book, moved, sums=False), f"{held}, {state}"), "codes-final")
    if last is not None:
        dropped(last)
    return final.select("vec_id", "label", "codes", F.aggregate(
        "distances", F.lit(0).cast("long"), lambda a, d: a + d).alias("error")), book


def codebooks_sha256(book: np.ndarray) -> str:
    """Digest of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each coded vector; nulls are one label together."""
    coded, book = vector_codes(vectors, **options)
    labels = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels") \
        .withColumnRenamed("label", "of")
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))
