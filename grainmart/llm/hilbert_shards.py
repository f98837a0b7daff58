"""Shards as runs of a Hilbert curve over metadata, for file pruning in several dimensions.

Source, language and size are quantised to 16 levels each; the cell's place on the Hilbert curve
orders the rows, so that a run of the curve spans few values in every dimension. Positions are
exact and distributed: totals per cell, then per bucket of a cell, then running numbers within a
bucket of bounded size. A cell that holds a third of all rows is just more buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmart.llm.common import unit, written

SHARDS = 16
BITS = 4  # per dimension: 16 levels
DIMENSIONS = 3
BUCKET_ROWS = 4096
BUCKET = ["curve", "bucket", "apart", "part"]


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place on the Hilbert curve of a point with coordinates of so many bits."""
    n, mask = len(point), (1 << len(point)) - 1

    def turned(x: int, by: int) -> int:  # rotate left within n bits
        by %= n
        return ((x << by) | (x >> (n - by))) & mask

    index = entry = axis = 0
    for plane in reversed(range(bits)):
        corner = sum(((c >> plane) & 1) << i for i, c in enumerate(point))
        gray = turned(corner ^ entry, n - (axis + 1) % n)
        step = gray
        shift = 1
        while shift < n:  # from Gray code to its rank
            step ^= step >> shift
            shift *= 2
        index = (index << n) | step
        start = max(0, (step - 1) // 2 * 2)
        entry ^= turned(start ^ (start >> 1), axis + 1)
        odd = step if step % 2 else step - 1
        run = 0
        while step and (odd >> run) & 1:
            run += 1
        axis = (axis + run + 1) % n
    return index


def in_buckets(rows: DataFrame) -> DataFrame:
    """rows with the columns apart and part, so that the columns of BUCKET cut a cell into buckets of bounded size."""
    # Rows that agree in every column share h: more of them than a bucket holds are buckets of their own, cut by tie.
    heavy = written(rows.groupBy("curve", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS).select(
        "curve", "h", F.ceil(F.col("n") / BUCKET_ROWS).alias("parts")), "shard-ties")
    return rows.join(heavy, ["curve", "h"], "left").withColumns({
        "apart": F.when(F.col("parts").isNotNull(), F.col("h")).otherwise(-1.0),
        "part": F.coalesce(F.floor(F.col("tie") * F.col("parts")), F.lit(0)).cast("long")})


def curve_shards(docs: DataFrame, shards: int = SHARDS, law: str = "rows", id_col: str = "doc_id",
                 text_col: str = "text", dimensions: tuple[str, str] = ("source", "lang")) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, curve (place of its cell), shard, slot.

    size is the text's UTF-8 bytes plus 1 (null: 1). law 'rows' gives shards whose row counts differ
    by one at most; law 'bytes' cuts at equal sizes, off by one document at most. slot numbers the
    rows of a shard from 0 in curve order. Nominal dimensions are quantised by hash, the size by
    its logarithm; nulls are a level of their own value. Rows that agree in every column are numbered in
    any order. An empty table gives an empty result.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law!r}")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    levels = 1 << BITS
    first, second = (F.pmod(F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("\0")).cast("binary")), F.lit(levels))
                     for c in dimensions)
    # 16 levels of size: below 64 bytes, then half a doubling each, the last without end.
    length = F.greatest(F.lit(0), F.least(F.lit(levels - 1), F.floor(2 * F.log2((F.col("size")) / 64)) + 1))
    facts = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text).alias("text_crc32"), first.alias("x"), second.alias("y"))
    facts = facts.withColumn("cell", (F.col("x") * levels * levels + F.col("y") * levels + length).cast("int"))
    places = docs.sparkSession.createDataFrame(
        [(i, hilbert_index((i // levels ** 2, i // levels % levels, i % levels), BITS))
         for i in range(levels ** DIMENSIONS)], "cell int, curve long")
    facts = written(facts.join(F.broadcast(places), "cell").select(
        "doc_id", "size", "text_crc32", "curve", unit("doc_id", "size", "text_crc32").alias("h"),
        unit(F.monotonically_increasing_id()).alias("tie")), "shard-facts")

    # At most 4096 cells: this window and this broadcast have that bound at any input.
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = facts.groupBy("curve").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    cells = written(cells.select(
        "curve", F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets"), "n", "bytes",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_rows"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("cell_bytes")), "shard-cells")
    total = cells.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    n, size = total["n"] or 0, total["bytes"] or 0

    dealt = facts.join(F.broadcast(cells.select("curve", "buckets", "cell_rows", "cell_bytes")), "curve") \
        .withColumn("bucket", F.floor(F.col("h") * F.col("buckets")).cast("long"))
    dealt = in_buckets(dealt)
    earlier = Window.partitionBy("curve").orderBy("bucket", "apart", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).select(
        *BUCKET, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("bucket_rows"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bucket_bytes"))
    inside = Window.partitionBy(*BUCKET).orderBy("h", "doc_id", "size", "text_crc32")
    placed = dealt.join(totals, BUCKET).withColumns({
        "at": F.col("cell_rows") + F.col("bucket_rows") + F.row_number().over(inside) - 1,
        "byte": F.col("cell_bytes") + F.col("bucket_bytes") + F.coalesce(
            F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    if law == "rows":
        small, larger = divmod(n, shards)  # the first shards are one row larger
        edge = larger * (small + 1)
        shard = F.when(F.col("at") < edge, F.floor(F.col("at") / (small + 1))).otherwise(
            larger + F.floor((F.col("at") - edge) / max(small, 1)))
        placed = placed.withColumn("shard", shard.cast("int"))
        start = F.col("shard") * small + F.least(F.col("shard"), F.lit(larger))
        placed = placed.withColumn("slot", (F.col("at") - start).cast("long"))
    else:
        placed = written(placed.withColumn(
            "shard", F.least(F.floor(F.col("byte") * shards / max(size, 1)), F.lit(shards - 1)).cast("int")), "shard-cut")
        starts = placed.groupBy("shard").agg(F.min("at").alias("start"))
        placed = placed.join(F.broadcast(starts), "shard").withColumn("slot", F.col("at") - F.col("start"))
    return placed.select("doc_id", "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> None:
    """Write docs as one folder per shard, rows in curve order, for readers that prune by file statistics.

    Ids are taken to be unique here, because rows meet their place by id.
    """
    places = curve_shards(docs, id_col=id_col, **options).select(F.col("doc_id").alias("_id"), "shard", "slot")
    rows = docs.join(places, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
