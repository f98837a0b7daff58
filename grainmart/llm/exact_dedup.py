"""Exact dedup by progressive refinement, in built-in functions only.

Texts are equal when they are identical after all white space is deleted. A first pass reads the
lengths; within a length, a hash of the first characters; only rows whose (length, prefix) is
shared get their full content hashed. Which pairs are shared reaches the second pass as a bitmap of
fixed size, so no text moves between tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import packed, written

PREFIX = 64
BITMAP_BITS = 1 << 15  # of one row of the bitmap (fixed by bitmap_construct_agg)
BITMAP_ROWS = 512  # 512 rows of 4 KB at most: the size of what may be broadcast


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for char in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the most code points stays, then the smallest id (nulls last), then any one of rows
    that agree in both. text_sha256 is the digest of the squeezed text; a row that refinement
    shows to be alone has it only if digest_all. Null and empty texts form one group. Other
    columns of docs are not read. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    measured = source.select(F.length(squeezed(F.col("text"))).alias("n"),
                             F.xxhash64(F.left(squeezed(F.col("text")), F.lit(PREFIX))).alias("prefix"))
    # A (length, prefix) pair can only be shared where the length is: one count by both refines
    # the count by length without a second pass over the texts.
    pairs = measured.groupBy("n", "prefix").agg(F.count(F.lit(1)).alias("rows"))
    slot = F.pmod(F.xxhash64("n", "prefix"), F.lit(BITMAP_BITS * BITMAP_ROWS))
    bitmap = written(
        pairs.where("rows > 1").select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / BITMAP_BITS).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("slot") % BITMAP_BITS).alias("bits")), "dedup-bitmap")

    second = source.withColumn("squeezed", squeezed(F.col("text"))).select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("points"), "squeezed",
        F.length("squeezed").alias("n"),
        F.xxhash64(F.left(F.col("squeezed"), F.lit(PREFIX))).alias("prefix"))
    second = second.withColumn("slot", slot).withColumn(
        "part", F.floor(F.col("slot") / BITMAP_BITS).cast("int"))
    at = F.col("slot") % BITMAP_BITS
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    second = second.join(F.broadcast(bitmap), "part", "left").withColumn(
        "survives", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
    digest = F.sha2("squeezed", 256)
    facts = written(second.select(
        "doc_id", "points", "n", "survives",
        (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row")), "dedup-facts")

    order = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("z"),
                     F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    # Written, so that the join shuffles both sides itself and the rows of a very large group can be split.
    groups = written(facts.where("survives").groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("size"), F.min(order).alias("best")).where("size > 1"), "dedup-groups")
    return facts.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("row") == F.col("best.row"))).alias("kept"),
        "text_sha256", "points")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with their columns. Of repeated rows that agree in id and squeezed text, one stays.

    Null and empty texts are one group, of which one row stays; a null id is an id. Columns may have any
    names. An empty table gives an empty result.
    """
    decisions = written(exact_dedup(docs, id_col, text_col, digest_all=True), "dedup-decisions")
    kept = decisions.where("kept").select(
        F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), F.col("points").alias("length"))
    alike = decisions.groupBy("doc_id", "text_sha256", "points").count().where("count > 1").limit(1).count()
    text = F.col("doc")[text_col]
    out = packed(docs).withColumns({"of": F.col("doc")[id_col], "digest": F.sha2(squeezed(text), 256),
                                    "points": F.length(F.coalesce(text, F.lit("")))})
    out = out.join(kept, F.col("of").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha"))
                   & (F.col("points") == F.col("length")), "left_semi")
    if alike:
        out = out.dropDuplicates(["of", "digest", "points"])
    return out.select("doc.*")
