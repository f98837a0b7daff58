"""Mix sources to target weights by pivotal dependent rounding, in built-in functions only.

Every document of a source gets the same fractional number of copies, its source's target over its
source's size. Pairs of documents then move mass (words) between their fractions at random until
one of the two is integral; what a leaf of documents leaves over is one fractional document, and
leaves are combined level by level in a reduction tree until one is left per source. Words of a
source are preserved exactly by every move, so the mix misses a target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmart.llm.common import WORD_CLASS, packed, unit, written

WEIGHTS = (3, 1, 2)  # repeat over the sources in code point order, null last
TOTAL_SHARE = 1.5  # words of the mix over words of the input
CEILING = 2  # copies of a source at most
LEAF = 256  # documents or residues folded in one row
LOT = 4096  # of rows that repeat id, source and size, numbered at once


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE,
                   ceiling: float = CEILING) -> DataFrame:
    """Add target to (source, source_size): share of all words by weight, no more than ceiling times the size.

    What a full source cannot take goes to the others by weight, so a target is
    min(ceiling * size, level * weight) with one level for all. One row per source: the windows
    here sort the list of sources, not documents.
    """
    ordered = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = ordered.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    ).withColumn("full_at", ceiling * F.col("source_size") / F.col("weight"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = weighed.withColumns({
        "mass_left": share * F.sum("source_size").over(everything)
        - ceiling * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    level = left.withColumn("level", F.col("mass_left") / F.col("weight_left"))
    # The level is right at the first source that it does not fill.
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))).over(everything)
    return level.withColumn("level", first["level"]).select(
        "source", "source_size", "units",
        F.least(F.col("source_size") * float(ceiling), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
        .alias("target"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _meeting(seed: int):
    return lambda state, x: _meet(state, x, seed)


def _meet(state: Column, x: Column, seed: int) -> Column:
    """One meeting: the carried document and x move mass until one of them is integral."""
    c = state["carry"]
    gain = F.least((1 - c["p"]) * c["mass"], x["p"] * x["mass"])  # what the carried one can take from x
    loss = F.least(c["p"] * c["mass"], (1 - x["p"]) * x["mass"])  # what it can give to x
    draw = unit(c["doc_id"], c["size"], c["tie"], x["doc_id"], x["size"], x["tie"], F.lit(seed))

    def settle(z):
        takes = z["draw"] * (z["gain"] + z["loss"]) < z["loss"]
        carry_ends = F.when(takes, z["gain"] >= (1 - c["p"]) * c["mass"]).otherwise(z["loss"] >= c["p"] * c["mass"])
        end = F.when(carry_ends, c).otherwise(x)
        up = F.when(carry_ends, takes).otherwise(~takes)
        moved = F.when(takes, z["gain"]).otherwise(-z["loss"])
        stay = F.when(carry_ends, x).otherwise(c)
        p = F.when(carry_ends, x["p"] - moved / x["mass"]).otherwise(c["p"] + moved / c["mass"])
        return F.struct(
            F.struct(stay["mass"].alias("mass"), stay["doc_id"].alias("doc_id"), stay["size"].alias("size"),
                     stay["tie"].alias("tie"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p")).alias("carry"),
            F.concat(state["done"], F.array(F.struct(
                end["doc_id"].alias("doc_id"), end["size"].alias("size"), end["tie"].alias("tie"),
                up.cast("int").alias("up")))).alias("done"))

    return _let(F.struct(gain.alias("gain"), loss.alias("loss"), draw.alias("draw")), settle)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, ceiling: int = CEILING,
                seed: int = 7) -> DataFrame:
    """One row per input row: doc_id, source, size, tie, source_size, target, copies, taken (= copies * size).

    Rows that repeat (id, source, size) are told apart by tie, from 1, and decided each. A text without words (or null) has size
    0, adds nothing to a target and gets its copies by an independent draw. A null source is a
    source of its own, a null id an id. Draws are hashes of ids and sizes: reruns agree on any
    partitioning. An empty table gives an empty result.
    """
    alike = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size")) \
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    lots = alike.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / LOT))))
    facts = written(lots.select("doc_id", "source", "size", F.explode(F.sequence(
        F.col("lot") * LOT + 1, F.least(F.col("rows"), (F.col("lot") + 1) * LOT))).alias("tie")), "mix-facts")
    sources = facts.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count_if(F.col("size") > 0).alias("units"))
    targets = written(source_targets(sources, weights, share, ceiling), "mix-targets")
    most = targets.agg(F.max("units")).first()[0] or 0

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumnRenamed("source", "_source")
    joined = facts.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumn("rate", rate).withColumn("p", F.col("rate") - F.floor("rate"))
    leaves = F.ceil(F.col("units") / LEAF)
    level = joined.where("size > 0 AND p > 0").select(
        "source", F.floor(unit("doc_id", "size", "tie", F.lit(seed)) * leaves).cast("long").alias("leaf"),
        F.struct(F.col("size").cast("double").alias("mass"), "doc_id", "size", "tie", "p").alias("u"))

    none = F.expr("cast(array() AS array<struct<doc_id: bigint, size: bigint, tie: bigint, up: int>>)") \
        .cast(f"array<struct<doc_id:{dict(facts.dtypes)['doc_id']},size:bigint,tie:bigint,up:int>>")
    ended, groups, depth = [], -(-most // LEAF), 0
    while True:
        meet = _meeting(seed + 1 + depth)
        # Largest first: the smaller of a pair is usually the one to become integral.
        folded = written(
            level.groupBy("source", "leaf").agg(F.sort_array(F.collect_list("u"), asc=False).alias("us"))
            .select("source", "leaf", F.aggregate(
                F.slice(F.col("us"), F.lit(2), F.greatest(F.size("us") - 1, F.lit(0))),
                F.struct(F.element_at("us", 1).alias("carry"), none.alias("done")),
                meet).alias("s")), f"mix-level{depth}")
        ended.append(folded.select("source", F.explode("s.done").alias("e")).select("source", "e.*"))
        level = folded.select("source", F.floor(F.col("leaf") / LEAF).cast("long").alias("leaf"), F.col("s.carry").alias("u"))
        if groups <= 1:
            break
        groups, depth = -(-groups // LEAF), depth + 1
    ended.append(level.select("source", "u.doc_id", "u.size", "u.tie", (F.col("u.p") >= 0.5).cast("int").alias("up")))
    rounded = ended[0]
    for part in ended[1:]:
        rounded = rounded.unionByName(part)

    decided = rounded.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("rate", rate)
    plain = joined.where("size = 0 OR p = 0").withColumn(
        "up", (unit("doc_id", "tie", F.lit(seed), F.lit("empty")) < F.col("p")).cast("int"))
    columns = ["doc_id", "source", "size", "tie", "source_size", "target",
               (F.floor("rate") + F.col("up")).cast("long").alias("copies")]
    both = decided.select(*columns).unionByName(plain.select(*columns))
    return both.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix with the columns of docs: a row for each copy, none where there are no copies.

    Rows that repeat id, source and size are numbered by their texts and follow a decision each. A null
    or empty text has no words and comes by its own draw; null ids and sources are values. Columns may have
    any names. An empty table gives an empty result.
    """
    copies = mix_sources(docs, id_col, text_col, source_col, **options).where("copies > 0").select(
        F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("size").alias("words"), F.col("tie").alias("number"), "copies")
    doc = F.col("doc")
    alike = Window.partitionBy("doc_id", "source", "size").orderBy("key")
    rows = packed(docs).withColumns({"doc_id": doc[id_col], "source": doc[source_col], "size": word_count(doc[text_col]),
                                     "key": F.xxhash64(doc[text_col])}).withColumn("tie", F.row_number().over(alike))
    return rows.join(
        copies, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of"))
        & (F.col("size") == F.col("words")) & (F.col("tie") == F.col("number"))
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
