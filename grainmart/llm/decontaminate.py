"""Benchmark decontamination by a distributed positional inverted index, in built-in functions only.

The index holds a posting (row, pos, term) for every training word that a test item asks for. It is cut
by documents: a posting is written by the task that reads its text, so building it moves nothing and no
term, however frequent, gathers in one task. A query starts from the rarest term of each window of an
item: its postings, less the term's offset, are candidate starts. They are intersected with the
offset-adjusted postings of the second rarest term, and what both agree on with those of all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmart.llm.common import written

WINDOW = 10  # words that make a phrase
SLACK = 10  # words more than its own that a proximity match may span
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BITS, PARTS = 1 << 15, 512  # a row of bitmap_construct_agg; rows: 2 MB in all is what may be broadcast


def terms(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM_CLASS), F.lit(0))


def build_index(docs: DataFrame, asked: DataFrame | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The written index: row, doc_id, n_words, pos (from 0), term.

    asked (one column, term) limits the postings to terms that a query can name. The first word of
    every text is kept, and a text without words has one line with pos null, so that each row of
    docs is found here; term is null where the word is not asked for.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), terms(F.col(text_col)).alias("words"))
    counted = read.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                          F.size("words").cast("long").alias("n_words"), "words")
    postings = counted.select("row", "doc_id", "n_words", F.posexplode_outer("words").alias("pos", "term"))
    if asked is not None:
        known = written(asked.select("term").distinct().withColumn("asked", F.lit(True)), "leak-asked")
        postings = postings.join(known, "term", "left").where("asked OR coalesce(pos, 0) = 0").select(
            "row", "doc_id", "n_words", "pos", F.when(F.col("asked"), F.col("term")).alias("term"))
    return written(postings, "leak-index")


def item_windows(items: DataFrame, length: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The written table (item, window): each run of length words of an item, or all of fewer, once per item.

    item is the id as text, a null id the empty text. An item without words has no window.
    """
    split = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), terms(F.col(text_col)).alias("words"))
    named = split.select(F.monotonically_increasing_id().alias("n"), "item", F.size("words").alias("size"), "words")
    numbered = written(named.select("n", "item", "size", F.posexplode("words").alias("pos", "term")), "leak-items")
    ahead = Window.partitionBy("n").orderBy("pos").rowsBetween(0, length - 1)
    runs = numbered.withColumn("window", F.collect_list("term").over(ahead))
    whole = (F.size("window") == length) | ((F.col("size") < length) & (F.col("pos") == 0))
    return written(runs.where(whole).select("item", "window").distinct(), "leak-windows")


def ranked_windows(windows: DataFrame, index: DataFrame) -> DataFrame:
    """The written table (w, window, ranked): distinct windows with (frequency, offset, term) from the rarest on.

    A window with a term that the index does not hold cannot occur and is left out.
    """
    frequency = written(index.where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("frequency")), "leak-terms")
    distinct = written(windows.select("window").distinct().withColumn("w", F.monotonically_increasing_id()), "leak-distinct")
    spread = distinct.select("w", F.posexplode("window").alias("offset", "term")).join(frequency, "term", "left")
    ranked = spread.groupBy("w").agg(F.sort_array(F.collect_list(F.struct(
        F.coalesce("frequency", F.lit(0)).alias("frequency"), "offset", "term"))).alias("ranked"))
    return written(ranked.where("ranked[0].frequency > 0").join(distinct, "w"), "leak-ranked")


def _marks(rows: DataFrame, column: str) -> DataFrame:
    """A bitmap of fixed size over the values of a long column: (part, bits), PARTS rows at most."""
    slot = F.pmod(F.xxhash64(column), F.lit(BITS * PARTS))
    return written(rows.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / BITS).cast("int").alias("part"))
                   .agg(F.bitmap_construct_agg(F.col("slot") % BITS).alias("bits")), "leak-marks")


def _marked(rows: DataFrame, column: str, marks: DataFrame) -> DataFrame:
    """The rows whose value may be marked; a few others pass too."""
    slot = F.pmod(F.xxhash64(column), F.lit(BITS * PARTS))
    at = slot % BITS
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("part", F.floor(slot / BITS).cast("int")).join(F.broadcast(marks), "part") \
        .where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("part", "bits")


def phrase_matches(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """The written table (row, w, start, length): every place where a window's words stand one after another."""
    postings = index.where("term IS NOT NULL").select("row", "pos", "term")
    plan = ranked.withColumn("length", F.size("ranked"))
    rarest, next_rare = F.col("ranked")[0], F.get("ranked", F.lit(1))
    # Written, so that Spark knows how small they are: the many postings of other terms then stay where they are.
    firsts, seconds = (written(plan.select(t["term"].alias("term")).where("term IS NOT NULL").distinct(), "leak-anchors")
                       for t in (rarest, next_rare))
    seeds = postings.join(firsts, "term", "left_semi").join(
        plan.select(rarest["term"].alias("term"), rarest["offset"].alias("offset"), "w", "length", next_rare.alias("next")), "term") \
        .where("pos >= offset").select("row", "w", (F.col("pos") - F.col("offset")).alias("start"), "length", "next")
    second = postings.join(seconds, "term", "left_semi")
    alone = seeds.where("length = 1").select("row", "w", "start", "length")
    agreed = written(
        seeds.where("length > 1").select("row", "w", "start", "length", (F.col("start") + F.col("next.offset")).alias("pos"),
                                         F.col("next.term").alias("term"))
        .join(second, ["row", "pos", "term"]).select("row", "w", "start", "length").unionByName(alone), "leak-agreed")

    # All other terms, looked up only in the rows where the two rarest agree.
    left = agreed.where("length > 2").join(plan.select("w", F.slice("ranked", F.lit(3), F.size("ranked")).alias("others")), "w") \
        .select("row", "w", "start", "length", F.explode("others").alias("o")) \
        .select("row", "w", "start", "length", (F.col("start") + F.col("o.offset")).alias("pos"), F.col("o.term").alias("term"))
    here = _marked(postings, "row", _marks(agreed.where("length > 2").select("row"), "row"))
    whole = left.join(here, ["row", "pos", "term"]).groupBy("row", "w", "start", "length").agg(F.count(F.lit(1)).alias("n")) \
        .where("n = length - 2").drop("n")
    return written(whole.unionByName(agreed.where("length <= 2")), "leak-matches")


def proximity_matches(index: DataFrame, ranked: DataFrame, slack: int = SLACK) -> DataFrame:
    """(row, w, start, span): places where all of a window's distinct terms stand, in any order, within its length plus slack.

    One line for each posting of the rarest term with such a place: the first shortest stretch that holds it.
    Others' postings are looked up in buckets of positions as long as the stretch, so a frequent term costs no more
    than its postings near a rare one.
    """
    postings = index.where("term IS NOT NULL").select("row", "pos", "term")
    reach = F.size("ranked") + slack
    plan = ranked.select("w", reach.alias("reach"), F.col("ranked")[0]["term"].alias("rare"),
                         F.array_distinct(F.transform("ranked", lambda t: t["term"])).alias("all"))
    seeds = postings.withColumnRenamed("term", "rare").join(plan, "rare")
    # Spans of all lengths share one bucket width, so that postings are bucketed once.
    width = (ranked.agg(F.max(F.size("ranked"))).first()[0] or 1) + slack
    asked = seeds.select("row", "w", F.col("pos").alias("at"), "reach", F.size("all").alias("n"), F.explode("all").alias("term")) \
        .withColumn("bucket", F.explode(F.array(*[F.floor(F.col("at") / width) + d for d in (-1, 0, 1)])))
    near = asked.join(postings.withColumn("bucket", F.floor(F.col("pos") / width)), ["row", "term", "bucket"]) \
        .where("abs(pos - at) < reach")
    found = near.groupBy("row", "w", "at", "reach", "n").agg(
        F.sort_array(F.collect_set(F.struct("pos", "term"))).alias("there")).where("size(there) >= n")
    # From each position on: the end of the shortest stretch with all terms, if it spans no more than the reach.
    stretch = F.transform("there", lambda x: F.struct(
        F.aggregate(F.array_distinct(F.transform(F.filter("there", lambda y: y["pos"] >= x["pos"]), lambda y: y["term"])),
                    F.struct(F.lit(0).alias("seen"), F.lit(-1).alias("end")),
                    lambda s, t: F.struct((s["seen"] + 1).alias("seen"), F.greatest(s["end"], F.array_min(F.transform(
                        F.filter("there", lambda y: (y["pos"] >= x["pos"]) & (y["term"] == t)), lambda y: y["pos"]))).alias("end"))
                    ).alias("s"), x["pos"].alias("start")))
    def span(z):
        return F.greatest(z["s"]["end"], F.col("at")) - z["start"] + 1  # the stretch holds the posting itself

    best = F.array_min(F.transform(
        F.filter(stretch, lambda z: (z["s"]["seen"] == F.col("n")) & (z["start"] <= F.col("at")) & (span(z) <= F.col("reach"))),
        lambda z: F.struct(span(z).alias("span"), z["start"].alias("start"))))
    return found.withColumn("best", best).where("best IS NOT NULL").select(
        "row", "w", F.col("best.start").alias("start"), F.col("best.span").alias("span")).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit: words inside an occurrence of any window of any item. items_sha256: digest of the ids of the
    items that occur, sorted as strings and joined by commas; of the empty text where there are none. Null and
    empty texts have no words and are clean. Rows that repeat an id are judged each by its own text.
    Items with one id are one item; null ids are one item with an empty id. Other columns are not read,
    so no name can clash. Either table may be empty.
    """
    windows = item_windows(benchmark, length, item_col, item_text_col)
    index = build_index(docs, windows.select(F.explode("window").alias("term")), id_col, text_col)
    ranked = ranked_windows(windows, index)
    matches = phrase_matches(index, ranked)

    # A place counts with what it adds to the stretch covered before it.
    places = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(places), F.lit(0))))
    hits = matches.select("row", "start", "length").distinct().withColumn("fresh", fresh) \
        .groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    # Rows with the same windows share one list of items: a passage in a third of all rows is looked up once.
    sets = written(matches.groupBy("row").agg(F.sort_array(F.collect_set("w")).alias("ws")), "leak-sets")
    lists = written(sets.select("ws").distinct(), "leak-lists")
    named = windows.join(ranked.select("w", "window"), "window").select("w", "item")
    items = written(lists.select("ws", F.explode("ws").alias("w")).join(named, "w").groupBy("ws").agg(
        F.sort_array(F.collect_set("item")).alias("items")).select(
        "ws", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "leak-named")
    found = hits.join(sets.join(items, "ws"), "row").select("row", "n_hit", "n_items", "items_sha256")
    rows = index.where("pos IS NULL OR pos = 0").select("row", "doc_id", "n_words")
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))
