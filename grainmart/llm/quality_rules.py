"""Quality by weak supervision, in built-in functions only.

Rules vote good (1) or bad (-1) or abstain (0). Expectation-maximisation over the counts of vote
patterns estimates how often each rule's votes are right and the share of good documents; a
document's posterior probability of being good replaces the test that all rules pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import WORD_CLASS, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
ROUNDS = 30
SETTLED = 1e-4

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = ("the", "of", "and", "to", "in", "is", "der", "die", "und", "zu", "le", "la", "les", "de", "des",
                  "et", "el", "los", "que", "en", "un", "une", "von", "mit", "du", "su", "it", "that", "with")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_repeated_words(rows: DataFrame, words: str = "words", into: str = "n_repeat_words") -> DataFrame:
    """Add the number of words in 8-word windows found twice or more in the list, the first included.

    A column per step keeps sorting and hashing in generated code. A hash of 8 words is made of
    two of 4, those of two of 2. Only lists with a repeated window are sorted by (hash, place).
    """
    out = rows.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):  # WINDOW is their sum and 1
        out = out.withColumn("_h", _joined("_h", step))
    out = out.withColumn("_h", F.slice("_h", F.lit(1), F.greatest(F.size("_h") - WINDOW + 1, F.lit(0))))
    out = out.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    out = out.withColumn("_starts", F.sort_array(F.transform(
        F.filter("_pairs", lambda x, k: (F.get("_pairs", k - 1)["h"] == x["h"]) | (F.get("_pairs", k + 1)["h"] == x["h"])),
        lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_starts", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    return out.withColumn(into, F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_pairs", "_starts")


def _joined(hashes: str, step: int) -> Column:
    """From each place, the hash there with the one so many places on."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base measures of the whole text, and the shares that the rules look at. Null counts as no text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(WORD_CLASS), F.lit(0)).alias("words"))
    words = with_repeated_words(words).withColumn(
        "lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")))

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    return words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
        count(f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.size("lines").alias("n_lines"),
        F.size(F.filter("words", lambda w: w.isin(*FUNCTION_WORDS))).alias("n_function"),
        count("[A-Z]").alias("n_capitals"), count("!").alias("n_shouts"),
        count(r"[.?](?:[ \t-\r]|\z)").alias("n_ends"))


def _vote(good: Column | None, bad: Column) -> Column:
    out = F.when(bad, F.lit(-1))
    if good is not None:
        out = out.when(good, F.lit(1))
    return out.otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    """Rule name -> its vote on a row of measures."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    c = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "repeats": _vote(10 * F.col("n_repeat_words") <= n, 100 * F.col("n_repeat_words") > 30 * n),
        "lines": _vote(F.col("n_dup_lines") == 0, 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "symbols": _vote(100 * F.col("n_symbols") <= n, 10 * F.col("n_symbols") > n),
        "word_size": _vote((2 * c >= 7 * n) & (c <= 8 * n), (2 * c < 5 * n) | (c > 12 * n)),
        "function_words": _vote(10 * F.col("n_function") >= n, 50 * F.col("n_function") < n),
        "capitals": _vote(10 * F.col("n_capitals") <= c, 10 * F.col("n_capitals") > 4 * c),
        "shouting": _vote(100 * F.col("n_shouts") <= n, 10 * F.col("n_shouts") > 2 * n),
        "sentences": _vote((100 * F.col("n_ends") >= 2 * n) & (4 * F.col("n_ends") <= n),
                           (200 * F.col("n_ends") < n) | (2 * F.col("n_ends") > n)),
    }


def _ratio(rates: dict, vote: int) -> float:
    return math.log(rates[1][vote] / rates[0][vote])


def posterior(names: list[str], share: float, rates: dict[str, dict]) -> Column:
    """Probability of good, given how often each rule votes what on good and on bad documents."""
    odds = F.lit(math.log(share / (1 - share)))
    for name in names:
        odds = odds + F.when(F.col(name) == 1, F.lit(_ratio(rates[name], 1))).when(
            F.col(name) == -1, F.lit(_ratio(rates[name], -1))).otherwise(F.lit(_ratio(rates[name], 0)))
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[float, dict]:
    """(share of good, {rule: {class: {vote: rate}}}) by expectation-maximisation.

    patterns has a row per vote pattern with its count n: 3 ** rules at most, whatever the corpus.
    A rule's accuracy is kept apart for good (1) and bad (0) documents, because a rule that calls
    most bad documents good says little when it does. It starts from rules that seldom err on good documents and
    catch a third of the bad ones; one doubtful document is added to each class.
    """
    share, rates = 0.8, {n: {1: {1: 0.7, 0: 0.28, -1: 0.02}, 0: {1: 0.4, 0: 0.3, -1: 0.3}} for n in names}
    for _ in range(rounds):
        rows = patterns.withColumn("q", posterior(names, share, rates))
        mass = {1: F.col("n") * F.col("q"), 0: F.col("n") * (1 - F.col("q"))}
        sums = [F.sum(mass[1]).alias("m1"), F.sum(mass[0]).alias("m0")]
        sums += [F.sum(F.when(F.col(name) == vote, mass[y])).alias(f"r{k}_{y}_{vote + 1}")
                 for k, name in enumerate(names) for y in (1, 0) for vote in (1, 0, -1)]
        got = rows.agg(*sums).first()
        if not got["m1"]:
            break
        new = {name: {y: {vote: ((got[f"r{k}_{y}_{vote + 1}"] or 0) + rates[name][y][vote]) / (got[f"m{y}"] + 1)
                          for vote in (1, 0, -1)} for y in (1, 0)} for k, name in enumerate(names)}
        new_share = min(max(got["m1"] / (got["m1"] + got["m0"]), 0.02), 0.98)
        moved = max([abs(new_share - share), *(abs(new[x][y][v] - rates[x][y][v])
                                               for x in names for y in (1, 0) for v in (1, 0, -1))])
        share, rates = new_share, new
        if moved < SETTLED:
            break
    return share, rates


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the base measures, base_failed, kept, posterior.

    base_failed: fewer than 20 words, or over 30 % of them in repeated windows. kept: not
    base_failed and a posterior of at least one half. Null and empty texts have no words and fail;
    repeated rows are judged alike; an empty table gives an empty result.
    """
    rules = votes()
    judged = written(measures(docs, id_col, text_col).select("*", *(v.alias(k) for k, v in rules.items())), "quality")
    names = list(rules)
    patterns = written(judged.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    share, rates = estimate(patterns, names)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), posterior(names, share, rates).alias("posterior")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
