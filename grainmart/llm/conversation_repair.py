"""Conversation structure repair by secondary-sorted streaming.

A conversation is repaired at least cost by a dynamic program over its rows and four states of the
form (s?(ua)+)?. Rows are repartitioned by conversation and sorted by turn; mapInPandas carries the
program's state across Arrow batches, so a conversation of any length needs the memory of one batch.
The first pass runs from the last turn back without texts and spills one byte per row, the best
edit from each state, into a written table: the backpointers. The second runs forward over rows and
backpointers sorted together, follows the best edits and digests the repaired texts as they pass.
Which rows repeat an earlier one is found by grouping, so no set of seen rows is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import written

DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"  # in ASCII order, so that the least letter is the least number
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
SPACES = " \t\n\x0b\x0c\r"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# States: nothing yet, after the system row, after a user row, after an assistant row.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT_ROLE = ("u", "u", "a", "u")  # what an inserted or reroled row must be
FOLLOW = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
FORCED = tuple(FOLLOW[q, NEXT_ROLE[q]] for q in range(4))
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)  # cost of inserting what an open state lacks
INITIALS = "sua"
FINE, TRUNCATED, DELETED = range(3)  # a row's fault as the program sees it
ROLES = {"u": "user", "a": "assistant"}


def best_edits(initial: str, fault: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """(backpointers, costs): from each state the cheapest first edit at a row, two bits a state, and its cost to the end.

    after: the costs behind the row. Of equally cheap edits the least letter counts: what follows a
    letter is determined by the state, so this is the least string of letters.
    """
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    options = []
    for q in range(4):
        o = {DELETE: DELETE_COST + after[q]}
        if fault != DELETED:
            if (q, initial) in FOLLOW:
                o[KEEP] = extra + after[FOLLOW[q, initial]]
            o[REROLE] = REROLE_COST + extra + after[FORCED[q]]
        options.append(o)
    costs = [min(o.values()) for o in options]
    for _ in range(3):
        costs = [min(c, INSERT_COST + costs[FORCED[q]]) for q, c in enumerate(costs)]
    packed = 0
    for q in range(4):
        options[q][INSERT] = INSERT_COST + costs[FORCED[q]]
        packed |= min(e for e, c in options[q].items() if c == costs[q]) << 2 * q
    return packed, tuple(costs)


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Backpointers of rows that come by conversation from the last turn back."""
    nothing = object()
    conv, costs = nothing, AT_END
    known: dict = {}  # (row kind, costs less their least) -> edits, costs: a few hundred at most
    for batch in batches:
        edits = []
        for c, initial, fault in zip(batch["conv"], batch["initial"], batch["fault"], strict=True):
            if c != conv:
                conv, costs = c, AT_END
            step = known.get((initial, fault, costs))
            if step is None:
                packed, new = best_edits(initial, fault, costs)
                least = min(new)
                step = known[initial, fault, costs] = packed, tuple(x - least for x in new)
            edits.append(step[0])
            costs = step[1]
        yield batch[["conv", "known", "turn", "tie", "row"]].assign(edits=pd.array(edits, "int32"))


class _Walk:
    """The forward walk along the best edits of one conversation."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.illegal, self.before = conv, START, 0, 0, None
        self.audit, self.digest, self.first = bytearray(), hashlib.sha256(), True

    def emit(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def insert(self) -> tuple[str, str]:
        role = ROLES[NEXT_ROLE[self.state]]
        self.audit += b"I"
        self.cost += INSERT_COST
        self.state = FORCED[self.state]
        self.emit(role, "")
        return role, ""

    def row(self, edits: int, initial: str, fault: int, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired rows that this one leads to, with their letters."""
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        while (edit := edits >> 2 * self.state & 3) == INSERT:
            yield *self.insert(), "I"
        self.audit += LETTERS[edit].encode()
        if edit == DELETE:
            self.cost += DELETE_COST
            return
        self.cost += TRUNCATED_COST if fault == TRUNCATED else 0
        if edit == KEEP:
            self.state = FOLLOW[self.state, initial]
        else:
            self.cost += REROLE_COST
            role, self.state = ROLES[NEXT_ROLE[self.state]], FORCED[self.state]
        self.emit(role, text)
        yield role, text, LETTERS[edit]

    def end(self) -> Iterator[tuple[str, str, str]]:
        while AT_END[self.state]:
            yield *self.insert(), "I"


def _forward(rows: bool):
    """Rows and backpointers in order to summaries, or to the repaired rows themselves."""
    columns = ["conv", "place", "role", "text", "edit"] if rows else ["conv", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk, place, edits = None, 0, 0
        for batch in batches:
            out = []

            def take(made) -> None:
                nonlocal place
                for role, text, letter in made:
                    if rows:
                        out.append((walk.conv, place, role, text, letter))
                    place += 1

            for conv, pointer, initial, fault, role, text in zip(*(batch[c] for c in (
                    "conv", "edits", "initial", "fault", "role", "text")), strict=True):
                if pointer >= 0:  # stands right before its row
                    edits = pointer
                    continue
                if walk is None or conv != walk.conv:
                    if walk is not None:
                        take(walk.end())
                        if not rows:
                            out.append((walk.conv, walk.illegal, walk.cost, walk.audit.decode(), walk.digest.hexdigest()))
                    walk, place = _Walk(conv), 0
                take(walk.row(edits, initial, fault, role, text))
            yield pd.DataFrame(out, columns=columns)
        if walk is not None:
            out = []
            for role, text, letter in walk.end():
                if rows:
                    out.append((walk.conv, place, role, text, letter))
                place += 1
            if not rows:
                out.append((walk.conv, walk.illegal, walk.cost, walk.audit.decode(), walk.digest.hexdigest()))
            yield pd.DataFrame(out, columns=columns)
    return run


def or_blank(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text after damage drawn from crc32 of `conv_id:turn`; nulls count as one space.

    Of 20 draws, 0 drops the row, 1 empties its text, 2 removes its marks .!?, 3 repeats it, 4 makes it a user's.
    Rows that repeat conv_id and turn share a draw.
    """
    draw = F.crc32(F.concat(or_blank(conv_col), F.lit(":"), or_blank(turn_col)).cast("binary")) % 20
    text, role = or_blank(text_col), or_blank(role_col)
    hit = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        draw.alias("draw")).where("draw <> 0")
    return hit.withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
        .select("conv_id", "turn", "role", "text")


def judged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The written rows with their order and faults: conv, known, turn, tie, row, role, text, initial, fault, kind.

    The order is by turn, nulls first; rows of one turn by a digest of role and text, so that repeats are neighbours.
    kind: blank, duplicate, truncated or null; the first that holds. A null role or text is one space.
    """
    role, text = or_blank(role_col), or_blank(text_col)
    tie = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32)
    named = written(rows.select(
        F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).isNotNull().alias("known"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"), role.alias("role"), text.alias("text"))
        .withColumn("tie", tie).withColumn("row", F.monotonically_increasing_id()), "repair-rows")
    # Written, so that the join shuffles both sides itself and a conversation of very many rows can be split.
    firsts = written(named.groupBy("conv", "tie").agg(F.min(F.struct("known", "turn", "row"))["row"].alias("first")), "repair-firsts") \
        .select(F.col("conv").alias("of"), F.col("tie").alias("like"), "first")
    kept = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = F.when(F.length(kept) == 0, F.lit("blank")).when(F.col("row") != F.col("first"), F.lit("duplicate")) \
        .when(~F.right(kept, F.lit(1)).isin(".", "!", "?"), F.lit("truncated"))
    first = F.substring("role", 1, 1)
    return written(
        named.join(firsts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("like"))).select(
            "conv", "known", "turn", "tie", "row", "role", "text",
            F.when(first.isin(*INITIALS), first).otherwise(F.lit("-")).alias("initial"), kind.alias("kind"))
        .withColumn("fault", F.when(F.col("kind").isNull(), F.lit(FINE)).when(F.col("kind") == "truncated", F.lit(TRUNCATED))
                    .otherwise(F.lit(DELETED))), "repair-judged")


ORDER = ("known", "turn", "tie", "row")


def _walked(rows: DataFrame, repaired: bool) -> DataFrame:
    """The two passes over judged rows."""
    back = written(
        rows.select("conv", *ORDER, "initial", "fault").repartition("conv")
        .sortWithinPartitions("conv", *[F.col(c).desc() for c in ORDER])
        .mapInPandas(_backward, "conv string, known boolean, turn bigint, tie string, row bigint, edits int"), "repair-pointers")
    pointers = back.select("conv", *ORDER, "edits", F.lit("").alias("initial"), F.lit(0).alias("fault"),
                           F.lit("").alias("role"), F.lit("").alias("text"))
    both = pointers.unionByName(rows.select("conv", *ORDER, F.lit(-1).alias("edits"), "initial", "fault", "role", "text"))
    schema = "conv string, place bigint, role string, text string, edit string" if repaired else \
        "conv string, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return both.repartition("conv").sortWithinPartitions("conv", *ORDER, F.col("edits").desc()) \
        .mapInPandas(_forward(repaired), schema)


def repaired_rows(rows: DataFrame, **columns: str) -> DataFrame:
    """The repaired conversations: conv (the id as text), place from 0, role, text, edit (K, R or I)."""
    return _walked(judged(rows, **columns), repaired=True)


def repair_report(rows: DataFrame, originals: DataFrame, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """One line per distinct conversation id of originals: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows are the conversations as they came; one that has none left there gets zeros, an empty audit and the
    digest of the empty text. A null id is a conversation of its own; null turns come first and
    count in no gap. Rows that repeat another (role and text) are duplicates and go. A text of white space
    only, or null, is blank. Texts may be of any length. Other columns are not read, so no name can clash. Empty
    tables give an empty result.
    """
    seen = judged(rows, conv_col=conv_col, **columns)
    walked = written(_walked(seen, repaired=False), "repair-walked")
    kinds = ("blank", "duplicate", "truncated")
    turns = seen.groupBy("conv", "known", "turn").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    at = F.when(F.col("known"), F.col("turn"))
    stats = turns.groupBy("conv").agg(
        F.coalesce(F.max(at) - F.min(at) + 1 - F.count_if("known"), F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in kinds])
    ids = originals.select(F.col(conv_col).alias("conv_id"), F.col(conv_col).cast("string").alias("key")).distinct()
    joined = ids.join(stats.withColumnRenamed("conv", "of"), F.col("key").eqNullSafe(F.col("of")), "left") \
        .join(walked, F.col("key").eqNullSafe(F.col("conv")), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *kinds, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))
