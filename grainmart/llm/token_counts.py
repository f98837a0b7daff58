"""Token counts that follow edits: a segment tree of pre-tokens per document.

Leaves hold runs of whole pre-tokens with their token counts, inner nodes the sums of characters and
tokens. An edit re-encodes the leaves it touches and a leaf of context around them, up to the first
old leaf boundary where the pre-tokens fall into step again, and updates the sums above.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.llm.byte_bpe import Encoder, encoder

LEAF_PIECES = 16
NEAR = 32  # characters of context that mostly settle a boundary
BATCH_ROWS = 64


class EditedText:
    """A text under edits with its token count; places and lengths are in code points."""

    def __init__(self, text: str, enc: Encoder):
        self.enc = enc
        self.recoded = 0  # pre-tokens encoded because of edits
        self._plant(self._leaves(enc.pattern.findall(text)))

    def _count(self, pieces: list[str]) -> int:
        return sum(map(len, map(self.enc.known.__getitem__, pieces))) // 4  # four bytes an id

    def _leaves(self, pieces: list[str], size: int = LEAF_PIECES) -> list[tuple[str, int, int]]:
        """(text, tokens, pre-tokens) of runs of pre-tokens."""
        runs = [pieces[i:i + size] for i in range(0, len(pieces), size)]
        return [("".join(run), self._count(run), len(run)) for run in runs]

    def _plant(self, leaves: list[tuple[str, int, int]]) -> None:
        self.n = max(1, len(leaves))
        self.width = 1 << (self.n - 1).bit_length()
        self.texts = [leaf[0] for leaf in leaves] or [""]
        self.pieces = [leaf[2] for leaf in leaves] or [0]
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, leaf in enumerate(leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = len(leaf[0]), leaf[1]
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _set(self, i: int, text: str, tokens: int, pieces: int) -> None:
        self.texts[i], self.pieces[i] = text, pieces
        node = self.width + i
        self.chars[node], self.tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the place, and where that leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place - begin >= self.chars[node] and begin + self.chars[node] < self.length:
                begin += self.chars[node]
                node += 1
        return min(node - self.width, self.n - 1), begin

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def edit(self, start: int, delete: int, insert: str) -> None:
        """Replace delete characters from start on by insert; both are cut to the text's bounds."""
        start = min(max(start, 0), self.length)
        stop = min(start + max(delete, 0), self.length)
        first, begin = self._find(start)
        # A pre-token is settled by two characters beyond it at most, so step back until the
        # leaves before the first cannot have seen the edit.
        while first and start < begin + 2:
            first -= 1
            begin -= len(self.texts[first])
        last, end = first, begin + len(self.texts[first])
        while end < stop:
            last += 1
            end += len(self.texts[last])
        old = "".join(self.texts[first:last + 1])
        changed = old[:start - begin] + insert + old[stop - begin:]
        pieces, ahead, context = None, last + 1, ""
        while pieces is None:
            # Context until the match at the boundary is settled whatever follows.
            while ahead < self.n and len(context) < 8:
                context += self.texts[ahead]
                ahead += 1
            if len(context) > NEAR:
                pieces = self._until(changed, context[:NEAR], False)
            if pieces is None:
                pieces = self._until(changed, context, ahead >= self.n)
            if pieces is None:
                if ahead < self.n and not self._reaches(changed, context):
                    context += self.texts[ahead]
                    ahead += 1
                elif last + 1 < self.n:
                    last += 1
                    changed += self.texts[last]
                    context, ahead = "", last + 1
                else:
                    raise AssertionError("the end of a text is always a boundary")
        self.recoded += len(pieces)
        places = last - first + 1
        size = max(LEAF_PIECES, -(-len(pieces) // places))
        if size <= 4 * LEAF_PIECES:  # leaves grow in place, so a tree is planted anew only after many insertions
            leaves = self._leaves(pieces, size)
            for i, leaf in enumerate([*leaves, *[("", 0, 0)] * (places - len(leaves))], first):
                self._set(i, *leaf)
        else:  # more leaves than places: put them between the others and build the sums anew
            at = lambda i: (self.texts[i], self.tokens[self.width + i], self.pieces[i])
            self._plant([*map(at, range(first)), *self._leaves(pieces), *map(at, range(last + 1, self.n))])

    def _until(self, changed: str, context: str, whole: bool) -> list[str] | None:
        """The pre-tokens of changed, if one ends where it ends when the context follows."""
        if not changed:
            return []
        # Near the end of the joined text, what is not seen could matter.
        if not whole and len(context) < 2:
            return None
        pieces = self.enc.pattern.findall(changed + context)
        ends = list(accumulate(map(len, pieces)))
        i = bisect_left(ends, len(changed))
        return pieces[:i + 1] if i < len(ends) and ends[i] == len(changed) else None

    def _reaches(self, changed: str, context: str) -> bool:
        """Whether a match that begins before the boundary ends beyond it, well before what is not seen."""
        ends = list(accumulate(map(len, self.enc.pattern.findall(changed + context))))
        i = bisect_right(ends, len(changed))
        return i < len(ends) and ends[i] + 2 <= len(changed) + len(context)


def synthetic_edits(id_col: str = "doc_id", text_col: str = "text", every: int = 2000) -> Column:
    """An edit script drawn from a document itself: an edit per so many code points, and one more.

    Each deletes up to 11 code points at a drawn place and puts in up to 16 from another place.
    Repeatable: all draws are hashes of id, length and number.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.transform(copying_edits(id_col, text_col, every), lambda e: F.struct(
        e["start"].alias("start"), e["delete"].alias("delete"),
        F.substring(text, e["from"] + 1, e["length"]).alias("insert")))


def copying_edits(id_col: str = "doc_id", text_col: str = "text", every: int = 2000) -> Column:
    """The edits of synthetic_edits with the place and length of what they put in, not the characters.

    Drawing them takes time in proportion to the text; a substring for each, in Spark, would read the text once an edit.
    """
    def script(n: Column) -> Column:
        def drawn(k: Column, what: str, below: Column) -> Column:
            return F.pmod(F.xxhash64(F.col(id_col), n, k, F.lit(what)), below.cast("long")).cast("int")

        return F.transform(F.sequence(F.lit(0), F.floor(n / every).cast("int")), lambda k: F.struct(
            drawn(k, "start", n + 1).alias("start"), drawn(k, "delete", F.lit(12)).alias("delete"),
            drawn(k, "from", n + 1).alias("from"), drawn(k, "length", F.lit(17)).alias("length")))

    # A text's length takes a pass over it, so it is counted once for all its edits.
    return F.transform(F.array(F.length(F.coalesce(F.col(text_col), F.lit("")))), script)[0]


def edited_counts(docs: DataFrame, edits: Column, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_edits, n_tokens_before, n_tokens_after, n_chars_after, n_pretokens, n_recoded, edited_sha256.

    edits is an array of (start, delete, insert) in the order to apply; null is no edit, a null member
    is skipped, a null insert is empty, and places outside the text are moved to its bounds. Instead of
    insert, members may have (from, length): what the unedited text has there (both 0 or more). A null
    text counts as empty. n_recoded says how many pre-tokens the edits made it encode again. Rows
    are independent of each other; nothing is shuffled. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), edits.alias("edits"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, n_edits bigint, n_tokens_before bigint, n_tokens_after bigint, "
              "n_chars_after bigint, n_pretokens bigint, n_recoded bigint, edited_sha256 string")

    def run(batches) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(begin, BATCH_ROWS)
                rows = []
                for changes, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    doc = EditedText(text, enc)
                    before, n_pieces = doc.n_tokens, sum(doc.pieces)
                    changes = [c for c in changes or () if c is not None]
                    for c in changes:
                        at = c.get("from") or 0
                        insert = c["insert"] if "insert" in c else text[at:at + (c["length"] or 0)]
                        doc.edit(c["start"] or 0, c["delete"] or 0, insert or "")
                    rows.append((len(changes), before, doc.n_tokens, doc.length, n_pieces, doc.recoded,
                                 hashlib.sha256(doc.text.encode()).hexdigest()))
                columns = [list(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())],
                    names=[f.split()[0] for f in schema.split(", ")])

    return source.mapInArrow(run, schema)
