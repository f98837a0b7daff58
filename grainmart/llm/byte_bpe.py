"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

The merges give a relation on tokens: a may stand before b if merging the bytes of both yields just
[a, b]. A token sequence is the encoding of its bytes if all neighbours may stand so; hence the
last token of every prefix is settled by one byte more, and encoding needs no merge loop. A state
of the transducer is the set of open tokens (a place in the token trie, and the token before it); states
and transitions are made when a text first needs them and forgotten when there are too many.
"""

from __future__ import annotations

import base64
import codecs
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import blocks, kept, utf8

STATES = 1 << 18  # states kept before all are forgotten
PIECES = 1 << 18  # pieces of up to PIECE_BYTES bytes whose ids are remembered
PIECE_BYTES = 64
CHUNK_IDS = 4096
NEVER = 1 << 60
# An open token of a state in one number: the place in the trie, the token before it plus one, bytes so far.
# A state is these numbers packed; the last of them is a token begun anew, so it tells the token before.
_AGE, _OPEN = 16, 38


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _written_out(pattern: str) -> re.Pattern | None:
    """The pattern for the standard library's matcher, over the first 65536 code points.

    Classes such as \\p{L} or \\s become the ranges that regex gives them there, so both matchers find the same.
    None for a pattern with anything that the two might read differently.
    """
    out, inside, basic = [], False, "".join(map(chr, range(1 << 16)))
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|\(\?(?:[:=!]|<[=!])|\(\?|\[\^?\]?|.", pattern, re.DOTALL):
        if re.match(r"\\[pP]\{|\\[sSdDwW]", part):
            runs = [m.group() for m in regex.finditer(part + "+", basic)]
            if not runs:
                return None
            ranges = "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in runs)
            part = ranges if inside else f"[{ranges}]"
        elif part in ("(?", "{") or part[0] == "[" and (inside or part[-1] == "]"):
            return None
        elif part[0] == "\\" and part[1].isalnum() and part[1] not in "nrtfv":
            return None
        elif part[0] in "[]":
            inside = part != "]"
        out.append(part)
    try:
        return re.compile("".join(out))
    except re.error:  # such as a look back of any length
        return None


class Splitter:
    """The matches of a pattern in a text: by the standard library where it can, which takes half the time of regex."""

    def __init__(self, pattern: str):
        self.full, self.basic = regex.compile(pattern), _written_out(pattern)

    def findall(self, text: str) -> list[str]:
        # Without code points above 65535, UTF-16 has two bytes for each.
        if self.basic and (text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)):
            return self.basic.findall(text)
        return self.full.findall(text)


class Transducer:
    """Encodes pieces: bytes in, token ids out, emitted once no later byte can change them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.byte_ids = [ranks.get(bytes([b]), -1) for b in range(256)]
        if max(ranks.values(), default=0) >= 1 << _OPEN - _AGE or max(self.length.values(), default=0) >= 1 << _AGE:
            raise ValueError("more or longer tokens than a state can hold")
        self.trie: dict[int, int] = {}  # node << 8 | byte -> node
        self.ends, self.inner = array("i", [-1]), bytearray(1)  # token of a node, whether it has others below
        for token, rank in ranks.items():
            # A token that its own bytes do not merge to can only be a whole piece.
            node = 0
            for byte in token:
                after = self.trie.get(node << 8 | byte)
                if after is None:
                    after = self.trie[node << 8 | byte] = len(self.ends)
                    self.inner[node] = 1
                    self.ends.append(-1)
                    self.inner.append(0)
                node = after
            self.ends[node] = rank
        self.steps: dict[int, tuple[bool, list[tuple[int, int, int]]]] = {}  # of the tokens seen: at most all
        # Any two tokens that merge, by their ids: the merges that the rank file implies.
        self.merges: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merges[left << 32 | right] = rank
        self.forget()

    def forget(self) -> None:
        self.states: list[bytes] = []
        self.last = array("i")  # of a state: the token that ends where it was entered
        self.numbers: dict[bytes, int] = {}
        self.moves: dict[int, int] = {}  # state << 8 | byte -> state
        self.start = self._number(array("q", [0]).tobytes())

    def _number(self, state: bytes) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.last.append((array("q", state)[-1] >> _AGE) - 1)
        return number

    def merged(self, parts: list[int]) -> list[int]:
        """The definition: merge the leftmost pair of lowest rank until none is left."""
        merges = self.merges
        pairs = [merges.get(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            lowest = min(pairs)
            if lowest == NEVER:
                break
            i = pairs.index(lowest)
            parts[i:i + 2] = [lowest]
            del pairs[i]
            if i:
                pairs[i - 1] = merges.get(parts[i - 1] << 32 | lowest, NEVER)
            if i < len(pairs):
                pairs[i] = merges.get(lowest << 32 | parts[i + 1], NEVER)
        return parts

    def _bytewise(self, token: int) -> list[int]:
        return [self.byte_ids[b] for b in self.bytes_of[token]]

    def _steps(self, token: int) -> tuple[bool, list[tuple[int, int, int]]]:
        """Whether a token's bytes merge to it, and its merges in order: (rank, first part, last part) before each, then
        (NEVER, token, token)."""
        parts, steps, merges = self._bytewise(token), [], self.merges
        while True:
            ranks = [merges.get(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            lowest = min(ranks, default=NEVER)
            steps.append((lowest, parts[0], parts[-1]))
            if lowest == NEVER:
                return len(parts) == 1, steps
            i = ranks.index(lowest)
            parts[i:i + 2] = [lowest]

    def _stands(self, before: int, token: int) -> bool:
        """Whether the bytes of both merge to just the two.

        Each side merges as it would alone, the lower rank first and the left one on a tie, unless the
        parts that meet between them merge before either.
        """
        right = self.steps.get(token)
        if right is None:
            right = self.steps[token] = self._steps(token)
        if not right[0] or before < 0:
            return right[0]
        left, merges = self.steps[before][1], self.merges
        if before << 32 | token in merges:  # what both end in would merge
            return False
        i = j = 0
        while True:
            a, b = left[i], right[1][j]
            across = merges.get(a[2] << 32 | b[1], NEVER)
            if across < a[0] and across <= b[0]:
                return False
            if a[0] <= b[0]:
                if a[0] == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _move(self, number: int, byte: int) -> int:
        """The next state."""
        opened, last, trie, inner, ends = [], -1, self.trie, self.inner, self.ends
        for one in array("q", self.states[number]):
            after = trie.get(one >> _OPEN << 8 | byte)
            if after is None:
                continue
            rest = one & (1 << _OPEN) - 1
            if inner[after]:
                opened.append((after << _OPEN | rest) + 1)
            token = ends[after]
            if last < 0 and token >= 0 and self._stands((rest >> _AGE) - 1, token):
                last = token
        opened.append(last + 1 << _AGE)
        after = self.moves[number << 8 | byte] = self._number(array("q", opened).tobytes())
        return after

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self.forget()
        if len(piece) <= 4 * CHUNK_IDS:
            state, path, moves = self.start, [], self.moves
            for byte in piece:
                state = moves.get(state << 8 | byte) or self._move(state, byte)
                path.append(state)
            tokens, end, last, length = [], len(path), self.last, self.length
            while end > 0:
                token = last[path[end - 1]]
                tokens.append(token)
                end -= length[token]
            return tokens[::-1]
        return self._encode_long(piece)

    def _encode_long(self, piece: bytes) -> list[int]:
        state, lasts, out, sent = self.start, [], [], 0
        for at, byte in enumerate(piece, 1):
            state = self.moves.get(state << 8 | byte) or self._move(state, byte)
            lasts.append(self.last[state])
            if at - sent >= 4 * CHUNK_IDS:  # emit what all open tokens agree on
                ready, until = self._settled(lasts, at, sent, state)
                out += ready
                del lasts[:until - sent]
                sent = until
                if len(self.states) > STATES:
                    held = self.states[state]
                    self.forget()
                    state = self._number(held)
        return out + self._walk(lasts, len(piece) - sent)[0]

    def _walk(self, lasts: list[int], end: int) -> tuple[list[int], list[int]]:
        """The tokens of the first end bytes after what is sent, and where each begins."""
        tokens, begins, length = [], [], self.length
        while end > 0:
            token = lasts[end - 1]
            end -= length[token]
            tokens.append(token)
            begins.append(end)
        return tokens[::-1], begins[::-1]

    def _settled(self, lasts: list[int], at: int, sent: int, state: int) -> tuple[list[int], int]:
        """What precedes every open token alike: the common beginning of their pasts."""
        pasts = [self._walk(lasts, at - sent - (one & (1 << _AGE) - 1)) for one in array("q", self.states[state])]
        shortest = min(len(tokens) for tokens, _ in pasts)
        same = 0
        while same < shortest and len({tokens[same] for tokens, _ in pasts}) == 1:
            same += 1
        tokens = pasts[0][0][:same]
        return tokens, sent + sum(len(self.bytes_of[t]) for t in tokens)


class _Pieces(dict):
    """Packed ids of the pieces met: two halves, of which the older is forgotten when the newer is full.

    A piece found in the older half moves to the newer one, so frequent pieces are never encoded twice.
    """

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.older = transducer, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode()
            ids = array("i", self.transducer.encode(raw)).tobytes()
            if len(raw) > PIECE_BYTES:
                return ids
        if len(self) >= PIECES // 2:
            self.older = None  # freed before its successor is made
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Whole texts to ids: each match of the pattern is encoded by itself."""

    def __init__(self, ranks_path: str, pattern: str):
        self.pattern = Splitter(pattern)
        self.transducer = Transducer(read_ranks(ranks_path))
        self.known = _Pieces(self.transducer)

    def packed(self, text: str) -> bytes:
        """The ids of a text, packed as 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()


class StreamDecoder:
    """Bytes and text from ids fed in any chunks; a character may straddle chunks."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.utf8 = codecs.getincrementaldecoder("utf-8")("strict")  # holds the bytes of an unfinished character

    def feed(self, ids: list[int], last: bool = False) -> tuple[bytes, str]:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw, self.utf8.decode(raw, last)


def encoder(ranks_path: str, pattern: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task until a stage without it begins."""
    return kept((ranks_path, pattern), lambda: Encoder(ranks_path, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array of int). Null and empty texts have no ids.

    No special tokens: their strings are ordinary text. The rank file must lie on every machine.
    Other columns are not read, repeated rows are encoded each, an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        kind = None
        enc = encoder(ranks_path, pattern)

        def seen(stream):
            nonlocal kind
            for batch in stream:
                kind = batch.schema.field(0).type
                yield batch

        for keys, texts in blocks(seen(batches), keep=(ranks_path, pattern)):
            ids = [enc.packed(t.decode("utf-8", "replace")) for t in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], kind),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))],
                names=["doc_id", "ids"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, bytes. Null ids give no bytes; an id without a token fails the job."""
    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        bytes_of = None
        for batch in batches:
            if bytes_of is None:
                bytes_of = {rank: token for token, rank in read_ranks(ranks_path).items()}
            column = batch.column(1)
            ends, out = np.cumsum([0, *(n or 0 for n in pc.list_value_length(column).to_pylist())]), []
            ids = column.flatten().to_numpy(zero_copy_only=False)
            for begin, end in zip(ends, ends[1:], strict=False):
                stream = StreamDecoder(bytes_of)
                out.append(b"".join(stream.feed(ids[i:min(i + CHUNK_IDS, end)].tolist())[0]
                                    for i in range(begin, end, CHUNK_IDS)))
                stream.feed([], last=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, bytes binary")


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """doc_id, ids, bytes of each row: encode and decode in one pass, so a core keeps one Python worker, not two."""
    source = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        enc, kind = encoder(ranks_path, pattern), None

        def seen(stream):
            nonlocal kind
            for batch in stream:
                kind = batch.schema.field(0).type
                yield batch

        for keys, texts in blocks(seen(batches), keep=(ranks_path, pattern)):
            packed = [enc.packed(t.decode("utf-8", "replace")) for t in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
            decoded = []
            for ids in packed:
                stream = StreamDecoder(enc.transducer.bytes_of)
                decoded.append(b"".join(stream.feed(array("i", ids[i:i + 4 * CHUNK_IDS]).tolist())[0]
                                        for i in range(0, len(ids), 4 * CHUNK_IDS)))
                stream.feed([], last=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], kind),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32))),
                 pa.array(decoded, pa.binary())], names=["doc_id", "ids", "bytes"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, ids array<int>, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, **columns) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encoded, and decoded again from the ids."""
    return encode_and_decode(docs, ranks_path, pattern, **columns).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
