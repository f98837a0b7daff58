"""What several operators share: written intermediate tables, blocks of text, word hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.config import scratch_dir

SPACE_CLASS = r"[ \t-\r]"  # \x20 and \x09-\x0D, the white space of all contracts
WORD_CLASS = r"[^ \t-\r]+"
BLOCK_BYTES = 1 << 20  # of text worked on at once: numpy holds some fifty times that
BLOCK_ROWS = 1024  # of an Arrow batch turned into Python objects at once
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df as a Parquet table in the session's shared checkpoint folder: cuts lineage, survives lost executors.

    If about how many narrow rows there are is known, the last stage has a task per FILE_ROWS of them,
    not a task and a file for each of many shuffle partitions with next to nothing.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(4, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """docs as one struct column, doc: columns named beside it cannot clash; select("doc.*") unpacks."""
    return docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("doc"))


def dropped(df: DataFrame) -> None:
    """Delete a written table that nothing will read again."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("llm-"):  # the name that written() gives
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(column: Column) -> Column:
    """crc32 of an id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def unit(*columns) -> Column:
    """A repeatable number in [0, 1) drawn from the values of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / float(1 << 52)


def utf8(text: str = "text", field: str | None = None) -> Column:
    """The text as UTF-8 bytes, null as empty; field: the text's name in a struct."""
    column = F.col(text) if field is None else F.col(text)[field]
    return F.coalesce(column, F.lit("")).cast("binary")


_KEPT: dict = {}


def _let_go() -> None:
    """Free what this worker kept, and return the freed memory of earlier stages to the machine."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def kept(key, make: Callable):
    """What make() gives, kept in this Python worker from task to task.

    Spark hands workers on from stage to stage, so a worker keeps one thing at a time, and a task
    that reads its texts by blocks() under another key lets go of it first.
    """
    if key not in _KEPT:
        _let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def blocks(batches: Iterable, limit: int = BLOCK_BYTES, keep=None) -> Iterator[tuple[list, list[bytes]]]:
    """(other columns as tuples, texts) of Arrow batches whose last column is the text, cut at limit bytes.

    One text longer than the limit is a block of its own, so memory follows the longest text.
    What this worker kept for another stage is let go of, unless its key is keep.
    """
    if keep not in _KEPT:
        _let_go()
    for whole in batches:
        keys, texts, held = [], [], 0
        for begin in range(0, whole.num_rows, BLOCK_ROWS):
            *rest, more = [column.to_pylist() for column in whole.slice(begin, BLOCK_ROWS).columns]
            fresh, start = list(zip(*rest, strict=True)), 0
            for i, text in enumerate(more):
                held += len(text)
                if held >= limit:
                    yield keys + fresh[start:i + 1], texts + more[start:i + 1]
                    keys, texts, start, held = [], [], i + 1, 0
            keys, texts = keys + fresh[start:], texts + more[start:]
        if texts:
            yield keys, texts


def sorted_groups(batches, column: int, limit: int) -> Iterator[list[np.ndarray]]:
    """Columns of a sorted partition in pieces of about limit rows, never cut within equal values of a column."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows >= limit:
            joined = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(joined[column], joined[column][-1]))
            if cut:
                yield [c[:cut] for c in joined]
            held, rows = [[c[cut:] for c in joined]], rows - cut
    if rows:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all 64 bits of each hash."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words of a block of texts, A-Z lower-cased: a 64-bit hash each, in text order.

    hashes[starts[i]:starts[i + 1]] are the words of text i.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        begin, end = edge[::2], edge[1::2]
        up, down = _powers(len(raw) + 1)
        total = np.empty(len(raw) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[raw] * up[:len(raw)], out=total[1:])
        self.hashes = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
        self.begin, self.end, self.raw = begin, end, raw
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.starts = np.searchsorted(begin, offsets)
        self.offsets = offsets

    def shingles(self, n: int) -> np.ndarray:
        """A hash for the n words from each word on; those that leave their text are never read."""
        h = self.hashes
        if len(h) < n:
            return np.empty(0, np.uint64)
        out = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            out += h[k:len(h) - n + 1 + k] * _PLACE[k]
        return mix(out)

    def whole(self, i: int) -> np.ndarray:
        """One hash for all the words of text i, which are fewer than a shingle's."""
        h = self.hashes[self.starts[i]:self.starts[i + 1]]
        return mix(np.array([(h * _PLACE[:len(h)]).sum() + np.uint64(len(h))], np.uint64)) if len(h) else h
