"""License scan: MinHash bands over overlapping windows retrieve templates, shingles verify them.

A text is cut into overlapping windows as long as a template; a window's MinHash bands look up
templates with an equal band. A passage with 0.8 of a template's shingles has a window of a
similarity near 0.6 or above, for which some band is equal with a probability above 0.999
(miss_probability). The template then counts only if the window really holds 0.8 of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import Words, blocks, mix, utf8

SHINGLE = 5
CONTAINED = (4, 5)  # share of a template's shingles that must be there
BANDS = 16
ROWS = 2  # hashes of a band
OVERLAP = 8  # a window starts every eighth of its length
BAND_BITS = 20  # of the table that says whether any template has a band
TEMPLATE_BYTES = 1 << 24  # templates whose tables a task holds at once; more are taken part by part

_RNG = np.random.default_rng(77)
_SALTS = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Notices and openings of public licenses that a corpus quotes.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
)


def miss_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that no band of two sets of this similarity collides."""
    return (1 - similarity**rows) ** bands


class Templates:
    """Shingle sets of the templates, their window lengths, and the bands that lead to them."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        words = Words([text.encode() for _, text in templates])
        shingles = words.shingles(SHINGLE)
        self.names = [name for name, _ in templates]
        self.sets = []
        for i, (name, _) in enumerate(templates):
            begin, end = words.starts[i], words.starts[i + 1] - SHINGLE + 1
            if end <= begin:
                raise ValueError(f"a template of {name} is shorter than {SHINGLE} words")
            self.sets.append(np.unique(shingles[begin:end]))
        self.lengths: dict[int, list[int]] = {}  # shingles of a window -> its templates
        for i, s in enumerate(self.sets):
            self.lengths.setdefault(int(words.starts[i + 1] - words.starts[i] - SHINGLE + 1), []).append(i)
        self.tables = {n: self._bands(members) for n, members in self.lengths.items()}

    def _bands(self, members: list[int]) -> tuple[np.ndarray, list[dict[int, list[int]]]]:
        """(for each band, which low bits of a key occur), (for each band, key -> templates)."""
        near = np.zeros((BANDS, 1 << BAND_BITS), bool)
        exact: list[dict[int, list[int]]] = [{} for _ in range(BANDS)]
        for i in members:
            least = np.array([[mix(self.sets[i] * salt).min()] for salt in _SALTS])
            for b in range(BANDS):
                key = int(_band(least[b * ROWS:(b + 1) * ROWS])[0])
                near[b, key & ((1 << BAND_BITS) - 1)] = True
                exact[b].setdefault(key, []).append(i)
        return near, exact


def _band(least: np.ndarray) -> np.ndarray:
    """One key from the minima of a band."""
    key = least[0]
    for row in least[1:]:
        key = key * np.uint64(0x9E3779B97F4A7C15) + row
    return key ^ (key >> np.uint64(31))


def _window_minima(values: np.ndarray, length: int, stride: int) -> np.ndarray:
    """Minimum of every window of about length values that starts at a multiple of stride.

    Windows are whole numbers of strides, so each is the minimum of some stride blocks; the blocks
    that a length does not fill are rounded up, which only widens the window.
    """
    n_blocks = -(-len(values) // stride)
    run = values
    if stride > 1:
        padded = np.full(n_blocks * stride, np.uint64(2**64 - 1))
        padded[:len(values)] = values
        run = padded.reshape(n_blocks, stride).min(axis=1)
    span = -(-length // stride)
    out, done, step = None, 0, 1
    while True:  # doubling: minima of 1, 2, 4 ... blocks
        if span & step:
            if out is None:
                out = run
            elif done < n_blocks:
                out = np.concatenate([np.minimum(out[:n_blocks - done], run[done:]), out[n_blocks - done:]])
            done += step
        if done == span:
            return out
        if step < n_blocks:
            run = np.concatenate([np.minimum(run[:-step], run[step:]), run[-step:]])
        step *= 2


def _found(templates: Templates, shingles: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, template, first word, last word, shingles held) of verified windows in a block of texts."""
    hashed = [mix(shingles * salt) for salt in _SALTS]
    for length, _ in templates.lengths.items():
        near, exact = templates.tables[length]
        stride = max(1, length // OVERLAP)
        seen = set()
        minima = [_window_minima(h, length, stride) for h in hashed]
        for b in range(BANDS):
            keys = _band(minima[b * ROWS:(b + 1) * ROWS])
            for w in np.flatnonzero(near[b, (keys & np.uint64((1 << BAND_BITS) - 1)).astype(np.int64)]):
                for i in exact[b].get(int(keys[w]), ()):
                    if (int(w), i) in seen:
                        continue
                    seen.add((int(w), i))
                    begin = int(w) * stride
                    end = begin + -(-length // stride) * stride
                    text = int(np.searchsorted(starts, begin, side="right")) - 1
                    # A window ends with its text; what hangs over belongs to the next one.
                    for t in (text, text + 1):
                        if t + 1 >= len(starts):
                            continue
                        # The passage may begin a stride before the window or end one after it.
                        low = max(begin - stride, int(starts[t]))
                        high = min(end + stride, int(starts[t + 1]) - SHINGLE + 1)
                        if high <= low:
                            continue
                        hit = np.isin(shingles[low:high], templates.sets[i])
                        held = len(np.unique(shingles[low:high][hit]))
                        if CONTAINED[1] * held >= CONTAINED[0] * len(templates.sets[i]):
                            at = np.flatnonzero(hit)
                            first = low + int(at[0]) - int(starts[t])
                            yield t, i, first, low + int(at[-1]) - int(starts[t]) + SHINGLE - 1, held


def _spans(found: list[tuple[int, int, int, int, int]], templates: Templates) -> list[dict]:
    """One row per license and passage of a text: overlapping windows of a license are one passage."""
    out: list[dict] = []
    for _, i, first, last, held in sorted(found, key=lambda f: (templates.names[f[1]], f[2], f[3])):
        share = held / len(templates.sets[i])
        if out and out[-1]["license"] == templates.names[i] and first <= out[-1]["last_word"]:
            out[-1]["last_word"] = max(out[-1]["last_word"], last)
            out[-1]["containment"] = max(out[-1]["containment"], share)
        else:
            out.append({"license": templates.names[i], "first_word": first, "last_word": last, "containment": share})
    return out


_SPAN = "array<struct<license: string, first_word: bigint, last_word: bigint, containment: double>>"


def _parts(templates: Sequence[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    part, size = [], 0
    for item in templates:
        if part and size + len(item[1]) > TEMPLATE_BYTES:
            yield part
            part, size = [], 0
        part.append(item)
        size += len(item[1])
    if part:
        yield part


def _scan(docs: DataFrame, parts: list[list[tuple[str, str]]], id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))
    schema = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                 ("containment", pa.float64())]))

    def run(batches) -> Iterator[pa.RecordBatch]:
        kind = None
        held: dict[int, Templates] = {}

        def seen(stream):
            nonlocal kind
            for batch in stream:
                kind = batch.schema.field(0).type
                yield batch

        for keys, texts in blocks(seen(batches)):
            words = Words(texts)
            shingles = words.shingles(SHINGLE)
            found: list[list] = [[] for _ in texts]
            for p, part in enumerate(parts):
                known = held.get(p)
                if known is None:
                    held.clear()  # one part's tables at a time
                    known = held[p] = Templates(part)
                hits: dict[int, list] = {}
                for hit in _found(known, shingles, words.starts):
                    hits.setdefault(hit[0], []).append(hit)
                for i, got in hits.items():
                    found[i] += _spans(got, known)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], kind), pa.array(np.diff(words.starts)),
                 pa.array([sorted(f, key=lambda s: (s["first_word"], s["license"])) for f in found], schema)],
                names=["doc_id", "n_words", "passages"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_words bigint, passages {_SPAN}")


def license_scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, passages, licenses.

    passages: (license, first_word, last_word, containment), word places from 0, of every passage
    that holds 0.8 or more of a template's five-word shingles; licenses: their distinct names in
    order. Case of A-Z and white space do not matter. Null, empty and short texts have none; repeated
    rows are scanned each; other columns are not read; an empty table gives an empty result.
    """
    if not templates:
        raise ValueError("no templates")
    scanned = _scan(docs, list(_parts(templates)), id_col, text_col)
    return scanned.withColumn("licenses", F.array_sort(F.array_distinct(F.transform("passages", lambda p: p["license"]))))
