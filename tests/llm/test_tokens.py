"""Byte-level BPE and edit-aware counts against the tokenizer library and full recounts."""

import hashlib
import itertools
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from grainmart.llm import byte_bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHARS = "abcdehilnorst    \n\t'\x1c\x1f\x85  0123é漢字\U0001f600́.,;'llsrevdед"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, PATTERN)


def drawn(rng, n):
    return "".join(rng.choice(CHARS) for _ in range(n))


def test_ids_equal_the_librarys(library, encoder):
    rng = random.Random(1)
    for _ in range(3000):
        text = drawn(rng, rng.randint(0, 60))
        assert encoder.encode(text) == library.encode_ordinary(text)
    for text in ("<|endoftext|>", "a" * 40_000, " " * 50_000, drawn(rng, 30_000), "abcdefgh" * 5000):
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_forgetting_states_and_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STATES", 50)
    monkeypatch.setattr(byte_bpe, "PIECES", 10)
    monkeypatch.setattr(byte_bpe, "CHUNK_IDS", 8)
    small = byte_bpe.Encoder(RANKS, PATTERN)
    rng = random.Random(2)
    for _ in range(200):
        text = drawn(rng, 80) + "".join(rng.choice("abcdef") for _ in range(200))
        assert small.encode(text) == library.encode_ordinary(text)


def test_decoding_in_chunks_keeps_characters_whole(library):
    bytes_of = {rank: token for token, rank in byte_bpe.read_ranks(RANKS).items()}
    text = drawn(random.Random(3), 400)
    ids = library.encode_ordinary(text)
    for step in (1, 2, 7, len(ids)):
        stream = byte_bpe.StreamDecoder(bytes_of)
        parts = [stream.feed(ids[i:i + step]) for i in range(0, len(ids), step)]
        assert b"".join(p[0] for p in parts).decode() == text == "".join(p[1] for p in parts) + stream.feed([], True)[1]
    with pytest.raises(UnicodeDecodeError):
        byte_bpe.StreamDecoder(bytes_of).feed(library.encode_ordinary("漢")[:1], last=True)


def test_round_trip_of_rows(spark, library):
    rng = random.Random(4)
    texts = [None, "", " ", drawn(rng, 500), "same", "same", "x" * 200_000]
    docs = spark.createDataFrame([(i, t, [1], 0) for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>, n int")
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(docs, RANKS, PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0
    apart = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in apart.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_counts_follow_edits(library, encoder):
    rng = random.Random(5)
    chars = "abcd l'sretv      \n\t0123é漢\U0001f600.,;'"
    draw = lambda n: "".join(rng.choice(chars) for _ in range(n))
    for trial in range(250):
        text = draw(rng.choice([0, 1, 5, 40, 400, 1500]))
        if trial % 7 == 0:
            text = text[:100] + " " * rng.randint(0, 400) + "a" * rng.randint(0, 300) + text[100:]
        doc = token_counts.EditedText(text, encoder)
        for _ in range(12):
            start, delete = rng.randint(0, len(text)), rng.choice([0, 1, 3, 12, 200])
            insert = draw(rng.choice([0, 1, 2, 16, 300]))
            text = text[:start] + insert + text[start + delete:]
            doc.edit(start, delete, insert)
            assert doc.text == text and doc.n_tokens == len(library.encode_ordinary(text)) and doc.length == len(text)


def test_an_edit_recodes_a_small_part(encoder):
    doc = token_counts.EditedText("the quick brown fox jumps over a lazy dog. " * 2000, encoder)
    doc.edit(40_000, 3, "slow")
    assert doc.recoded < 4 * token_counts.LEAF_PIECES


def test_edited_rows(spark, library):
    rows = [(1, "hello there world", [(0, 5, "goodbye"), (-4, 0, ">"), (999, 5, "<"), None, (None, None, None)]),
            (2, None, [(0, 3, "new")]), (3, "kept", None), (3, "kept", []), (None, "", None)]
    kind = "doc_id bigint, text string, edits array<struct<start: int, delete: int, insert: string>>, n_edits string"
    docs = spark.createDataFrame([(*r, "clash") for r in rows], kind)
    got = token_counts.edited_counts(docs, F.col("edits"), RANKS, PATTERN).collect()
    texts = {1: ">goodbye there world<", 2: "new", 3: "kept", None: ""}
    assert len(got) == 5
    for r in got:
        text = texts[r["doc_id"]]
        assert r["n_tokens_after"] == len(library.encode_ordinary(text)) and r["n_chars_after"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert {r["doc_id"]: r["n_edits"] for r in got} == {1: 4, 2: 1, 3: 0, None: 0}
    assert token_counts.edited_counts(docs.limit(0), F.col("edits"), RANKS, PATTERN).count() == 0


def test_drawn_edits_match_a_plain_replay(spark, library):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, drawn(rng, rng.choice([0, 10, 3000, 9000]))) for i in range(30)], "doc_id bigint, text string")
    script = token_counts.synthetic_edits()
    replay = {}
    for r in docs.select("doc_id", "text", script.alias("edits")).collect():
        text = r["text"]
        for e in r["edits"]:
            start = min(e["start"], len(text))
            text = text[:start] + e["insert"] + text[start + e["delete"]:]
        replay[r["doc_id"]] = (len(r["edits"]), len(library.encode_ordinary(text)))
    got = token_counts.edited_counts(docs, script, RANKS, PATTERN).collect()
    assert {r["doc_id"]: (r["n_edits"], r["n_tokens_after"]) for r in got} == replay


def test_copying_edits_are_the_drawn_edits(spark):
    rng = random.Random(7)
    texts = [None, "", "é", *(drawn(rng, n) for n in (1, 1999, 2000, 9000)), "a b" * 40_000]
    docs = spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    counted = [token_counts.edited_counts(docs, script, RANKS, PATTERN) for script in (token_counts.synthetic_edits(), token_counts.copying_edits())]
    assert sorted(map(str, counted[0].collect())) == sorted(map(str, counted[1].collect()))


def test_a_tree_is_planted_anew_only_after_many_insertions(library, encoder, monkeypatch):
    doc = token_counts.EditedText("some words in a row, again and again. " * 3000, encoder)
    planted = []
    plant = token_counts.EditedText._plant
    monkeypatch.setattr(token_counts.EditedText, "_plant", lambda self, leaves: (planted.append(1), plant(self, leaves)))
    rng = random.Random(8)
    text = doc.text
    for _ in range(400):
        start = rng.randint(0, len(text))
        text = text[:start] + " new words here" + text[start:]
        doc.edit(start, 0, " new words here")
    assert doc.n_tokens == len(library.encode_ordinary(text)) and doc.text == text
    assert not planted
    doc.edit(5, 0, " many" * 500)
    assert len(planted) == 1 and doc.n_tokens == len(library.encode_ordinary(text[:5] + " many" * 500 + text[5:]))


def test_both_matchers_find_the_same_pieces():
    split, plain = byte_bpe.Splitter(PATTERN), regex.compile(PATTERN)
    assert split.basic is not None
    rng = random.Random(9)
    every = [chr(i) for i in range(0x110000)]
    for chars in (every[:128], every[:256], every[:1 << 16], every, CHARS):
        for _ in range(300):
            text = "".join(rng.choice(" \n'as" if rng.random() < 0.4 else chars) for _ in range(200))
            assert split.findall(text) == plain.findall(text)
    basic = "".join(every[:1 << 16])  # a class at a time, and a mark between any two characters
    for text in (basic, "x".join(basic), " ".join(basic), "\n".join(basic)):
        assert split.findall(text) == split.basic.findall(text) == plain.findall(text)


def test_patterns_that_the_matchers_may_read_differently_stay_with_regex():
    for pattern in (r"(?i)'s|\p{L}+|.", r"\p{L}{1,3}|.", r"\X", r"[[a-z]--[e]]+|.", r"[]\p{L}]+|.", r"(?<=a+)b|.", r"\p{Script=Latin}+|."):
        assert byte_bpe.Splitter(pattern).basic is None
        assert byte_bpe.Splitter(pattern).findall("It's é \U0001f600") == regex.compile(pattern).findall("It's é \U0001f600")
    for pattern in (r"[^\S\n]+|\P{L}|\w+", r"\[|\p{Lu}\p{Ll}*|(?<=a)b|[\d.]+|."):
        assert byte_bpe.Splitter(pattern).basic is not None
        assert byte_bpe.Splitter(pattern).findall("It's [12.5] ab\n é") == regex.compile(pattern).findall("It's [12.5] ab\n é")


def test_a_hundred_thousand_words_are_encoded_once():
    own = byte_bpe.Encoder(RANKS, PATTERN)
    words = " ".join("".join(w) for w in itertools.islice(itertools.product("qzxjkvwybfgp", repeat=5), 100_000))
    first, encode, again = own.packed(words), own.transducer.encode, []
    own.transducer.encode = lambda piece: (again.append(piece), encode(piece))[1]
    assert own.packed(words) == first and not again
