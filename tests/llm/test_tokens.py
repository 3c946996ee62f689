"""Operators 1, 3 and 10 against the tokenizers library, brute force and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from convaudit.llm import bpe, packing, wordpiece
from convaudit.llm.queries import QUERIES

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  a", "a  b", "a \n b", "x\n \ny", "a\n ", "<|endoftext|> hi<|startoftext|>", "İstanbul Σας ΣΑΣ", "é é café",
         "don't I'LL we'd'", "a\x1cb \x1d c", "一二三 四" * 20, "x" * 5000, "ab12 3½ ²", " a b\x85c d", "😀👍🏽 ok!!", "tab\tx \t y", " " * 300,
         "the quick brown fox, " * 50, "٠‍ x　y"]
MIXED = st.text(alphabet=st.sampled_from(list("abtheTHE '.,!12éÉß\n\t  一😀<|>")), max_size=60)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.fixture(scope="module")
def word():
    text = open(WORD, encoding="utf-8").read()
    return bpe.Bpe(text), Tokenizer.from_str(text)


@pytest.fixture(scope="module")
def byte():
    return packing.Encoder(open(BYTE, encoding="utf-8").read())


def same(word, t):
    own, library = word
    expected = library.encode(t, add_special_tokens=False).ids
    assert ids(own.encode(t)) == expected
    assert own.decode(own.encode(t)) == library.decode(expected, skip_special_tokens=False)


def test_bpe_equals_the_library(word):
    for t in TEXTS:
        same(word, t)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_bpe_equals_the_library_on_mixed_texts(word, t):
    same(word, t)


def test_merges_in_rank_order_then_leftmost(word):
    own, rng = word[0], random.Random(1)
    for _ in range(200):
        start = [own.first[rng.choice(b"aehnrst")] for _ in range(rng.randrange(1, 30))]
        plain = list(start)
        while True:  # one merge at a time, by scanning all pairs
            found = [(own.rank[a << 32 | b], i) for i, (a, b) in enumerate(zip(plain, plain[1:])) if a << 32 | b in own.rank]
            if not found:
                break
            r, i = min(found)
            plain[i:i + 2] = [own.made[r]]
        assert own.merge(list(start)) == plain


def test_packing_ids_equal_the_library(byte):
    assert byte.fast is not None
    for t in [*TEXTS, " " * 30_000, "a" + " " * 25_000 + "b"]:
        assert ids(byte.encode(t)) == byte.library.encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_packing_ids_equal_the_library_on_mixed_texts(byte, t):
    assert ids(byte.encode(t)) == byte.library.encode(t, add_special_tokens=False).ids


def test_lengths_are_powers_of_two():
    for n in [*range(0, 300), 2047, 2048, 2049, 10_000]:
        cut = packing.lengths(n, 256)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 256 for x in cut) and cut == sorted(cut, reverse=True)


def brute(word, starts, continues):
    raw, at, n = word.encode(), 0, 0
    while at < len(raw):
        end = next((e for e in range(len(raw), at, -1) if raw[at:e] in (continues if at else starts)), None)
        if end is None:
            return 1 + wordpiece.UNKNOWN
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12),
       st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12),
       st.lists(st.text("abc", min_size=1, max_size=12), max_size=10))
def test_longest_match_counts(starts, continues, words):
    counter = wordpiece.PieceCounter(sorted(starts), sorted(continues))
    for w in words:
        assert counter.count(w) == brute(w, starts, continues)


def frame(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(100, None, "x", 0), (1, " ", "x", 0), (None, "null key", "x", 0), (7, TEXTS[7], "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, length int")


def test_odd_rows(spark, word, byte):
    df = frame(spark)
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    got = sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in bpe.encode_decode(df, WORD).collect())
    assert got == sorted((str(k), word[0].encode(t), word[0].decode(word[0].encode(t))) for k, t in rows)
    got = wordpiece.token_counts(df, BYTE).collect()
    starts, continues = map(set, wordpiece.pieces_of(open(BYTE, encoding="utf-8").read()))
    expected = []
    for k, t in rows:
        words = wordpiece.words_of(t)
        total = sum(brute(w, starts, continues) for w in words)
        expected.append((str(k), len(words), total % wordpiece.UNKNOWN, total // wordpiece.UNKNOWN))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown) for r in got) == sorted(expected)
    pieces = packing.pack(df, BYTE).collect()
    check_pieces(pieces, [(k, byte.encode(t) + b"\1\0\0\0") for k, t in rows])


def test_token_count_query_equals_brute_force(spark):
    """Every document of the table, longest match tried piece by piece."""
    starts, continues = map(set, wordpiece.pieces_of(open(BYTE, encoding="utf-8").read()))
    known, expected = {}, {}
    for r in spark.read.parquet(SF001 + "/documents.parquet").select("doc_id", "text").collect():
        words = wordpiece.words_of(r.text or "")
        for w in words:
            if w not in known:
                known[w] = brute(w, starts, continues)
        total = sum(known[w] for w in words)
        expected[r.doc_id] = (len(words), total % wordpiece.UNKNOWN, total // wordpiece.UNKNOWN)
    out = QUERIES["op3_token_counts"](spark, SF001)
    assert {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in out.collect()} == expected


def check_pieces(pieces, docs, width=2048):
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    found = {}
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= width and p.offset == 0 and 1 << (p.sequence_id & 31) == p.length
        found.setdefault((p.doc_id, p.start, p.length, bytes(p.ids), p.doc_tokens), []).append(p)
    expected = {}
    for k, raw in docs:
        at = 0
        for n in packing.lengths(len(raw) // 4, width):
            key = (k, at, n, raw[4 * at:4 * (at + n)], len(raw) // 4)
            expected[key] = expected.get(key, 0) + 1
            at += n
    assert {k: len(v) for k, v in found.items()} == expected


def test_empty_tables(spark):
    none = frame(spark).where("false")
    assert bpe.encode_decode(none, WORD).count() == wordpiece.token_counts(none, BYTE).count() == packing.pack(none, BYTE).count() == 0


def test_queries(spark, word, byte):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(SF001 + "/documents.parquet").collect()]
    for r in QUERIES["op1_bpe"](spark, SF001).collect():
        t = dict(docs)[r.doc_id]
        own = word[1].encode(t, add_special_tokens=False).ids
        assert r.n_tokens == len(own) and r.ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(word[1].decode(own, skip_special_tokens=False).encode()).hexdigest()
    parts = {}
    for r in QUERIES["op10_packing"](spark, SF001).collect():
        parts.setdefault(r.doc_id, []).append(r)
    for k, t in docs:
        raw = np.array([*byte.library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()
        own = sorted(parts[k], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(raw) // 4 == own[0].doc_tokens
        assert [r.ids_crc32 for r in own] == [zlib.crc32(raw[4 * r.start:4 * (r.start + r.length)]) for r in own]
