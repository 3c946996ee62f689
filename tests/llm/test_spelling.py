"""Operator 12 against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from convaudit.llm import spelling
from convaudit.testing import compare, duck
from conftest import SF001


def edits(a, b):
    """One edit apart, by its definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def plain_groups(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def texts(rng, n):
    base = ["letter", "letters", "lettre", "settle", "kettle", "fettle", "nettle", "Größe", "größe", "GRÖSSE", "straße", "aaaaa", "aaaaaa", "aaaaab", "baaaaa", "abcdefgh", "abcdefg",
            "bcdefgh", "ÀÉÎÕÜ", "àéîõü", "x" * 40, "x" * 41, "y" + "x" * 40, "abc"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(60))) for i in range(n)]
    for i in range(n):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(5, 9)))
        rows.append((1000 + i, f"{w}, {w}! {w.upper()} {w}1{w}"))
    return rows


def got(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_groups_equal_brute_force(spark):
    rows = texts(random.Random(3), 150)
    rows += [(None, "settle settle settle"), (None, None), (7, ""), (7, ""), (8, "é" * 200_000 + " " + "no-words 123"), (1, rows[0][1]), (1, rows[0][1])]
    rows += [(5000 + i, w) for i, w in enumerate(["chainx"] * 60 + ["chainy"] * 20 + ["chaizy"] * 6)]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    out = spelling.spelling_groups(docs)
    assert got(out) == plain_groups(rows)
    assert out.count() == len(plain_words(rows))
    assert any(r[3] and r[5] != r[3] for r in got(out))  # a chain of two forms


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "abcde " * 2), (2, None)], "doc_id long, text string")
    assert got(spelling.spelling_groups(docs)) == set()
    assert got(spelling.spelling_groups(docs.where("false"))) == set()
    assert got(spelling.spelling_groups(docs.union(docs).where("doc_id = 1"))) == plain_groups([(1, "abcde " * 2)] * 2)


def test_long_texts_and_full_tables_count_alike(spark, monkeypatch):
    rows = texts(random.Random(5), 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    assert list(spelling.words_of(1, "One two ONE two two", 97)) == [("one", 1), ("two", 3), ("one", 1)]
    monkeypatch.setattr(spelling, "COUNTED", 3)
    assert {(r.word, r.n) for r in spelling.vocabulary(docs).collect()} == set(plain_words(rows).items())


WORD = st.text(alphabet="abcé", min_size=5, max_size=9)


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, st.integers(0, 8), st.sampled_from("abcé"), st.integers(0, 2))
def test_near_words_share_a_signature(w, other, at, letter, kind):
    signer = spelling.Signer(list("abcé"))
    at %= len(w)
    near = {0: w[:at] + letter + w[at + 1:], 1: w[:at] + letter + w[at:], 2: w[:at] + w[at + 1:]}[kind]
    for v in (near, other):
        if not edits(w, v):
            continue
        a, b = set(signer.signatures(w)), set(signer.signatures(v))
        met = {k for k, r in a if r == spelling.REPLACED} & {k for k, r in b if r == spelling.REPLACED}
        met |= {k for k, r in a if r == spelling.SHORTER_SIDE} & {k for k, r in b if r == spelling.LONGER_SIDE}
        met |= {k for k, r in a if r == spelling.LONGER_SIDE} & {k for k, r in b if r == spelling.SHORTER_SIDE}
        assert met


def test_the_query_equals_its_sql(spark):
    r = compare(spark, "op12_spelling", SF001, duck(SF001))
    assert r["match"] and not r["type_diffs"], r
