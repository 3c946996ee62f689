"""Lexicon matching, line splitting and rank AUC against brute force."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convaudit.functions.lexicon import contains_any, minimal_entries, trie_pattern
from convaudit.operators import evaluate
from convaudit.operators import lexicon as lexops

ALPHA = st.text(alphabet="abc.*é", min_size=0, max_size=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHA.filter(bool), min_size=1, max_size=8), st.lists(ALPHA, min_size=1, max_size=8))
def test_trie_pattern_equals_substring_search(entries, texts):
    pat = trie_pattern(entries)
    for t in texts:
        expect = any(e in t for e in entries)
        got = bool(re.search(pat, t)) if pat else pat == ""
        assert got == expect, (entries, t, pat)


def test_minimal_entries():
    assert minimal_entries(["ab", "abc", "b", "xb", "q"]) == ["b", "q"]
    assert trie_pattern([]) is None
    assert trie_pattern(["", "x"]) == ""


def test_inline_and_join_paths_agree(spark):
    words = ["bad", "very bad", "x", "zz"]
    rows = [(i, t) for i, t in enumerate(["this is bad", "goodx", "nothing", "z z", "zz top", "", "very"])]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("tokens", F.split("text", " "))
    inline = {r.id for r in df.where(contains_any(F.concat_ws("", "tokens"), words)).collect()}
    lex = spark.createDataFrame([(w,) for w in words], "entry string")
    joined = {r.id for r in lexops.semi_join_lexicon(df, lex, "substring").collect()}
    brute = {i for i, t in rows if any(w in t.replace(" ", "") for w in words)}
    assert inline == joined == brute
    tok = {r.id for r in lexops.semi_join_lexicon(df, lex, "token").collect()}
    assert tok == {0, 4}


def test_join_path_over_many_groups_equals_substring_search(spark, monkeypatch):
    rng = __import__("random").Random(3)
    word = lambda a, b: "".join(rng.choice("abé😀") for _ in range(rng.randrange(a, b)))
    words = [word(3, 14) for _ in range(60)] + ["ab", None, "abababab" + "b" * 9]
    rows = [(i, [word(0, 6) for _ in range(rng.randrange(6))]) for i in range(400)] + [(None, None), (7, ["abababa", "bbbbbbbbbb"])] * 2
    df = spark.createDataFrame(rows, "id int, tokens array<string>").repartition(3)
    lex = spark.createDataFrame([(w,) for w in words], "entry string")
    monkeypatch.setattr(lexops, "GROUP_CHARS", 200)
    for most in (1 << 28, 64):  # a bitmap that tells prefixes apart, one that hardly does
        monkeypatch.setattr(lexops, "MOST_BITS", most)
        for skip in (None, "ab"):
            kept = [w for w in words if w and w != skip]
            got = sorted((r.id, tuple(r.tokens)) for r in lexops.semi_join_lexicon(df, lex.where(F.col("entry") != (skip or "")), "substring").collect())
            assert got == sorted((i, tuple(t)) for i, t in rows if t and any(w in "".join(t) for w in kept))
    assert lexops.semi_join_lexicon(df, lex.where("false"), "substring").count() == 0


def test_lines_like_a_text_file_reader(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n\nd\n",), ("x",), ("\n",), (" sp \n",)], "text string")
    got = [r.l for r in df.select(lexops.lines_of("text").alias("l")).collect()]
    assert got == [["a", "b", "c", "", "d"], ["x"], [""], [" sp "]]


def test_read_lexicon_file(spark, tmp_path):
    p = tmp_path / "words.txt"
    p.write_text("alpha\n beta \n\ngamma", encoding="utf-8")
    got = [r.entry for r in lexops.read_lexicon(spark, str(p)).collect()]
    assert got == ["alpha", " beta ", "", "gamma"]


def test_rank_auc_equals_pairwise_count(spark):
    import random

    rnd = random.Random(7)
    rows = [(float(rnd.randint(0, 20)), float(rnd.random() < 0.4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label double")
    pos = [s for s, y in rows if y == 1.0]
    neg = [s for s, y in rows if y == 0.0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    for parts in (1, 2, 5, 50, 20_000):  # one range, several, more ranges than distinct scores
        got = evaluate.auc_rank(df, parts=parts).first()
        assert abs(got.auc - wins / (len(pos) * len(neg))) < 1e-12, parts
        assert got.n_pos == len(pos) and got.n_neg == len(neg)


def test_hard_auc_and_accuracy(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    a = evaluate.accuracy(df).first()
    assert (a.n, a.n_correct, a.accuracy) == (5, 3, 0.6)
    h = evaluate.auc_hard(df).first()
    tpr, fpr = 2 / 3, 1 / 2
    assert abs(h.auc - (1 + tpr - fpr) / 2) < 1e-12
    r = evaluate.auc_rank(df.withColumnRenamed("prediction", "score")).first()
    assert abs(r.auc - h.auc) < 1e-12
