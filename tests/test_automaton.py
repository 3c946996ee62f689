"""The automaton against substring search; its plans."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from convaudit.config import AuditConfig
from convaudit.functions import automaton
from convaudit.functions.automaton import Automaton, shards
from convaudit.operators.score import RatioScorer
from convaudit.plans import audit
from convaudit import registry
from convaudit.registry import QUERIES
from convaudit.sources import fixtures as fx

WORDS = st.text(alphabet="abé一", min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=12), st.lists(st.text(alphabet="abé一z😀", max_size=25), max_size=8))
def test_equals_substring_search(entries, texts):
    assert Automaton(entries).contained(texts).tolist() == [any(e in t for e in entries) for t in texts]


def test_failure_links_lead_to_the_longest_suffix():
    a = Automaton(["he", "she", "his", "hers"])
    assert a.states == 10
    assert a.contained(["ushers", "hi", "hershe", "xhex", "sh"]).tolist() == [True, False, True, True, False]


def test_long_texts_entries_and_pieces(monkeypatch):
    rng = random.Random(8)
    entries = ["".join(rng.choice("ab") for _ in range(rng.randrange(8, 16))) for _ in range(40)] + ["x" * 700]
    texts = ["".join(rng.choice("abc") for _ in range(5000)) for _ in range(20)] + ["y" + "x" * 699 + "y" + "x" * 701, "x" * 699, "a" * 300_000]
    expected = [any(e in t for e in entries) for t in texts]
    assert Automaton(entries).contained(texts).tolist() == expected
    monkeypatch.setattr(automaton, "PIECE", 16)
    monkeypatch.setattr(automaton, "TOGETHER", 3)
    assert Automaton(entries[:-1]).contained(texts).tolist() == [any(e in t for e in entries[:-1]) for t in texts]


def test_shards_hold_all_entries():
    words = ["a", "ab", "b" * 10, "ba", "c"]
    parts = shards(words, 4)
    assert sorted(w for p in parts for w in p) == sorted(words) and len(parts) > 1
    assert shards([], 4) == [[]]


def test_a_large_lexicon_is_built_and_run_quickly():
    rng = random.Random(1)
    entries = {"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(30_000)}
    texts = ["".join(rng.choice("abcdefghijk") for _ in range(200)) for _ in range(2_000)]
    start = time.time()
    hit = Automaton(entries).contained(texts)
    assert time.time() - start < 5
    assert hit.tolist() == [any(t[i:i + 9] in entries for i in range(192)) for t in texts]


@pytest.mark.parametrize("most", [1 << 20, 6])  # one automaton, several
def test_hits_of_arrays_with_nulls(spark, monkeypatch, most):
    monkeypatch.setattr(automaton, "SHARD_CHARS", most)
    monkeypatch.setattr(automaton, "TEXT_CHARS", 5)
    rows = [(1, ["this is bad", None, "good"]), (2, None), (3, []), (4, ["worse", "", "awful things", "b ad"])]
    df = spark.createDataFrame(rows, "id int, texts array<string>").repartition(2)
    got = {r.id: r.h for r in df.select("id", automaton.hits(spark, F.col("texts"), ["bad", "awful", "worse"]).alias("h")).collect()}
    assert got == {1: [True, False, False], 2: [], 3: [], 4: [True, False, True, False]}
    empty = df.select("id", automaton.hits(spark, F.col("texts"), [""]).alias("h")).collect()
    assert {r.id: r.h for r in empty}[1] == [True, False, True]
    assert not any(any(r.h) for r in df.where("id <> 2").select(automaton.hits(spark, F.col("texts"), []).alias("h")).collect())


def test_audit_plan_has_no_explode_and_no_shuffle(spark):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/automaton-{time.time_ns()}"
    fx.chat_json(spark, SF001).write.parquet(path)
    cfg = AuditConfig(chat_threshold=fx.TEST_THRESHOLD, max_inline_lexicon=0)
    out = audit.chat_audit(spark.read.parquet(path), fx.terms_df(spark), RatioScorer(tuple(fx.TERMS)), cfg)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "Exchange" not in plan and "Aggregate" not in plan
    assert plan.count("from_json") == 1  # the candidates are built once
    plain = audit.chat_audit(spark.read.parquet(path), fx.TERMS, RatioScorer(tuple(fx.TERMS)), AuditConfig(chat_threshold=fx.TEST_THRESHOLD))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    assert out.count() > 0


def test_speech_audit_by_automaton_equals_the_others(spark):
    speech, scorer = fx.speech_json(spark, SF001), RatioScorer(tuple(fx.TERMS))
    ways = [AuditConfig(speech_threshold=fx.TEST_THRESHOLD, max_inline_lexicon=n, max_automaton_chars=c, inline=i)
            for n, c, i in ((2000, 0, True), (0, 1000, True), (0, 1000, False), (0, 0, False))]
    rows = [sorted(map(tuple, audit.speech_audit(speech, fx.terms_df(spark), scorer, w).collect())) for w in ways]
    assert rows[0] and all(r == rows[0] for r in rows)


def test_query_has_no_explode_of_texts(spark):
    plan = QUERIES["sensitive_automaton"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "sequence" not in plan


def test_query_over_a_lexicon_beyond_the_bound(spark, monkeypatch):
    plain = sorted(map(tuple, QUERIES["sensitive_automaton"](spark, SF001).collect()))
    monkeypatch.setattr(registry, "AuditConfig", lambda **kw: AuditConfig(**{**kw, "max_automaton_chars": 1000}))
    assert plain and sorted(map(tuple, QUERIES["sensitive_automaton"](spark, SF001).collect())) == plain
