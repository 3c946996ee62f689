"""Hand-written cases for the semantics that must be got right."""

import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from convaudit.config import AuditConfig, FlowConfig
from convaudit.functions.text import compare
from convaudit.operators import parse
from convaudit.operators.score import RatioScorer
from convaudit.plans import audit
from convaudit.plans.ticket_flow import flow_check

TS = dt.datetime(2024, 1, 15, 8, 0, 0)
SCORER = RatioScorer(("bad",))
LEX = ["bad"]


def msg(uid, digest, keys=8):
    m = {"userName": "n", "userId": uid, "digest": digest, "content": "", "time": "0", "msgType": "text",
         "userFaceUrl": "", "imuserid": "x"}
    if keys == 7:
        m.pop("imuserid")
    return m


def chat_df(spark, rows):
    """rows: (session_id, messages list or raw text, user_id, agent_id)"""
    data = [(TS, m if isinstance(m, str) else json.dumps(m), sid, u, a) for sid, m, u, a in rows]
    return spark.createDataFrame(
        data, "create_time timestamp_ntz, chat_records string, session_id string, user_id string, agent_id string")


INLINE = [True]


def cfg(**kw):
    base = dict(chat_threshold=0.1, speech_threshold=0.1, inline=INLINE[0])
    base.update(kw)
    return AuditConfig(**base)


@pytest.fixture(params=[True, False], ids=["in-row", "exploded"], autouse=True)
def plan_shape(request):
    INLINE[0] = request.param
    yield
    INLINE[0] = True


def result(df):
    return {r.record_id: (r.problem_text, round(r.score, 6)) for r in df.collect()}


def test_agent_best_is_never_emitted_in_faithful_mode(spark):
    chats = chat_df(spark, [
        ("s1", [msg("u", "bad good good"), msg("a", "bad good")], "u", "a"),    # user 1/3, agent 1/2
        ("s2", [msg("u", "all good"), msg("a", "bad bad good")], "u", "a"),     # agent only
        ("s3", [msg("u", "bad good"), msg("a", "bad good")], "u", "a"),         # tie
        ("s4", [msg("u", "bad"), msg("a", "bad good")], "u", "a"),              # user higher
    ])
    faithful = result(audit.chat_audit(chats, LEX, SCORER, cfg(select_mode="faithful")))
    intended = result(audit.chat_audit(chats, LEX, SCORER, cfg(select_mode="intended")))
    assert faithful == {"s1": ("bad good good", 0.333333), "s3": ("bad good", 0.5), "s4": ("bad", 1.0)}
    assert intended == {"s1": ("bad good", 0.5), "s2": ("bad bad good", 0.666667), "s3": ("bad good", 0.5),
                        "s4": ("bad", 1.0)}


def test_faithful_mode_emits_blank_row_for_non_positive_threshold(spark):
    chats = chat_df(spark, [("s2", [msg("u", "all good"), msg("a", "bad bad good")], "u", "a")])
    out = result(audit.chat_audit(chats, LEX, SCORER, cfg(select_mode="faithful", chat_threshold=0.0)))
    assert out == {"s2": ("", 0.0)}


def test_first_sentence_wins_ties_and_strict_sentence_threshold(spark):
    chats = chat_df(spark, [("s", [msg("u", "bad good"), msg("u", "good bad"), msg("u", "bad bad")], "u", "a")])
    assert result(audit.chat_audit(chats, LEX, SCORER, cfg(chat_threshold=0.5))) == {"s": ("bad bad", 1.0)}
    chats = chat_df(spark, [("s", [msg("u", "bad good"), msg("u", "good bad")], "u", "a")])
    assert result(audit.chat_audit(chats, LEX, SCORER, cfg())) == {"s": ("bad good", 0.5)}
    # sentence threshold is strict for chat: 0.5 > 0.5 is false
    assert result(audit.chat_audit(chats, LEX, SCORER, cfg(chat_threshold=0.5))) == {}


def test_message_guards_speaker_and_canned(spark):
    chats = chat_df(spark, [
        ("k", [msg("u", "bad", keys=7), msg("u", "bad good")], "u", "a"),       # 7-key message skipped
        ("b", [msg("bot", "bad")], "u", "a"),                                    # bot skipped
        ("n", [msg(None, "bad good good")], None, "a"),                           # null ids match (user)
        ("c", [msg("u", " bad "), msg("u", "bad good good good")], "u", "a"),     # canned sentence skipped
    ])
    canned = spark.createDataFrame([("bad",)], "sentence string")
    out = result(audit.chat_audit(chats, LEX, SCORER, cfg(), canned))
    assert out == {"k": ("bad good", 0.5), "n": ("bad good good", 0.333333), "c": ("bad good good good", 0.25)}


def test_sensitive_word_gate_and_token_mode(spark):
    chats = chat_df(spark, [("s", [msg("u", "badly done bad")], "u", "a")])
    # substring mode: 'bad' inside 'badly' also counts; token mode needs a whole token
    assert result(audit.chat_audit(chats, ["badl"], SCORER, cfg())) == {"s": ("badly done bad", 0.333333)}
    assert result(audit.chat_audit(chats, ["badl"], SCORER, cfg(sensitive_mode="token"))) == {}


def test_quarantine_reasons(spark):
    chats = chat_df(spark, [("ok", [msg("u", "x")], "u", "a"), ("cut", '[{"userId": "u", "dig', "u", "a"),
                            ("obj", '{"userId": "u"}', "u", "a")])
    speech = spark.createDataFrame(
        [("t1", "o", 0.1, '{"sentenceListData": [{"text": "a", "wordList": ["a"]}]}', dt.date(2024, 1, 15)),
         ("t2", "o", 0.1, '{"other": 1}', dt.date(2024, 1, 15)),
         ("t3", "o", 0.1, '{"sentenceListData": [', dt.date(2024, 1, 15))],
        "task_no string, order_no string, score_qingxu double, result string, v_date date")
    q = {(r.kind, r.record_id): r.reason for r in parse.quarantine(chats, speech).collect()}
    assert q == {("chat", "cut"): "bad_json", ("chat", "obj"): "bad_shape",
                 ("speech", "t2"): "bad_shape", ("speech", "t3"): "bad_json"}


def test_text_behind_the_json_is_refused(spark):
    """A payload is one JSON value: whatever follows it, the record is quarantined and not audited."""
    whole = json.dumps([msg("u", "bad good")])
    junk = [" x", "[]", "]", "}", "},", ",1", ',"z":[]', ',"v":[]', ',"z":[]}', '],"z":[[]', "null", "\\", '"']
    bad = [*(whole + j for j in junk), whole.replace('"', "'"), "x" + whole, whole[:-1]]
    good = [whole, f"  {whole}\n", json.dumps([msg("u", "bad ] } ,\" good")]), whole.replace('"digest"', '"digest": "first", "digest"')]
    chats = chat_df(spark, [(f"{kind}{i}", t, "u", "a") for kind, ts in (("bad", bad), ("good", good)) for i, t in enumerate(ts)])
    assert {r.record_id: r.reason for r in parse.quarantine(chats).collect()} == {f"bad{i}": "bad_json" for i in range(len(bad))}
    assert set(result(audit.chat_audit(chats, LEX, SCORER, cfg()))) == {f"good{i}" for i in range(len(good))}
    d = dt.date(2024, 1, 15)
    speech = json.dumps({"sentenceListData": [{"text": "a", "wordList": ["a"]}]})
    rows = spark.createDataFrame([(f"t{i}", "o", 0.1, speech + j, d) for i, j in enumerate(["", *junk])],
                                 "task_no string, order_no string, score_qingxu double, result string, v_date date")
    assert {r.record_id for r in parse.quarantine(speech=rows).collect()} == {f"t{i + 1}" for i in range(len(junk))}


def test_speech_min_words_blend_and_joined_text(spark):
    payload = {"sentenceListData": [
        {"text": "x", "wordList": ["bad", "bad", "bad", "bad"]},              # 4 words: skipped
        {"text": "y", "wordList": ["bad", "a", "b", "c", "d"]},               # 1/5
        {"text": "z", "wordList": ["bad", "bad", "b", "c", "d", "e"]},        # 2/6
    ]}
    speech = spark.createDataFrame([("t", "o", 0.5, json.dumps(payload), dt.date(2024, 1, 15))],
                                   "task_no string, order_no string, score_qingxu double, result string, v_date date")
    out = audit.speech_audit(speech, LEX, SCORER, cfg()).collect()
    assert len(out) == 1
    assert out[0].problem_text == "bad bad b c d e"
    assert abs(out[0].score - (0.8 * (2 / 6) + 0.2 * 0.5)) < 1e-12
    assert out[0].v_date == "2024-01-15" and out[0].source == 2


def test_nan_never_passes(spark):
    df = spark.createDataFrame([(float("nan"),), (0.5,)], "s double")
    assert df.where(compare(F.col("s"), ">", 0.1)).count() == 1
    assert df.where(compare(F.col("s"), ">=", 0.1)).count() == 1


def _flow_inputs(spark):
    rules = spark.createDataFrame(
        [(1, "X", "2", "k1#k2"), (2, "Y", "9", "y1"), (3, "Z", "oops", "z1"), (4, "X", "3", "k2#k1"),
         (5, "E", "1", "")],
        "rule_id int, question_type string, caller_threshold string, key_words string")
    d = dt.date(2024, 1, 15)
    tickets = spark.createDataFrame([
        (d, "1", "o1", "X", 5),        # passes (threshold 3 after last-wins)
        (d, "2", "o1", "Y", 1),        # later ticket of o1: o1's type becomes Y
        (d, "3", "o2", "X", 1),        # fails
        (d, "4", "o3", "Z", 99),       # type without a valid rule: never scanned
        (d, "5", "o4", "E", 1),        # empty keyword list -> [''] matches any text
        (dt.date(2024, 1, 10), "6", "o5", "X", 9)],
        "v_date date, issue_no string, order_no string, problem_config_no_3 string, caller_num int")
    calls = spark.createDataFrame([
        (d, 1, "o1", "c1", json.dumps([{"digest": "k1 here"}, {"digest": "y1 then k2"}, {"digest": "y1 again"}])),
        (d, 2, "o1", "c2", json.dumps({"sentenceListData": [{"text": ""}, {"text": "no"}]})),
        (d, 1, "o2", "c3", json.dumps([{"digest": "y1"}])),
        (d, 2, "o4", "c4", json.dumps({"sentenceListData": [{"text": ""}, {"text": "first"}]})),
        (d, 1, "o5", "c5", json.dumps([{"digest": "k1"}]))],
        "v_date date, source int, order_no string, task_no string, result string")
    return rules, tickets, calls


def test_flow_check_semantics(spark):
    rules, tickets, calls = _flow_inputs(spark)
    out = flow_check(rules, tickets, calls, FlowConfig(ticket_dates=("2024-01-15", "2024-01-15")))
    got = {(r.task_no, r.keyword, r.text) for r in out.results.collect()}
    # o1 passes through its X ticket but its type is Y (last ticket): keywords come from Y
    # one row per call record; o2 fails; o3's type has no valid rule; o5 is outside the date window
    assert got == {("c1", "y1", "y1 then k2"), ("c4", "", "first")}
    types = {r.question_type for r in out.rules.collect()}
    assert types == {"X", "Y", "E"}
    x = [r for r in out.rules.collect() if r.question_type == "X"][0]
    assert x.threshold == 3.0 and x.keywords == ["k2", "k1"]


def test_flow_check_without_keywords(spark):
    rules, tickets, calls = _flow_inputs(spark)
    out = flow_check(rules, tickets, calls, FlowConfig(is_keyword=False))
    got = {(r.task_no, r.keyword, r.text) for r in out.results.collect()}
    assert got == {("c1", "null", "k1 here"), ("c2", "null", "no"), ("c4", "null", "first"),
                   ("c5", "null", "k1")}


def test_duplicate_json_keys_last_value_wins(spark):
    """As with a JSON-to-dict parser, a repeated key keeps its last value and
    counts once, so 8 distinct keys pass the guard."""
    m = ('{"userName": "n", "userId": "u", "digest": "good", "content": "", "time": "0", "msgType": "text", '
         '"userFaceUrl": "", "imuserid": "x", "digest": "bad good"}')
    chats = chat_df(spark, [("d", "[" + m + "]", "u", "a")])
    assert result(audit.chat_audit(chats, LEX, SCORER, cfg())) == {"d": ("bad good", 0.5)}


def test_quotes_in_text_keep_the_row(spark):
    """Quote characters broke the reference's string-built INSERT and lost the row."""
    text = 'it\'s "bad" good'
    chats = chat_df(spark, [("q", [msg("u", text)], "u", "a")])
    assert result(audit.chat_audit(chats, LEX, SCORER, cfg())) == {"q": (text, 0.25)}


def test_chinese_text_with_phrase_lexicon(spark):
    """Han text is tokenised per character; a multi-character entry matches the
    joined tokens (substring mode), as entries span several segmenter tokens."""
    chats = chat_df(spark, [("zh", [msg("u", "你们的服务太差了"), msg("u", "谢谢")], "u", "a")])
    scorer = RatioScorer(("差",))
    out = result(audit.chat_audit(chats, ["太差"], scorer, cfg()))
    assert out == {"zh": ("你们的服务太差了", 0.125)}  # 8 character tokens, 1 hit
    assert result(audit.chat_audit(chats, ["太差"], scorer, cfg(sensitive_mode="token"))) == {}


def _odd_records(spark):
    """Two records of one key, a null session, a null time, and one record twice."""
    rows = [(TS, [msg("u", "bad a b")], "s"), (TS, [msg("u", "bad bad")], "s"), (TS, [msg("u", "bad x")], None),
            (None, [msg("u", "bad y")], "t"), (TS, [msg("u", "bad z")], "w"), (TS, [msg("u", "bad z")], "w")]
    return spark.createDataFrame([(t, json.dumps(m), s, "u", "a") for t, m, s in rows],
                                 "create_time timestamp_ntz, chat_records string, session_id string, user_id string, agent_id string")


def test_one_row_per_record_whatever_the_lexicon_size(spark):
    chats = _odd_records(spark)
    lex = spark.createDataFrame([("bad",)], "entry string")
    canned = spark.createDataFrame([("bad q",)], "sentence string")
    for mode in ("substring", "token"):
        for most, chars in ((20_000, 0), (0, 100), (0, 0)):  # inline entries, the automaton, the join path
            out = audit.chat_audit(chats, lex, SCORER, cfg(max_inline_lexicon=most, max_automaton_chars=chars, sensitive_mode=mode), canned).collect()
            assert sorted(r.problem_text for r in out) == ["bad a b", "bad bad", "bad x", "bad y", "bad z", "bad z"]


def test_large_lexicon_reports_the_sentence_that_was_hit(spark):
    """Another record of the same key must not lend its hit."""
    chats = chat_df(spark, [("k", [msg("u", "lexhit bad a b c")], "u", "a"), ("k", [msg("u", "bad bad")], "u", "a")])
    lex = spark.createDataFrame([("lexhit",)], "entry string")
    for most, chars in ((20_000, 0), (0, 100), (0, 0)):
        assert result(audit.chat_audit(chats, lex, SCORER, cfg(max_inline_lexicon=most, max_automaton_chars=chars))) == {"k": ("lexhit bad a b c", 0.2)}


def test_speech_records_of_one_key_stay_apart(spark):
    say = lambda *w: json.dumps({"sentenceListData": [{"text": "x", "wordList": list(w)}]})
    d = dt.date(2024, 1, 15)
    rows = [("t", "o", 0.5, say("bad", "a", "b", "c", "d"), d), ("t", "o", 0.5, say("bad", "bad", "b", "c", "d"), d),
            (None, "o", 0.5, say("bad", "e", "f", "g", "h"), d), ("r", "o", 0.5, say("bad", "i", "j", "k", "l"), d),
            ("r", "o", 0.5, say("bad", "i", "j", "k", "l"), d)]
    speech = spark.createDataFrame(rows, "task_no string, order_no string, score_qingxu double, result string, v_date date")
    assert audit.speech_audit(speech, LEX, SCORER, cfg()).count() == 5


def test_upper_case_entries_match(spark):
    chats = chat_df(spark, [("s", [msg("u", "bad APP")], "u", "a")])
    for mode in ("substring", "token"):
        assert result(audit.chat_audit(chats, ["APP"], SCORER, cfg(sensitive_mode=mode))) == {"s": ("bad APP", 0.5)}


def test_rules_and_tickets_that_do_not_parse_are_skipped(spark):
    """A null keyword text fails to split, a null or odd count fails to convert, a null date
    fails to format: each such row is skipped before anything is learned from it."""
    rules = spark.createDataFrame([(1, "X", "2", "k1"), (2, "X", "2", None), (3, "Y", "2", "y1")],
                                  "rule_id int, question_type string, caller_threshold string, key_words string")
    d = dt.date(2024, 1, 15)
    tickets = spark.createDataFrame(
        [(d, "1", "o", "X", "5"), (d, "2", "o", "Y", None), (d, "3", "o", "Y", "n/a"), (None, "4", "o", "Y", "9")],
        "v_date date, issue_no string, order_no string, problem_config_no_3 string, caller_num string")
    calls = spark.createDataFrame([(d, 1, "o", "c", json.dumps([{"digest": "hello"}, {"digest": "y1"}, {"digest": "k1 here"}]))],
                                  "v_date date, source int, order_no string, task_no string, result string")
    out = flow_check(rules, tickets, calls, FlowConfig())
    assert [(r.keyword, r.text) for r in out.results.collect()] == [("k1", "k1 here")]
    assert out.orders.first().n_tickets == 1


def test_check_date_applies_where_calls_carry_one(spark):
    rules, tickets, calls = _flow_inputs(spark)
    dated = calls.withColumn("compute_date", F.when(F.col("task_no") == "c1", F.lit("2024-01-16")).otherwise("2024-01-15").cast("date"))
    run = lambda day: {r.task_no for r in flow_check(rules, tickets, dated, FlowConfig(check_date=day)).results.collect()}
    assert run("2024-01-16") == {"c1"} and "c1" not in run("2024-01-15")


def test_incomplete_records_are_quarantined(spark):
    whole, no_digest = msg("u", "x"), msg("u", "x")
    no_digest["other"] = no_digest.pop("digest")
    chats = chat_df(spark, [("ok", [whole], "u", "a"), ("mis", [whole, no_digest], "u", "a")])
    d, words = dt.date(2024, 1, 15), json.dumps({"sentenceListData": [{"text": "a", "wordList": ["a"]}]})
    speech = spark.createDataFrame(
        [("ok", "o", 0.1, words, d), ("nul", "o", None, words, d), ("mis", "o", 0.1, '{"sentenceListData": [{"text": "a"}]}', d)],
        "task_no string, order_no string, score_qingxu double, result string, v_date date")
    assert {(r.kind, r.record_id): r.reason for r in parse.quarantine(chats, speech).collect()} == {
        ("chat", "mis"): "missing_field", ("speech", "nul"): "null_emotion", ("speech", "mis"): "missing_field"}


def test_rule_layout_is_checked(spark):
    from convaudit import schemas

    _, tickets, calls = _flow_inputs(spark)
    with pytest.raises(schemas.SchemaMismatch):
        flow_check(spark.createDataFrame([("X", "1")], "question_type string, key_words string"), tickets, calls, FlowConfig())
