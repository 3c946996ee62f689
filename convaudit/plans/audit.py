"""Q1 chat audit, Q2 speech audit, Q5 daily audit.

Both audits are: parse the record's JSON into sentences, tokenise and clean,
keep sentences with tokens left that contain a sensitive word (the cheap,
side-effect-free predicates run *before* scoring, so the scorer only sees
candidates), score, apply the sentence threshold, then pick the best sentence
per record with one partially aggregated ``max(struct)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit import schemas
from convaudit.config import SOURCE_CHAT, SOURCE_SPEECH, AuditConfig
from convaudit.functions import automaton
from convaudit.functions.lexicon import sensitive
from convaudit.functions.text import clean_tokens, compare, lower_all, tokenize
from convaudit.operators import lexicon as lexops
from convaudit.operators import parse
from convaudit.operators.score import blend
from convaudit.operators.select import choose, record_bests
from convaudit.operators.util import keep_where, present
from convaudit.sources.tables import day_scan

Scorer = Callable[[DataFrame], DataFrame]
Lexicon = Sequence[str] | DataFrame


def _folded(lexicon: Lexicon) -> Lexicon:
    """Entries in lower case, as the tokens are."""
    if isinstance(lexicon, DataFrame):
        return lexicon.select(F.lower(F.col(lexicon.columns[0])).alias("entry"))
    return lexicon  # ``sensitive`` folds a list


@dataclass(frozen=True)
class KnownLexicon:
    """Entries within a bound, and whether they are tested by an expression or by an automaton."""

    entries: list[str]
    automaton: bool = False


def known_lexicon(lexicon: Lexicon, cfg: AuditConfig) -> KnownLexicon | None:
    """The lexicon if it is small enough to be known when the plan is made (at most two small jobs find out)."""
    lexicon = _folded(lexicon)
    if not isinstance(lexicon, DataFrame) and (len(lexicon) <= cfg.max_inline_lexicon or cfg.sensitive_mode != "substring"):
        return KnownLexicon([e for e in lexicon if e is not None])
    if isinstance(lexicon, DataFrame):
        entries = lexops.inline_entries(lexicon, cfg.max_inline_lexicon)
        if entries is not None:
            return KnownLexicon(entries)
        if cfg.sensitive_mode != "substring":
            return None
    entries = lexops.bounded_entries(lexicon, cfg.max_automaton_chars)
    return None if entries is None else KnownLexicon([e.lower() for e in entries], True)


def _with_sensitive(df: DataFrame, lexicon: Lexicon, cfg: AuditConfig) -> DataFrame:
    """Keep rows whose ``tokens`` hit the lexicon: an expression, an automaton or a join, by its size."""
    known = known_lexicon(lexicon, cfg)
    if known is None:
        return lexops.semi_join_lexicon(df, _folded(lexicon), cfg.sensitive_mode)
    if not known.automaton:
        return df.where(sensitive(F.col("tokens"), known.entries, cfg.sensitive_mode))
    hit = automaton.hits(df.sparkSession, F.array(F.concat_ws("", "tokens")), known.entries)
    return df.withColumn("_hit", hit).where(F.get("_hit", 0)).drop("_hit")


def chat_candidates(chat: DataFrame, lexicon: Lexicon, cfg: AuditConfig,
                    canned: DataFrame | None = None) -> DataFrame:
    """Spoken chat sentences with tokens that hit the lexicon."""
    s = parse.chat_sentences(chat, canned, cfg.message_keys)
    s = s.withColumn("tokens", clean_tokens(tokenize(F.col("digest"), cfg.han_mode), cfg.filter_chars))
    s = s.where(F.size("tokens") > 0)
    return _with_sensitive(s, lexicon, cfg)


def chat_scored(chat: DataFrame, lexicon: Lexicon, scorer: Scorer, cfg: AuditConfig,
                canned: DataFrame | None = None) -> DataFrame:
    """Candidates that pass the sentence threshold (strict ``>`` by default)."""
    s = scorer(chat_candidates(chat, lexicon, cfg, canned))
    op = cfg.sentence_op or ">"
    # only a positive score can beat the initial best of 0.0
    return keep_where(s, "score", lambda x: compare(x, op, cfg.chat_threshold) & (x > 0))


@dataclass(frozen=True)
class InRow:
    """What the in-row path needs: the lexicon, canned sentences, and a scorer of one of two kinds."""

    lexicon: KnownLexicon
    canned: list[str]
    column: Callable[[Column], Column] | None  # of a token array
    scores: Callable[[Column], Column] | None  # of an array of token arrays


def _in_row(spark: SparkSession, lexicon: Lexicon, scorer: Scorer, cfg: AuditConfig, canned: DataFrame | None) -> InRow | None:
    """The in-row path's inputs, when it applies, else None.

    It applies when the scorer is an expression of a token array or can score all
    sentences of a record, and the lexicon and canned table are within their bounds (measured).
    """
    if not cfg.inline or not (hasattr(scorer, "column") or hasattr(scorer, "row_scores")):
        return None
    known = known_lexicon(lexicon, cfg)
    if known is None:
        return None
    sentences: list[str] = []
    if canned is not None:
        sentences = lexops.inline_entries(canned.select("sentence"), cfg.max_inline_canned)
        if sentences is None:
            return None
    if hasattr(scorer, "column"):
        return InRow(known, sentences, scorer.column, None)
    scores = scorer.row_scores(spark)
    return None if scores is None else InRow(known, sentences, None, scores)


def _hits_in_row(df: DataFrame, keys: Sequence[str], cands: Column, lexicon: KnownLexicon, cfg: AuditConfig) -> DataFrame:
    """``keys`` and ``_c``: the elements of ``cands`` (with ``tokens``) that hit the lexicon."""
    if not lexicon.automaton:
        return df.select(*keys, F.filter(cands, lambda x: sensitive(x["tokens"], lexicon.entries, cfg.sensitive_mode)).alias("_c"))
    joined = F.transform("_c", lambda x: F.concat_ws("", x["tokens"]))
    tested = df.select(*keys, cands.alias("_c")).select(*keys, "_c", automaton.hits(df.sparkSession, joined, lexicon.entries).alias("_h"))
    return tested.select(*keys, F.transform(F.filter(F.arrays_zip("_c", "_h"), lambda z: z["_h"]), lambda z: z["_c"]).alias("_c"))


def _scores_in_row(df: DataFrame, keys: Sequence[str], inputs: InRow, element: Callable[[Column, Column], Column]) -> DataFrame:
    """``keys`` and ``_e``: ``element(candidate, score)`` of every element of ``_c``."""
    if inputs.column:
        return df.select(*keys, F.transform("_c", lambda x: element(x, inputs.column(x["tokens"]))).alias("_e"))
    scored = df.select(*keys, "_c", inputs.scores(F.transform("_c", lambda x: x["tokens"])).alias("_s"))
    return scored.select(*keys, F.zip_with("_c", "_s", element).alias("_e"))


def _chat_pick_inline(chat: DataFrame, inputs: InRow, cfg: AuditConfig) -> DataFrame:
    """``create_time, session_id, c``: the chosen (speaker, score, text) of each
    chat record, computed inside its row.

    Same steps as the exploded plan — 8-key guard, speaker, canned, tokens,
    lexicon, score, sentence threshold, best per speaker, choice — over the record's
    message array: no explode, no shuffle, one result per input record. Expressions are
    higher-order functions; an automaton and models get all sentences of a batch of records. The candidate array and the two
    bests are separate projections, so each is evaluated once per row even
    though the choice refers to them several times.
    """
    msgs = parse.whole_json(F.col("chat_records"), schemas.CHAT_JSON)

    def cand(m, i):
        return F.struct(parse.n_keys(m).alias("n_keys"), i.alias("pos"), parse.field(m, "digest").alias("text"),
                        parse.speaker_of(parse.field(m, "userId"), F.col("user_id"), F.col("agent_id"))
                        .alias("speaker"))

    def spoken(x):  # cheap tests first: key count, speaker, canned text
        ok = (x["n_keys"] == cfg.message_keys) & x["speaker"].isNotNull()
        if inputs.canned:
            ok = ok & ~F.coalesce(F.trim(x["text"]).isin(*inputs.canned), F.lit(False))
        return ok

    def tokens(x):
        return F.struct(x["pos"].alias("pos"), x["text"].alias("text"), x["speaker"].alias("speaker"),
                        clean_tokens(tokenize(x["text"], cfg.han_mode), cfg.filter_chars).alias("tokens"))

    cands = F.filter(F.transform(F.filter(F.transform(msgs, cand), spoken), tokens), lambda x: F.size(x["tokens"]) > 0)
    keys = ["create_time", "session_id"]
    hit = _hits_in_row(chat, keys, cands, inputs.lexicon, cfg)
    scored = _scores_in_row(hit, keys, inputs, lambda x, score: F.struct(
        x["speaker"].alias("speaker"),
        F.struct(score.alias("score"), (-x["pos"]).alias("neg_pos"), x["text"].alias("text")).alias("b")))
    op = cfg.sentence_op or ">"
    passing = F.filter("_e", lambda x: compare(x["b"]["score"], op, cfg.chat_threshold) & (x["b"]["score"] > 0))

    def best(who):
        return F.array_max(F.transform(F.filter(F.col("_p"), lambda x: x["speaker"] == who), lambda x: x["b"]))

    p = scored.select(*keys, passing.alias("_p"))
    b = p.select("create_time", "session_id", best("user").alias("_u"), best("agent").alias("_a"))
    ok = lambda c: compare(c["score"], cfg.record_op, cfg.chat_threshold)
    return b.select("create_time", "session_id", present(choose(F.col("_u"), F.col("_a"), cfg.select_mode), ok)
                    .alias("c"))


def chat_audit(chat: DataFrame, lexicon: Lexicon, scorer: Scorer, cfg: AuditConfig = AuditConfig(),
               canned: DataFrame | None = None) -> DataFrame:
    """Q1 -> audit_result rows (source 1).

    With a scorer that is an expression or made of known models, and bounded lexicon/canned tables, the whole audit
    runs inside each record's row (map-only plan); otherwise sentences are
    exploded, scored and reduced per record. Every plan gives one
    row per input record, whatever its key (null, shared or repeated).
    """
    chat = schemas.require(chat, schemas.CHAT_RECORD, "chat_record")
    inline = _in_row(chat.sparkSession, lexicon, scorer, cfg, canned)
    if inline is not None:
        pick = _chat_pick_inline(chat, inline, cfg)
    else:
        s = chat_scored(chat, lexicon, scorer, cfg, canned).withColumnRenamed("digest", "text")
        best = record_bests(s, parse.CHAT_KEYS + parse.PAYLOAD_HASH, speaker="speaker")
        pick = best.select("create_time", "session_id", choose(F.col("u"), F.col("a"), cfg.select_mode).alias("c"))
        pick = pick.where(F.col("c").isNotNull() & compare(F.col("c.score"), cfg.record_op, cfg.chat_threshold))
    return pick.select(
        F.date_format("create_time", "yyyy-MM-dd").alias("v_date"),
        F.date_format("create_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.lit(SOURCE_CHAT).cast("int").alias("source"),
        F.col("session_id").alias("record_id"),
        F.col("c.text").alias("problem_text"),
        F.col("c.score").alias("score"),
    )


def speech_candidates(speech: DataFrame, lexicon: Lexicon, cfg: AuditConfig) -> DataFrame:
    """Recognised sentences of >= min_words words whose cleaned tokens hit the lexicon."""
    s = parse.keep_min_words(parse.speech_sentences(speech), cfg.min_words)
    s = s.withColumn("tokens", clean_tokens(lower_all(F.col("words")), cfg.filter_chars)).where(F.size("tokens") > 0)
    return _with_sensitive(s, lexicon, cfg)


def speech_scored(speech: DataFrame, lexicon: Lexicon, scorer: Scorer, cfg: AuditConfig) -> DataFrame:
    """Candidates with the emotion-blended score that pass the sentence threshold."""
    s = scorer(speech_candidates(speech, lexicon, cfg))
    s = s.withColumn("score", blend(F.col("score"), F.col("score_qingxu"), cfg.emotion_weights))
    op = cfg.sentence_op or ">="
    return keep_where(s, "score", lambda x: compare(x, op, cfg.speech_threshold) & (x > 0))


def _speech_best_inline(speech: DataFrame, inputs: InRow, cfg: AuditConfig) -> DataFrame:
    """``v_date, task_no, _b``: the best (score, -pos, text) of each speech record, computed inside its row."""
    sents = parse.whole_json(F.col("result"), schemas.SPEECH_JSON)["sentenceListData"]

    def cand(s, i):
        return F.struct(i.alias("pos"), s["wordList"].alias("words"),
                        clean_tokens(lower_all(s["wordList"]), cfg.filter_chars).alias("tokens"))

    cands = F.filter(F.transform(sents, cand), lambda x: (F.size(x["words"]) >= cfg.min_words) & (F.size(x["tokens"]) > 0))
    keys = ["v_date", "task_no", "score_qingxu"]
    scored = _scores_in_row(_hits_in_row(speech, keys, cands, inputs.lexicon, cfg), keys, inputs, lambda x, score: F.struct(
        blend(score, F.col("score_qingxu"), cfg.emotion_weights).alias("score"),
        (-x["pos"]).alias("neg_pos"), F.concat_ws(" ", x["words"]).alias("text")))
    op = cfg.sentence_op or ">="
    best = F.array_max(F.filter("_e", lambda x: compare(x["score"], op, cfg.speech_threshold) & (x["score"] > 0)))
    return scored.select("v_date", "task_no", present(best).alias("_b"))


def speech_audit(speech: DataFrame, lexicon: Lexicon, scorer: Scorer, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Q2 -> audit_result rows (source 2); the text is the sentence's words joined by spaces.

    In-row (map-only) with a bounded lexicon and a scorer that is an expression or made of
    known models, else exploded + one partial aggregate.
    """
    speech = schemas.require(speech, schemas.SPEECH_RECORD, "speech_record")
    inline = _in_row(speech.sparkSession, lexicon, scorer, cfg, None)
    if inline is not None:
        best = _speech_best_inline(speech, inline, cfg).select(
            "v_date", "task_no", F.col("_b.score").alias("best_score"), F.col("_b.text").alias("best_text"))
    else:
        s = speech_scored(speech, lexicon, scorer, cfg).withColumn("text", F.concat_ws(" ", "words"))
        best = record_bests(s, parse.SPEECH_KEYS + parse.PAYLOAD_HASH).select(
            "v_date", "task_no", F.col("best.score").alias("best_score"), F.col("best.text").alias("best_text"))
    best = best.where(compare(F.col("best_score"), cfg.record_op, cfg.speech_threshold))
    day = F.date_format("v_date", "yyyy-MM-dd")
    return best.select(
        day.alias("v_date"), day.alias("event_time"),
        F.lit(SOURCE_SPEECH).cast("int").alias("source"),
        F.col("task_no").alias("record_id"),
        F.col("best_text").alias("problem_text"),
        F.col("best_score").alias("score"),
    )


def audit_union(chat_results: DataFrame, speech_results: DataFrame) -> DataFrame:
    """Both sources in one result table."""
    return chat_results.unionByName(speech_results)


def integrate(results: DataFrame, calls: DataFrame) -> DataFrame:
    """Serving rows: results left-joined to the call dimension on (v_date, id).

    The dimension is first reduced to one row per key, so the join can't fan
    out; the aggregate's hash partitioning on the key is reused by the join.
    """
    dim = calls.groupBy(F.date_format("v_date", "yyyy-MM-dd").alias("v_date"),
                        F.col("task_no").alias("record_id")).agg(
        F.max(F.struct("order_no", "source")).alias("_d"))
    dim = dim.select("v_date", "record_id", F.col("_d.order_no").alias("order_no"),
                     F.col("_d.source").alias("call_source"))
    return results.join(dim, ["v_date", "record_id"], "left")


def integrate_day(results: DataFrame, calls: DataFrame, day: str) -> DataFrame:
    """One day's serving rows from bucketed tables (J7, S12): ``integrate`` without a shuffle.

    Both tables lie in folders by ``v_date`` (text) and in equally many buckets, the results by ``record_id``, the calls by
    ``task_no``. Within a day these alone are the join's keys, so the aggregate that reduces the calls to one row
    per key and the join both use the buckets as they lie.
    """
    dim = calls.where(F.col("v_date") == day).groupBy("task_no").agg(F.max(F.struct("order_no", "source")).alias("_d"))
    dim = dim.select("task_no", F.col("_d.order_no").alias("order_no"), F.col("_d.source").alias("call_source"))
    r = results.where(F.col("v_date") == day)
    return r.join(dim, F.col("record_id") == F.col("task_no"), "left").drop("task_no")


def daily_audit(chat: DataFrame, speech: DataFrame, calls: DataFrame, lexicon: Lexicon, scorer: Scorer,
                cfg: AuditConfig = AuditConfig(), canned: DataFrame | None = None) -> DataFrame:
    """Q5: audit one day of chats and calls, union the results, integrate them.

    The day bound is a half-open timestamp range on chats and an equality on
    the speech/call date, so both reach the scan as pushed filters.
    """
    day = cfg.day
    c = day_scan(chat, "create_time", day)
    s = speech.where(F.col("v_date") == F.lit(day).cast("date"))
    k = calls.where(F.col("v_date") == F.lit(day).cast("date"))
    results = audit_union(chat_audit(c, lexicon, scorer, cfg, canned), speech_audit(s, lexicon, scorer, cfg))
    return integrate(results, k)
