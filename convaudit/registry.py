"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the test tables of ``sf_dir`` in full (through the fixture
views of ``convaudit.sources.fixtures``) and returns a DataFrame whose columns
are aliased exactly as in the matching SQL of ``convaudit.oracle_queries``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit import schemas
from convaudit.config import SOURCE_CHAT, SOURCE_SPEECH, AuditConfig, FlowConfig
from convaudit.functions import automaton
from convaudit.functions.lexicon import sensitive
from convaudit.functions.text import clean_tokens, compare, ratio_score, split_ws, tokenize
from convaudit.ml import registry
from convaudit.ml import train as ml_train
from convaudit.ml.features import FeatureConfig, fit_features, with_tokens
from convaudit.ml.score import ModelScorer, neg_prob, predict_label
from convaudit.ml.train import TrainConfig
from convaudit.operators import evaluate, flow, parse
from convaudit.operators import lexicon as lexops
from convaudit.operators.score import RatioScorer, blend, mean_of
from convaudit.operators.shuffle import shuffled
from convaudit.operators.select import argmax, argmax_window, choose, speaker_bests
from convaudit.plans import audit, training
from convaudit.plans import ticket_flow as flowplan
from convaudit.sources import fixtures as fx
from convaudit.session import ensure_checkpoint_dir
from convaudit.sources import tables
from convaudit.sources.sinks import FLOW_PARTITIONS, write_bucketed, write_partitioned

#: Buckets of the serving tables; a cluster takes as many as its largest day needs.
SERVING_BUCKETS = 8
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _flow(spark: SparkSession, sf: str, cfg: FlowConfig = FlowConfig()):
    return flowplan.flow_check(fx.rules(spark, sf), fx.tickets(spark, sf), fx.calls(spark, sf), cfg)


# ---------------------------------------------------------------- flow check

@query
def rule_parse(spark, sf):
    r = flow.parse_rules(fx.rules(spark, sf))
    return r.select("question_type", F.col("threshold").alias("caller_threshold"),
                    F.array_join("keywords", "#").alias("key_words"),
                    F.size("keywords").cast("int").alias("n_keywords"))


@query
def ticket_scan(spark, sf):
    t = flow.scan_tickets(fx.tickets(spark, sf), flow.parse_rules(fx.rules(spark, sf)), fx.TICKET_DATES)
    return t.select(F.date_format("v_date", "yyyy-MM-dd").alias("v_date"), "issue_no", "order_no",
                    "problem_config_no_3", "caller_num")


@query
def ticket_threshold(spark, sf):
    t = _flow(spark, sf).tickets.where(F.col("passes"))
    return t.select(F.date_format("v_date", "yyyy-MM-dd").alias("v_date"), "issue_no", "order_no",
                    "problem_config_no_3", "caller_num", "threshold")


@query
def order_type_last(spark, sf):
    return _flow(spark, sf).orders.select("order_no", "question_type", "n_tickets")


@query
def call_scan(spark, sf):
    o = _flow(spark, sf).orders
    c = flow.scan_calls(fx.calls(spark, sf), o, fx.CALL_DATES, fx.CALL_DATE)
    return c.select("task_no", "order_no", "source", "question_type")


@query
def call_keywords(spark, sf):
    c = _flow(spark, sf).calls
    return c.select("task_no", "order_no", "question_type", F.array_join("keywords", "#").alias("key_words"))


@query
def flow_first_keyword(spark, sf):
    """Keyword hit for every call whose order has a known type (no threshold filter)."""
    rules_p = flow.parse_rules(fx.rules(spark, sf))
    t = flow.ticket_thresholds(flow.scan_tickets(fx.tickets(spark, sf), rules_p), rules_p)
    orders = flow.order_info(t).withColumn("passes", F.lit(True))
    c = flow.attach_keywords(flow.scan_calls(fx.calls(spark, sf), orders), rules_p)
    return flow.flow_rows(flow.flow_results(c, is_keyword=True))


@query
def flow_first_sentence(spark, sf):
    return _flow(spark, sf, FlowConfig(is_keyword=False)).results


@query
def flow_check(spark, sf):
    return _flow(spark, sf).results


@query
def flow_summary(spark, sf):
    return _flow(spark, sf).summary


# ---------------------------------------------------------------- sources

@query
def lexicon_lines(spark, sf):
    """Each benchmark text read as a word-list file: its lines as entries."""
    b = fx.table(spark, sf, "benchmark")
    e = b.select("item_id", F.posexplode(lexops.lines_of("text")).alias("line_no", "entry"))
    return e.select("item_id", F.col("line_no").cast("int").alias("line_no"), "entry",
                    F.length("entry").cast("int").alias("n_chars"))


@query
def chat_day_scan(spark, sf):
    """Events of one day; the half-open range on ``ts`` reaches the parquet scan."""
    e = tables.day_scan(fx.table(spark, sf, "events"), "ts", fx.EVENT_DAY)
    return e.select("event_id", "user_id", "event_type",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def speech_day_scan(spark, sf):
    """Orders of one order date (the speech table's date partition), date as text."""
    o = tables.day_scan(fx.table(spark, sf, "orders"), "o_orderdate", fx.ORDER_DAY)
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("v_date"))


# ---------------------------------------------------------------- parsing

def _chat(spark, sf):
    return fx.chat_json(spark, sf)


@query
def chat_explode(spark, sf):
    m = parse.chat_messages(_chat(spark, sf))
    return m.select("session_id", "pos", "n_keys", "user_key", "digest")


@query
def chat_arity_guard(spark, sf):
    m = parse.keep_arity(parse.chat_messages(_chat(spark, sf)))
    return m.select("session_id", "pos", "user_key")


@query
def speaker_split(spark, sf):
    m = parse.split_speakers(parse.keep_arity(parse.chat_messages(_chat(spark, sf))))
    return m.select("session_id", "pos", "speaker")


@query
def canned_anti(spark, sf):
    m = parse.chat_sentences(_chat(spark, sf), fx.canned(spark, sf))
    return m.select("session_id", "pos", "speaker")


@query
def speech_explode(spark, sf):
    s = parse.speech_sentences(fx.speech_json(spark, sf))
    return s.select("task_no", "pos", "text", F.size("words").cast("int").alias("n_words"))


@query
def speech_min_words(spark, sf):
    s = parse.keep_min_words(parse.speech_sentences(fx.speech_json(spark, sf)))
    return s.select("task_no", "pos", F.size("words").cast("int").alias("n_words"))


@query
def json_quarantine(spark, sf):
    return parse.quarantine(_chat(spark, sf), fx.speech_json(spark, sf), fx.calls(spark, sf))


@query
def flow_sentences(spark, sf):
    s = parse.flow_sentences(fx.calls(spark, sf))
    return s.select("task_no", "source", "pos", "text")


# ---------------------------------------------------------------- text

@query
def tokenize_corpus(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", F.size(tokenize("text")).cast("int").alias("n_tokens"))


@query
def token_clean(spark, sf):
    """Whitespace tokens of every turn, cleaned; turns with nothing left are skipped."""
    c = fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", split_ws(F.coalesce(F.col("text"), F.lit(""))).alias("raw"))
    c = c.withColumn("clean", clean_tokens("raw"))
    return c.where(F.size("clean") > 0).select(
        "conv_id", "turn", F.size("raw").cast("int").alias("n_raw"), F.size("clean").cast("int").alias("n_clean"))


@query
def vocab_counts(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select(F.explode(tokenize("text")).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))


def _chat_tokens(spark, sf):
    m = parse.chat_sentences(_chat(spark, sf), fx.canned(spark, sf))
    return m.withColumn("tokens", clean_tokens(tokenize("digest")))


@query
def sensitive_token(spark, sf):
    m = _chat_tokens(spark, sf).where(sensitive(F.col("tokens"), fx.TERMS, "token"))
    return m.select("session_id", "pos")


@query
def sensitive_substring(spark, sf):
    m = _chat_tokens(spark, sf).where(sensitive(F.col("tokens"), [*fx.TERMS, fx.MIXED_CASE_ENTRY + "ER"], "substring"))
    return m.select("session_id", "pos")


def _large_lexicon(spark, sf):
    """The long words of the documents as a word-list file, one entry a line, read back."""
    path = _folder(spark, "lexicon")
    fx.large_lexicon(spark, sf).write.text(path)
    return lexops.read_lexicon(spark, path)


@query
def sensitive_automaton(spark, sf):
    """P11 over a large lexicon: one automaton, no explode and no join; beyond the driver's bound one for each group of texts."""
    lexicon = _large_lexicon(spark, sf)
    entries = lexops.bounded_entries(lexicon, AuditConfig().max_automaton_chars)
    m = _chat_tokens(spark, sf).where(F.size("tokens") > 0)
    if entries is None:
        return lexops.semi_join_lexicon(m, lexicon).select("session_id", "pos")
    hit = automaton.hits(spark, F.array(F.concat_ws("", "tokens")), entries)
    return m.select("session_id", "pos", hit.alias("hit")).where(F.get("hit", 0)).select("session_id", "pos")


@query
def lexicon_semi(spark, sf):
    """The token test as a join against the lexicon table."""
    return lexops.token_hits(_chat_tokens(spark, sf), fx.terms_df(spark), ["session_id", "pos"])


def _cfg(**kw):
    base = dict(chat_threshold=fx.TEST_THRESHOLD, speech_threshold=fx.TEST_THRESHOLD)
    base.update(kw)
    return AuditConfig(**base)


@query
def threshold_modes(spark, sf):
    """How many candidate sentences pass the test threshold under each comparison."""
    s = RatioScorer(tuple(fx.TERMS))(audit.chat_candidates(_chat(spark, sf), fx.TERMS, _cfg(),
                                                            fx.canned(spark, sf)))
    t = fx.TEST_THRESHOLD
    return s.agg(*[F.sum(compare(F.col("score"), op, t).cast("int")).cast("long").alias(name)
                   for op, name in [(">", "n_gt"), (">=", "n_ge"), ("<", "n_lt"), ("<=", "n_le")]])


# ---------------------------------------------------------------- selection

def _chat_scored(spark, sf, **kw):
    return audit.chat_scored(_chat(spark, sf), fx.TERMS, RatioScorer(tuple(fx.TERMS)), _cfg(**kw),
                             fx.canned(spark, sf)).withColumnRenamed("digest", "text")


@query
def chat_argmax(spark, sf):
    return argmax(_chat_scored(spark, sf), ["session_id", "speaker"])


@query
def chat_argmax_window(spark, sf):
    return argmax_window(_chat_scored(spark, sf), ["session_id", "speaker"])


def _select(spark, sf, mode):
    b = speaker_bests(_chat_scored(spark, sf), ["session_id"])
    c = b.select("session_id", choose(F.col("u"), F.col("a"), mode).alias("c")).where(F.col("c").isNotNull())
    return c.select("session_id", F.col("c.speaker").alias("speaker"), F.col("c.score").alias("score"),
                    F.col("c.text").alias("text"))


@query
def chat_select_faithful(spark, sf):
    return _select(spark, sf, "faithful")


@query
def chat_select_intended(spark, sf):
    return _select(spark, sf, "intended")


@query
def speech_argmax(spark, sf):
    s = audit.speech_scored(fx.speech_json(spark, sf), fx.TERMS, RatioScorer(tuple(fx.TERMS)), _cfg())
    s = s.withColumn("text", F.concat_ws(" ", "words"))
    return argmax(s, ["task_no"])


@query
def emotion_blend(spark, sf):
    s = parse.speech_sentences(fx.speech_json(spark, sf)).where(F.size("words") > 0)
    s = RatioScorer(tuple(fx.TERMS), tokens="words")(s)
    return s.select("task_no", "pos", blend(F.col("score"), F.col("score_qingxu")).alias("score"))


@query
def ensemble_mean(spark, sf):
    """Mean of three stand-in model scores per spoken chat sentence (A10)."""
    m = _chat_tokens(spark, sf).where(F.size("tokens") > 0)
    parts = [ratio_score("tokens", fx.TERMS), ratio_score("tokens", fx.TERMS[:4]),
             ratio_score("tokens", fx.TERMS[4:])]
    return m.select("session_id", "pos", mean_of(parts).alias("p_neg"))


# ---------------------------------------------------------------- audits

def _chat_audit(spark, sf, **kw):
    return audit.chat_audit(_chat(spark, sf), fx.TERMS, RatioScorer(tuple(fx.TERMS)), _cfg(**kw),
                            fx.canned(spark, sf))


def _speech_audit(spark, sf, **kw):
    return audit.speech_audit(fx.speech_json(spark, sf), fx.TERMS, RatioScorer(tuple(fx.TERMS)), _cfg(**kw))


@query
def chat_audit(spark, sf):
    return _chat_audit(spark, sf)


@query
def chat_audit_large_lexicon(spark, sf):
    """Q1 over the large lexicon, read from its file: the automaton inside each record's row."""
    return audit.chat_audit(_chat(spark, sf), _large_lexicon(spark, sf), RatioScorer(tuple(fx.TERMS)), _cfg(), fx.canned(spark, sf))


@query
def chat_audit_joined_lexicon(spark, sf):
    """Q1 over a lexicon beyond all bounds: the same rows by the join path."""
    return audit.chat_audit(_chat(spark, sf), fx.terms_df(spark), RatioScorer(tuple(fx.TERMS)),
                            _cfg(max_inline_lexicon=0, max_automaton_chars=0), fx.canned(spark, sf))


@query
def speech_audit(spark, sf):
    return _speech_audit(spark, sf)


@query
def audit_union(spark, sf):
    return audit.audit_union(_chat_audit(spark, sf), _speech_audit(spark, sf))


@query
def integrate_results(spark, sf):
    return audit.integrate(audit.audit_union(_chat_audit(spark, sf), _speech_audit(spark, sf)),
                           fx.calls(spark, sf))


@query
def integrate_bucketed(spark, sf):
    """J7 over bucketed tables: results and calls written in buckets, one day joined without a shuffle."""
    name = uuid.uuid4().hex
    results = audit.audit_union(_chat_audit(spark, sf), _speech_audit(spark, sf))
    calls = fx.calls(spark, sf).select(F.date_format("v_date", "yyyy-MM-dd").alias("v_date"), "task_no", "order_no", "source")
    for df, table, key in ((results, f"results_{name}", "record_id"), (calls, f"calls_{name}", "task_no")):
        write_bucketed(df, table, _folder(spark, table), key, SERVING_BUCKETS)
    return audit.integrate_day(spark.table(f"results_{name}"), spark.table(f"calls_{name}"), fx.CALL_DATE)


@query
def layout_check(spark, sf):
    """Every record of the whole source tables, whose columns are checked one by one."""
    out = None
    for kind, names, schema, rows in (("chat", schemas.CHAT_TABLE, schemas.CHAT_RECORD, _chat(spark, sf)),
                                      ("speech", schemas.SPEECH_TABLE, schemas.SPEECH_RECORD, fx.speech_json(spark, sf))):
        whole = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names])
        read = schemas.require_table(whole, names, schema, kind)
        record = "session_id" if kind == "chat" else "task_no"
        part = read.select(F.lit(kind).alias("kind"), F.col(record).alias("record_id"), F.lit(len(whole.columns)).alias("n_columns"),
                           F.lit(len(read.columns)).alias("n_read"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def daily_audit(spark, sf):
    """Q5: chat and speech audits of the day, unioned and integrated."""
    return audit.daily_audit(_chat(spark, sf), fx.speech_json(spark, sf), fx.calls(spark, sf),
                                  fx.TERMS, RatioScorer(tuple(fx.TERMS)), _cfg(prediction_date=fx.CALL_DATE),
                                  fx.canned(spark, sf))


# ---------------------------------------------------------------- sinks

def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/queries/{name}-{uuid.uuid4().hex}"


@query
def audit_sink_rerun(spark, sf):
    """Both audits written, then the first day written again with no speech row."""
    path, rows = _folder(spark, "audits"), audit.audit_union(_chat_audit(spark, sf), _speech_audit(spark, sf))
    write_partitioned(rows, path)
    day = [{"v_date": fx.CALL_DATE, "source": s} for s in (SOURCE_CHAT, SOURCE_SPEECH)]
    write_partitioned(_chat_audit(spark, sf).where(F.col("v_date") == fx.CALL_DATE), path, targets=day)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query
def flow_sink_two_days(spark, sf):
    """The flow check of two consecutive days; neither run touches the other's rows."""
    path = _folder(spark, "flow")
    for check, first, last in fx.FLOW_DAYS:
        rows = _flow(spark, sf, FlowConfig(call_dates=(first, last), check_date=check)).results
        rows = rows.select(F.lit(check).alias("check_date"), "*")
        write_partitioned(rows, path, FLOW_PARTITIONS, targets=[{"check_date": check}])
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


# ---------------------------------------------------------------- evaluation

def _label_pred(spark, sf):
    """Labels with a stand-in hard prediction: quality is the label, 1 - toxic the prediction."""
    lab = fx.table(spark, sf, "labels")
    return lab.select("doc_id", F.col("quality").cast("double").alias("label"),
                      (F.lit(1) - F.col("toxic")).cast("double").alias("prediction"))


@query
def eval_accuracy(spark, sf):
    return evaluate.accuracy(_label_pred(spark, sf))


@query
def eval_auc_hard(spark, sf):
    return evaluate.auc_hard(_label_pred(spark, sf))


@query
def eval_auc_rank(spark, sf):
    """Rank AUC of document length as a score for the quality label."""
    d = fx.table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score"))
    lab = fx.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return evaluate.auc_rank(d.join(lab, "doc_id"))


@query
def train_corpus(spark, sf):
    pos, neg = evaluate.split_corpus(fx.labelled(spark, sf))
    c = evaluate.tagged_corpus(pos, neg)
    return c.select("doc_id", "tag", "label", F.size(clean_tokens(tokenize("text"))).cast("int").alias("n_tokens"))


@query
def train_shuffle(spark, sf):
    """The labelled rows' places in a seeded order."""
    return shuffled(fx.labelled(spark, sf), ["doc_id"]).select("doc_id", "label", "place")


@query
def train_test_split(spark, sf):
    s = evaluate.assign_split(fx.labelled(spark, sf))
    return s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- ML (rows-only checks)
# The library's settings: 2 x 400 columns, 5000 LR iterations at most, 300 trees.
ML_FEATURES = FeatureConfig()
ML_CFG = TrainConfig(features=ML_FEATURES)


def _split(spark, sf):
    return training.split(fx.labelled(spark, sf))


@query
def features_two_view(spark, sf):
    lab = with_tokens(fx.labelled(spark, sf), ML_FEATURES)
    v = fit_features(lab, ML_FEATURES).transform(lab)
    return v.select("doc_id", "label", vector_to_array("features").alias("_f")).select(
        "doc_id", "label", F.size("_f").cast("int").alias("dim"),
        F.round(F.aggregate("_f", F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))


def _fit_one(spark, sf, name):
    train, test = _split(spark, sf)
    return ml_train.FITTERS[name](train, ML_CFG), test


@query
def lr_neg_prob(spark, sf):
    m, test = _fit_one(spark, sf, "lr")
    return neg_prob(m, test.select("doc_id", "text", "label")).drop("text")


@query
def rf_neg_prob(spark, sf):
    m, test = _fit_one(spark, sf, "rf")
    return neg_prob(m, test.select("doc_id", "text", "label")).drop("text")


@query
def gbt_neg_prob(spark, sf):
    m, test = _fit_one(spark, sf, "gbt")
    return neg_prob(m, test.select("doc_id", "text", "label")).drop("text")


@query
def regress_score(spark, sf):
    m, test = _fit_one(spark, sf, "regressor")
    return predict_label(m, test.select("doc_id", "text", "label"), "score").drop("text")


@query
def predict_label_lr(spark, sf):
    m, test = _fit_one(spark, sf, "lr")
    return predict_label(m, test.select("doc_id", "text", "label")).drop("text")


@query
def ensemble_neg_prob(spark, sf):
    train, test = _split(spark, sf)
    return training.score_test(training.fit_models(train, ("lr", "rf"), ML_CFG), test)


@query
def ml_output_check(spark, sf):
    """What SQL can know of the models' outputs on held-out rows: P(negative) within 0 to 1, hard
    labels that agree with it, the ensemble as the mean of its parts."""
    train, test = _split(spark, sf)
    models = training.fit_models(train, ("lr", "rf"), ML_CFG)
    p = training.score_test(models, test)
    for name, m in models.items():
        p = p.join(predict_label(m, test.select("doc_id", "text")).select("doc_id", F.col("prediction").alias(f"_{name}")), "doc_id")
    parts = [F.col(f"p_{n}") for n in models]
    in_range, agrees = F.lit(True), F.lit(True)
    for n, c in zip(models, parts):
        in_range = in_range & c.between(0.0, 1.0)
        agrees = agrees & ((c == 0.5) | ((F.col(f"_{n}") == 0.0) == (c > 0.5)))
    mean = F.abs(F.col("p_neg") - mean_of(parts)) < 1e-12
    return p.select("doc_id", "label", in_range.alias("in_range"), agrees.alias("labels_agree"), mean.alias("mean_of_parts"))


@query
def model_reload(spark, sf):
    """A model saved twice and the latest version loaded; its scores are the fitted model's."""
    train, test = _split(spark, sf)
    root, m = _folder(spark, "models"), ml_train.fit_lr(train, ML_CFG)
    for version in ("20240101-000000", "20240102-000000"):
        registry.save_model(spark, m, root, "lr", version=version)
    rows = test.select("doc_id", "text", "label")
    both = neg_prob(m, rows, "p").join(neg_prob(registry.load_model(spark, root, "lr"), rows.select("doc_id", "text"), "q").drop("text"), "doc_id")
    return both.select("doc_id", "label", (F.abs(F.col("p") - F.col("q")) < 1e-12).alias("same"),
                       F.lit(registry.latest_version(spark, root, "lr")).alias("version"))


@query
def model_report(spark, sf):
    train, test = _split(spark, sf)
    return training.report(training.fit_models(train, ("lr", "rf", "gbt", "regressor"), ML_CFG), test)


@query
def chat_audit_lr(spark, sf):
    """Q1 with a logistic-regression scorer trained on the labelled corpus."""
    train, _ = _split(spark, sf)
    scorer = ModelScorer([ml_train.fit_lr(train, ML_CFG)])
    return audit.chat_audit(_chat(spark, sf), fx.TERMS, scorer, _cfg(chat_threshold=fx.LR_THRESHOLD), fx.canned(spark, sf))


@query
def speech_audit_lr(spark, sf):
    """Q2 with the same scorer."""
    train, _ = _split(spark, sf)
    scorer = ModelScorer([ml_train.fit_lr(train, ML_CFG)])
    return audit.speech_audit(fx.speech_json(spark, sf), fx.TERMS, scorer, _cfg(speech_threshold=fx.LR_THRESHOLD))
