"""Plan invariants on the sf0.01 fixtures."""

import os

from pyspark.sql import functions as F

from conftest import SF01
from convaudit.config import AuditConfig
from convaudit.functions.lexicon import sensitive
from convaudit.operators import parse
from convaudit.operators.score import RatioScorer
from convaudit.operators.select import argmax
from convaudit.plans import audit
from convaudit.registry import QUERIES as Q
from convaudit.sources import fixtures as fx
from convaudit.sources.sinks import write_partitioned

def test_argmax_aggregate_equals_window(spark):
    a = Q["chat_argmax"](spark, SF01)
    w = Q["chat_argmax_window"](spark, SF01)
    assert a.count() > 0
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_at_most_one_row_per_record_and_subset_of_input(spark):
    for name, key in [("chat_audit", "record_id"), ("speech_audit", "record_id"), ("flow_check", "task_no")]:
        df = Q[name](spark, SF01)
        assert df.groupBy(key).count().where("count > 1").count() == 0, name
    chat = fx.chat_json(spark, SF01)
    out = Q["chat_audit"](spark, SF01)
    assert out.join(chat, out.record_id == chat.session_id, "left_anti").count() == 0


def test_predicate_order_does_not_change_result(spark):
    """Testing the lexicon after scoring gives the same audit as testing it before."""
    cfg = AuditConfig(chat_threshold=fx.TEST_THRESHOLD)
    early = audit.chat_audit(fx.chat_json(spark, SF01), fx.TERMS, RatioScorer(tuple(fx.TERMS)), cfg,
                             fx.canned(spark, SF01))
    from convaudit.functions.text import clean_tokens, compare, tokenize
    s = parse.chat_sentences(fx.chat_json(spark, SF01), fx.canned(spark, SF01))
    s = s.withColumn("tokens", clean_tokens(tokenize("digest")))
    s = RatioScorer(tuple(fx.TERMS))(s.where(F.size("tokens") > 0))
    s = s.where(compare(F.col("score"), ">", fx.TEST_THRESHOLD) & (F.col("score") > 0))
    s = s.where(sensitive(F.col("tokens"), fx.TERMS))
    late = argmax(s.withColumnRenamed("digest", "text"), ["session_id", "speaker"])
    ref = Q["chat_argmax"](spark, SF01)
    assert late.exceptAll(ref).count() == 0 and ref.exceptAll(late).count() == 0
    assert early.count() > 0


def test_partitioned_sink_is_rerun_safe(spark, tmp_path):
    out = str(tmp_path / "audit")
    res = Q["audit_union"](spark, SF01)
    n = res.count()
    write_partitioned(res, out)
    write_partitioned(res, out)  # rerun of the same day
    assert spark.read.parquet(out).count() == n
    other = res.withColumn("v_date", F.lit("2024-02-16"))
    write_partitioned(other, out)  # another day lands beside it
    assert spark.read.parquet(out).count() == 2 * n
    assert sorted(d for d in os.listdir(out) if d.startswith("v_date=")) == [
        "v_date=2024-01-15", "v_date=2024-01-16", "v_date=2024-01-17", "v_date=2024-02-16"]


def test_schema_gate_rejects_wrong_layout(spark):
    import pytest

    from convaudit import schemas

    bad = spark.createDataFrame([("x",)], "session_id string")
    with pytest.raises(schemas.SchemaMismatch):
        audit.chat_audit(bad, fx.TERMS, RatioScorer(tuple(fx.TERMS)))
    wrong_type = fx.tickets(spark, SF01).withColumn("caller_num", F.lit(1.5))
    with pytest.raises(schemas.SchemaMismatch):
        schemas.require(wrong_type, schemas.TICKET)


def test_whole_tables_are_checked_column_by_column(spark):
    import pytest

    from convaudit import schemas

    for names, schema, rows in ((schemas.CHAT_TABLE, schemas.CHAT_RECORD, fx.chat_json(spark, SF01)),
                                (schemas.SPEECH_TABLE, schemas.SPEECH_RECORD, fx.speech_json(spark, SF01))):
        whole = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names])
        assert len(whole.columns) == len(names)
        assert schemas.require_table(whole, names, schema).columns == schema.fieldNames()
        for bad in (whole.drop(names[0]), whole.withColumn("more", F.lit(1)), whole.select(*reversed(names)), rows):
            with pytest.raises(schemas.SchemaMismatch):
                schemas.require_table(bad, names, schema)


def test_day_scan_pushes_filter_to_parquet(spark):
    df = Q["chat_day_scan"](spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "LessThan(ts," in plan


def test_inline_and_exploded_audits_agree(spark):
    """The map-only (in-row) audits equal the explode + aggregate audits."""
    import pytest  # noqa: F401

    scorer = RatioScorer(tuple(fx.TERMS))
    chats, speech, canned = fx.chat_json(spark, SF01), fx.speech_json(spark, SF01), fx.canned(spark, SF01)
    for mode in ["intended", "faithful"]:
        a = audit.chat_audit(chats, fx.TERMS, scorer, AuditConfig(chat_threshold=0.02, select_mode=mode), canned)
        b = audit.chat_audit(chats, fx.TERMS, scorer,
                             AuditConfig(chat_threshold=0.02, select_mode=mode, inline=False), canned)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = audit.speech_audit(speech, fx.TERMS, scorer, AuditConfig(speech_threshold=0.02))
    b = audit.speech_audit(speech, fx.TERMS, scorer, AuditConfig(speech_threshold=0.02, inline=False))
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_inline_audit_plan_has_no_shuffle(spark):
    """Over stored records the in-row chat audit is a map-only plan."""
    import tempfile

    path = tempfile.mkdtemp(prefix="chat-records-", dir=str(spark.conf.get("spark.checkpoint.dir")))
    fx.chat_json(spark, SF01).write.mode("overwrite").parquet(path)
    chats = spark.read.parquet(path)
    out = audit.chat_audit(chats, fx.TERMS, RatioScorer(tuple(fx.TERMS)), AuditConfig(chat_threshold=0.02))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan, plan


def test_inline_speech_audit_plan_has_no_shuffle(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="speech-records-", dir=str(spark.conf.get("spark.checkpoint.dir")))
    fx.speech_json(spark, SF01).write.mode("overwrite").parquet(path)
    out = audit.speech_audit(spark.read.parquet(path), fx.TERMS, RatioScorer(tuple(fx.TERMS)),
                             AuditConfig(speech_threshold=0.02))
    assert out.count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan, plan
