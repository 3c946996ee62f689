"""The batch jobs end to end on stored sf0.001 record tables."""

from convaudit import jobs
from convaudit.config import AuditConfig, FlowConfig
from convaudit.ml.features import FeatureConfig
from convaudit.ml.train import TrainConfig
from convaudit.sources import fixtures as fx
from conftest import SF001

SMALL = TrainConfig(features=FeatureConfig(vector_size=64), lr_max_iter=20, trees=5, depth=3)


def test_jobs_end_to_end(spark, tmp_path):
    d = str(tmp_path)
    fx.chat_json(spark, SF001).write.parquet(f"{d}/chat")
    fx.speech_json(spark, SF001).write.parquet(f"{d}/speech")
    fx.canned(spark, SF001).write.parquet(f"{d}/canned")
    fx.rules(spark, SF001).write.parquet(f"{d}/rules")
    fx.tickets(spark, SF001).write.parquet(f"{d}/tickets")
    fx.calls(spark, SF001).write.parquet(f"{d}/calls")
    fx.labelled(spark, SF001).write.parquet(f"{d}/corpus")
    with open(f"{d}/lexicon.txt", "w", encoding="utf-8") as fh:
        fh.write("\n".join(fx.TERMS) + "\n")

    rep = jobs.run_train(spark, f"{d}/corpus", f"{d}/models", ["lr", "rf"], SMALL, version="v1")
    assert sorted(r.model for r in rep.collect()) == ["lr", "rf"]

    cfg = AuditConfig(prediction_date=fx.CALL_DATE, chat_threshold=0.0, speech_threshold=0.0)
    chat = jobs.run_chat(spark, f"{d}/chat", f"{d}/lexicon.txt", f"{d}/models", f"{d}/results", ["lr", "rf"],
                         cfg, f"{d}/canned")
    speech = jobs.run_speech(spark, f"{d}/speech", f"{d}/lexicon.txt", f"{d}/models", f"{d}/results", ["lr"], cfg)
    stored = spark.read.parquet(f"{d}/results")
    assert stored.count() == chat.count() + speech.count() > 0

    flow = jobs.run_flow(spark, f"{d}/rules", f"{d}/tickets", f"{d}/calls", f"{d}/flow", FlowConfig())
    assert spark.read.parquet(f"{d}/flow").count() == flow.count() > 0
    assert spark.read.parquet(f"{d}/flow_summary").count() == flow.count()

    joined = jobs.run_integrate(spark, f"{d}/results", f"{d}/calls", f"{d}/serving", fx.CALL_DATE)
    assert spark.read.parquet(f"{d}/serving").count() == joined.count() == stored.count()

    # the daily job is the three audits' jobs in one, and a rerun replaces the day
    again = jobs.run_daily(spark, f"{d}/chat", f"{d}/speech", f"{d}/calls", f"{d}/lexicon.txt", f"{d}/models", f"{d}/results2",
                           f"{d}/serving2", ["lr"], cfg, f"{d}/canned")
    n = again.count()
    jobs.run_daily(spark, f"{d}/chat", f"{d}/speech", f"{d}/calls", f"{d}/lexicon.txt", f"{d}/models", f"{d}/results2",
                   f"{d}/serving2", ["lr"], cfg, f"{d}/canned")
    assert spark.read.parquet(f"{d}/serving2").count() == n > 0


def test_cli_parses_reference_style_runs():
    p = jobs._parser()
    a = p.parse_args(["chat", "--chat", "c", "--lexicon", "l", "--models", "m", "--out", "o", "--threshold", "0.9"])
    assert a.job == "chat" and a.threshold == 0.9 and a.select_mode == "intended"
    a = p.parse_args(["flow", "--rules", "r", "--tickets", "t", "--calls", "c", "--out", "o", "--no-keyword"])
    assert a.no_keyword and a.date is None
