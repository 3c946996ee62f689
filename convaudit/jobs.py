"""Batch jobs, one per run of the reference's nightly schedule.

    spark-submit --py-files convaudit.zip convaudit/jobs.py chat   --chat P --lexicon P [--canned P] --models ROOT --out P [--date D]
    spark-submit --py-files convaudit.zip convaudit/jobs.py speech --speech P --lexicon P --models ROOT --out P [--date D]
    spark-submit --py-files convaudit.zip convaudit/jobs.py flow   --rules P --tickets P --calls P --out P [--date D --begin D --end D]
    spark-submit --py-files convaudit.zip convaudit/jobs.py integrate --results P --calls P --out P [--date D]
    spark-submit --py-files convaudit.zip convaudit/jobs.py daily  --chat P --speech P --calls P --lexicon P [--canned P] --models ROOT --out P --serving P [--day-offset N]
    spark-submit --py-files convaudit.zip convaudit/jobs.py train  --corpus P --models ROOT [--names lr,rf]

Inputs are parquet tables in the declared layouts (``convaudit.schemas``); the
lexicon is a text file, one entry per line. Every output is computed and written
once; audits are partitioned by ``v_date`` and ``source``, flow results by the run's
``check_date`` and ``source``, and a run replaces exactly what it stands for, also
when it has no rows. ``daily`` runs chat, speech and integration for one day. The
day is ``--date``, or ``--day-offset`` days before today (1: yesterday).
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convaudit import schemas
from convaudit.config import (CHAT_THRESHOLD, FILTER_CHARS, LR_MAX_ITER, SOURCE_CHAT, SOURCE_SPEECH, SPEECH_THRESHOLD,
                              VECTOR_SIZE, AuditConfig, FlowConfig, days_ago, today, yesterday)
from convaudit.ml import registry
from convaudit.ml.score import ModelScorer
from convaudit.ml.train import TrainConfig, fit_models
from convaudit.ml.features import FeatureConfig
from convaudit.operators import lexicon as lexops
from convaudit.operators.flow import flow_rows
from convaudit.plans import audit, training
from convaudit.plans.ticket_flow import flow_check
from convaudit.sources.sinks import FLOW_PARTITIONS, write_partitioned
from convaudit.sources.tables import day_scan


def _scorer(spark: SparkSession, root: str, names: list[str]) -> ModelScorer:
    return ModelScorer([registry.load_model(spark, root, n) for n in names])


def _stored(spark: SparkSession, path: str, schema: T.StructType, day: str, col: str = "v_date") -> DataFrame:
    """What a run has written for ``day``; the declared schema also serves where nothing is left."""
    return spark.read.schema(schema).parquet(path).where(F.col(col) == day)


def run_chat(spark: SparkSession, chat: str, lexicon: str, models: str, out: str, names: list[str],
             cfg: AuditConfig, canned: str | None = None, whole_table: bool = False) -> DataFrame:
    rows = spark.read.parquet(chat)
    if whole_table:
        rows = schemas.require_table(rows, schemas.CHAT_TABLE, schemas.CHAT_RECORD, "chat table")
    day = day_scan(rows, "create_time", cfg.day)
    cn = spark.read.parquet(canned) if canned else None
    res = audit.chat_audit(day, lexops.read_lexicon(spark, lexicon), _scorer(spark, models, names), cfg, cn)
    write_partitioned(res, out, targets=[{"v_date": cfg.day, "source": SOURCE_CHAT}])
    return _stored(spark, out, res.schema, cfg.day).where(F.col("source") == SOURCE_CHAT)


def run_speech(spark: SparkSession, speech: str, lexicon: str, models: str, out: str, names: list[str],
               cfg: AuditConfig, whole_table: bool = False) -> DataFrame:
    rows = spark.read.parquet(speech)
    if whole_table:
        rows = schemas.require_table(rows, schemas.SPEECH_TABLE, schemas.SPEECH_RECORD, "speech table")
    day = rows.where(F.col("v_date") == F.lit(cfg.day).cast("date"))
    res = audit.speech_audit(day, lexops.read_lexicon(spark, lexicon), _scorer(spark, models, names), cfg)
    write_partitioned(res, out, targets=[{"v_date": cfg.day, "source": SOURCE_SPEECH}])
    return _stored(spark, out, res.schema, cfg.day).where(F.col("source") == SOURCE_SPEECH)


def run_flow(spark: SparkSession, rules: str, tickets: str, calls: str, out: str, cfg: FlowConfig) -> DataFrame:
    day = cfg.check_date or yesterday()
    r = flow_check(spark.read.parquet(rules), spark.read.parquet(tickets), spark.read.parquet(calls), cfg)
    target = [{"check_date": day}]
    summary = r.summary.select(F.lit(day).alias("check_date"), "*")
    write_partitioned(summary, out.rstrip("/") + "_summary", FLOW_PARTITIONS, targets=target)
    stored = _stored(spark, out.rstrip("/") + "_summary", summary.schema, day, "check_date")
    results = flow_rows(stored)
    write_partitioned(results, out, FLOW_PARTITIONS, targets=target)
    return results


def run_integrate(spark: SparkSession, results: str, calls: str, out: str, day: str) -> DataFrame:
    res = _stored(spark, results, schemas.AUDIT_RESULT, day)
    k = spark.read.parquet(calls).where(F.col("v_date") == F.lit(day).cast("date"))
    joined = audit.integrate(res, k)
    write_partitioned(joined, out, targets=[{"v_date": day}])
    return _stored(spark, out, joined.schema, day)


def run_daily(spark: SparkSession, chat: str, speech: str, calls: str, lexicon: str, models: str, out: str, serving: str,
              names: list[str], cfg: AuditConfig, canned: str | None = None) -> DataFrame:
    """Q5: the chat and speech audits of a day, then their integration."""
    run_chat(spark, chat, lexicon, models, out, names, cfg, canned)
    run_speech(spark, speech, lexicon, models, out, names, cfg)
    return run_integrate(spark, out, calls, serving, cfg.day)


def run_train(spark: SparkSession, corpus: str, models: str, names: list[str], cfg: TrainConfig = TrainConfig(),
              version: str | None = None, label: str = "label", positive: str | None = None) -> DataFrame:
    """Fit on the train split, report held-out metrics, save every model as a new version.

    ``positive``: the label's value for class 1; by default the column holds 0 and 1.
    """
    rows = spark.read.parquet(corpus)
    named = F.col(label).cast("double")
    if positive is not None:
        named = F.coalesce(F.col(label).try_cast("double") == F.lit(positive).try_cast("double"), F.col(label).cast("string") == positive).cast("double")
    train, test = training.split(rows.withColumn("label", named))
    fitted = fit_models(train, names, cfg)
    rep = training.report(fitted, test)
    rows = rep.collect()  # one row per model
    metrics = {r.model: {"accuracy": r.accuracy, "auc": r.auc} for r in rows}
    for n, m in fitted.items():
        registry.save_model(spark, m, models, n, metrics.get(n), version)
    return spark.createDataFrame(rows, rep.schema)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="convaudit.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("chat", "speech"):
        s = sub.add_parser(name)
        s.add_argument(f"--{name}", required=True)
        s.add_argument("--lexicon", required=True)
        s.add_argument("--models", required=True)
        s.add_argument("--names", default="lr")
        s.add_argument("--out", required=True)
        s.add_argument("--date", default=None)
        s.add_argument("--threshold", type=float,
                       default=CHAT_THRESHOLD if name == "chat" else SPEECH_THRESHOLD)
        s.add_argument("--select-mode", default="intended", choices=["intended", "faithful"])
        s.add_argument("--filter-chars", default=FILTER_CHARS)
        s.add_argument("--whole-table", action="store_true", help="the input must have the source table's full layout")
        if name == "chat":
            s.add_argument("--canned", default=None)
    d = sub.add_parser("daily")
    for a in ("--chat", "--speech", "--calls", "--lexicon", "--models", "--out", "--serving"):
        d.add_argument(a, required=True)
    d.add_argument("--canned", default=None)
    d.add_argument("--names", default="lr")
    d.add_argument("--date", default=None)
    d.add_argument("--day-offset", type=int, default=1)
    d.add_argument("--chat-threshold", type=float, default=CHAT_THRESHOLD)
    d.add_argument("--speech-threshold", type=float, default=SPEECH_THRESHOLD)
    d.add_argument("--filter-chars", default=FILTER_CHARS)
    f = sub.add_parser("flow")
    for a in ("--rules", "--tickets", "--calls", "--out"):
        f.add_argument(a, required=True)
    f.add_argument("--date", default=None)
    f.add_argument("--begin", default=None)
    f.add_argument("--end", default=None)
    f.add_argument("--no-keyword", action="store_true")
    i = sub.add_parser("integrate")
    for a in ("--results", "--calls", "--out"):
        i.add_argument(a, required=True)
    i.add_argument("--date", default=None)
    t = sub.add_parser("train")
    t.add_argument("--corpus", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--names", default="lr,rf")
    t.add_argument("--filter-chars", default=FILTER_CHARS)
    t.add_argument("--vector-size", type=int, default=VECTOR_SIZE)
    t.add_argument("--iterations", type=int, default=LR_MAX_ITER)
    t.add_argument("--label-column", default="label")
    t.add_argument("--positive-label", default="1")
    return p


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"convaudit-{a.job}").getOrCreate()
    if a.job in ("chat", "speech"):
        key = "chat_threshold" if a.job == "chat" else "speech_threshold"
        cfg = replace(AuditConfig(prediction_date=a.date or yesterday(), select_mode=a.select_mode, filter_chars=a.filter_chars),
                      **{key: a.threshold})
        names = a.names.split(",")
        if a.job == "chat":
            run_chat(spark, a.chat, a.lexicon, a.models, a.out, names, cfg, a.canned, a.whole_table)
        else:
            run_speech(spark, a.speech, a.lexicon, a.models, a.out, names, cfg, a.whole_table)
    elif a.job == "daily":
        cfg = AuditConfig(prediction_date=a.date or days_ago(a.day_offset), chat_threshold=a.chat_threshold,
                          speech_threshold=a.speech_threshold, filter_chars=a.filter_chars)
        run_daily(spark, a.chat, a.speech, a.calls, a.lexicon, a.models, a.out, a.serving, a.names.split(","), cfg, a.canned)
    elif a.job == "flow":
        d = a.date or yesterday()
        cfg = replace(FlowConfig.for_day(d, a.begin, a.end or today()), is_keyword=not a.no_keyword)
        run_flow(spark, a.rules, a.tickets, a.calls, a.out, cfg)
    elif a.job == "integrate":
        run_integrate(spark, a.results, a.calls, a.out, a.date or yesterday())
    elif a.job == "train":
        features = FeatureConfig(vector_size=a.vector_size, filter_chars=a.filter_chars)
        rep = run_train(spark, a.corpus, a.models, a.names.split(","), TrainConfig(features=features, lr_max_iter=a.iterations),
                        label=a.label_column, positive=a.positive_label)
        print(json.dumps([r.asDict() for r in rep.collect()]))


if __name__ == "__main__":
    main()
