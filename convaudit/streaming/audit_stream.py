"""Incremental audits: the stateless chat/speech plans over a file stream.

Every record carries all of its sentences, so auditing a micro-batch on its own
gives exactly the rows a batch run over the same records would give; no
streaming state or watermark is needed. Each micro-batch is written to its own
``batch_id=<n>`` folder (partitioned by ``v_date`` and ``source`` inside) with
overwrite, so a replayed batch after a failure rewrites, not duplicates, its
rows. Reading the sink root returns all batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from convaudit import schemas
from convaudit.config import AuditConfig
from convaudit.plans import audit
from convaudit.sources.sinks import write_partitioned


def _run(spark: SparkSession, source_path: str, schema, plan: Callable[[DataFrame], DataFrame], sink_path: str,
         checkpoint: str, available_now: bool, max_files: int | None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    src = reader.parquet(source_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_partitioned(plan(batch), f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_chat_audit(spark: SparkSession, source_path: str, sink_path: str, checkpoint: str, lexicon,
                      scorer, cfg: AuditConfig = AuditConfig(), canned: DataFrame | None = None,
                      available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Audit chat records as parquet files arrive under ``source_path``."""
    return _run(spark, source_path, schemas.CHAT_RECORD,
                lambda b: audit.chat_audit(b, lexicon, scorer, cfg, canned), sink_path, checkpoint,
                available_now, max_files)


def stream_speech_audit(spark: SparkSession, source_path: str, sink_path: str, checkpoint: str, lexicon,
                        scorer, cfg: AuditConfig = AuditConfig(), available_now: bool = True,
                        max_files: int | None = None) -> StreamingQuery:
    """Audit speech records as parquet files arrive under ``source_path``."""
    return _run(spark, source_path, schemas.SPEECH_RECORD,
                lambda b: audit.speech_audit(b, lexicon, scorer, cfg), sink_path, checkpoint,
                available_now, max_files)
