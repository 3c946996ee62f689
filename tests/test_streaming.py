"""The streamed chat audit equals the batch audit over the same records."""

from conftest import SF01
from convaudit.config import AuditConfig
from convaudit.operators.score import RatioScorer
from convaudit.plans import audit
from convaudit.sources import fixtures as fx
from convaudit.streaming.audit_stream import stream_chat_audit


def test_stream_equals_batch(spark, tmp_path):
    chats = fx.chat_json(spark, SF01)
    src = str(tmp_path / "in")
    chats.where("crc32(session_id) % 100 < 50").write.parquet(src, mode="append")
    chats.where("crc32(session_id) % 100 >= 50").write.parquet(src, mode="append")
    cfg = AuditConfig(chat_threshold=fx.TEST_THRESHOLD)
    scorer = RatioScorer(tuple(fx.TERMS))
    canned = fx.canned(spark, SF01)
    q = stream_chat_audit(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), fx.TERMS, scorer, cfg,
                          canned, max_files=1)
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    want = audit.chat_audit(chats, fx.TERMS, scorer, cfg, canned)
    got = got.select(*want.columns)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_speech_stream_equals_batch(spark, tmp_path):
    from convaudit.streaming.audit_stream import stream_speech_audit

    speech = fx.speech_json(spark, SF01)
    src = str(tmp_path / "in")
    speech.write.parquet(src)
    cfg = AuditConfig(speech_threshold=fx.TEST_THRESHOLD)
    scorer = RatioScorer(tuple(fx.TERMS))
    q = stream_speech_audit(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), fx.TERMS, scorer, cfg)
    q.awaitTermination(300)
    want = audit.speech_audit(speech, fx.TERMS, scorer, cfg)
    got = spark.read.parquet(str(tmp_path / "out")).select(*want.columns)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
