"""Job parameters (F3, X1) and tokeniser modes."""

import datetime as dt

from pyspark.sql import functions as F

from convaudit.config import FILTER_CHARS, AuditConfig, FlowConfig, yesterday
from convaudit.functions.text import clean_tokens, split_ws, tokenize


def test_default_day_is_yesterday():
    y = (dt.date.today() - dt.timedelta(days=1)).isoformat()
    assert yesterday() == y
    assert AuditConfig().day == y
    assert AuditConfig(prediction_date="2024-01-15").day == "2024-01-15"
    f = FlowConfig.for_day("2024-01-15", end="2024-01-17")
    assert f.ticket_dates == ("2024-01-15", "2024-01-15") and f.call_dates == ("2024-01-15", "2024-01-17")
    assert FlowConfig.for_day().ticket_dates == (y, y)


def test_reference_defaults():
    c = AuditConfig()
    assert (c.chat_threshold, c.speech_threshold, c.emotion_weights) == (0.98, 0.6, (0.8, 0.2))
    assert len(set(FILTER_CHARS)) == 33 and " " in FILTER_CHARS and "\n" in FILTER_CHARS


def test_han_modes(spark):
    df = spark.createDataFrame([("太坑了吧 ABC12 直接",)], "t string")
    none, char, bigram = df.select(tokenize("t", "none"), tokenize("t", "char"), tokenize("t", "bigram")).first()
    assert none == ["太坑了吧", "abc12", "直接"]
    assert char == ["太", "坑", "了", "吧", "abc12", "直", "接"]
    assert bigram == char + ["太坑", "坑了", "了吧", "直接"]


def test_clean_drops_punctuation_only_tokens(spark):
    df = spark.createDataFrame([("好 ， 。。 ok! -- a.b\n（）",)], "t string")
    got = df.select(clean_tokens(split_ws("t")).alias("c")).first().c
    assert got == ["好", "ok!", "a.b"]
    assert df.select(F.size(split_ws(F.lit("  "))).alias("n")).first().n == 0
