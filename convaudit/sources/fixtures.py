"""Record-shaped views built from the driver's test tables.

The reference reads chat records, speech records, tickets, call records and a
rule table from a database. The test tables carry the same information in
another shape, so each view here derives one record layout from them by a fixed
rule (documented in FIXTURES.md). The DuckDB oracle builds the same views with
the same rules in ``convaudit.oracle``.

All views grow with the input tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit.functions.text import tokenize

# ---------------------------------------------------------------------------
# Fixed values of the test fixtures.
# ---------------------------------------------------------------------------
TERMS = ["und", "que", "la", "that", "was", "from", "this", "die"]
TEST_THRESHOLD = 0.02
LR_THRESHOLD = 0.15          # P(negative) of the test model; its class 0 is about a sixth of the rows
LEXICON_LENGTH = 9           # least characters of a word of the large lexicon
CHAT_CREATE_TIME = "2024-01-15 08:00:00"
CALL_DATE = "2024-01-15"
EVENT_DAY = "2024-01-15"      # day of the events day-scan
ORDER_DAY = "1996-06-03"      # day of the orders day-scan
USER_ID = "user"
AGENT_ID = "assistant"
SEVEN_KEY_TURN = (7, 6)      # turn % 7 == 6 -> message has 7 keys
EXTRA_MOD = 11               # conv_id % 11 == 0, 1, 2, 3 -> an extra, unusable copy of the record (see _extras)
DAYS = 3                     # conv_id % 3 days after the first day
CANNED_MOD = 9               # conv_id % 9 == 0, turn 0 -> canned sentence
RULE_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TICKET_DATES = ("1995-01-01", "1996-12-31")
CALL_DATES = ("2024-01-15", "2024-01-16")
MIXED_CASE_ENTRY = "Th"      # with ER appended: an entry in mixed case
# check date, first and last call date of two flow runs
FLOW_DAYS = [("2024-01-15", "2024-01-15", "2024-01-16"), ("2024-01-16", "2024-01-16", "2024-01-17")]
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def terms_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TERMS], "term string")


def large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long words of all documents, as ``word``: tens of thousands."""
    words = table(spark, sf_dir, "documents").select(F.explode(tokenize("text")).alias("word"))
    return words.where(F.length("word") >= LEXICON_LENGTH).distinct()


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flow-check rules, one per benchmark item: some without a type, a numeric
    threshold or keywords, some with empty keywords."""
    b = table(spark, sf_dir, "benchmark")
    i = F.col("item_id")
    words = F.slice(tokenize("text"), 1, 3)
    return b.select(
        i.cast("int").alias("rule_id"),
        F.get(F.array(*[F.lit(t) for t in RULE_TYPES]), (i % 6).cast("int")).alias("question_type"),
        F.when(i % 7 == 3, "abc").otherwise((i % 4 + 2).cast("string")).alias("caller_threshold"),
        F.when(i % 9 == 4, F.lit(None)).when(i % 11 == 5, "").otherwise(F.array_join(words, "#")).alias("key_words"))


def _day(conv_id):
    """The record's day: one of DAYS days from the first."""
    return F.date_add(F.lit(CALL_DATE).cast("date"), (conv_id % DAYS).cast("int"))


def _extras(rows: DataFrame, id_col: str, payload: str, field: str | None = None, null_col: str | None = None) -> DataFrame:
    """``rows`` and unusable copies of some: cut JSON, text behind the JSON, ``field`` renamed away, ``null_col`` null.

    ``conv_id`` names the source conversation and is dropped.
    """
    kind = F.col("conv_id") % EXTRA_MOD
    named = lambda prefix: F.concat(F.lit(prefix), F.col(id_col))
    out = rows.unionByName(rows.where(kind == 0).withColumns(
        {id_col: named("cut-"), payload: F.expr(f"substring({payload}, 1, length({payload}) div 2)")}))
    out = out.unionByName(rows.where(kind == 3).withColumns({id_col: named("jnk-"), payload: F.concat(F.col(payload), F.lit(" []"))}))
    if null_col:
        null = F.lit(None).cast(rows.schema[null_col].dataType)
        out = out.unionByName(rows.where(kind == 1).withColumns({id_col: named("nul-"), null_col: null}))
    if field:
        out = out.unionByName(rows.where(kind == 2).withColumns(
            {id_col: named("mis-"), payload: F.replace(F.col(payload), F.lit(f'"{field}":'), F.lit('"other":'))}))
    return out.drop("conv_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation turn with its speaker class."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") == "user", "user").when(F.col("role") == "assistant", "agent")
        .otherwise("bot").alias("speaker"),
        F.col("text"),
    )


def _chat_message(c) -> F.Column:
    base = [
        F.lit("userName"), F.col("role"),
        F.lit("userId"), F.col("role"),
        F.lit("digest"), F.coalesce(F.col("text"), F.lit("")),
        F.lit("content"), F.lit(""),
        F.lit("time"), F.col("turn").cast("string"),
        F.lit("msgType"), F.lit("text"),
        F.lit("userFaceUrl"), F.lit(""),
    ]
    full = F.create_map(*base, F.lit("imuserid"), F.col("conv_id").cast("string"))
    seven = F.create_map(*base)
    mod, rem = SEVEN_KEY_TURN
    return F.when(F.col("turn") % mod == rem, seven).otherwise(full)


def chat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chat_record rows: one JSON array of messages per conversation."""
    c = table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn"), F.to_json(_chat_message(c)).alias("m")))).alias("ms"))
    js = per.select(
        "conv_id", F.concat(F.lit("["), F.array_join(F.transform("ms", lambda x: x["m"]), ","), F.lit("]")).alias("js"))
    rows = js.select(
        "conv_id",
        (F.lit(CHAT_CREATE_TIME).cast("timestamp_ntz") + F.make_dt_interval((F.col("conv_id") % DAYS).cast("int"))).alias("create_time"),
        F.col("js").alias("chat_records"),
        F.col("conv_id").cast("string").alias("session_id"),
        F.lit(USER_ID).alias("user_id"),
        F.lit(AGENT_ID).alias("agent_id"),
    )
    return _extras(rows, "session_id", "chat_records", "digest")


def _speech_payload(c: DataFrame) -> DataFrame:
    per = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        tokenize(F.coalesce(F.col("text"), F.lit(""))).alias("wordList")))).alias("ss"))
    return per.select("conv_id", F.to_json(F.struct(F.transform(
        "ss", lambda x: F.struct(x["text"].alias("text"), x["wordList"].alias("wordList"))
    ).alias("sentenceListData"))).alias("js"))


def speech_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """speech_record rows: one sentence per turn, tokens as the word list."""
    p = _speech_payload(table(spark, sf_dir, "conversations"))
    rows = p.select(
        "conv_id",
        F.col("conv_id").cast("string").alias("task_no"),
        F.col("conv_id").cast("string").alias("order_no"),
        ((F.col("conv_id") % 10).cast("double") / 10.0).alias("score_qingxu"),
        F.col("js").alias("result"),
        _day(F.col("conv_id")).alias("v_date"),
    )
    return _extras(rows, "task_no", "result", "wordList", "score_qingxu")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """call_record rows: even conversations are chats (source 1), odd are calls (2).

    One aggregate per conversation builds whichever JSON shape its source uses.
    """
    c = table(spark, sf_dir, "conversations")
    text = F.coalesce(F.col("text"), F.lit(""))
    per = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), text.alias("text"), tokenize(text).alias("wordList")))).alias("ss"))
    digests = F.to_json(F.transform("ss", lambda x: F.struct(x["text"].alias("digest"))))
    sentences = F.to_json(F.struct(F.transform(
        "ss", lambda x: F.struct(x["text"].alias("text"), x["wordList"].alias("wordList"))
    ).alias("sentenceListData")))
    js = per.select("conv_id", F.when(F.col("conv_id") % 2 == 0, digests).otherwise(sentences).alias("jsx"))
    rows = js.select(
        "conv_id",
        _day(F.col("conv_id")).alias("v_date"),
        F.when(F.col("conv_id") % 2 == 0, 1).otherwise(2).cast("int").alias("source"),
        F.col("conv_id").cast("string").alias("order_no"),
        F.col("conv_id").cast("string").alias("task_no"),
        F.col("jsx").alias("result"),
        F.date_add(F.lit(CALL_DATE).cast("date"), (F.col("conv_id") % 2).cast("int")).alias("compute_date"),
    )
    return _extras(rows, "task_no", "result")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticket rows: one per order; caller count = the order's line count, as text. Some
    counts are null or no number, some dates null."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select(
        F.when(F.col("o_orderkey") % 89 != 7, F.col("o_orderdate").cast("date")).alias("v_date"),
        F.col("o_orderkey").cast("string").alias("issue_no"),
        F.col("o_custkey").cast("string").alias("order_no"),
        F.col("o_orderpriority").alias("problem_config_no_3"),
        F.when(F.col("o_orderkey") % 97 == 5, F.lit(None)).when(F.col("o_orderkey") % 97 == 6, F.lit("n/a"))
        .otherwise(F.coalesce(F.col("n"), F.lit(0)).cast("string")).alias("caller_num"),
    )


def canned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canned (fixed) sentences: the opening text of every 9th conversation."""
    c = table(spark, sf_dir, "conversations")
    return c.where((F.col("conv_id") % CANNED_MOD == 0) & (F.col("turn") == 0) & F.col("text").isNotNull()) \
        .select(F.trim(F.col("text")).alias("sentence")).distinct()


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus: documents with their quality label (1 = positive)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
