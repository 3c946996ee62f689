"""Declared record layouts and the schema gate (fail fast on a wrong layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S = T.StringType()

CHAT_RECORD = T.StructType([
    T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("chat_records", S),
    T.StructField("session_id", S),
    T.StructField("user_id", S),
    T.StructField("agent_id", S),
])

SPEECH_RECORD = T.StructType([
    T.StructField("task_no", S),
    T.StructField("order_no", S),
    T.StructField("score_qingxu", T.DoubleType()),
    T.StructField("result", S),
    T.StructField("v_date", T.DateType()),
])

FLOW_RULE = T.StructType([
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("question_type", S),
    T.StructField("caller_threshold", S),
    T.StructField("key_words", S),
])

TICKET = T.StructType([
    T.StructField("v_date", T.DateType()),
    T.StructField("issue_no", S),
    T.StructField("order_no", S),
    T.StructField("problem_config_no_3", S),
    T.StructField("caller_num", S),
])

CALL_RECORD = T.StructType([
    T.StructField("v_date", T.DateType()),
    T.StructField("source", T.IntegerType()),
    T.StructField("order_no", S),
    T.StructField("task_no", S),
    T.StructField("result", S),
])

AUDIT_RESULT = T.StructType([
    T.StructField("v_date", S),
    T.StructField("event_time", S),
    T.StructField("source", T.IntegerType()),
    T.StructField("record_id", S),
    T.StructField("problem_text", S),
    T.StructField("score", T.DoubleType()),
])

FLOW_RESULT = T.StructType([
    T.StructField("v_date", S),
    T.StructField("source", T.IntegerType()),
    T.StructField("order_no", S),
    T.StructField("task_no", S),
    T.StructField("keyword", S),
    T.StructField("text", S),
])

# Whole source tables, as the reference's queries return them: it stops on a row of another
# width. Columns without a known name are numbered.
CHAT_TABLE = ["column_0", "create_time", "chat_records", "session_id", "time_long", "user_id", "agent_id", "begin_time",
              "end_time", "column_9"]
SPEECH_TABLE = ["task_no", "business_no", "order_no", "score_qingxu", "score_caozuo", "voice_address", "caller_role", "dialed_role",
                "creator_ucaccount", "start_time", "stop_time", "result", "v_date"]

# JSON payload shapes.
CHAT_JSON = T.ArrayType(T.MapType(S, S))
SPEECH_JSON = T.StructType([
    T.StructField("sentenceListData", T.ArrayType(T.StructType([
        T.StructField("text", S),
        T.StructField("wordList", T.ArrayType(S)),
    ]))),
])
DIGEST_JSON = T.ArrayType(T.StructType([T.StructField("digest", S)]))
TEXT_JSON = T.StructType([
    T.StructField("sentenceListData", T.ArrayType(T.StructType([T.StructField("text", S)]))),
])


class SchemaMismatch(ValueError):
    pass


def require(df: DataFrame, schema: T.StructType, name: str = "input", extra: list[str] | None = None) -> DataFrame:
    """Check that ``df`` carries every declared column with its declared type.

    Extra columns are allowed (they are pruned by the plans); a missing column
    or a type change raises, as the reference stops on a wrong row arity.
    Returns ``df`` projected to the declared column order, then the ``extra`` ones.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df.select(*[f.name for f in schema.fields], *(extra or []))


def require_table(df: DataFrame, columns: list[str], schema: T.StructType, name: str = "input") -> DataFrame:
    """Check that ``df`` is the whole source table: these columns in this order, those that are read typed
    as in ``schema``. Returns the columns that are read."""
    if df.columns != columns:
        missing, extra = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
        raise SchemaMismatch(f"{name}: {len(df.columns)} columns, {len(columns)} expected"
                             + (f"; missing {missing}" if missing else "") + (f"; unknown {extra}" if extra else "")
                             + ("; in another order" if not missing and not extra else ""))
    return require(df, schema, name)
