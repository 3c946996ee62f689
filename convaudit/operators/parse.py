"""JSON payloads -> sentences (chat messages, speech sentences, call texts).

Records are self-contained: every sentence of a conversation sits in the JSON
text of one row. Parsing is a narrow (per-row) transformation; ``posexplode``
keeps the list position, which later decides first-wins ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convaudit import schemas
from convaudit.config import CHAT_MESSAGE_KEYS, SOURCE_CHAT, SOURCE_SPEECH, SPEECH_MIN_WORDS
from convaudit.operators.util import BROADCAST_BYTES, bounded_broadcast

CHAT_KEYS = ["create_time", "session_id", "user_id", "agent_id"]
SPEECH_KEYS = ["v_date", "task_no", "order_no", "score_qingxu"]
PAYLOAD_HASH = ["payload_h1", "payload_h2"]


def with_payload_hash(df: DataFrame, payload: str) -> DataFrame:
    """Two hashes of the record's JSON text: with the record's own columns they
    identify it, also where its key is null or shared."""
    return df.withColumns({"payload_h1": F.xxhash64(payload), "payload_h2": F.xxhash64(F.lit("record"), payload)})


def whole_json(text: Column, schema: T.DataType) -> Column:
    """``from_json`` of a text that is one JSON value and nothing else; null otherwise.

    Spark's parser stops at the end of the first value, so junk behind it goes unseen. Here the text is the first
    entry of an object, the second is named by the text's hash: whatever follows the text's value breaks the object,
    adds an entry or hides the second. Quotes are double, as JSON has them. Still one parse a record.
    """
    mark = F.xxhash64(text).cast("string")
    p = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(',"'), mark, F.lit('":null}')), T.MapType(T.StringType(), schema), {"allowSingleQuotes": "false"})
    # the parsed object is the element of a one-entry array, so that it is named once
    return F.get(F.transform(F.array(p), lambda m: F.when(F.map_keys(m) == F.array(F.lit("v"), mark), F.get(F.map_values(m), 0))), 0)


# -- chat ------------------------------------------------------------------

def parse_chat(chat: DataFrame) -> DataFrame:
    """Add ``msgs``: the message array, null when the JSON is not an array of objects."""
    return chat.withColumn("msgs", whole_json(F.col("chat_records"), schemas.CHAT_JSON))


def n_keys(m: Column) -> Column:
    """Distinct keys of a parsed JSON object (a repeated key counts once)."""
    return F.size(F.array_distinct(F.map_keys(m)))


def field(m: Column, key: str) -> Column:
    """Value of ``key`` in a parsed JSON object; for a repeated key the last one,
    as a JSON-to-dict parser keeps it (Spark's map keeps every entry and a plain
    lookup returns the first)."""
    return F.get(F.reverse(F.filter(F.map_entries(m), lambda e: e["key"] == F.lit(key))), 0)["value"]


def chat_messages(chat: DataFrame) -> DataFrame:
    """One row per message of every parseable, non-empty chat record.

    Columns: record keys, ``pos``, ``n_keys``, ``user_key`` (the message's
    ``userId``), ``digest``.
    """
    p = parse_chat(with_payload_hash(chat, "chat_records"))
    keys = CHAT_KEYS + PAYLOAD_HASH
    return p.select(*keys, F.posexplode("msgs").alias("pos", "m")).select(
        *keys, "pos",
        n_keys(F.col("m")).alias("n_keys"),
        field(F.col("m"), "userId").alias("user_key"),
        field(F.col("m"), "digest").alias("digest"),
    )


def keep_arity(msgs: DataFrame, n_keys: int = CHAT_MESSAGE_KEYS) -> DataFrame:
    """Keep messages with exactly ``n_keys`` keys."""
    return msgs.where(F.col("n_keys") == n_keys)


def speaker_of(user_key: Column, user_id: Column, agent_id: Column) -> Column:
    """'user' / 'agent' / null (bot). Null-safe equality: a null id matches a null key."""
    return F.when(user_key.eqNullSafe(user_id), F.lit("user")) \
        .when(user_key.eqNullSafe(agent_id), F.lit("agent"))


def split_speakers(msgs: DataFrame) -> DataFrame:
    """Tag each message with its speaker and drop the bot's."""
    sp = speaker_of(F.col("user_key"), F.col("user_id"), F.col("agent_id"))
    return msgs.withColumn("speaker", sp).where(F.col("speaker").isNotNull())


def drop_canned(msgs: DataFrame, canned: DataFrame, text_col: str = "digest",
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Remove canned sentences: exact match of the trimmed text.

    ``canned`` has one column ``sentence``. It is broadcast only when its bytes are
    within ``max_bytes``. An anti join needs no distinct right side, and without
    one both sides are plain exchanges, so a frequent sentence can be split.
    """
    c = bounded_broadcast(canned.select(F.col("sentence").alias("_canned")), max_bytes)
    return msgs.join(c, F.trim(F.col(text_col)) == F.col("_canned"), "left_anti")


def chat_sentences(chat: DataFrame, canned: DataFrame | None = None,
                   n_keys: int = CHAT_MESSAGE_KEYS) -> DataFrame:
    """P1 -> P2 -> P3 -> P4: the spoken sentences of users and agents."""
    m = split_speakers(keep_arity(chat_messages(chat), n_keys))
    return drop_canned(m, canned) if canned is not None else m


# -- speech ----------------------------------------------------------------

def parse_speech(speech: DataFrame) -> DataFrame:
    return speech.withColumn("payload", whole_json(F.col("result"), schemas.SPEECH_JSON))


def speech_sentences(speech: DataFrame) -> DataFrame:
    """One row per recognised sentence (P5): ``pos``, ``text``, ``words``."""
    p = parse_speech(with_payload_hash(speech, "result"))
    keys = SPEECH_KEYS + PAYLOAD_HASH
    return p.select(*keys, F.posexplode("payload.sentenceListData").alias("pos", "s")).select(
        *keys, "pos",
        F.col("s.text").alias("text"),
        F.col("s.wordList").alias("words"),
    )


def keep_min_words(sent: DataFrame, min_words: int = SPEECH_MIN_WORDS) -> DataFrame:
    """Keep sentences with at least ``min_words`` recognised words."""
    return sent.where(F.size("words") >= min_words)


# -- call records (flow check) ----------------------------------------------

def call_texts(result: Column, source: Column) -> Column:
    """The sentence texts of a call record, chosen by source.

    Source 1 (chat) is an array of ``{digest}`` objects, source 2 (speech) an
    object with ``sentenceListData`` of ``{text}``; any other source has none.
    """
    digests = F.transform(whole_json(result, schemas.DIGEST_JSON), lambda x: x["digest"])
    texts = F.transform(whole_json(result, schemas.TEXT_JSON)["sentenceListData"], lambda x: x["text"])
    return F.when(source == SOURCE_CHAT, digests).when(source == SOURCE_SPEECH, texts)


def flow_sentences(calls: DataFrame, keys: tuple[str, ...] = ("v_date", "source", "order_no", "task_no")) -> DataFrame:
    """Non-empty sentence texts of call records with their position."""
    t = calls.select(*keys, F.posexplode(call_texts(F.col("result"), F.col("source"))).alias("pos", "text"))
    return t.where(F.col("text").isNotNull() & (F.col("text") != ""))


# -- quarantine ----------------------------------------------------------------

def _reason(text: Column) -> Column:
    mark = F.xxhash64(text)
    v = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))  # as whole_json
    alone = F.coalesce(F.try_variant_get(v, "$[1]", "long") == mark, F.lit(False))
    return F.when(alone, F.lit("bad_shape")).otherwise(F.lit("bad_json"))


def _lacks(array: Column, field_of) -> Column:
    """True where an element of the array has no value for the field."""
    return F.coalesce(F.exists(array, lambda x: x.isNull() | field_of(x).isNull()), F.lit(False))


def quarantine(chat: DataFrame | None = None, speech: DataFrame | None = None,
               calls: DataFrame | None = None, message_keys: int = CHAT_MESSAGE_KEYS) -> DataFrame:
    """Records whose payload can't be used in full, with the reason.

    ``bad_json``: the text is not valid JSON, or more than one value; ``bad_shape``: valid JSON of
    another shape (e.g. a speech object without ``sentenceListData``);
    ``missing_field``: a full-width chat message without ``userId`` or ``digest``, or
    a speech sentence without ``wordList``; ``null_emotion``: a speech record
    without its emotion score. Empty but well-formed payloads are not errors (the
    reference skips them silently). One row per record.
    """
    parts = []
    if chat is not None:
        p = parse_chat(chat).where(F.col("chat_records").isNotNull())
        full = F.filter("msgs", lambda m: n_keys(m) == message_keys)
        lacks = _lacks(full, lambda m: field(m, "userId")) | _lacks(full, lambda m: field(m, "digest"))
        reason = F.when(F.col("msgs").isNull(), _reason(F.col("chat_records"))).when(lacks, F.lit("missing_field"))
        parts.append(p.select(F.lit("chat").alias("kind"), F.col("session_id").alias("record_id"), reason.alias("reason")))
    if speech is not None:
        p = parse_speech(speech).where(F.col("result").isNotNull())
        sents = F.col("payload.sentenceListData")
        reason = (F.when(sents.isNull(), _reason(F.col("result")))
                  .when(_lacks(sents, lambda s: s["wordList"]), F.lit("missing_field"))
                  .when(F.col("score_qingxu").isNull(), F.lit("null_emotion")))
        parts.append(p.select(F.lit("speech").alias("kind"), F.col("task_no").alias("record_id"), reason.alias("reason")))
    if calls is not None:
        c = calls.where(F.col("source").isin(SOURCE_CHAT, SOURCE_SPEECH) & F.col("result").isNotNull())
        reason = F.when(call_texts(F.col("result"), F.col("source")).isNull(), _reason(F.col("result")))
        parts.append(c.select(F.lit("call").alias("kind"), F.col("task_no").alias("record_id"), reason.alias("reason")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("reason").isNotNull())
