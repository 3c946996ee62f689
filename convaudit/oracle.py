"""Independent SQL (DuckDB dialect) for every query with a SQL form.

The fixture views are rebuilt here in SQL from the same rules as
``convaudit.sources.fixtures``; each query's SQL is prefixed with the views it
needs as CTEs. The driver registers the raw test tables as views.
"""

from __future__ import annotations

from convaudit.config import FILTER_CHARS
from convaudit.sources import fixtures as fx


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TERMS_VALUES = ", ".join(f"({_q(t)})" for t in fx.TERMS)
_TYPES_SQL = "[" + ", ".join(_q(t) for t in fx.RULE_TYPES) + "]"
WORD_RE = r"'[\p{L}\p{N}]+'"
FILTER_SQL = _q(FILTER_CHARS)
TERMS_SQL = "[" + ", ".join(_q(t) for t in fx.TERMS) + "]"
M7, R7 = fx.SEVEN_KEY_TURN


def _msg_json(extra: bool) -> str:
    pairs = ("'userName', role, 'userId', role, 'digest', coalesce(text, ''), 'content', '', "
             "'time', CAST(turn AS VARCHAR), 'msgType', 'text', 'userFaceUrl', ''")
    if extra:
        pairs += ", 'imuserid', CAST(conv_id AS VARCHAR)"
    return f"json_object({pairs})"


def _day(col: str = "conv_id") -> str:
    return f"CAST(CAST({_q(fx.CALL_DATE)} AS DATE) + CAST({col} % {fx.DAYS} AS INTEGER) AS DATE)"


def _extras(rows: str, id_col: str, payload: str, field: str | None = None, null_col: str | None = None) -> str:
    """``rows`` (with conv_id) and the unusable copies that ``fixtures._extras`` adds."""
    parts = [f"SELECT * FROM ({rows})",
             f"SELECT * REPLACE ('cut-' || {id_col} AS {id_col}, substring({payload}, 1, length({payload}) // 2) AS {payload}) "
             f"FROM ({rows}) WHERE conv_id % {fx.EXTRA_MOD} = 0",
             f"SELECT * REPLACE ('jnk-' || {id_col} AS {id_col}, {payload} || ' []' AS {payload}) FROM ({rows}) WHERE conv_id % {fx.EXTRA_MOD} = 3"]
    if null_col:
        parts.append(f"SELECT * REPLACE ('nul-' || {id_col} AS {id_col}, NULL AS {null_col}) FROM ({rows}) WHERE conv_id % {fx.EXTRA_MOD} = 1")
    if field:
        parts.append(f"SELECT * REPLACE ('mis-' || {id_col} AS {id_col}, replace({payload}, '\"{field}\":', '\"other\":') AS {payload}) "
                     f"FROM ({rows}) WHERE conv_id % {fx.EXTRA_MOD} = 2")
    return "SELECT * EXCLUDE (conv_id) FROM (" + " UNION ALL ".join(parts) + ")"


# name -> (dependencies, body)
VIEWS: dict[str, tuple[list[str], str]] = {
    "lexicon": ([], f"""
        SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text), {WORD_RE})) AS word FROM documents)
        WHERE length(word) >= {fx.LEXICON_LENGTH}"""),
    "terms": ([], f"SELECT * FROM (VALUES {_TERMS_VALUES}) t(term)"),
    "rules": ([], f"""
        SELECT CAST(item_id AS INTEGER) AS rule_id, ({_TYPES_SQL})[item_id % 6 + 1] AS question_type,
               CASE WHEN item_id % 7 = 3 THEN 'abc' ELSE CAST(item_id % 4 + 2 AS VARCHAR) END AS caller_threshold,
               CASE WHEN item_id % 9 = 4 THEN NULL WHEN item_id % 11 = 5 THEN ''
                    ELSE array_to_string(regexp_extract_all(lower(text), {WORD_RE})[1:3], '#') END AS key_words
        FROM benchmark"""),
    "messages": ([], """
        SELECT CAST(conv_id AS VARCHAR) AS session_id, turn AS pos,
               CASE WHEN role = 'user' THEN 'user' WHEN role = 'assistant' THEN 'agent' ELSE 'bot' END AS speaker,
               text
        FROM conversations"""),
    "chat_json": ([], _extras(f"""
        SELECT conv_id, CAST({_q(fx.CHAT_CREATE_TIME)} AS TIMESTAMP) + to_days(CAST(conv_id % {fx.DAYS} AS INTEGER)) AS create_time,
               js AS chat_records,
               CAST(conv_id AS VARCHAR) AS session_id, {_q(fx.USER_ID)} AS user_id, {_q(fx.AGENT_ID)} AS agent_id
        FROM (SELECT conv_id,
                     '[' || string_agg(CASE WHEN turn % {M7} = {R7} THEN {_msg_json(False)}
                                            ELSE {_msg_json(True)} END::VARCHAR, ',' ORDER BY turn) || ']' AS js
              FROM conversations GROUP BY conv_id)""", "session_id", "chat_records", "digest")),
    "speech_payload": ([], f"""
        SELECT conv_id,
               '{{"sentenceListData":[' || string_agg(json_object(
                    'text', coalesce(text, ''),
                    'wordList', regexp_extract_all(lower(coalesce(text, '')), {WORD_RE}))::VARCHAR,
                    ',' ORDER BY turn) || ']}}' AS js
        FROM conversations GROUP BY conv_id"""),
    "speech_json": (["speech_payload"], _extras(f"""
        SELECT conv_id, CAST(conv_id AS VARCHAR) AS task_no, CAST(conv_id AS VARCHAR) AS order_no,
               CAST(conv_id % 10 AS DOUBLE) / 10.0 AS score_qingxu,
               js AS result, {_day()} AS v_date
        FROM speech_payload""", "task_no", "result", "wordList", "score_qingxu")),
    "digest_payload": ([], """
        SELECT conv_id,
               '[' || string_agg(json_object('digest', coalesce(text, ''))::VARCHAR, ',' ORDER BY turn) || ']' AS js1
        FROM conversations GROUP BY conv_id"""),
    "calls": (["speech_payload", "digest_payload"], _extras(f"""
        SELECT conv_id, {_day()} AS v_date,
               CAST(CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS source,
               CAST(conv_id AS VARCHAR) AS order_no, CAST(conv_id AS VARCHAR) AS task_no,
               jsx AS result, CAST(CAST({_q(fx.CALL_DATE)} AS DATE) + CAST(conv_id % 2 AS INTEGER) AS DATE) AS compute_date
        FROM (SELECT p.conv_id, CASE WHEN p.conv_id % 2 = 0 THEN d.js1 ELSE p.js END AS jsx
              FROM speech_payload p JOIN digest_payload d ON p.conv_id = d.conv_id)""", "task_no", "result")),
    "tickets": ([], """
        SELECT CASE WHEN o_orderkey % 89 <> 7 THEN CAST(o_orderdate AS DATE) END AS v_date, CAST(o_orderkey AS VARCHAR) AS issue_no,
               CAST(o_custkey AS VARCHAR) AS order_no, o_orderpriority AS problem_config_no_3,
               CASE WHEN o_orderkey % 97 = 5 THEN NULL WHEN o_orderkey % 97 = 6 THEN 'n/a'
                    ELSE CAST(coalesce(li.n, 0) AS VARCHAR) END AS caller_num
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) li
             ON o_orderkey = li.l_orderkey"""),
    "canned": ([], f"""
        SELECT DISTINCT trim(text) AS sentence FROM conversations
        WHERE conv_id % {fx.CANNED_MOD} = 0 AND turn = 0 AND text IS NOT NULL"""),
    "labelled": ([], """
        SELECT d.doc_id, d.text, CAST(l.quality AS DOUBLE) AS label
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""),
    # ---- derived views used by several queries ----
    "chat_msgs": (["chat_json"], """
        SELECT create_time, session_id, user_id, agent_id, CAST(pos AS INTEGER) AS pos, e,
               CAST(len(list_distinct(json_keys(e))) AS INTEGER) AS n_keys, e->>'userId' AS user_key, e->>'digest' AS digest
        FROM (SELECT create_time, session_id, user_id, agent_id,
                     unnest(from_json(chat_records, '["JSON"]')) AS e,
                     generate_subscripts(from_json(chat_records, '["JSON"]'), 1) - 1 AS pos
              FROM chat_json
              WHERE CASE WHEN json_valid(chat_records) THEN json_type(chat_records) = 'ARRAY' ELSE false END)"""),
    "chat_spoken": (["chat_msgs"], """
        SELECT *, CASE WHEN user_key IS NOT DISTINCT FROM user_id THEN 'user'
                       WHEN user_key IS NOT DISTINCT FROM agent_id THEN 'agent' END AS speaker
        FROM chat_msgs WHERE n_keys = 8"""),
    "chat_sent": (["chat_spoken", "canned"], f"""
        SELECT s.*, list_filter(regexp_extract_all(lower(digest), {WORD_RE}),
                                lambda t: translate(t, {FILTER_SQL}, '') <> '') AS tokens
        FROM chat_spoken s
        WHERE speaker IS NOT NULL AND NOT EXISTS (SELECT 1 FROM canned c WHERE c.sentence = trim(s.digest))"""),
    "chat_scored": (["chat_sent", "terms"], f"""
        SELECT *, CAST(len(list_filter(tokens, lambda t: list_contains({TERMS_SQL}, t))) AS DOUBLE)
                  / CAST(len(tokens) AS DOUBLE) AS score
        FROM chat_sent
        WHERE len(tokens) > 0
          AND EXISTS (SELECT 1 FROM terms WHERE contains(array_to_string(tokens, ''), term))"""),
    "speech_sent": (["speech_json"], """
        SELECT task_no, order_no, score_qingxu, v_date, CAST(pos AS INTEGER) AS pos,
               s.text AS text, s.wordList AS words
        FROM (SELECT task_no, order_no, score_qingxu, v_date,
                     unnest(p.sentenceListData) AS s,
                     generate_subscripts(p.sentenceListData, 1) - 1 AS pos
              FROM (SELECT *, CASE WHEN json_valid(result) THEN from_json(result,
                      '{"sentenceListData":[{"text":"VARCHAR","wordList":["VARCHAR"]}]}') END AS p
                    FROM speech_json))"""),
    "speech_scored": (["speech_sent", "terms"], f"""
        SELECT *, 0.8 * (CAST(len(list_filter(tokens, lambda t: list_contains({TERMS_SQL}, t))) AS DOUBLE)
                         / CAST(len(tokens) AS DOUBLE)) + 0.2 * score_qingxu AS score
        FROM (SELECT *, list_filter(words, lambda t: translate(t, {FILTER_SQL}, '') <> '') AS tokens
              FROM speech_sent WHERE len(words) >= 5)
        WHERE len(tokens) > 0
          AND EXISTS (SELECT 1 FROM terms WHERE contains(array_to_string(tokens, ''), term))"""),
    "rules_p": (["rules"], """
        SELECT question_type, threshold, keywords FROM (
            SELECT question_type, TRY_CAST(caller_threshold AS DOUBLE) AS threshold,
                   string_split(key_words, '#') AS keywords,
                   row_number() OVER (PARTITION BY question_type ORDER BY rule_id DESC) AS rn
            FROM rules WHERE TRY_CAST(caller_threshold AS DOUBLE) IS NOT NULL AND question_type IS NOT NULL
                  AND key_words IS NOT NULL)
        WHERE rn = 1"""),
    "tickets_t": (["tickets", "rules_p"], """
        SELECT t.* REPLACE (TRY_CAST(t.caller_num AS INTEGER) AS caller_num), r.threshold,
               TRY_CAST(t.caller_num AS DOUBLE) >= r.threshold AS passes
        FROM tickets t JOIN rules_p r ON t.problem_config_no_3 = r.question_type
        WHERE TRY_CAST(t.caller_num AS INTEGER) IS NOT NULL AND t.v_date IS NOT NULL"""),
    "orders_i": (["tickets_t"], """
        SELECT order_no, question_type, passes, n_tickets, n_passing, max_caller_num FROM (
            SELECT order_no,
                   arg_max(problem_config_no_3, (v_date, issue_no)) AS question_type,
                   bool_or(passes) AS passes, count(*) AS n_tickets,
                   CAST(sum(CAST(passes AS INTEGER)) AS BIGINT) AS n_passing, max(caller_num) AS max_caller_num
            FROM tickets_t GROUP BY order_no)"""),
    "call_texts": (["calls"], """
        SELECT *, CASE
            WHEN NOT json_valid(result) THEN NULL
            WHEN source = 1 THEN list_transform(from_json(result, '[{"digest":"VARCHAR"}]'), lambda x: x.digest)
            WHEN source = 2 THEN list_transform(from_json(result, '{"sentenceListData":[{"text":"VARCHAR"}]}')
                                                .sentenceListData, lambda x: x.text)
            END AS texts
        FROM calls"""),
    "calls_k": (["call_texts", "orders_i", "rules_p"], """
        SELECT c.*, o.question_type, r.keywords
        FROM call_texts c JOIN orders_i o ON c.order_no = o.order_no AND o.passes
        JOIN rules_p r ON o.question_type = r.question_type"""),
    "flow_res": (["calls_k"], """
        SELECT strftime(v_date, '%Y-%m-%d') AS v_date, source, order_no, task_no, h.keyword AS keyword, h.text AS text
        FROM (SELECT *, list_filter(list_transform(texts, lambda t, i: {
                     'pos': i, 'keyword': list_filter(keywords, lambda k: contains(t, k))[1], 'text': t}),
                   lambda x: x.text IS NOT NULL AND x.text <> '' AND x.keyword IS NOT NULL)[1] AS h
              FROM calls_k)
        WHERE h IS NOT NULL"""),
    "chat_best": (["chat_scored"], f"""
        SELECT create_time, session_id, speaker, score AS best_score, pos AS best_pos, digest AS best_text FROM (
            SELECT *, row_number() OVER (PARTITION BY create_time, session_id, speaker ORDER BY score DESC, pos) AS rn
            FROM chat_scored WHERE score > {fx.TEST_THRESHOLD} AND score > 0)
        WHERE rn = 1"""),
    "chat_pair": (["chat_best"], """
        SELECT s.create_time, s.session_id, u.best_score AS us, u.best_text AS ut, a.best_score AS ks, a.best_text AS kt
        FROM (SELECT DISTINCT create_time, session_id FROM chat_best) s
        LEFT JOIN chat_best u ON u.session_id = s.session_id AND u.create_time = s.create_time AND u.speaker = 'user'
        LEFT JOIN chat_best a ON a.session_id = s.session_id AND a.create_time = s.create_time
                              AND a.speaker = 'agent'"""),
    "chat_result": (["chat_pair"], f"""
        SELECT strftime(create_time, '%Y-%m-%d') AS v_date, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS event_time,
               CAST(1 AS INTEGER) AS source, session_id AS record_id, text AS problem_text, score
        FROM (SELECT *, CASE WHEN coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL THEN coalesce(us, 0.0)
                             WHEN coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL THEN coalesce(ks, 0.0)
                        END AS score,
                        CASE WHEN coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL THEN ut
                             WHEN coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL THEN kt END AS text
              FROM chat_pair)
        WHERE score IS NOT NULL AND score >= {fx.TEST_THRESHOLD}"""),
    "speech_best": (["speech_scored"], f"""
        SELECT v_date, task_no, score AS best_score, pos AS best_pos, array_to_string(words, ' ') AS best_text FROM (
            SELECT *, row_number() OVER (PARTITION BY v_date, task_no ORDER BY score DESC, pos) AS rn
            FROM speech_scored WHERE score >= {fx.TEST_THRESHOLD} AND score > 0)
        WHERE rn = 1"""),
    "speech_result": (["speech_best"], f"""
        SELECT strftime(v_date, '%Y-%m-%d') AS v_date, strftime(v_date, '%Y-%m-%d') AS event_time,
               CAST(2 AS INTEGER) AS source, task_no AS record_id, best_text AS problem_text, best_score AS score
        FROM speech_best WHERE best_score >= {fx.TEST_THRESHOLD}"""),
    "audit_rows": (["chat_result", "speech_result"], """
        SELECT * FROM chat_result UNION ALL SELECT * FROM speech_result"""),
    "integrated": (["audit_rows", "calls"], """
        SELECT r.*, d.order_no, d.call_source
        FROM audit_rows r LEFT JOIN (
            SELECT strftime(v_date, '%Y-%m-%d') AS v_date, task_no AS record_id,
                   arg_max(order_no, (order_no, source)) AS order_no, arg_max(source, (order_no, source)) AS call_source
            FROM calls GROUP BY 1, 2) d
        ON r.v_date = d.v_date AND r.record_id = d.record_id"""),
}


def with_views(body: str, *names: str) -> str:
    """``WITH`` the named views (and their dependencies, in order) ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"
