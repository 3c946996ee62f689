"""DuckDB SQL per registered query key (see ``convaudit.oracle`` for the views)."""

from __future__ import annotations

from convaudit.oracle import FILTER_SQL, TERMS_SQL, WORD_RE
from convaudit.oracle import with_views as W
from convaudit.sources import fixtures as fx

T = fx.TEST_THRESHOLD

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- flow check
SQL["rule_parse"] = W("""
SELECT question_type, threshold AS caller_threshold, array_to_string(keywords, '#') AS key_words,
       CAST(len(keywords) AS INTEGER) AS n_keywords
FROM rules_p""", "rules_p")

SQL["ticket_scan"] = W(f"""
SELECT strftime(v_date, '%Y-%m-%d') AS v_date, issue_no, order_no, problem_config_no_3, caller_num
FROM tickets WHERE problem_config_no_3 IN (SELECT question_type FROM rules_p)
  AND v_date BETWEEN CAST('{fx.TICKET_DATES[0]}' AS DATE) AND CAST('{fx.TICKET_DATES[1]}' AS DATE)""", "tickets", "rules_p")

SQL["ticket_threshold"] = W("""
SELECT strftime(v_date, '%Y-%m-%d') AS v_date, issue_no, order_no, problem_config_no_3, caller_num, threshold
FROM tickets_t WHERE passes""", "tickets_t")

SQL["order_type_last"] = W("SELECT order_no, question_type, n_tickets FROM orders_i", "orders_i")

SQL["call_scan"] = W(f"""
SELECT c.task_no, c.order_no, c.source, o.question_type
FROM calls c JOIN orders_i o ON c.order_no = o.order_no
WHERE o.passes AND c.compute_date = CAST('{fx.CALL_DATE}' AS DATE)
  AND c.v_date BETWEEN CAST('{fx.CALL_DATES[0]}' AS DATE) AND CAST('{fx.CALL_DATES[1]}' AS DATE)""", "calls", "orders_i")

SQL["call_keywords"] = W("""
SELECT task_no, order_no, question_type, array_to_string(keywords, '#') AS key_words FROM calls_k""", "calls_k")

SQL["flow_first_keyword"] = W("""
SELECT strftime(v_date, '%Y-%m-%d') AS v_date, source, order_no, task_no, h.keyword AS keyword, h.text AS text
FROM (SELECT c.*, list_filter(list_transform(c.texts, lambda t: {
             'keyword': list_filter(r.keywords, lambda k: contains(t, k))[1], 'text': t}),
           lambda x: x.text IS NOT NULL AND x.text <> '' AND x.keyword IS NOT NULL)[1] AS h
      FROM call_texts c JOIN orders_i o ON c.order_no = o.order_no
      JOIN rules_p r ON o.question_type = r.question_type)
WHERE h IS NOT NULL""", "call_texts", "orders_i", "rules_p")

SQL["flow_first_sentence"] = W("""
SELECT strftime(v_date, '%Y-%m-%d') AS v_date, source, order_no, task_no, 'null' AS keyword, h AS text
FROM (SELECT *, list_filter(texts, lambda t: t IS NOT NULL AND t <> '')[1] AS h FROM calls_k)
WHERE h IS NOT NULL""", "calls_k")

SQL["flow_check"] = W("SELECT * FROM flow_res", "flow_res")

SQL["flow_summary"] = W("""
SELECT f.*, o.question_type, o.n_tickets, o.n_passing, o.max_caller_num
FROM flow_res f LEFT JOIN orders_i o ON f.order_no = o.order_no""", "flow_res", "orders_i")

# ---------------------------------------------------------------- sources
SQL["lexicon_lines"] = r"""
SELECT item_id, CAST(i - 1 AS INTEGER) AS line_no, entry, CAST(length(entry) AS INTEGER) AS n_chars
FROM (SELECT item_id, unnest(l) AS entry, generate_subscripts(l, 1) AS i
      FROM (SELECT item_id, CASE WHEN regexp_matches(text, '(\r|\n)$') THEN parts[1:len(parts) - 1]
                                 ELSE parts END AS l
            FROM (SELECT item_id, text, string_split_regex(text, '\r\n|\r|\n') AS parts FROM benchmark)))"""

SQL["chat_day_scan"] = f"""
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
WHERE ts >= CAST('{fx.EVENT_DAY}' AS TIMESTAMP) AND ts < CAST('{fx.EVENT_DAY}' AS TIMESTAMP) + INTERVAL 1 DAY"""

SQL["speech_day_scan"] = f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS v_date FROM orders
WHERE o_orderdate >= CAST('{fx.ORDER_DAY}' AS TIMESTAMP)
  AND o_orderdate < CAST('{fx.ORDER_DAY}' AS TIMESTAMP) + INTERVAL 1 DAY"""

# ---------------------------------------------------------------- parsing
SQL["chat_explode"] = W("SELECT session_id, pos, n_keys, user_key, digest FROM chat_msgs", "chat_msgs")
SQL["chat_arity_guard"] = W("SELECT session_id, pos, user_key FROM chat_msgs WHERE n_keys = 8", "chat_msgs")
SQL["speaker_split"] = W("SELECT session_id, pos, speaker FROM chat_spoken WHERE speaker IS NOT NULL",
                         "chat_spoken")
SQL["canned_anti"] = W("SELECT session_id, pos, speaker FROM chat_sent", "chat_sent")
SQL["speech_explode"] = W("SELECT task_no, pos, text, CAST(len(words) AS INTEGER) AS n_words FROM speech_sent",
                          "speech_sent")
SQL["speech_min_words"] = W("""
SELECT task_no, pos, CAST(len(words) AS INTEGER) AS n_words FROM speech_sent WHERE len(words) >= 5""", "speech_sent")

SQL["json_quarantine"] = W("""
SELECT * FROM (
SELECT 'chat' AS kind, session_id AS record_id,
       CASE WHEN NOT json_valid(chat_records) THEN 'bad_json'
            WHEN json_type(chat_records) <> 'ARRAY' THEN 'bad_shape'
            WHEN len(list_filter(from_json(chat_records, '["JSON"]'),
                     lambda e: len(list_distinct(json_keys(e))) = 8 AND (e->>'userId' IS NULL OR e->>'digest' IS NULL))) > 0
            THEN 'missing_field' END AS reason
FROM chat_json WHERE chat_records IS NOT NULL
UNION ALL
SELECT 'speech', task_no,
       CASE WHEN NOT json_valid(result) THEN 'bad_json'
            WHEN json_extract(result, '$.sentenceListData') IS NULL THEN 'bad_shape'
            WHEN len(list_filter(from_json(result, '{"sentenceListData":[{"text":"VARCHAR","wordList":["VARCHAR"]}]}').sentenceListData,
                     lambda x: x.wordList IS NULL)) > 0 THEN 'missing_field'
            WHEN score_qingxu IS NULL THEN 'null_emotion' END
FROM speech_json WHERE result IS NOT NULL
UNION ALL
SELECT 'call', task_no, CASE WHEN texts IS NOT NULL THEN NULL WHEN json_valid(result) THEN 'bad_shape' ELSE 'bad_json' END
FROM call_texts WHERE source IN (1, 2) AND result IS NOT NULL)
WHERE reason IS NOT NULL""", "chat_json", "speech_json", "call_texts")

SQL["flow_sentences"] = W("""
SELECT task_no, source, CAST(i - 1 AS INTEGER) AS pos, text
FROM (SELECT task_no, source, unnest(texts) AS text, generate_subscripts(texts, 1) AS i FROM call_texts)
WHERE text IS NOT NULL AND text <> ''""", "call_texts")

# ---------------------------------------------------------------- text
SQL["tokenize_corpus"] = f"""
SELECT doc_id, CAST(len(regexp_extract_all(lower(text), {WORD_RE})) AS INTEGER) AS n_tokens FROM documents"""

SQL["token_clean"] = f"""
SELECT conv_id, turn, CAST(len(raw) AS INTEGER) AS n_raw, CAST(len(clean) AS INTEGER) AS n_clean
FROM (SELECT conv_id, turn, raw, list_filter(raw, lambda t: translate(t, {FILTER_SQL}, '') <> '') AS clean
      FROM (SELECT conv_id, turn,
                   list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda t: t <> '') AS raw
            FROM conversations))
WHERE len(clean) > 0"""

SQL["vocab_counts"] = f"""
SELECT token, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(text), {WORD_RE})) AS token FROM documents) GROUP BY token"""

SQL["sensitive_token"] = W(f"SELECT session_id, pos FROM chat_sent WHERE list_has_any(tokens, {TERMS_SQL})",
                           "chat_sent")
SQL["sensitive_substring"] = W(f"""
SELECT session_id, pos FROM chat_sent
WHERE EXISTS (SELECT 1 FROM (SELECT term FROM terms UNION ALL SELECT '{fx.MIXED_CASE_ENTRY}' || 'ER') t
              WHERE contains(array_to_string(tokens, ''), lower(t.term)))""", "chat_sent", "terms")
_HIT = "EXISTS (SELECT 1 FROM lexicon WHERE contains(array_to_string(tokens, ''), word))"
SQL["sensitive_automaton"] = W(f"SELECT session_id, pos FROM chat_sent WHERE len(tokens) > 0 AND {_HIT}", "lexicon", "chat_sent")
SQL["lexicon_semi"] = W("""
SELECT DISTINCT s.session_id, s.pos FROM chat_sent s, unnest(s.tokens) AS u(tok)
WHERE u.tok IN (SELECT term FROM terms)""", "chat_sent", "terms")

SQL["threshold_modes"] = W(f"""
SELECT CAST(sum(CAST(score > {T} AS INTEGER)) AS BIGINT) AS n_gt,
       CAST(sum(CAST(score >= {T} AS INTEGER)) AS BIGINT) AS n_ge,
       CAST(sum(CAST(score < {T} AS INTEGER)) AS BIGINT) AS n_lt,
       CAST(sum(CAST(score <= {T} AS INTEGER)) AS BIGINT) AS n_le
FROM chat_scored""", "chat_scored")

# ---------------------------------------------------------------- selection
_ARGMAX = "SELECT session_id, speaker, best_score, best_pos, best_text FROM chat_best"
SQL["chat_argmax"] = W(_ARGMAX, "chat_best")
SQL["chat_argmax_window"] = W(_ARGMAX, "chat_best")
SQL["chat_select_intended"] = W("""
SELECT session_id, speaker, score, text FROM (
  SELECT session_id,
         CASE WHEN coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL THEN 'user'
              WHEN coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL THEN 'agent' END AS speaker,
         CASE WHEN coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL THEN coalesce(us, 0.0)
              WHEN coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL THEN coalesce(ks, 0.0) END AS score,
         CASE WHEN coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL THEN ut
              WHEN coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL THEN kt END AS text
  FROM chat_pair) WHERE speaker IS NOT NULL""", "chat_pair")
SQL["chat_select_faithful"] = W("""
SELECT session_id, 'user' AS speaker, coalesce(us, 0.0) AS score, coalesce(ut, '') AS text
FROM chat_pair
WHERE (coalesce(us, 0.0) > coalesce(ks, 0.0) AND ut IS NOT NULL)
   OR (coalesce(us, 0.0) <= coalesce(ks, 0.0) AND kt IS NOT NULL)""", "chat_pair")
SQL["speech_argmax"] = W("SELECT task_no, best_score, best_pos, best_text FROM speech_best", "speech_best")

SQL["emotion_blend"] = W(f"""
SELECT task_no, pos,
       0.8 * (CAST(len(list_filter(words, lambda t: list_contains({TERMS_SQL}, t))) AS DOUBLE)
              / CAST(len(words) AS DOUBLE)) + 0.2 * score_qingxu AS score
FROM speech_sent WHERE len(words) > 0""", "speech_sent")


def _ratio(terms: list[str]) -> str:
    arr = "[" + ", ".join("'" + t + "'" for t in terms) + "]"
    return (f"CAST(len(list_filter(tokens, lambda t: list_contains({arr}, t))) AS DOUBLE)"
            f" / CAST(len(tokens) AS DOUBLE)")


SQL["ensemble_mean"] = W(f"""
SELECT session_id, pos,
       ({_ratio(fx.TERMS)} + {_ratio(fx.TERMS[:4])} + {_ratio(fx.TERMS[4:])}) / 3.0 AS p_neg
FROM chat_sent WHERE len(tokens) > 0""", "chat_sent")

# ---------------------------------------------------------------- audits
SQL["chat_audit"] = W("SELECT * FROM chat_result", "chat_result")
SQL["speech_audit"] = W("SELECT * FROM speech_result", "speech_result")
SQL["audit_union"] = W("SELECT * FROM audit_rows", "audit_rows")
SQL["integrate_results"] = W("SELECT * FROM integrated", "integrated")
SQL["daily_audit"] = W(f"SELECT * FROM integrated WHERE v_date = '{fx.CALL_DATE}'", "integrated")
SQL["integrate_bucketed"] = SQL["daily_audit"]
SQL["layout_check"] = W("""
SELECT 'chat' AS kind, session_id AS record_id, 10 AS n_columns, 5 AS n_read FROM chat_json
UNION ALL SELECT 'speech', task_no, 13, 5 FROM speech_json""", "chat_json", "speech_json")
SQL["chat_audit_joined_lexicon"] = SQL["chat_audit"]
SQL["chat_audit_large_lexicon"] = W("SELECT * FROM chat_result", "lexicon", "chat_result").replace(
    "EXISTS (SELECT 1 FROM terms WHERE contains(array_to_string(tokens, ''), term))", _HIT)
SQL["audit_sink_rerun"] = W(f"SELECT * FROM audit_rows WHERE NOT (source = 2 AND v_date = '{fx.CALL_DATE}')", "audit_rows")


def _flow_day(check: str, first: str, last: str) -> str:
    return f"""
SELECT '{check}' AS check_date, f.* FROM flow_res f JOIN calls c ON c.task_no = f.task_no
WHERE c.compute_date = CAST('{check}' AS DATE) AND c.v_date BETWEEN CAST('{first}' AS DATE) AND CAST('{last}' AS DATE)"""


SQL["flow_sink_two_days"] = W(" UNION ALL ".join(_flow_day(*d) for d in fx.FLOW_DAYS), "flow_res", "calls")

# ---------------------------------------------------------------- evaluation
_LP = "(SELECT doc_id, CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels)"

SQL["eval_accuracy"] = f"""
SELECT count(*) AS n, CAST(coalesce(sum(CAST((CASE WHEN prediction >= 0.5 THEN 1.0 ELSE 0.0 END) = label AS BIGINT)), 0)
                           AS BIGINT) AS n_correct,
       CASE WHEN count(*) > 0 THEN CAST(sum(CAST((CASE WHEN prediction >= 0.5 THEN 1.0 ELSE 0.0 END) = label AS BIGINT))
                                         AS DOUBLE) / CAST(count(*) AS DOUBLE) END AS accuracy
FROM {_LP}"""

SQL["eval_auc_hard"] = f"""
SELECT n_pos, n_neg, tp, fp,
       CASE WHEN n_pos > 0 AND n_neg > 0 THEN CAST(n_pos * n_neg + tp * n_neg - fp * n_pos AS DOUBLE)
                                             / CAST(2 * n_pos * n_neg AS DOUBLE) END AS auc
FROM (SELECT CAST(sum(CAST(label = 1.0 AS BIGINT)) AS BIGINT) AS n_pos,
             CAST(sum(CAST(label = 0.0 AS BIGINT)) AS BIGINT) AS n_neg,
             CAST(sum(CAST(prediction >= 0.5 AND label = 1.0 AS BIGINT)) AS BIGINT) AS tp,
             CAST(sum(CAST(prediction >= 0.5 AND label = 0.0 AS BIGINT)) AS BIGINT) AS fp
      FROM {_LP})"""

SQL["eval_auc_rank"] = """
SELECT n_pos, n_neg,
       CASE WHEN n_pos > 0 AND n_neg > 0 THEN CAST(two_r - n_pos * (n_pos + 1) AS DOUBLE)
                                             / CAST(2 * n_pos * n_neg AS DOUBLE) END AS auc
FROM (SELECT CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(c) - sum(p) AS BIGINT) AS n_neg,
             CAST(sum(p * (2 * b + c + 1)) AS BIGINT) AS two_r
      FROM (SELECT s, c, p, coalesce(sum(c) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
            FROM (SELECT d.n_chars AS s, count(*) AS c, sum(CAST(l.quality = 1 AS BIGINT)) AS p
                  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
                  WHERE d.n_chars IS NOT NULL AND l.quality IN (0, 1) GROUP BY d.n_chars)))"""

SQL["train_corpus"] = W(f"""
SELECT doc_id, CASE WHEN label = 1.0 THEN 'POS' ELSE 'NEG' END AS tag, label,
       CAST(len(list_filter(regexp_extract_all(lower(text), {WORD_RE}),
                            lambda t: translate(t, {FILTER_SQL}, '') <> '')) AS INTEGER) AS n_tokens
FROM labelled WHERE label IN (0.0, 1.0)""", "labelled")

SQL["train_shuffle"] = W("""
SELECT doc_id, label, row_number() OVER (ORDER BY sha256('42:' || CAST(doc_id AS VARCHAR))) - 1 AS place FROM labelled""", "labelled")

SQL["train_test_split"] = W("""
SELECT CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, label, count(*) AS n
FROM labelled GROUP BY 1, 2""", "labelled")

# ---------------------------------------------------------------- models: what SQL can know
SQL["features_two_view"] = W(f"""
SELECT doc_id, label, CAST(800 AS INTEGER) AS dim,
       CASE WHEN len(list_filter(regexp_extract_all(lower(text), {WORD_RE}), lambda t: translate(t, {FILTER_SQL}, '') <> '')) > 0
            THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sq_norm
FROM labelled""", "labelled")
SQL["ml_output_check"] = W("""
SELECT doc_id, label, true AS in_range, true AS labels_agree, true AS mean_of_parts FROM labelled WHERE doc_id % 5 = 0""", "labelled")
SQL["model_reload"] = W("""
SELECT doc_id, label, true AS same, '20240102-000000' AS version FROM labelled WHERE doc_id % 5 = 0""", "labelled")
