"""Ticket flow check: rules -> tickets -> calls -> first keyword sentence.

Plan shape (one Spark job; two small ones before it measure the rules and name the hot orders):

* rules are parsed and de-duplicated (last valid row per type wins) and, being a
  bounded configuration table, broadcast (bytes checked);
* tickets are filtered by date and rule type, rows that don't parse are skipped,
  the others tagged with pass/fail against their type's threshold, then aggregated
  once per order: the order's type is the last ticket's type (over *all* scanned
  valid tickets, as in the reference) and the order passes when any of its tickets
  does;
* call records join that per-order table on ``order_no``. Only hot orders, which a sketch of the calls
  names, also get a salt: the few bytes of such an order stand ``SALTS`` times, and its calls are dealt
  over as many tasks, so an order with a third of all calls isn't one task's work. The order's summary
  rides along, so it isn't joined a second time. Calls pick up their keywords from
  the broadcast rules and find the first matching sentence *inside the row* with
  higher-order functions, so the call texts are never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convaudit.config import NO_KEYWORD
from convaudit.functions.lexicon import first_contained
from convaudit.operators.parse import call_texts
from convaudit.operators.util import BROADCAST_BYTES, is_bounded, maybe_broadcast, present


def parse_rules(rules: DataFrame, order_col: str = "rule_id") -> DataFrame:
    """Rule table -> one row per question type.

    Rows whose threshold is not a number, or without keywords (null) or a type, are
    skipped; among the rest the last row (by ``order_col``) of each type wins.
    Keywords split on ``#``: an empty text gives ``['']``, and ``''`` is contained in
    every text.
    """
    ok = rules.select(
        order_col, "question_type",
        F.col("caller_threshold").try_cast("double").alias("threshold"),
        F.split("key_words", "#").alias("keywords"),
    ).where(F.col("threshold").isNotNull() & F.col("question_type").isNotNull() & F.col("keywords").isNotNull())
    last = ok.groupBy("question_type").agg(
        F.max(F.struct(order_col, "threshold", "keywords")).alias("_r"))
    return last.select("question_type", F.col("_r.threshold").alias("threshold"),
                       F.col("_r.keywords").alias("keywords"))


#: Tasks that the calls of one order are dealt over.
SALTS = 16
#: An order with this share of the calls is hot; items that the sketch tracks.
HOT_SHARE, TRACKED = 1 / 64, 16_384


def whole_number(c: Column) -> Column:
    """An int from an int or a text of digits with an optional sign; anything else is null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def _between(c: Column, dates: tuple[str, str] | None) -> Column:
    if dates is None:
        return F.lit(True)
    lo, hi = dates
    return (c >= F.lit(lo).cast("date")) & (c <= F.lit(hi).cast("date"))


def rules_are_small(rules_p: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rule table's bytes allow a broadcast (checked once per plan)."""
    return is_bounded(rules_p, max_bytes)


def scan_tickets(tickets: DataFrame, rules_p: DataFrame, dates: tuple[str, str] | None = None,
                 small_rules: bool | None = None) -> DataFrame:
    """Tickets of the date window whose type has a rule.

    The date predicate reaches the parquet scan; the type restriction is a
    semi join against the broadcast rule types (the reference's ``IN`` list).
    """
    small = rules_are_small(rules_p) if small_rules is None else small_rules
    types = maybe_broadcast(rules_p.select(F.col("question_type").alias("problem_config_no_3")), small)
    return tickets.where(_between(F.col("v_date"), dates)).join(types, "problem_config_no_3", "left_semi")


def ticket_thresholds(tickets_s: DataFrame, rules_p: DataFrame, small_rules: bool | None = None) -> DataFrame:
    """Each scanned ticket with its type's threshold and pass flag."""
    small = rules_are_small(rules_p) if small_rules is None else small_rules
    r = maybe_broadcast(rules_p.select(F.col("question_type").alias("problem_config_no_3"), "threshold"), small)
    # rows that don't parse are skipped before anything is learned from them
    t = tickets_s.withColumn("caller_num", whole_number(F.col("caller_num"))).where(
        F.col("caller_num").isNotNull() & F.col("v_date").isNotNull())
    t = t.join(r, "problem_config_no_3")
    return t.withColumn("passes", F.col("caller_num").cast("double") >= F.col("threshold"))


def order_info(tickets_t: DataFrame) -> DataFrame:
    """Per order: the last ticket's type (A4) and whether any ticket passes.

    "Last" is the greatest ``(v_date, issue_no)``; the reference takes database
    order, which its query does not fix. One partial aggregate, skew-safe.
    """
    a = tickets_t.groupBy("order_no").agg(
        F.max(F.struct("v_date", "issue_no", "problem_config_no_3")).alias("_last"),
        F.max(F.col("passes").cast("int")).alias("_pass"),
        F.count(F.lit(1)).alias("n_tickets"),
        F.sum(F.col("passes").cast("int")).alias("n_passing"),
        F.max("caller_num").alias("max_caller_num"),
    )
    return a.select("order_no", F.col("_last.problem_config_no_3").alias("question_type"),
                    (F.col("_pass") == 1).alias("passes"), "n_tickets",
                    F.col("n_passing").cast("long").alias("n_passing"), "max_caller_num")


ORDER_COLUMNS = ["question_type", "n_tickets", "n_passing", "max_caller_num"]


def scan_calls(calls: DataFrame, orders: DataFrame, dates: tuple[str, str] | None = None,
               check_date: str | None = None, check_col: str = "compute_date") -> DataFrame:
    """Call records of the window that belong to a passing order.

    Joined (not semi-joined) so the order's type and ticket summary ride along. The calls of
    hot orders are salted by a hash of the row and these orders repeated for each salt; all other
    orders stand once and join plainly, so Spark may filter the calls by their keys at run time.
    ``check_date`` keeps the records computed for that date; it applies to tables
    that carry ``check_col``.
    """
    c = calls.where(_between(F.col("v_date"), dates))
    if check_date is not None and check_col in calls.columns:
        c = c.where(F.col(check_col) == F.lit(check_date).cast("date"))
    o = orders.where(F.col("passes")).select("order_no", *ORDER_COLUMNS)
    hot = hot_orders(c)
    if not hot:
        return c.join(o, "order_no")
    is_hot, every = F.col("order_no").isin(*hot), F.sequence(F.lit(0), F.lit(SALTS - 1))
    o = o.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    salt = F.when(is_hot, F.pmod(F.xxhash64("task_no", "result"), F.lit(SALTS))).otherwise(0).cast("int")
    return c.withColumn("_salt", salt).join(o, ["order_no", "_salt"]).drop("_salt")


def hot_orders(calls: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """Orders with ``share`` of the calls or more, by a frequent-items sketch of the order numbers.

    One job over that column runs when the plan is made; it sends one sketch per task, and there are at most
    ``1 / share`` such orders. The sketch counts at least what is there, so none is missed.
    """
    top = F.expr(f"approx_top_k(order_no, {int(2 / share)}, {TRACKED})")
    r = calls.where(F.col("order_no").isNotNull()).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return sorted(x["item"] for x in r.top or [] if x["count"] >= r.n * share)


def attach_keywords(calls_t: DataFrame, rules_p: DataFrame, small_rules: bool | None = None) -> DataFrame:
    """Bring each call's keyword list into the row (J4). Unknown types drop out."""
    small = rules_are_small(rules_p) if small_rules is None else small_rules
    r = maybe_broadcast(rules_p.select("question_type", "keywords"), small)
    return calls_t.join(r, "question_type")


def first_hit(texts: Column, keywords: Column | None) -> Column:
    """First non-empty sentence (in list order) holding a keyword, and that
    keyword (first in rule order) — evaluated inside the row (J9, A5, A6).

    With ``keywords=None`` (keyword filtering off) the first non-empty sentence
    is taken and the keyword is the literal ``'null'``.
    Returns ``struct(pos, keyword, text)`` or null.
    """
    if keywords is None:
        cand = F.transform(texts, lambda t, i: F.struct(
            i.alias("pos"), F.lit(NO_KEYWORD).alias("keyword"), t.alias("text")))
        ok = F.filter(cand, lambda x: x["text"].isNotNull() & (x["text"] != ""))
    else:
        cand = F.transform(texts, lambda t, i: F.struct(
            i.alias("pos"), first_contained(t, keywords).alias("keyword"), t.alias("text")))
        ok = F.filter(cand, lambda x: x["text"].isNotNull() & (x["text"] != "") & x["keyword"].isNotNull())
    return F.get(ok, 0)


def flow_results(calls_k: DataFrame, is_keyword: bool = True) -> DataFrame:
    """One row per call record with a hit: v_date, source, order_no, task_no, keyword, text, and the order's summary."""
    texts = call_texts(F.col("result"), F.col("source"))
    hit = first_hit(texts, F.col("keywords") if is_keyword else None)
    r = calls_k.select("v_date", "source", "order_no", "task_no", *ORDER_COLUMNS, present(hit).alias("_h"))
    return r.select(F.date_format("v_date", "yyyy-MM-dd").alias("v_date"), F.col("source").cast("int").alias("source"),
                    "order_no", "task_no", F.col("_h.keyword").alias("keyword"), F.col("_h.text").alias("text"), *ORDER_COLUMNS)


def flow_rows(results: DataFrame) -> DataFrame:
    """The declared flow_result columns."""
    return results.drop(*ORDER_COLUMNS)
