"""Q3: the ticket flow check as one DataFrame plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from convaudit import schemas
from convaudit.config import FlowConfig
from convaudit.operators import flow


@dataclass
class FlowOutputs:
    rules: DataFrame        # parsed rules, one row per type
    tickets: DataFrame      # scanned tickets with threshold and pass flag
    orders: DataFrame       # per order: last type, pass flag, ticket summary
    calls: DataFrame        # calls of passing orders with their keywords
    results: DataFrame      # flow_result rows
    summary: DataFrame      # results joined to their order's ticket summary


def flow_check(rules: DataFrame, tickets: DataFrame, calls: DataFrame,
               cfg: FlowConfig = FlowConfig()) -> FlowOutputs:
    rules = schemas.require(rules, schemas.FLOW_RULE, "flow_rule")
    tickets = schemas.require(tickets.withColumn("caller_num", tickets["caller_num"].cast("string")), schemas.TICKET, "ticket")
    extra = [c for c in ("compute_date",) if c in calls.columns]
    calls = schemas.require(calls, schemas.CALL_RECORD, "call_record", extra)
    # parsed rules are no larger than the raw rule rows: bound the raw table (no shuffle)
    small = flow.rules_are_small(rules, cfg.max_broadcast_bytes)
    rules_p = flow.parse_rules(rules)
    t = flow.ticket_thresholds(flow.scan_tickets(tickets, rules_p, cfg.ticket_dates, small), rules_p, small)
    orders = flow.order_info(t)
    c = flow.attach_keywords(flow.scan_calls(calls, orders, cfg.call_dates, cfg.check_date), rules_p, small)
    summary = flow.flow_results(c, cfg.is_keyword)
    return FlowOutputs(rules_p, t, orders, c, flow.flow_rows(summary), summary)
