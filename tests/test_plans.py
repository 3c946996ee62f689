"""Plan-shape guards for every registered query of the reference's operators."""

import pytest

from conftest import SF001
from convaudit.oracle_queries import SQL
from convaudit.registry import QUERIES

BAD = ["BroadcastNestedLoopJoin", "CartesianProduct"]


# every key with SQL, and the ML keys whose plan holds joins; the others fit a model first and plan none
@pytest.mark.parametrize("name", sorted({*SQL, "model_report", "chat_audit_lr"}))
def test_no_theta_or_cross_join(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in BAD:
        assert op not in plan, f"{name} plans a {op}"
    # nothing funnels all rows into one task (a global window, sort or limit). A
    # global aggregate's final step is fine: only one partial row per task reaches
    # it. The rank AUC's single-partition window sees one row per range partition.
    if name in ("eval_auc_rank", "model_report", "train_shuffle"):
        return
    lines = [ln for ln in plan.splitlines() if ln.strip()]
    for i, ln in enumerate(lines):
        if "SinglePartition" in ln:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            assert "Aggregate(keys=[]" in below, f"{name} moves all rows into one partition:\n{plan}"


def test_hot_order_is_dealt_over_tasks(spark):
    """Half of all calls on one order: the salted join leaves no task with more than a quarter of them."""
    from pyspark.sql import functions as F

    from convaudit.operators import flow

    n = 16_000
    calls = spark.range(n).select(
        F.lit("2024-01-15").cast("date").alias("v_date"), F.lit(1).alias("source"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_no"),
        F.col("id").cast("string").alias("task_no"), F.lit("[]").alias("result"))
    orders = calls.select("order_no").distinct().select(
        "order_no", F.lit("T").alias("question_type"), F.lit(True).alias("passes"), F.lit(1).cast("long").alias("n_tickets"),
        F.lit(1).cast("long").alias("n_passing"), F.lit(1).alias("max_caller_num"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = flow.scan_calls(calls, orders).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == n
    assert max(r["count"] for r in sizes) <= n // 4


def test_only_hot_orders_are_repeated(spark):
    """The orders' side of the join has at most a tenth more rows than orders; without a hot one the join is plain."""
    from pyspark.sql import functions as F

    from convaudit.operators import flow

    n = 8_000
    calls = spark.range(2 * n).select(
        F.lit("2024-01-15").cast("date").alias("v_date"), F.lit(1).alias("source"),
        F.when(F.col("id") < n, "hot").when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("order_no"),
        F.col("id").cast("string").alias("task_no"), F.lit("[]").alias("result"))
    orders = calls.select("order_no").where("order_no is not null").distinct().select(
        "order_no", F.lit("T").alias("question_type"), F.lit(True).alias("passes"), F.lit(1).cast("long").alias("n_tickets"),
        F.lit(1).cast("long").alias("n_passing"), F.lit(1).alias("max_caller_num"))
    assert flow.hot_orders(calls) == ["hot"]
    joined = flow.scan_calls(calls, orders)
    assert joined.count() == calls.where("order_no is not null").count()
    path = f"{spark.conf.get('spark.checkpoint.dir')}/event-{id(joined)}"
    orders.write.parquet(path)
    plan = flow.scan_calls(calls, spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan
    salted = orders.count() + (flow.SALTS - 1)
    assert salted <= 1.1 * orders.count()
    even = calls.where("order_no <> 'hot'")
    assert flow.hot_orders(even) == [] and flow.hot_orders(calls.where("false")) == []
    assert "Generate explode" not in flow.scan_calls(even, orders)._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_day_joins_without_a_shuffle(spark):
    """Neither side of the serving join is exchanged, also where a broadcast is ruled out; a rerun replaces its day."""
    from pyspark.sql import functions as F

    from convaudit.plans import audit
    from convaudit.sources.sinks import write_bucketed

    base = spark.conf.get("spark.checkpoint.dir")
    results = spark.range(400).select(F.concat(F.lit("r"), F.col("id") % 300).alias("record_id"), (F.col("id") * 0.5).alias("score"),
                                      F.when(F.col("id") % 2 == 0, "2024-01-15").otherwise("2024-01-16").alias("v_date"))
    calls = spark.range(900).select(F.concat(F.lit("r"), F.col("id") % 450).alias("task_no"), F.col("id").cast("string").alias("order_no"),
                                    F.lit(1).alias("source"), F.lit("2024-01-15").alias("v_date"))
    name = f"t{id(results)}"
    write_bucketed(results, f"r_{name}", f"{base}/r-{name}", "record_id", 4)
    write_bucketed(calls, f"c_{name}", f"{base}/c-{name}", "task_no", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = audit.integrate_day(spark.table(f"r_{name}"), spark.table(f"c_{name}"), "2024-01-15")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = audit.integrate(results.where("v_date = '2024-01-15'"), calls)
        cols = sorted(out.columns)
        assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))
        write_bucketed(results.where("v_date = '2024-01-15' and score > 100"), f"r_{name}", f"{base}/r-{name}", "record_id", 4)
        spark.catalog.refreshTable(f"r_{name}")
        left = spark.table(f"r_{name}")
        assert left.where("v_date = '2024-01-16'").count() == 200 and left.where("v_date = '2024-01-15'").count() == 99
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
