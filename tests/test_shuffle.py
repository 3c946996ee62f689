"""The seeded shuffle: a permutation, repeatable, different per seed, and even."""

import hashlib

from pyspark.sql import functions as F

from convaudit.operators.shuffle import shuffled


def places(df, **kw):
    return {r.id: r.place for r in shuffled(df, ["id"], **kw).collect()}


def test_permutation_that_repeats(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("label")).repartition(5)
    first = places(df)
    assert sorted(first.values()) == list(range(3000))
    order = sorted(range(3000), key=lambda i: hashlib.sha256(f"42:{i}".encode()).hexdigest())
    assert [i for i, _ in sorted(first.items(), key=lambda x: x[1])] == order
    assert places(df.repartition(2), digits=1) == first == places(df.coalesce(1), digits=4)
    assert places(df, seed=7) != first


def test_neighbours_and_labels_are_mixed(spark):
    df = spark.range(4000).select("id", (F.col("id") < 2000).cast("int").alias("label"))
    at = places(df)
    front = sum(at[i] < 2000 for i in range(2000))
    assert 900 < front < 1100
    assert sum(abs(at[i] - at[i + 1]) for i in range(3999)) / 3999 > 1000


def test_nulls_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None)], "id long, t string")
    got = shuffled(df, ["id"]).collect()
    assert sorted(r.place for r in got) == list(range(5))
    assert sorted((r.id or 0, r.t or "") for r in got) == [(0, ""), (0, "c"), (1, "a"), (1, "a"), (1, "b")]
    assert shuffled(df.where("false"), ["id"]).count() == 0


def test_rows_are_numbered_in_many_tasks(spark):
    plan = shuffled(spark.range(100), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the offsets: one row per bucket
