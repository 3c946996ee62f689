"""Plan helpers: empty lexicon entry, byte bounds, targeted partitioned writes."""

import os

from pyspark.sql import functions as F

from convaudit.operators import lexicon as lexops
from convaudit.operators.util import is_bounded, keep_where, present
from convaudit.sources.sinks import FLOW_PARTITIONS, write_partitioned


def test_empty_entry_matches_every_text_on_the_join_path(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["b", "c"])], "id int, tokens array<string>")
    lex = spark.createDataFrame([("",), ("zz",)], "entry string")
    assert {r.id for r in lexops.semi_join_lexicon(df, lex, "substring").collect()} == {1, 2}
    assert lexops.semi_join_lexicon(df, lex, "token").count() == 0


def test_salted_partitioned_write(spark, tmp_path):
    df = spark.range(100).select(F.lit("2024-01-15").alias("v_date"), (F.col("id") % 2).cast("int").alias("source"),
                                 F.col("id"))
    out = str(tmp_path / "o")
    write_partitioned(df, out, target_files_per_partition=3)
    assert spark.read.parquet(out).count() == 100
    files = [f for f in os.listdir(os.path.join(out, "v_date=2024-01-15", "source=0")) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 3


def _audit(spark, rows):
    return spark.createDataFrame(rows, "v_date string, source int, record_id string")


def _ids(spark, out):
    return sorted(r.record_id for r in spark.read.parquet(out).collect())


def test_empty_rerun_clears_its_target_only(spark, tmp_path):
    out = str(tmp_path / "o")
    write_partitioned(_audit(spark, [("d1", 1, "a"), ("d1", 2, "b"), ("d2", 1, "c")]), out)
    none = _audit(spark, [("d1", 1, "x")]).where("false")
    write_partitioned(none, out, targets=[{"v_date": "d1", "source": 1}])
    assert _ids(spark, out) == ["b", "c"]
    write_partitioned(_audit(spark, [("d1", 2, "n")]), out, targets=[{"v_date": "d1"}])
    assert _ids(spark, out) == ["c", "n"]


def test_runs_of_two_days_keep_each_other(spark, tmp_path):
    out = str(tmp_path / "o")
    for day, rows in (("d1", [("d1", 1, "a"), ("d1", 2, "b")]), ("d2", [("d2", 1, "c")]), ("d1", [("d1", 1, "z")])):
        df = spark.createDataFrame(rows, "check_date string, source int, record_id string")
        write_partitioned(df, out, FLOW_PARTITIONS, targets=[{"check_date": day}])
    assert _ids(spark, out) == ["c", "z"]


def test_present_and_keep_where(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.1)], "id int, s double")
    assert {r.id for r in keep_where(df, "s", lambda x: x > 0.2).collect()} == {1}
    assert keep_where(df, "s", lambda x: x > 0.2).columns == ["id", "s"]
    assert df.select(present(F.col("s")).alias("s")).count() == 2
    assert is_bounded(df, 96) and not is_bounded(df, 95)  # three rows of two 16-byte columns
