"""Result sinks (S10-S12): one partitioned, rerun-safe write per job.

The reference inserts one row per statement and appends again on a rerun. Here
a job writes its whole result in one distributed write and names the targets it is
to replace (e.g. its day and source). The write overwrites the partitions it has
rows for; a target that it has none for is emptied. Partitions outside the targets
are left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_PARTITIONS = ("v_date", "source")
#: A flow run writes call dates other than its own, so its check date is what a rerun replaces.
FLOW_PARTITIONS = ("check_date", "source")


def _folders(spark: SparkSession, path: str, target: Mapping[str, object], partition_cols: Sequence[str]):
    """(file system, status) of the partition folders that a target names; a column it leaves out matches any value."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    level = [f"{c}={target[c]}" if c in target else f"{c}=*" for c in partition_cols]
    place = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *level]))
    fs = place.getFileSystem(conf)
    return [(fs, s) for s in fs.globStatus(place) or []]


def _files(fs, folder) -> frozenset[str]:
    return frozenset(f.getPath().getName() for f in fs.listStatus(folder.getPath()))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = AUDIT_PARTITIONS,
                      fmt: str = "parquet", target_files_per_partition: int | None = None,
                      targets: Sequence[Mapping[str, object]] = ()) -> None:
    """Overwrite the partitions that ``df`` has rows for, and empty the other ``targets``.

    ``targets``: partition values that this write stands for, e.g.
    ``[{"v_date": day, "source": 1}]``; rows of an earlier run there go even if there
    are no new ones.
    ``target_files_per_partition``: repartition by the partition columns first
    (optionally salted into that many files) so each output partition is
    written by a bounded number of tasks instead of one file per task.
    """
    spark = df.sparkSession
    before = {f.getPath().toString(): _files(fs, f) for t in targets for fs, f in _folders(spark, path, t, partition_cols)}
    out = df
    if target_files_per_partition:
        salt = (F.abs(F.xxhash64(*df.columns)) % target_files_per_partition).alias("_salt")
        out = df.withColumn("_salt", salt).repartition(*partition_cols, "_salt").drop("_salt")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))
    for t in targets:
        for fs, folder in _folders(spark, path, t, partition_cols):
            if before.get(folder.getPath().toString()) == _files(fs, folder):  # nothing was written there
                fs.delete(folder.getPath(), True)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, day: str = "v_date") -> None:
    """``df`` as table ``name`` under ``path``: a folder per day, its rows in ``buckets`` by ``key``, sorted by it.

    Tables written with the same number of buckets join on their keys without a shuffle. A rerun of a day
    replaces it. ``path`` must be shared; the session's catalog holds the table's name.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    dealt = df.repartition(buckets, F.col(key))
    if not spark.catalog.tableExists(name):
        dealt.write.partitionBy(day).bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
        return
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # a table's writer reads it from the session alone
    try:
        dealt.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batch_size: int = 10_000) -> None:
    """Batched JDBC insert (the reference's target is a database table)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
