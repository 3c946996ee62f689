"""Table sources: parquet / JDBC readers and date-bounded scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convaudit import schemas


def day_scan(df: DataFrame, ts_col: str, day: str) -> DataFrame:
    """Rows of one calendar day: ``day <= ts < day + 1``.

    Half-open, so fractions of a second after 23:59:59 are kept (the reference
    binds ``D 00:00:00`` and ``D 23:59:59``). Comparing the raw column with
    literals of its own type lets the predicate reach the parquet scan and
    prune row groups or date partitions.
    """
    dt = df.schema[ts_col].dataType
    lo = F.lit(day).cast("date")
    if isinstance(dt, T.DateType):
        return df.where(F.col(ts_col) == lo)
    kind = "timestamp_ntz" if isinstance(dt, T.TimestampNTZType) else "timestamp"
    start = lo.cast(kind)
    end = F.date_add(lo, 1).cast(kind)
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 name: str = "input") -> DataFrame:
    """Parquet source; with ``schema`` the declared columns are checked."""
    df = spark.read.parquet(path)
    return schemas.require(df, schema, name) if schema is not None else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC source (the reference reads its tables from a database).

    Give ``partition_column`` with bounds to read in parallel ranges; filters
    applied to the result are pushed into the database query by Spark.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()
