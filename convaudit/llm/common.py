"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from convaudit.session import ensure_checkpoint_dir

#: Rows and bytes of one Arrow slice that Python handles at a time; they bound the output held in memory.
SLICE_ROWS, SLICE_BYTES = 512, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``rows`` rows and ``size`` bytes; a larger row is a slice of its own."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        if part.nbytes <= size or part.num_rows == 1:
            yield part
        else:
            yield from slices(part, (part.num_rows + 1) // 2, size)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType,
               rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` at most ``rows`` rows and about ``size`` bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows, size):
                yield fn(part)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: int = 1) -> list[str]:
    """The batch's texts as Python strings, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


class Memo(dict):
    """Bounded memo of ``compute(key)``: two generations of at most ``limit`` entries each.

    Frequent keys move to the young generation when they are used again, so a
    full memo forgets the rare ones first. Keys longer than ``longest`` are
    computed every time. Use ``memo[key]``.
    """

    def __init__(self, compute: Callable, limit: int = 250_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
