"""Toxicity (operator 2): character n-grams, naive Bayes ratios, a linear classifier.

A text is lower-cased, its white space collapsed, and its distinct n-grams are
hashed to ``1 << bits`` features. A feature's value is its log-count ratio: how
much likelier it is in texts of label 1 than of label 0, from the document counts
of the rows given to ``fit`` (one row per feature and task is shuffled). A logistic
regression over these scaled features, with an L2 penalty, gives the score.

``sample_labels`` bounds the labelled rows (a parameter): those with the smallest
hashes of their keys. So few of them can be sent to every task, and the texts they
belong to are read where they lie. The regression is fitted on the distinct texts of
all of them, and on the ``fit_features`` features that tell the labels apart best
(G-test). Of more than ``fit_rows`` rows it takes about that many distinct texts,
those with the smallest hashes; the default is the bound of ``sample_labels``. Both
are parameters and bound what the driver receives: packed feature numbers, never
texts. The model, an array of fixed size, goes to the tasks as a broadcast;
scoring is one pass without a shuffle.

Null texts are empty; empty texts have no n-gram and the score of the intercept
alone. Labelled rows without a label or without a text count for nothing. Where a
label is missing altogether the score is the share of label 1 (or 0 without rows).
Long texts are read whole, block by block. Repeated rows are each scored; equal texts count once for the regression.
Other columns pass through ``with_scores``; one that is named like its output is an error. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convaudit.llm.common import map_slices, texts_of

ORDERS = (3, 4, 5)
BLOCK = 1 << 20
#: Labelled rows that a model is learned from at most.
LABELS = 30_000


class Grams:
    """Distinct hashed n-grams of a text."""

    def __init__(self, bits: int = 18, orders: tuple[int, ...] = ORDERS):
        self.bits, self.orders, self.stamp = bits, orders, np.zeros(1 << bits, np.int32)

    def _block(self, codes: np.ndarray) -> np.ndarray:
        out, h = [], codes * np.uint32(0x9E3779B1)
        for n in range(2, max(self.orders) + 1):
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1:]
            if n in self.orders:
                mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
                out.append(mixed >> np.uint32(32 - self.bits))
        every = np.concatenate(out)
        at = np.arange(len(every), dtype=np.int32)
        self.stamp[every] = at  # the last of equal ones stays
        return every[self.stamp[every] == at]

    def of(self, text: str) -> np.ndarray:
        body = " ".join(text.lower().split())
        if not body:
            return np.zeros(0, np.uint32)
        codes = np.frombuffer(f" {body} ".encode("utf-32-le", "surrogatepass"), "<u4")
        if len(codes) < max(self.orders):
            codes = np.concatenate((codes, np.full(max(self.orders) - len(codes), 32, "<u4")))
        if len(codes) <= BLOCK:
            return self._block(codes)
        more = max(self.orders) - 1
        return np.unique(np.concatenate([self._block(codes[a:a + BLOCK + more]) for a in range(0, len(codes) - more, BLOCK)]))


@dataclass(frozen=True)
class Model:
    """``weight`` holds the ratio times the fitted coefficient of every feature."""

    bits: int
    orders: tuple[int, ...]
    weight: np.ndarray
    intercept: float

    def scores(self, texts: list[str]) -> np.ndarray:
        grams = Grams(self.bits, self.orders)
        z = np.array([self.weight[grams.of(t)].sum(dtype=np.float64) for t in texts]) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def sample_labels(labels: DataFrame, label: str, key: str = "doc_id", most: int = LABELS) -> DataFrame:
    """At most ``most`` rows of ``key`` and ``label`` (0 or 1), with the smallest hashes of the key; small enough to broadcast."""
    rows = labels.select(key, F.col(label).cast("int").alias(label)).where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    return rows.orderBy(F.xxhash64(key), key, label).limit(most)


def feature_counts(rows: DataFrame, bits: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each label (0, 1), and in how many of them each feature is found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, total = Grams(bits, orders), np.zeros((2, 1 << bits), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label, grams.of(text)] += 1
                total[label] += 1
        some = np.flatnonzero(counts.any(axis=0))
        feature = np.concatenate((some, [-1]))
        yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int64()), *(pa.array(np.append(counts[k, some], total[k])) for k in (0, 1))],
                                         ["feature", "n0", "n1"])

    summed = rows.select("label", "text").mapInArrow(run, "feature long, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = summed.toPandas()  # at most one row per feature of the fixed table
    counts, total = np.zeros((2, 1 << bits), np.int64), np.zeros(2, np.int64)
    real = got.feature >= 0
    for k, name in enumerate(("n0", "n1")):
        counts[k, got.feature[real]] = got[name][real]
        total[k] = got[name][~real].sum()
    return total, counts


def ratios(total: np.ndarray, counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log of a feature's share of the rows of label 1 over its share of those of label 0."""
    share = (counts + smooth) / (total[:, None] + 2 * smooth)
    return np.log(share[1] / share[0])


def telling(total: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` features with the largest G statistic of presence against label, ascending."""
    rows = total.sum()
    inside, with_it = np.stack((total[:, None] - counts, counts)).astype(float), counts.sum(axis=0)
    expected = np.stack((rows - with_it, with_it))[:, None, :] * total[None, :, None] / rows
    with np.errstate(all="ignore"):
        g = np.where(inside > 0, inside * np.log(inside / expected), 0).sum(axis=(0, 1))
    best = np.argsort(-g, kind="stable")[:n]
    return np.sort(best[with_it[best] > 0])


def logistic(rows: list[np.ndarray], label: np.ndarray, value: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Coefficients and intercept by accelerated gradient steps; ``rows`` holds the features present in each row."""
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = value[at]
    n, w, b = len(rows), np.zeros(len(value)), 0.0
    seen_w, seen_b, momentum = w, b, 1.0
    # the largest eigenvalue of X'X by power iteration bounds the curvature
    v = np.ones(len(value) + 1)
    for _ in range(20):
        z = np.bincount(of, x * v[at], n) + v[-1]
        v = np.append(np.bincount(at, x * z[of], len(value)), z.sum())
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (size / (4 * n) * 1.05 + penalty)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, x * seen_w[at], n) + seen_b, -500, 500)))
        off = (p - label) / n
        new_w = seen_w - step * (np.bincount(at, x * off[of], len(value)) + penalty * seen_w)
        new_b = seen_b - step * off.sum()
        after = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        seen_w, seen_b = new_w + (momentum - 1) / after * (new_w - w), new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new_w, new_b, after
    return w, float(b)


def fit(labelled: DataFrame, label: str, key: str = "doc_id", text: str = "text", bits: int = 18, orders: tuple[int, ...] = ORDERS,
        fit_rows: int = LABELS, fit_features: int = 2048, penalty: float = 1e-4, rounds: int = 300) -> Model:
    """A model from rows with ``key``, ``text`` and a 0/1 ``label``."""
    rows = labelled.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), F.col(text).alias("text")).where(
        "label in (0, 1) and text is not null")
    total, counts = feature_counts(rows, bits, orders)
    weight = np.zeros(1 << bits, np.float32)
    if total.min() == 0:
        share = total[1] / total.sum() if total.sum() else 0.0
        return Model(bits, orders, weight, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    chosen = telling(total, counts, fit_features)
    place = np.full(1 << bits, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    value = ratios(total, counts)[chosen]

    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = Grams(bits, orders)
        found = [np.sort(f[f >= 0]).astype("<i4").tobytes() for f in (place[grams.of(t)] for t in texts_of(batch, 2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["at", "label", "features"])

    # copies hash alike, so a text stands once for each label however often it is repeated
    below = min(2**63 - 1, round(-2**63 + 2**64 * fit_rows / int(total.sum())))
    sample = rows.select(F.xxhash64("text").alias("at"), "label", "text").where(F.col("at") <= below).dropDuplicates(["at", "label"])
    got = map_slices(sample, present, "at long, label int, features binary").collect()
    got.sort(key=lambda r: (r.at, r.label, r.features))
    w, b = logistic([np.frombuffer(r.features, "<i4") for r in got], np.array([r.label for r in got], float), value, penalty, rounds)
    weight[chosen] = w * value
    return Model(bits, orders, weight, b)


def with_scores(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score (0 to 1, higher: label 1 likelier) of every row."""
    if out in df.columns:
        raise ValueError(f"column to rename first: {out}")
    at, shared = df.columns.index(text), df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array(shared.value.scores(texts_of(batch, at)), pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out])

    return map_slices(df, run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))
