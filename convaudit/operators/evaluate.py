"""Model evaluation as aggregates (A7, A8) and the labelled corpus.

All metrics are computed in distributed passes; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POS_TAG = "POS"
NEG_TAG = "NEG"
#: For counts that are multiplied: products of two stay within 38 digits.
WHOLE = "decimal(18,0)"


def hard_label(pred: Column, cut: float = 0.5) -> Column:
    """A model output as a 0/1 label: 1.0 when ``pred >= cut``."""
    return F.when(pred >= F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0))


def accuracy(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose hard prediction equals the label (A7); null for no rows."""
    ok = (hard_label(F.col(pred)) == F.col(label).cast("double")).cast("long")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.sum(ok).alias("n_correct"))
    return a.select("n", F.coalesce(F.col("n_correct"), F.lit(0)).cast("long").alias("n_correct"),
                    F.when(F.col("n") > 0, F.col("n_correct").cast("double") / F.col("n").cast("double"))
                    .alias("accuracy"))


def auc_hard(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """ROC area of hard 0/1 predictions (A8): the ROC curve has one inner point,
    so AUC = (1 + TPR - FPR) / 2, computed as a ratio of integers:
    (P*N + TP*N - FP*P) / (2*P*N)."""
    h = hard_label(F.col(pred))
    y = F.col(label).cast("double")
    a = df.agg(
        F.sum((y == 1.0).cast("long")).alias("n_pos"), F.sum((y == 0.0).cast("long")).alias("n_neg"),
        F.sum(((h == 1.0) & (y == 1.0)).cast("long")).alias("tp"),
        F.sum(((h == 1.0) & (y == 0.0)).cast("long")).alias("fp"))
    p, n, tp, fp = (F.col(c).cast(WHOLE) for c in ("n_pos", "n_neg", "tp", "fp"))
    num = p * n + tp * n - fp * p
    return a.select("n_pos", "n_neg", "tp", "fp",
                    F.when((p > 0) & (n > 0), num.cast("double") / (p * n * 2).cast("double")).alias("auc"))


#: Value ranges that a rank is cut into at most.
MOST_RANGES = 4096


def auc_rank(df: DataFrame, score: str = "score", label: str = "label", parts: int | None = None,
             by: str | None = None) -> DataFrame:
    """ROC area of a continuous score (A8), Mann-Whitney form, mean ranks on ties; one row, or one per ``by``.

    Exact with integers: twice a tie group's mean rank is ``2b + c + 1`` (``b``
    rows rank below it, ``c`` rows in it), so
    ``AUC = (sum_pos(2 * rank) - P(P+1)) / (2PN)``. Products are decimals of 38 digits.

    ``b`` needs a global order, built without moving all rows into one task: rows are
    reduced to one per distinct score; these are cut into ``parts`` value ranges (``MOST_RANGES`` at most) at
    approximate quantiles, an aggregate of bounded size that is broadcast to its own
    input, where a binary search finds a score's range; each range is prefix-summed on its own and offset by the totals of the
    ranges below it (one row per range). Nothing runs while the plan is built.
    """
    parts = max(1, min(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES))
    steps = [1 << k for k in range(parts.bit_length() - 1, -1, -1)]
    y = F.col(label).cast("double")
    ok = df.where(F.col(score).isNotNull() & y.isin(0.0, 1.0))
    # a key that the optimizer doesn't fold keeps the joins below equi-joins
    key = F.col(by) if by else (y * 0).cast("int")
    g = ok.groupBy(key.alias("_k"), F.col(score).cast("double").alias("_s")).agg(
        F.count(F.lit(1)).alias("_c"), F.sum((y == 1.0).cast("long")).alias("_p"))
    cuts = g.groupBy("_k").agg(F.percentile_approx("_s", [i / parts for i in range(1, max(parts, 2))], max(1000, 4 * parts)).alias("_cuts"))
    # how many cuts lie below the score, found by halving: an index past the end is null and adds nothing
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(
        F.get("_cuts", at + step - 1) < F.col("_s"), step).otherwise(0))
    r = g.join(F.broadcast(cuts), "_k").select("_k", "_s", "_c", "_p", below.alias("_part"))  # one row of cuts per key
    tot = r.groupBy("_k", "_part").agg(F.sum("_c").alias("_tot"))
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_k", "_part", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_k", "_part").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_local", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    r = r.join(F.broadcast(off), ["_k", "_part"])  # one row per value range (at most ``parts`` for a key)
    two_r = F.col("_p").cast(WHOLE) * (F.lit(2) * (F.col("_off") + F.col("_local")) + F.col("_c") + F.lit(1)).cast(WHOLE)
    grouped = r.groupBy(F.col("_k").alias(by)) if by else r
    a = grouped.agg(F.sum("_p").alias("n_pos"), (F.sum("_c") - F.sum("_p")).alias("n_neg"), F.sum(two_r).alias("_2r"))
    p, n = F.col("n_pos").cast(WHOLE), F.col("n_neg").cast(WHOLE)
    return a.select(*([by] if by else []), F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"),
                    F.when((p > 0) & (n > 0), (F.col("_2r") - p * (p + 1)).cast("double")
                           / (p * n * 2).cast("double")).alias("auc"))


def tagged_corpus(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Positive and negative corpora tagged and appended into one frame."""
    return pos.withColumn("tag", F.lit(POS_TAG)).withColumn("label", F.lit(1.0)).unionByName(
        neg.withColumn("tag", F.lit(NEG_TAG)).withColumn("label", F.lit(0.0)))


def split_corpus(labelled: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """The labelled frame as its positive and negative corpora."""
    return labelled.where(F.col(label) == 1.0).drop(label), labelled.where(F.col(label) == 0.0).drop(label)


def assign_split(df: DataFrame, key: str = "doc_id", folds: int = 5, test_fold: int = 0) -> DataFrame:
    """Repeatable train/test split by key (M4): fold = key mod ``folds``.

    Integer keys use the key itself; other keys use a hash. Unlike
    ``randomSplit`` the result doesn't depend on partitioning or reruns.
    """
    k = F.col(key)
    fold = F.pmod(k, F.lit(folds)) if dict(df.dtypes)[key] in ("int", "bigint", "smallint", "tinyint") \
        else F.pmod(F.xxhash64(k), F.lit(folds))
    return df.withColumn("split", F.when(fold == test_fold, F.lit("test")).otherwise(F.lit("train")))
