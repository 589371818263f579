"""Classification metrics as grouped aggregates over one long table of scores.

``scores`` has one row per scored game with the label ``y`` (0 or 1), the probability ``p`` and any
grouping columns, by default ``run, model, fold``. A score without probabilities passes its
predicted class as ``p``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BY = ["run", "model", "fold"]
# Distance of a probability to 0 and 1 in the log loss, and the calibration bins.
LOG_EPSILON = 2.220446049250313e-16
CALIBRATION_BINS = 10


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 for a zero denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def tally(scores: DataFrame, by: list[str]) -> DataFrame:
    """Per row, how many positives and negatives it stands for; no shuffle."""
    y = F.col("y").cast("long")
    return scores.select(
        *by, F.col("p").cast("double").alias("p"), y.alias("pos"), (1 - y).alias("neg")
    )


def tally_by_score(scores: DataFrame, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    return tally(scores, by).groupBy(*by, "p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


# --- threshold metrics -----------------------------------------------------------------------


def _confusion_sums() -> list[Column]:
    hit = F.col("p") > 0.5
    return [
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
    ]


def _log_loss() -> Column:
    p = F.least(F.greatest(F.col("p"), F.lit(LOG_EPSILON)), F.lit(1.0 - LOG_EPSILON))
    total = F.sum(F.col("pos") * F.ln(p) + F.col("neg") * F.log1p(-p))
    return (-total / F.sum(F.col("pos") + F.col("neg"))).alias("log_loss")


def _brier() -> Column:
    p = F.col("p")
    total = F.sum(F.col("pos") * (1.0 - p) * (1.0 - p) + F.col("neg") * p * p)
    return (total / F.sum(F.col("pos") + F.col("neg"))).alias("brier")


def confusion(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    return tally(scores, by).groupBy(*by).agg(*_confusion_sums())


def log_loss(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    return tally(scores, by).groupBy(*by).agg(_log_loss())


def brier(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    return tally(scores, by).groupBy(*by).agg(_brier())


def class_metric_columns() -> dict[str, Column]:
    """Accuracy, precision, recall, F1 and Matthews correlation of the four counts."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "mcc": ratio(tp * tn - fp * fn, spread),
    }


def class_metrics(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    return confusion(scores, by).select(
        *by, *(c.alias(n) for n, c in class_metric_columns().items())
    )


def class_report(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    """One row per class plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    counts = confusion(scores, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def one_class(label: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + missed).alias("recall"),
            ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    classes = counts.select(
        *by,
        (tn + fp + fn + tp).alias("total"),
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        one_class("0", tn, fn, fp).alias("loss"),
        one_class("1", tp, fp, fn).alias("win"),
    )

    def averaged(label: str, weights: tuple[Column, Column]) -> Column:
        left, right = weights
        parts = [
            (F.col(f"loss.{m}") * left + F.col(f"win.{m}") * right).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(label).alias("label"), *parts, F.col("total").alias("support"))

    share = ratio(F.col("win.support"), F.col("total"))
    accuracy = F.struct(
        F.lit("accuracy").alias("label"),
        *(F.col("accuracy").alias(m) for m in ("precision", "recall", "f1")),
        F.col("total").alias("support"),
    )
    rows = F.array(
        F.col("loss"),
        F.col("win"),
        accuracy,
        averaged("macro avg", (F.lit(0.5), F.lit(0.5))),
        averaged("weighted avg", (1.0 - share, share)),
    )
    return classes.select(*by, F.explode(rows).alias("row")).select(*by, "row.*")


# --- ranking and calibration -----------------------------------------------------------------


def auc(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    return auc_of_tally(tally_by_score(scores, by), by)


def auc_of_tally(tallied: DataFrame, by: list[str]) -> DataFrame:
    """Area under the ROC curve, ties counted half; missing when a class is absent.

    The distinct scores are dealt to ranges of (group, score), so a large group is cut into slices of
    like size wherever its scores lie. A slice yields its positives, its negatives and the pairs won
    inside it; the running count over a group's slices adds the rest. Nothing is joined.
    """
    sliced = tallied.repartitionByRange(*by, "p").withColumn("_slice", F.spark_partition_id())
    before = Window.partitionBy(*by, "_slice").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    cells = (
        sliced.withColumn("won", F.col("pos") * (below + F.col("neg") / 2.0))
        .groupBy(*by, "_slice")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # At most as many rows per group from here on as there were slices.
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return (
        cells.withColumn("won_all", F.col("won") + F.col("pos").cast("double") * lower)
        .groupBy(*by)
        .agg(F.try_divide(F.sum("won_all"), pairs).alias("auc"))
    )


def ece(scores: DataFrame, by: list[str] = BY, bins: int = CALIBRATION_BINS) -> DataFrame:
    return ece_of_tally(tally(scores, by), by, bins)


def ece_of_tally(tallied: DataFrame, by: list[str], bins: int = CALIBRATION_BINS) -> DataFrame:
    """Expected calibration error over equal-width bins closed on the right."""
    place = F.least(F.greatest(F.ceil(F.col("p") * bins) - 1, F.lit(0)), F.lit(bins - 1))
    count = F.col("pos") + F.col("neg")
    binned = (
        tallied.withColumn("bin", place)
        .groupBy(*by, "bin")
        .agg(
            F.sum(count).alias("n"),
            F.sum("pos").alias("won"),
            F.sum(count * F.col("p")).alias("expected"),
        )
    )
    gap = F.sum(F.abs(F.col("won") - F.col("expected")))
    return binned.groupBy(*by).agg((gap / F.sum("n")).alias("ece"))


# --- everything at once ----------------------------------------------------------------------


def evaluate(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    """All metrics, one row per group.

    The scores are shuffled once, as counts per distinct score; every metric reads those counts.
    """
    tallied = tally_by_score(scores, by)
    points = (
        tallied.groupBy(*by)
        .agg(*_confusion_sums(), _log_loss(), _brier())
        .withColumns(class_metric_columns())
    )
    joined = points
    for other in (auc_of_tally(tallied, by), ece_of_tally(tallied, by)):
        joined = _join_groups(joined, other, by)
    return joined.select(
        *by, "accuracy", "precision", "recall", "f1", "mcc", "auc", "log_loss", "brier", "ece",
        "tn", "fp", "fn", "tp",
    )


def _join_groups(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two one-row-per-group tables; a null group value matches itself."""
    renamed = right.select(
        *(F.col(c).alias(f"_{c}") for c in by), *(c for c in right.columns if c not in by)
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by))
    return left.join(renamed, same).drop(*(f"_{c}" for c in by))


def accuracy(scores: DataFrame, by: list[str] = BY) -> DataFrame:
    """Share of games whose predicted class is right."""
    right = (F.col("p") > 0.5).cast("int") == F.col("y")
    return scores.groupBy(*by).agg(F.avg(right.cast("double")).alias("accuracy"))
