"""Losses, AUC and per-task evaluation as aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.operators.layout import sums_above

LOSS_EPSILON = 1e-7
AUC_EPSILON = 1e-6
THRESHOLDS = 1001


def row_log_loss(label: Column, pred: Column, clip: bool = False) -> Column:
    """Loss of one row: epsilon is added inside the logarithms, or the prediction is clipped by it."""
    y = label.cast("double")
    if clip:
        p = F.least(F.greatest(pred, F.lit(LOSS_EPSILON)), F.lit(1 - LOSS_EPSILON))
        return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return -(y * F.ln(pred + LOSS_EPSILON) + (1 - y) * F.ln(1 - pred + LOSS_EPSILON))


def log_loss(label: Column, pred: Column, weight: Column | None = None, clip: bool = False) -> Column:
    """Aggregate: weighted loss over the number of rows whose weight is not zero; 0 when there are none."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    total = F.sum(F.when(w != 0, w * row_log_loss(label, pred, clip)))
    return F.coalesce(total / F.nullif(F.sum((w != 0).cast("long")), F.lit(0)), F.lit(0.0))


def non_member_weight(vip: Column) -> Column:
    return F.when(vip > 0, 0.0).otherwise(1.0)


def threshold_bin(pred: Column, thresholds: int = THRESHOLDS) -> Column:
    """How many inner thresholds a prediction exceeds, from 1; the lowest two bins act as one."""
    steps = thresholds - 1
    return F.least(F.greatest(F.ceil(pred * steps), F.lit(1)), F.lit(steps))


def _area(neg: str, pos: str, pos_above: str, all_pos: Column, all_neg: Column, epsilon: float) -> Column:
    """Area of a bin's trapezoid under the curve of hit rate over false-alarm rate."""
    width = F.col(neg) / (all_neg + epsilon)
    height = (2 * F.col(pos_above) + F.col(pos) + 2 * epsilon) / (2 * (all_pos + epsilon))
    return width * height


def auc(df: DataFrame, label: str, pred: str, weight: str | None = None, thresholds: int = THRESHOLDS,
        by: Sequence[str] = (), epsilon: float = AUC_EPSILON) -> DataFrame:
    """AUC over equally spaced thresholds, one row per `by` group.

    Rows shrink to at most `thresholds` sums per group before anything is ordered.
    Bins without rows have no width, so none need to be filled in.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    y = F.col(label).cast("double")
    bins = df.groupBy(*by, threshold_bin(F.col(pred), thresholds).alias("__bin")).agg(
        F.sum(w * y).alias("__pos"), F.sum(w * (1 - y)).alias("__neg"))
    return _auc_of_bins(bins, by, epsilon)


def _auc_of_bins(bins: DataFrame, by: Sequence[str], epsilon: float) -> DataFrame:
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    above = group.orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, -1)
    parts = bins.withColumns({"__above": F.coalesce(F.sum("__pos").over(above), F.lit(0.0)),
                              "__all_pos": F.sum("__pos").over(group), "__all_neg": F.sum("__neg").over(group)})
    area = _area("__neg", "__pos", "__above", F.col("__all_pos"), F.col("__all_neg"), epsilon)
    return parts.groupBy(*by).agg(F.sum(area).alias("auc"))


def auc_exact(df: DataFrame, label: str, pred: str, weight: str | None = None) -> DataFrame:
    """AUC over every distinct prediction; ties count half.

    Equal predictions are combined first; the running sums work range by range.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    y = F.col(label).cast("double")
    scores = df.groupBy(F.col(pred).alias("__score")).agg(F.sum(w * y).alias("pos"), F.sum(w * (1 - y)).alias("neg"))
    placed = sums_above(scores, "__score", ["pos"])
    won = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    return placed.agg((won / (F.sum("pos") * F.sum("neg"))).alias("auc"))


@dataclass(frozen=True)
class Task:
    """One objective: its label, the score ranked for AUC, the score in the loss, and an optional row weight."""
    label: str
    ranked: str
    in_loss: str
    weight: str | None = None


# Which score each objective ranks by, which one its loss sees, and its weight.
TASKS: Mapping[str, Task] = {
    "ctr": Task("ctr_label", "ctr_debiased", "ctr_debiased"),
    "fvtr": Task("finish_view_label", "fvtr", "ctfvtr"),
    "unlock": Task("unlock_label", "unlock", "ctunlock"),
    "cvr": Task("cvr_label", "cvr", "ctcvr", "non_member"),
}


def with_chain(scored: DataFrame, debias: bool = True) -> DataFrame:
    """Add the debiased click score, the chained products and the non-member weight to raw head scores."""
    first = F.col("ctr") * F.col("pos") if debias else F.col("ctr")
    return (scored.withColumns({"ctr_debiased": first, "non_member": non_member_weight(F.col("vip_label"))})
            .withColumns({f"ct{t}": F.col("ctr_debiased") * F.col(t) for t in ("fvtr", "unlock", "cvr")}))


def evaluate(scored: DataFrame, tasks: Mapping[str, Task] = TASKS, thresholds: int = THRESHOLDS,
             by: Sequence[str] = ()) -> DataFrame:
    """Loss, AUC and row count of every task in one pass over the data.

    Each row is folded into (task, bin) sums where it is read; the shuffle carries at
    most `thresholds` rows per task and input partition.
    """
    per_task = F.array(*[
        F.struct(F.lit(name).alias("task"), F.col(t.label).cast("double").alias("y"), F.col(t.ranked).alias("p"),
                 row_log_loss(F.col(t.label), F.col(t.in_loss)).alias("loss"),
                 (F.col(t.weight) if t.weight else F.lit(1.0)).alias("w"))
        for name, t in tasks.items()])
    rows = scored.select(*by, F.explode(per_task).alias("t")).select(*by, "t.*")
    w, y = F.col("w"), F.col("y")
    bins = rows.groupBy(*by, "task", threshold_bin(F.col("p"), thresholds).alias("__bin")).agg(
        F.sum(w * y).alias("__pos"), F.sum(w * (1 - y)).alias("__neg"),
        F.sum(F.when(w != 0, w * F.col("loss")).otherwise(0.0)).alias("__loss"),
        F.sum((w != 0).cast("long")).alias("__weighted"), F.count(F.lit(1)).alias("__rows"))
    keys = [*by, "task"]
    group = Window.partitionBy(*keys)
    above = group.orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, -1)
    parts = bins.withColumns({"__above": F.coalesce(F.sum("__pos").over(above), F.lit(0.0)),
                              "__all_pos": F.sum("__pos").over(group), "__all_neg": F.sum("__neg").over(group)})
    area = _area("__neg", "__pos", "__above", F.col("__all_pos"), F.col("__all_neg"), AUC_EPSILON)
    return parts.groupBy(*keys).agg(
        F.coalesce(F.sum("__loss") / F.nullif(F.sum("__weighted"), F.lit(0)), F.lit(0.0)).alias("loss"),
        F.sum(area).alias("auc"), F.sum("__rows").alias("rows"))


def total_loss(evaluated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return evaluated.groupBy(*by).agg(F.sum("loss").alias("total_loss"))


def label_summary(df: DataFrame, by: Sequence[str], labels: Sequence[str], subtotals: bool = False) -> DataFrame:
    """Rows and positive rate of each label per group, with subtotals on request."""
    grouped = df.rollup(*by) if subtotals else df.groupBy(*by)
    return grouped.agg(F.count(F.lit(1)).alias("n"),
                       *[F.avg(F.col(c).cast("double")).alias(c.removesuffix("_label") + "_rate") for c in labels])


def daily_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def batch_losses(df: DataFrame, label: str, pred: str, weight: str | None = None) -> DataFrame:
    """Mean loss of every batch."""
    w = None if weight is None else F.col(weight)
    return df.groupBy("batch_id").agg(log_loss(F.col(label), F.col(pred), w).alias("loss"))


def batch_metric_mean(losses: DataFrame, every: int | None = None) -> DataFrame:
    """Mean of the batch losses, overall or per `every` batches."""
    if every is None:
        return losses.agg(F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("batches"))
    return losses.groupBy(F.floor(F.col("batch_id") / F.lit(every)).alias("report")).agg(
        F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("batches"))
