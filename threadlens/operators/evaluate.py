"""Evaluation tables (M1, M3-M12): class weights, scores, accuracy, F1,
confusion, weighted loss, and the epoch bookkeeping of training runs.

Every metric is an aggregation (partial aggregation map-side); tables that
are broadcast (class weights) have one row per class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX

N_CLASSES = len(L.STANCE_CLASSES)


def _classes(spark, k: int) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("class"))


def class_weights(df: DataFrame, label_col: str = "stance_label", k: int = N_CLASSES) -> DataFrame:
    """M1: weight = largest class count / class count over ``k`` fixed
    classes; an absent class gets NULL (not an infinite weight)."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("int").alias("class")) \
        .agg(F.count(F.lit(1)).alias("n"))
    allc = _classes(df.sparkSession, k).join(counts, "class", "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    mx = F.max("n").over(Window.partitionBy())
    return allc.withColumn("weight", mx.cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double"))


def softmax(z) -> Column:
    """M3: numerically stable softmax of a logit array."""
    z = F.col(z) if isinstance(z, str) else z
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / s)


def argmax(z) -> Column:
    """M3: index of the largest logit (lowest index on ties)."""
    z = F.col(z) if isinstance(z, str) else z
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def accuracy(df: DataFrame, gold: str = "gold", pred: str = "pred",
             group_cols: Sequence[str] = ()) -> DataFrame:
    """M4."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(gold) == F.col(pred)).cast("long")).alias("n_correct"),
        F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("accuracy"))


def correct_per_level(df: DataFrame, gold: str = "gold", pred: str = "pred",
                      branch_id_col: str = "branch_id") -> DataFrame:
    """M5: correct predictions per branch depth (text after the first '.')."""
    return df.groupBy(TX.branch_level(branch_id_col).alias("level")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(gold) == F.col(pred)).cast("long")).alias("n_correct"),
        F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("rate"))


def per_class(df: DataFrame, gold: str = "gold", pred: str = "pred",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """tp / support / predicted count per class seen in gold or pred
    (two aggregates and a full outer join)."""
    g = df.groupBy(*group_cols, F.col(gold).alias("class")).agg(
        F.count(F.lit(1)).alias("n_gold"),
        F.sum((F.col(gold) == F.col(pred)).cast("long")).alias("tp"))
    p = df.groupBy(*group_cols, F.col(pred).alias("class")).agg(F.count(F.lit(1)).alias("n_pred"))
    j = g.join(p, [*group_cols, "class"], "full_outer")
    return j.select(*group_cols, "class",
                    F.coalesce("n_gold", F.lit(0)).alias("n_gold"),
                    F.coalesce("n_pred", F.lit(0)).alias("n_pred"),
                    F.coalesce("tp", F.lit(0)).alias("tp")) \
        .withColumn("f1", F.when(F.col("n_gold") + F.col("n_pred") > 0,
                                 2.0 * F.col("tp") / (F.col("n_gold") + F.col("n_pred"))).otherwise(0.0))


def f1(df: DataFrame, average: str = "macro", gold: str = "gold", pred: str = "pred",
       group_cols: Sequence[str] = ()) -> DataFrame:
    """M6 (macro: mean over labels of gold and pred) / M7 (weighted by support)."""
    pc = per_class(df, gold, pred, group_cols)
    if average == "macro":
        val = F.avg("f1")
    elif average == "weighted":
        val = F.sum(F.col("f1") * F.col("n_gold")) / F.sum("n_gold")
    else:
        raise ValueError(average)
    return pc.groupBy(*group_cols).agg(val.alias(f"f1_{average}"))


def weighted_log_loss(df: DataFrame, weights: DataFrame, gold: str = "gold", logits: str = "z",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """M8: class-weighted cross-entropy, sum(w * nll) / sum(w). ``weights``
    has one row per class (broadcast)."""
    z = F.col(logits)
    m = F.array_max(z)
    lse = m + F.log(F.aggregate(F.transform(z, lambda x: F.exp(x - m)), F.lit(0.0), lambda a, x: a + x))
    nll = lse - F.element_at(z, F.col(gold) + 1)
    w = weights.select(F.col("class").alias(gold), F.col("weight").alias("_w"))
    j = df.join(F.broadcast(w), gold, "left")
    return j.groupBy(*group_cols).agg(
        (F.sum(F.col("_w") * nll) / F.sum("_w")).alias("loss"))


def confusion(df: DataFrame, gold: str = "gold", pred: str = "pred", k: int = N_CLASSES) -> DataFrame:
    """M9: gold x predicted counts, one column per predicted class."""
    pv = df.groupBy(F.col(gold).alias("gold")).pivot(pred, list(range(k))).agg(F.count(F.lit(1)))
    return pv.select("gold", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("long").alias(f"pred_{i}")
                               for i in range(k)])


def running_best(metrics: DataFrame, split: str = "dev") -> DataFrame:
    """Per run and epoch of ``split``: running best loss (min),
    accuracy and F1 (max), and the epoch of the best loss so far (a new best
    needs a strictly lower loss). One window per run (epochs are few)."""
    m = metrics.where(F.col("split") == split)
    w = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("_prev_best", F.min("loss").over(prev))
    m = m.withColumn("is_new_best", F.col("_prev_best").isNull() | (F.col("loss") < F.col("_prev_best")))
    return m.select(
        "run", "epoch", "loss",
        F.min("loss").over(w).alias("best_loss"),
        F.max("accuracy").over(w).alias("best_accuracy"),
        F.max("f1_macro").over(w).alias("best_f1"),
        F.max(F.when(F.col("is_new_best"), F.col("epoch"))).over(w).alias("best_epoch"),
    )


def early_stop(metrics: DataFrame, patience: int = L.DEFAULT_PATIENCE, split: str = "dev") -> DataFrame:
    """First epoch whose loss is above the best so far and that is more
    than ``patience`` epochs after the best; NULL when the run never stops.
    ``best_epoch`` / ``best_loss`` are as of the stop (or the last epoch)."""
    rb = running_best(metrics, split)
    stop = (F.col("loss") > F.col("best_loss")) & (F.col("epoch") > F.col("best_epoch") + patience)
    rb = rb.withColumn("_stop", stop)
    first_stop = rb.groupBy("run").agg(
        F.min(F.when(F.col("_stop"), F.col("epoch"))).alias("stop_epoch"),
        F.max("epoch").alias("last_epoch"))
    j = rb.join(first_stop, "run").where(F.col("epoch") == F.coalesce("stop_epoch", "last_epoch"))
    return j.select("run", "stop_epoch", "best_epoch", "best_loss")


def learning_curves(metrics: DataFrame) -> DataFrame:
    """Wide per-split metrics -> long (run, epoch, split, metric, value)."""
    return metrics.unpivot(["run", "epoch", "split"], ["loss", "accuracy", "f1_macro", "f1_weighted"],
                           "metric", "value")
