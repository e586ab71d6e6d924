"""Data-set profiling (A1-A6): each one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.operators.evaluate import N_CLASSES, _classes


def branch_profile(branch_rows: DataFrame, approx: bool = False) -> DataFrame:
    """A1: post occurrences over all branches, distinct posts, and
    occurrences of source posts. ``approx`` uses a HyperLogLog sketch for the
    distinct count (fixed memory at any scale)."""
    distinct = F.approx_count_distinct("post_id") if approx else F.countDistinct("post_id")
    return branch_rows.agg(
        F.count(F.lit(1)).alias("n_occurrences"),
        distinct.alias("n_posts"),
        F.sum(F.col("issource").cast("long")).alias("n_source_occurrences"))


def profile_sketches(branch_rows: DataFrame, group_cols: Sequence[str] = ("fold",), lg_k: int = 14) -> DataFrame:
    """A1 to be kept and merged: per group the two counts and a HyperLogLog
    sketch of the distinct posts (2^``lg_k`` registers at most). Store it, and
    profile new folders alone."""
    return branch_rows.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_occurrences"), F.sum(F.col("issource").cast("long")).alias("n_source_occurrences"),
        F.hll_sketch_agg("post_id", F.lit(lg_k)).alias("posts"))


def merge_profiles(sketches: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of ``profile_sketches`` (of any parts, united) merged to coarser
    groups; the result has the same columns and can be merged again."""
    return sketches.groupBy(*group_cols).agg(
        F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_source_occurrences").alias("n_source_occurrences"),
        F.hll_union_agg("posts").alias("posts"))


def profile_estimates(sketches: DataFrame) -> DataFrame:
    """A1 from merged sketches: ``n_posts`` is an estimate, the counts are exact."""
    return sketches.withColumn("n_posts", F.hll_sketch_estimate("posts")).drop("posts")


def class_balance(examples: DataFrame, label_col: str = "stance_label", k: int = N_CLASSES) -> DataFrame:
    """A2: class counts over all examples and over source posts only; every
    class of ``range(k)`` appears (0 when absent)."""
    c = examples.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("int").alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("issource").cast("long")).alias("n_source"))
    return _classes(examples.sparkSession, k).join(c, "class", "left").select(
        "class", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.coalesce("n_source", F.lit(0)).cast("long").alias("n_source"))


def label_histogram(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """A3: gold label counts by name."""
    return labels.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def normalized(counts: DataFrame, n_col: str = "n", out: str = "pct") -> DataFrame:
    """A4: percentage of each row of a small count table (<= a few rows)."""
    return counts.withColumn(out, 100.0 * F.col(n_col) / F.sum(n_col).over(Window.partitionBy()))


def fold_sizes(examples: DataFrame) -> DataFrame:
    """Examples per fold."""
    return examples.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
