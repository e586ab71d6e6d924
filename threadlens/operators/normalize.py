"""Post normalisation, label attachment and fold assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import text as TX


def normalize_posts(raw: DataFrame, platform: str) -> DataFrame:
    """N1 + N2: one post schema ``(conv_id, post_id, is_source, text, user)``.

    twitter: ``text`` as is (NULL kept; see ``missing_text``), no user.
    reddit:  source -> ``data.children[0].data.{title,author}``;
             reply  -> ``data.{body,author}``, a reply without ``body`` is a
             deleted post: text '' and user ''.
    """
    keep = [c for c in raw.columns if c in ("platform", "topic", "file_path", "line_no")]
    if platform == "twitter":
        return raw.select("conv_id", "post_id", "is_source", "text",
                          F.lit(None).cast("string").alias("user"), *keep)
    if platform != "reddit":
        raise ValueError(f"unknown platform {platform}")
    first = F.element_at(F.col("data.children"), 1)["data"]
    body = F.col("data.body")
    text = F.when(F.col("is_source"), first["title"]).otherwise(F.coalesce(body, F.lit("")))
    user = F.when(F.col("is_source"), first["author"]).otherwise(
        F.when(body.isNull(), F.lit("")).otherwise(F.col("data.author")))
    return raw.select("conv_id", "post_id", "is_source", text.alias("text"), user.alias("user"), *keep)


def missing_text(posts: DataFrame) -> DataFrame:
    """Posts whose text is NULL."""
    return posts.where(F.col("text").isNull()).select("conv_id", "post_id")


def best_label(labels: DataFrame, priority: Sequence[str] = ("dev", "train")) -> DataFrame:
    """One (post_id, split, label) per post: the split earliest in
    ``priority`` wins (splits not listed come last, by name). An aggregate,
    so a post id listed many times never gathers in one task."""
    rank = F.lit(len(priority))
    for i, s in enumerate(reversed(priority)):
        rank = F.when(F.col("split") == s, F.lit(len(priority) - 1 - i)).otherwise(rank)
    return labels.groupBy("post_id").agg(F.min(F.struct(rank.alias("r"), "split", "label")).alias("_b")) \
        .select("post_id", F.col("_b.split").alias("split"), F.col("_b.label").alias("label"))


def attach_labels(posts: DataFrame, labels: DataFrame,
                  priority: Sequence[str] = ("dev", "train")) -> DataFrame:
    """N4 (+N10): left join of the winning key entry; adds split, label, stance."""
    base = posts.drop(*[c for c in ("split", "label", "stance") if c in posts.columns])
    j = base.join(best_label(labels, priority), "post_id", "left")
    return j.withColumn("stance", TX.encode_label("label"))


def unlabelled(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts found in no key (left anti join)."""
    return posts.join(labels.select("post_id"), "post_id", "left_anti")


def assign_fold(posts: DataFrame, order_col: str = "post_id", default: str = "train",
                fixed: str | None = None) -> DataFrame:
    """Fold of a conversation = split of its last labelled reply in
    ``order_col`` (file-name) order; no labelled reply -> ``default``;
    ``fixed`` (e.g. 'test') overrides everything."""
    if fixed is not None:
        return posts.select("conv_id").distinct().withColumn("fold", F.lit(fixed))
    cond = (~F.col("is_source")) & F.col("split").isNotNull()
    last = F.max(F.when(cond, F.struct(F.col(order_col).alias("o"), F.col("split").alias("s"))))
    return posts.groupBy("conv_id").agg(last.alias("_l")) \
        .select("conv_id", F.coalesce(F.col("_l.s"), F.lit(default)).alias("fold"))


def split_trees(posts: DataFrame) -> DataFrame:
    """Conversations whose labelled posts fall in more than one split."""
    return posts.where(F.col("split").isNotNull()).groupBy("conv_id") \
        .agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def unknown_labels(posts: DataFrame, label_col: str = "label") -> DataFrame:
    """Label values that map to no class, with their counts."""
    return posts.where(F.col(label_col).isNotNull() & TX.encode_label(label_col).isNull()) \
        .groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def union_platforms(*frames: DataFrame) -> DataFrame:
    """Union of per-platform frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
