"""Example assembly.

One example per post and fold: the first occurrence of the post in
(branch number, position) order, with the text of the previous post of that
branch and of the branch's first post.

No branch is exploded: for a node, the first branch through it is the first
leaf below it in pre-order, so
  branch_no = non-empty leaves before the node in pre-order (T3, index.py),
  pos       = present ancestors,        prev = nearest present ancestor,
  src       = first present ancestor    (all carried by the tree walk).
This is O(nodes x depth) rather than O(sum of branch lengths).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions import text as TX
from threadlens.operators import tree as TR
from threadlens.operators.features import one_post, thread_features
from threadlens.operators.index import dense_index
from threadlens.session import materialize

# --- T7 / T8 on the long branch form --------------------------------------------
def with_prev(branch_rows: DataFrame, text_col: str = "text", out: str = "text_prev") -> DataFrame:
    """T7 on explicit branch rows: previous post's text in the branch, '' first."""
    w = Window.partitionBy("conv_id", "branch_no").orderBy("pos")
    return branch_rows.withColumn(out, F.coalesce(F.lag(text_col).over(w), F.lit("")))


def with_source(branch_rows: DataFrame, text_col: str = "text", out: str = "text_src") -> DataFrame:
    """T8 on explicit branch rows: first post's text in the branch, '' for it."""
    w = Window.partitionBy("conv_id", "branch_no").orderBy("pos") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return branch_rows.withColumn(
        out, F.when(F.col("pos") > 0, F.first(text_col).over(w)).otherwise(F.lit("")))


# --- T9 / T10 -------------------------------------------------------------------
def first_occurrence(rows: DataFrame, key_cols: Sequence[str] = ("fold", "post_id"),
                     order_cols: Sequence[str] = ("branch_no", "pos")) -> DataFrame:
    """Keep, per key, the row that comes first in ``order_cols``.

    ``min(struct(order..., rest...))`` is an ordinary aggregate (partial
    aggregation map-side), so a post repeated in many threads never gathers
    in one task.
    """
    key_cols, order_cols = list(key_cols), list(order_cols)
    rest = [c for c in rows.columns if c not in key_cols and c not in order_cols]
    s = F.min(F.struct(*order_cols, *rest)).alias("_m")
    return rows.groupBy(*key_cols).agg(s).select(*key_cols, *[F.col(f"_m.{c}").alias(c)
                                                              for c in order_cols + rest])


def with_example_id(rows: DataFrame, group_cols: Sequence[str] = ("fold",),
                    order_cols: Sequence[str] = ("branch_no", "pos"), out: str = "id") -> DataFrame:
    """Running example number per fold (range buckets, no global window)."""
    return dense_index(rows, order_cols, out, group_cols)


# --- T13 ------------------------------------------------------------------------
def conversation_table(posts: DataFrame, conv_order: Sequence[str], fold_col: str) -> DataFrame:
    """(conv_id, fold) pairs with the ordering columns: a conversation whose
    posts are given for two folds is in both."""
    cols = [c for c in dict.fromkeys(conv_order) if c not in ("conv_id", fold_col)]
    return posts.groupBy("conv_id", fold_col).agg(*[F.min(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n")).drop("_n")


def _by_fold(df: DataFrame, fold_col: str) -> DataFrame:
    """The conversation key made (fold, conv_id)."""
    return df.withColumn("conv_id", F.struct(F.col(fold_col).alias("fold"), F.col("conv_id").alias("conv")))


def example_nodes(posts: DataFrame, edges: DataFrame, convs: DataFrame | None = None,
                  conv_order: Sequence[str] = ("conv_id",), fold_col: str = "fold") -> DataFrame:
    """Present nodes with fold, branch number, position, previous and source
    post ids (T3 + T4 + T7 + T8 in id form)."""
    if convs is None:
        convs = conversation_table(posts, conv_order, fold_col)
    extra = [c for c in dict.fromkeys(conv_order) if c not in ("conv_id", fold_col)]
    edges = _by_fold(edges.join(convs.select("conv_id", fold_col), "conv_id"), fold_col).select("conv_id", "parent_id", "post_id", "sib_pos")
    nd = TR.nodes(edges, _by_fold(posts, fold_col))
    if extra:
        nd = nd.join(_by_fold(convs, fold_col).select("conv_id", *extra), "conv_id")
    nd = nd.withColumn(fold_col, F.col("conv_id.fold")).withColumn("conv_id", F.col("conv_id.conv"))
    # without further ordering columns this is a projection of the stored nodes
    numbered = TR.number_branches(nd, conv_order, [fold_col], stored=not extra)
    return numbered.where("present").select(
        F.col(fold_col).alias("fold"), "conv_id", "post_id", "branch_no",
        F.col("n_anc").cast("int").alias("pos"), "prev_id", "src_id")


def build_examples(posts: DataFrame, edges: DataFrame, lexicon, convs: DataFrame | None = None,
                   conv_order: Sequence[str] = ("conv_id",), fold_col: str = "fold",
                   gazetteer=None, features: DataFrame | None = None) -> DataFrame:
    """T13, the flagship: posts + reply edges -> one example per post and fold.

    posts: conv_id, post_id, is_source, text, stance (nullable), fold; several
           rows of one post are one post (``one_post``)
    edges: conv_id, parent_id, post_id, sib_pos; repeated edges are one edge

    The post's own, the previous and the first post's columns are joined to
    thin (fold, id, key) rows, each join a plain shuffle join that AQE can
    split at a hot post or thread; the three text-bearing parts meet last, on
    the unique (fold, id).
    """
    posts = one_post(posts, ("conv_id", "post_id", fold_col))
    ex = first_occurrence(example_nodes(posts, edges, convs, conv_order, fold_col))
    ex = materialize(with_example_id(ex), "example-ids")
    if features is None:
        # stored as Parquet: the three joins below read only the columns they take
        features = materialize(thread_features(posts, lexicon, gazetteer), "features")
    flags = ["issource", "hasqmark", "hasemark", "hashashtag", "hasurl", "haspic", "hasnegation",
             "hasswearwords", "src_rumour", "thread_rumour"]
    f = features.select("conv_id", "post_id", "stance", "raw_text", "clean_text", "ner", *flags)

    def context(id_col: str, tag: str) -> DataFrame:
        side = features.select("conv_id", F.col("post_id").alias(id_col), F.col("raw_text").alias(f"raw_text_{tag}"),
                               F.col("clean_text").alias(f"clean_text_{tag}"))
        thin = ex.select("fold", "id", "conv_id", id_col).where(F.col(id_col).isNotNull())
        return thin.join(side, ["conv_id", id_col]).select("fold", "id", f"raw_text_{tag}", f"clean_text_{tag}")

    own = ex.select("fold", "id", "conv_id", "post_id", "branch_no", "pos").join(f, ["conv_id", "post_id"])
    j = own.join(context("prev_id", "prev"), ["fold", "id"], "left").join(context("src_id", "src"), ["fold", "id"], "left")
    return j.select(
        "fold", "id", TX.branch_id("branch_no", "pos").alias("branch_id"),
        F.col("post_id").alias("tweet_id"), F.col("stance").alias("stance_label"),
        "raw_text", F.coalesce("raw_text_prev", F.lit("")).alias("raw_text_prev"),
        F.coalesce("raw_text_src", F.lit("")).alias("raw_text_src"),
        "issource", "clean_text", "ner", "hasqmark", "hasemark", "hashashtag", "hasurl", "haspic",
        "hasnegation", "hasswearwords", "src_rumour", "thread_rumour",
        F.coalesce("clean_text_prev", F.lit("")).alias("clean_text_prev"),
        F.coalesce("clean_text_src", F.lit("")).alias("clean_text_src"),
    )
