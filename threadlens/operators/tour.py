"""T2/T3 by an Euler tour: pre-order, depth, subtree and branch numbers of every
post as longs, in rows whose width does not grow with the depth.

Going round a reply tree, each post is entered once and left once. The element
before an entry is the exit of the sibling before it, or the entry of its
parent; before an exit comes the exit of the last child, or the post's own
entry. Each element points to the one before it and holds the sums over the
stretch it has covered so far; a round of pointer doubling appends the stretch
of the element pointed at, so a conversation of n posts takes log2(2n) joins,
whatever the shape of its tree. An element is pointed at by one other only:
no join key is hot, not even in a conversation that holds most posts or below
a post with most replies (siblings are numbered by ``dense_index``).

Defined results: a post listed under several parents is taken as a root if it
is one, else below the smallest parent, at its first position there; siblings
of equal position stand in the order of their ids; posts that no root leads to
are left out (``tree.unreachable`` reports them); no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.index import dense_index
from threadlens.session import materialize

CHUNK = 4096  # branch numbers that one row is unfolded into at a time


def _element(out: bool, rows: DataFrame, up_post, up_out, entries, depth, leaves) -> DataFrame:
    return rows.select("conv_id", "post_id", F.lit(out).alias("out"), up_post.alias("up_post"), up_out.alias("up_out"),
                       entries.cast("long").alias("n"), depth.cast("long").alias("d"), leaves.cast("long").alias("l"))


def _elements(edges: DataFrame) -> DataFrame:
    """Entry and exit of each post with the element before it: ``n`` entries,
    ``d`` steps down less steps up and ``l`` leaves are that element's own."""
    one = edges.groupBy("conv_id", "post_id").agg(F.min(F.struct(F.col("parent_id").isNotNull().alias("below"), "parent_id", F.col("sib_pos").cast("int").alias("sib_pos"))).alias("e"))
    one = one.select("conv_id", "post_id", "e.parent_id", "e.sib_pos")
    r = materialize(dense_index(one, ["conv_id", "parent_id", "sib_pos", "post_id"], "_r"), "siblings")
    before = r.select(F.col("conv_id").alias("b_conv"), F.col("parent_id").alias("b_parent"), F.col("post_id").alias("b_post"), (F.col("_r") + 1).alias("b_r"))
    entry = r.join(before, (F.col("_r") == F.col("b_r")) & (F.col("conv_id") == F.col("b_conv")) & F.col("parent_id").eqNullSafe(F.col("b_parent")), "left")
    sibling, child = F.col("b_post").isNotNull(), F.col("last").isNotNull()
    below = F.col("parent_id").isNotNull()
    entries = _element(False, entry, F.coalesce("b_post", "parent_id"), sibling, F.when(~sibling & below, 1).otherwise(0),
                       F.when(sibling, -1).when(below, 1).otherwise(0), F.lit(0))
    last = r.where(below).groupBy("conv_id", F.col("parent_id").alias("post_id")).agg(F.max(F.struct("_r", "post_id")).alias("m")).select("conv_id", "post_id", F.col("m.post_id").alias("last"))
    exits = _element(True, r.join(last, ["conv_id", "post_id"], "left"), F.coalesce("last", "post_id"), child,
                     F.when(child, 0).otherwise(1), F.when(child, -1).otherwise(1), F.when(child, 0).otherwise(1))
    return entries.unionByName(exits)


def euler_tour(edges: DataFrame) -> DataFrame:
    """(conv_id, post_id, enter, depth, size, branch_no, n_leaves) as longs:
    place in pre-order from 0, steps from the root, posts of the subtree, leaves
    before it in the conversation, leaves in it."""
    state = materialize(_elements(edges), "tour")
    done, active = state.where("up_post is null"), state.where("up_post is not null")
    while True:
        a = done.unionByName(active).select(F.col("conv_id").alias("a_conv"), F.col("post_id").alias("a_post"), F.col("out").alias("a_out"),
                                            F.col("up_post").alias("a_up"), F.col("up_out").alias("a_up_out"), F.col("n").alias("a_n"), F.col("d").alias("a_d"), F.col("l").alias("a_l"))
        on = (F.col("conv_id") == F.col("a_conv")) & (F.col("up_post") == F.col("a_post")) & (F.col("up_out") == F.col("a_out"))
        step = materialize(active.join(a, on).select("conv_id", "post_id", "out", F.col("a_up").alias("up_post"), F.col("a_up_out").alias("up_out"),
                                                     (F.col("n") + F.col("a_n")).alias("n"), (F.col("d") + F.col("a_d")).alias("d"), (F.col("l") + F.col("a_l")).alias("l")), "tour")
        new = step.where("up_post is null")
        # places on a list are contiguous: a round that ends none leaves circles only
        if not new.limit(1).count():
            break
        done, active = done.unionByName(new), step.where("up_post is not null")
    side = {c: (F.max(F.when(~F.col("out"), F.col(c))), F.max(F.when(F.col("out"), F.col(c)))) for c in "nl"}
    return done.groupBy("conv_id", "post_id").agg(
        side["n"][0].alias("enter"), F.max(F.when(~F.col("out"), F.col("d"))).alias("depth"), (side["n"][1] - side["n"][0]).alias("size"),
        side["l"][0].alias("branch_no"), (side["l"][1] - side["l"][0]).alias("n_leaves"))


def tour_branches(tour: DataFrame) -> DataFrame:
    """``(conv_id, branch_no, pos, post_id)`` as ``tree.branches`` gives it: a
    post is on the branches of the leaves below it, at the place of its depth.
    Rows are unfolded where they stand, without paths, sorts or joins."""
    last = F.col("branch_no") + F.col("n_leaves") - 1
    parts = tour.select("conv_id", "post_id", F.col("depth").cast("int").alias("pos"), last.alias("last"),
                        F.explode(F.sequence(F.col("branch_no"), last, F.lit(CHUNK).cast("long"))).alias("start"))
    numbers = F.sequence(F.col("start"), F.least(F.col("start") + (CHUNK - 1), F.col("last")), F.lit(1).cast("long"))
    return parts.withColumn("branch_no", F.explode(numbers)).select("conv_id", F.col("branch_no").cast("int").alias("branch_no"), "pos", "post_id")
