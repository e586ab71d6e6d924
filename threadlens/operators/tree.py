"""Reply-tree operators.

Trees are keyed tables, never one nested row per conversation:

    edges (conv_id, parent_id NULL for a root, post_id, sib_pos INT)
    nodes (conv_id, post_id, parent_id, ord ARRAY<INT>, path ARRAY<id>, depth,
           is_leaf, [present, n_anc, prev_id, src_id])

``ord`` holds the sibling positions from the root down; comparing ``ord``
arrays lexicographically is pre-order, so no branch ever has to be
materialised to number it. The walk doubles pointers: after k rounds every
node knows its nearest 2^k ancestors, so a tree of any depth takes log2(depth)
joins. They are plain shuffle joins on the node, so AQE splits the many
replies of one hot post.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.operators.index import dense_index, prefix_sum
from threadlens.session import materialize, ship_package

GRAFT_BASE = 1_000_000_000  # sib_pos of grafted children: after every original child


# --- T1 --------------------------------------------------------------------
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+')


def _tree_edges(doc: str | None) -> list[tuple]:
    """(parent, id, sibling position) of a nested id tree, in one scan of the
    text with a stack of its own, so depth has no limit. A repeated key keeps
    its first position and its last subtree, as in a Python dict; a document
    that is no tree of objects gives nothing."""
    if not doc:
        return []
    root: dict = {}
    stack: list = []      # open objects
    key, want_value = None, False
    for m in _TOKEN.finditer(doc):
        t = m.group()
        if t == "{":
            if not stack:
                if root:
                    break
                stack.append(root)
            elif stack[-1] is None:
                stack.append(None)
            else:
                child: dict = {}
                stack[-1][key] = child
                stack.append(child)
            want_value = False
        elif t == "[":
            if stack and stack[-1] is not None and want_value:
                stack[-1][key] = {}
            stack.append(None)  # a list is a leaf whatever it holds
            want_value = False
        elif t in "}]":
            if not stack:
                return []
            stack.pop()
            if not stack:
                break
        elif t == ":":
            want_value = True
        elif t == ",":
            want_value = False
        elif stack and stack[-1] is not None:
            if want_value:
                stack[-1][key] = {}  # a scalar ends the branch
                want_value = False
            else:
                try:
                    key = json.loads(t, strict=False) if t[0] == '"' else t
                except ValueError:
                    return []
    if stack:
        return []  # the text ends inside
    out, todo = [], [(None, root)]
    while todo:
        parent, node = todo.pop()
        for pos, (k, sub) in enumerate(node.items()):
            out.append((parent, k, pos))
            if sub:
                todo.append((k, sub))
    return out


def _parse_batches(batches):
    import pyarrow as pa

    for b in batches:
        rows = [(c, *e) for c, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for e in _tree_edges(doc)]
        c, p, i, n = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, b.schema.field(0).type), pa.array(p, pa.string()), pa.array(i, pa.string()), pa.array(n, pa.int32())],
                                         ["conv_id", "parent_id", "post_id", "sib_pos"])


def tree_json_to_edges(raw: DataFrame, json_col: str = "value", conv_col: str = "conv_id") -> DataFrame:
    """Nested id tree ``{"id": {children} | []}`` -> edge rows; key order is
    sibling order, a list or ``{}`` is a leaf. Each document is read once."""
    ship_package(raw.sparkSession)
    src = raw.select(F.col(conv_col).alias("conv_id"), F.col(json_col).cast("string").alias("doc"))
    conv = src.schema["conv_id"].dataType.simpleString()
    return src.mapInArrow(_parse_batches, f"conv_id {conv}, parent_id string, post_id string, sib_pos int")


# --- N8 / N9 ---------------------------------------------------------------
def prune_roots(edges: DataFrame, root_id: Column | str = "conv_id") -> DataFrame:
    """Keep only the root whose id equals ``root_id``; other roots (and with
    them everything below them) drop out of the walk."""
    rid = F.col(root_id) if isinstance(root_id, str) else root_id
    return edges.where(F.col("parent_id").isNotNull() | (F.col("post_id") == rid))


def graft(edges: DataFrame, fixes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Move subtrees: ``fixes(conv_id, post_id, new_parent, fix_pos)``.

    A grafted child comes after every original child of its new parent, in
    ``fix_pos`` order (a dict key added last). ``fixes`` is left to the
    planner: a hand-made table of a few rows is broadcast by size, a large one
    is shuffle-joined. ``keep`` names further columns of the edges to keep.
    """
    f = fixes.select("conv_id", "post_id", F.col("new_parent").alias("_np"),
                     F.col("fix_pos").alias("_fp"))
    j = edges.join(f, ["conv_id", "post_id"], "left")
    return j.select(
        "conv_id",
        F.coalesce("_np", "parent_id").alias("parent_id"),
        "post_id",
        F.when(F.col("_np").isNotNull(), F.lit(GRAFT_BASE) + F.col("_fp").cast("int"))
         .otherwise(F.col("sib_pos")).cast("int").alias("sib_pos"),
        *keep,
    )


# --- presence ----------------------------------------------------------------
def with_presence(edges: DataFrame, posts: DataFrame | None) -> DataFrame:
    """Flag each edge whose post exists (left semi-style lookup)."""
    if posts is None:
        return edges.withColumn("present", F.lit(True))
    keys = posts.select("conv_id", "post_id").dropDuplicates(["conv_id", "post_id"]) \
        .withColumn("present", F.lit(True))
    return edges.join(keys, ["conv_id", "post_id"], "left") \
        .withColumn("present", F.coalesce("present", F.lit(False)))


# --- T2: the walk -----------------------------------------------------------------
def unique_edges(edges: DataFrame) -> DataFrame:
    """One row per (conversation, parent, post): a reply listed twice under
    one parent keeps its first sibling position."""
    return edges.groupBy("conv_id", "parent_id", "post_id").agg(F.min(F.col("sib_pos").cast("int")).alias("sib_pos"))


def walk(edges: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Every node reachable from a root, with its pre-order key and the
    present-ancestor bookkeeping used by example assembly:

    n_anc   number of present strict ancestors (= position in the cleaned branch)
    prev_id nearest present strict ancestor (the previous post of the branch)
    src_id  first present post on the path above the node (the branch source)

    Pointer doubling: a row holds what lies between its node and the ancestor
    it points to (``_up``; null once a root is reached); a round appends what
    that ancestor's row holds. A post listed under two parents has a row for
    each path; a cycle in a parent table is cut (no post twice on a path).
    """
    e = with_presence(unique_edges(edges), posts)
    present = F.col("present").cast("int")
    own = F.when(F.col("present"), F.col("post_id"))
    state = materialize(e.select(
        "conv_id", "post_id", "parent_id", "present", F.col("parent_id").alias("_up"),
        F.array("sib_pos").alias("ord"), F.array("post_id").alias("path"),
        # over the covered stretch, the node itself left out / taken in
        F.lit(0).alias("n_anc"), F.lit(None).cast(e.schema["post_id"].dataType).alias("prev_id"), F.lit(None).cast(e.schema["post_id"].dataType).alias("src_id"),
        present.alias("_n"), own.alias("_last"), own.alias("_first")), "walk")
    done = state.where("_up is null")
    active = state.where("_up is not null")
    while True:
        everything = done.unionByName(active)
        a = everything.select(F.col("conv_id").alias("a_conv"), F.col("post_id").alias("a_post"), F.col("_up").alias("a_up"), F.col("ord").alias("a_ord"),
                              F.col("path").alias("a_path"), F.col("_n").alias("a_n"), F.col("_last").alias("a_last"), F.col("_first").alias("a_first"))
        j = active.join(a, (F.col("conv_id") == F.col("a_conv")) & (F.col("_up") == F.col("a_post"))).where(~F.arrays_overlap("path", "a_path"))
        step = materialize(j.select(
            "conv_id", "post_id", "parent_id", "present", F.col("a_up").alias("_up"),
            F.concat("a_ord", "ord").alias("ord"), F.concat("a_path", "path").alias("path"),
            (F.col("n_anc") + F.col("a_n")).alias("n_anc"),
            F.coalesce("prev_id", "a_last").alias("prev_id"), F.coalesce("a_first", "src_id").alias("src_id"),
            (F.col("_n") + F.col("a_n")).alias("_n"), F.coalesce("_last", "a_last").alias("_last"), F.coalesce("a_first", "_first").alias("_first")), "walk")
        new = step.where("_up is null")
        # depths are contiguous: a round that reaches no root leaves only cycles and orphans (see ``unreachable``)
        if not new.limit(1).count():
            break
        done = done.unionByName(new)
        active = step.where("_up is not null")
    return done.select("conv_id", "post_id", "parent_id", "present", "ord", "path", (F.size("path") - 1).alias("depth"), "n_anc", "prev_id", "src_id")


def unreachable(edges: DataFrame, reached: DataFrame | None = None) -> DataFrame:
    """(conv_id, post_id, reason, top): the posts that no root leads to, which
    the walk leaves out. ``reason`` is 'orphan' where the way up ends at a post
    without a row (``top``), 'cycle' where it runs in a circle (``top`` is the
    circle's smallest post). ``reached``: the walk of these edges, if at hand.

    Of the posts left over each points to its parent (several: the smallest
    that is left over too). After k rounds of pointer doubling a post points
    2^k steps up; with 2^k at least the number of posts left over in any
    conversation, what is pointed at lies on a circle, and every post of a
    circle is pointed at by one of its own. Rows have a fixed width."""
    reached = walk(edges) if reached is None else reached
    lost = unique_edges(edges).where(F.col("parent_id").isNotNull()).join(reached.select("conv_id", "post_id").distinct(), ["conv_id", "post_id"], "left_anti")
    lost = materialize(lost.select("conv_id", "post_id", "parent_id"), "lost")
    size = lost.groupBy("conv_id").agg(F.countDistinct("post_id").alias("n")).agg(F.max("n")).first()[0]
    known = lost.select("conv_id", F.col("post_id").alias("parent_id"), F.lit(True).alias("_here")).distinct()
    up = lost.join(known, ["conv_id", "parent_id"], "left").groupBy("conv_id", "post_id").agg(
        F.min(F.when(F.col("_here"), F.col("parent_id"))).alias("_up"), F.min("parent_id").alias("_missing"))
    # a post whose way up has ended: _up is null and _end is the post that is not there
    state = materialize(up.select("conv_id", "post_id", "_up", F.when(F.col("_up").isNull(), F.col("_missing")).alias("_end"), F.col("post_id").alias("_low")), "ways")
    for _ in range(max(0, ((size or 0) - 1).bit_length())):
        a = state.select("conv_id", F.col("post_id").alias("_up"), F.col("_up").alias("a_up"), F.col("_end").alias("a_end"), F.col("_low").alias("a_low"))
        state = materialize(state.join(a, ["conv_id", "_up"], "left").select(
            "conv_id", "post_id", F.col("a_up").alias("_up"), F.coalesce("_end", "a_end").alias("_end"), F.least("_low", "a_low").alias("_low")), "ways")
    circles = state.join(state.where("_up is not null").select("conv_id", F.col("_up").alias("post_id")).distinct(), ["conv_id", "post_id"], "left_semi") \
        .select("conv_id", F.col("post_id").alias("_up"), F.col("_low").alias("_top"))
    return state.join(circles, ["conv_id", "_up"], "left").select(
        "conv_id", "post_id", F.when(F.col("_up").isNull(), "orphan").otherwise("cycle").alias("reason"), F.coalesce("_end", "_top").alias("top"))


def nodes(edges: DataFrame, posts: DataFrame | None = None, materialized: bool = True) -> DataFrame:
    """``walk`` plus ``is_leaf`` (no child edge). Everything downstream reads
    the node table several times, so by default it is stored once."""
    w = walk(edges, posts)
    parents = edges.where(F.col("parent_id").isNotNull()) \
        .select("conv_id", F.col("parent_id").alias("post_id")).distinct() \
        .withColumn("_has_child", F.lit(True))
    out = w.join(parents, ["conv_id", "post_id"], "left") \
        .withColumn("is_leaf", F.col("_has_child").isNull()).drop("_has_child")
    return materialize(out, "nodes") if materialized else out


def branches(node_df: DataFrame, conv_order: Sequence[str] = ("conv_id",), stored: bool = True) -> DataFrame:
    """Long form ``(conv_id, branch_no, pos, post_id)``: one row per post of
    every root-to-leaf path; ``branch_no`` counts leaves in pre-order inside
    the conversation (0-based)."""
    leaves = node_df.where("is_leaf").select(*dict.fromkeys([*conv_order, "conv_id"]), "ord", "path")
    g = materialize(dense_index(leaves, [*conv_order, "ord"], "_g", stored=stored), "leaves")
    first = g.groupBy("conv_id").agg(F.min("_g").alias("_g0"))
    numbered = g.join(first, "conv_id").withColumn("branch_no", (F.col("_g") - F.col("_g0")).cast("int"))
    return numbered.select("conv_id", "branch_no", F.posexplode("path").alias("pos", "post_id")) \
        .withColumn("pos", F.col("pos").cast("int"))


def number_branches(node_df: DataFrame, conv_order: Sequence[str] = ("conv_id",),
                    group_cols: Sequence[str] = (), stored: bool = False) -> DataFrame:
    """``branch_no`` of a node = number of non-empty branches before the
    first branch through it, counted over the whole group (fold) in
    (conversation order, pre-order). A branch is non-empty when at least one
    post on it exists."""
    counted = (F.col("is_leaf") & (F.col("present") | (F.col("n_anc") > 0))).cast("long")
    return prefix_sum(node_df.withColumn("_counted", counted), [*conv_order, "ord"],
                      "branch_no", "_counted", group_cols, stored=stored).drop("_counted")


# --- T4-T6, T12 ---------------------------------------------------------------
def present_branches(branch_df: DataFrame, posts: DataFrame) -> DataFrame:
    """T4: drop branch entries without a post (left semi) and re-number
    ``pos``; a branch left empty disappears. The window is one branch."""
    keys = posts.select("conv_id", "post_id")
    kept = branch_df.join(keys, ["conv_id", "post_id"], "left_semi")
    w = Window.partitionBy("conv_id", "branch_no").orderBy("pos")
    return kept.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))


def branch_labels(branch_df: DataFrame, posts: DataFrame, label_col: str = "stance") -> DataFrame:
    """T5: stance labels aligned with the posts of each branch (pos order)."""
    j = branch_df.join(posts.select("conv_id", "post_id", label_col), ["conv_id", "post_id"])
    return j.groupBy("conv_id", "branch_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col(label_col).alias("v")))).alias("_s")
    ).select("conv_id", "branch_no", F.transform("_s", lambda s: s["v"]).alias("labels"))


def branch_features(branch_df: DataFrame, features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per branch, the feature structs of its posts in ``pos`` order."""
    j = branch_df.join(features.select("conv_id", "post_id", *cols), ["conv_id", "post_id"])
    return j.groupBy("conv_id", "branch_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "post_id", *cols))).alias("features"))


def branch_conv(branch_df: DataFrame) -> DataFrame:
    """The conversation of every branch."""
    return branch_df.select("conv_id", "branch_no").distinct()
