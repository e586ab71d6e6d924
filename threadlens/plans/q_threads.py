"""Queries for the tree and example operators (T1-T13) on the thread fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.operators import examples as EX
from threadlens.operators import tour as TO
from threadlens.operators import tree as TR
from threadlens.operators.features import thread_features
from threadlens.plans import duck as D
from threadlens.plans.fixtures import duck_with, fixture
from threadlens.plans.registry import register
from threadlens.session import materialize


def ints_str(c):
    """ARRAY<INT> (NULLs shown as 'null') -> 'a,b,c' for engine-neutral comparison."""
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c,
                                    lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ",")


def duck_ints_str(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda x: coalesce(CAST(x AS VARCHAR), 'null')), ',')"


# Shared DuckDB CTEs: full walk over ``edges``, leaves, branch entries.
DUCK_TREE = """,
walk AS (
  SELECT conv_id, post_id, [sib_pos] AS ord, [post_id] AS path FROM edges WHERE parent_id IS NULL
  UNION ALL
  SELECT e.conv_id, e.post_id, list_append(w.ord, e.sib_pos), list_append(w.path, e.post_id)
  FROM walk w JOIN edges e ON e.conv_id = w.conv_id AND e.parent_id = w.post_id
  WHERE NOT list_contains(w.path, e.post_id)),
leaves AS (
  SELECT w.conv_id, w.ord, w.path FROM walk w
  WHERE NOT EXISTS (SELECT 1 FROM walk c WHERE c.conv_id = w.conv_id AND len(c.path) = len(w.path) + 1
                    AND c.path[len(c.path) - 1] = w.post_id)),
bp AS (
  SELECT conv_id, ord, unnest(path) AS post_id, generate_subscripts(path, 1) AS k FROM leaves),
conv_branch AS (
  SELECT conv_id, ord, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY ord) - 1 AS INT) AS branch_no
  FROM leaves),
present_bp AS (
  SELECT cb.conv_id, cb.branch_no, bp.post_id,
         CAST(row_number() OVER (PARTITION BY bp.conv_id, bp.ord ORDER BY bp.k) - 1 AS INT) AS pos
  FROM bp JOIN conv_branch cb ON cb.conv_id = bp.conv_id AND cb.ord = bp.ord
  WHERE EXISTS (SELECT 1 FROM posts p WHERE p.conv_id = bp.conv_id AND p.post_id = bp.post_id))"""

# Examples by explicit branch explosion (independent of the Spark method).
DUCK_EXAMPLES = """,
pe AS (
  SELECT bp.conv_id, bp.ord, bp.post_id, bp.k, p.fold
  FROM bp JOIN posts p ON p.conv_id = bp.conv_id AND p.post_id = bp.post_id),
nb AS (
  SELECT conv_id, ord, fold, row_number() OVER (PARTITION BY fold ORDER BY conv_id, ord) - 1 AS branch_no
  FROM (SELECT DISTINCT conv_id, ord, fold FROM pe)),
ent AS (
  SELECT nb.fold, nb.conv_id, nb.branch_no, pe.post_id,
         row_number() OVER (PARTITION BY nb.conv_id, nb.ord ORDER BY pe.k) - 1 AS pos
  FROM pe JOIN nb ON pe.conv_id = nb.conv_id AND pe.ord = nb.ord),
ctx AS (
  SELECT *, lag(post_id) OVER w AS prev_id,
         CASE WHEN pos > 0 THEN first_value(post_id) OVER w END AS src_id
  FROM ent WINDOW w AS (PARTITION BY conv_id, branch_no ORDER BY pos)),
firsts AS (
  SELECT * FROM ctx QUALIFY row_number() OVER (PARTITION BY fold, post_id ORDER BY branch_no, pos) = 1),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY fold ORDER BY branch_no, pos) - 1 AS id FROM firsts)"""


def _posts_edges(spark, d):
    return fixture(spark, d, "posts"), fixture(spark, d, "edges")


# --- T13 flagship ---------------------------------------------------------------
def flagship(spark, d):
    posts, edges = _posts_edges(spark, d)
    ex = EX.build_examples(posts, edges, L.FIXTURE_SWEAR_LEXICON)
    return ex.withColumn("ner", ints_str("ner"))


DUCK_EXAMPLES_TABLE = """,
examples AS (
SELECT n.fold, n.id, CAST(n.branch_no AS VARCHAR) || '.' || CAST(n.pos AS VARCHAR) AS branch_id,
  n.post_id AS tweet_id, f.stance AS stance_label, f.raw_text,
  coalesce(fp.raw_text, '') AS raw_text_prev, coalesce(fs.raw_text, '') AS raw_text_src,
  f.issource, f.clean_text, f.ner,
  f.hasqmark, f.hasemark, f.hashashtag, f.hasurl, f.haspic, f.hasnegation, f.hasswearwords,
  f.src_rumour, f.thread_rumour,
  coalesce(fp.clean_text, '') AS clean_text_prev, coalesce(fs.clean_text, '') AS clean_text_src
FROM numbered n JOIN feat f ON f.conv_id = n.conv_id AND f.post_id = n.post_id
LEFT JOIN feat fp ON fp.conv_id = n.conv_id AND fp.post_id = n.prev_id
LEFT JOIN feat fs ON fs.conv_id = n.conv_id AND fs.post_id = n.src_id)"""

DUCK_EXAMPLES_WITH = (duck_with("posts", "edges", recursive=True) + "," + D.features_cte("posts")
                      + DUCK_TREE + DUCK_EXAMPLES + DUCK_EXAMPLES_TABLE)

EXAMPLE_COLS = ("fold, id, branch_id, tweet_id, stance_label, raw_text, raw_text_prev, raw_text_src, issource, "
                "clean_text, ner, hasqmark, hasemark, hashashtag, hasurl, haspic, hasnegation, hasswearwords, "
                "src_rumour, thread_rumour, clean_text_prev, clean_text_src")

register("examples_flagship", DUCK_EXAMPLES_WITH + "\nSELECT " + EXAMPLE_COLS.replace(
    " ner,", " " + duck_ints_str("ner") + " AS ner,") + " FROM examples")(flagship)


# the same rows from a table in which posts and edges are given several times
register("examples_repeated_posts", DUCK_EXAMPLES_WITH + "\nSELECT " + EXAMPLE_COLS.replace(
    " ner,", " " + duck_ints_str("ner") + " AS ner,") + " FROM examples")(
    lambda spark, d: EX.build_examples(fixture(spark, d, "posts_repeated"), fixture(spark, d, "edges_repeated"), L.FIXTURE_SWEAR_LEXICON)
    .withColumn("ner", ints_str("ner")))


def examples_df(spark, d, materialized: bool = True):
    """The flagship example table (arrays kept) for the queries built on it;
    checkpointed, since those queries read it more than once."""
    posts, edges = _posts_edges(spark, d)
    ex = EX.build_examples(posts, edges, L.FIXTURE_SWEAR_LEXICON)
    return materialize(ex) if materialized else ex


# --- T2 / T12 -------------------------------------------------------------------------
@register("tree_branches", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT cb.conv_id, cb.branch_no, CAST(bp.k - 1 AS INT) AS pos, bp.post_id
FROM bp JOIN conv_branch cb ON cb.conv_id = bp.conv_id AND cb.ord = bp.ord""")
def q_tree_branches(spark, d):
    edges = fixture(spark, d, "edges")
    return TR.branches(TR.nodes(edges))


@register("tree_branch_conv", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT conv_id, branch_no FROM conv_branch""")
def q_tree_branch_conv(spark, d):
    return TR.branch_conv(TR.branches(TR.nodes(fixture(spark, d, "edges"))))


# the same branches, and the numbers they come from, by an Euler tour
@register("tree_tour_branches", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT cb.conv_id, cb.branch_no, CAST(bp.k - 1 AS INT) AS pos, bp.post_id
FROM bp JOIN conv_branch cb ON cb.conv_id = bp.conv_id AND cb.ord = bp.ord""")
def q_tree_tour_branches(spark, d):
    return TO.tour_branches(TO.euler_tour(fixture(spark, d, "edges")))


@register("tree_tour", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """,
sizes AS (SELECT conv_id, post_id, count(*) AS size FROM (SELECT conv_id, unnest(path) AS post_id FROM walk) GROUP BY ALL),
below AS (SELECT conv_id, post_id, count(*) AS n_leaves FROM bp GROUP BY ALL)
SELECT w.conv_id, w.post_id, row_number() OVER (PARTITION BY w.conv_id ORDER BY w.ord) - 1 AS enter,
  CAST(len(w.path) - 1 AS BIGINT) AS depth, s.size, b.n_leaves,
  (SELECT count(*) FROM leaves l WHERE l.conv_id = w.conv_id AND l.ord < w.ord) AS branch_no
FROM walk w JOIN sizes s USING (conv_id, post_id) JOIN below b USING (conv_id, post_id)""")
def q_tree_tour(spark, d):
    return TO.euler_tour(fixture(spark, d, "edges"))


# --- T3 -------------------------------------------------------------------------------
@register("tree_branch_no", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """,
cf AS (SELECT conv_id, min(fold) AS fold FROM posts GROUP BY conv_id),
ne AS (SELECT DISTINCT bp.conv_id, bp.ord, cf.fold FROM bp JOIN cf USING (conv_id)
       WHERE EXISTS (SELECT 1 FROM posts p WHERE p.conv_id = bp.conv_id AND p.post_id = bp.post_id))
SELECT cf.fold, w.conv_id, w.post_id,
  (SELECT count(*) FROM ne WHERE ne.fold = cf.fold
     AND (ne.conv_id < w.conv_id OR (ne.conv_id = w.conv_id AND ne.ord < w.ord))) AS branch_no
FROM walk w JOIN cf USING (conv_id)""")
def q_tree_branch_no(spark, d):
    posts, edges = _posts_edges(spark, d)
    convs = EX.conversation_table(posts, ["conv_id"], "fold")
    nd = TR.nodes(edges, posts).join(convs, "conv_id")
    return TR.number_branches(nd, ["conv_id"], ["fold"]).select("fold", "conv_id", "post_id", "branch_no")


# --- T4 -------------------------------------------------------------------------------
def _present_branches(spark, d):
    posts, edges = _posts_edges(spark, d)
    return posts, TR.present_branches(TR.branches(TR.nodes(edges)), posts)


@register("join_present_semi", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT conv_id, branch_no, pos, post_id FROM present_bp""")
def q_present(spark, d):
    return _present_branches(spark, d)[1]


# --- T5 / T6 ---------------------------------------------------------------------------
@register("agg_branch_labels", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT b.conv_id, b.branch_no, """ + duck_ints_str("list(p.stance ORDER BY b.pos)") + """ AS labels
FROM present_bp b JOIN posts p ON p.conv_id = b.conv_id AND p.post_id = b.post_id
GROUP BY b.conv_id, b.branch_no""")
def q_branch_labels(spark, d):
    posts, pb = _present_branches(spark, d)
    return TR.branch_labels(pb, posts).withColumn("labels", ints_str("labels"))


@register("agg_branch_features", duck_with("posts", "edges", recursive=True) + "," + D.features_cte("posts")
          + DUCK_TREE + """
SELECT b.conv_id, b.branch_no,
  string_agg(b.post_id || ':' || CAST(f.hasqmark AS VARCHAR) || ':' || CAST(f.hasnegation AS VARCHAR)
             || ':' || CAST(f.thread_rumour AS VARCHAR), ';' ORDER BY b.pos) AS features
FROM present_bp b JOIN feat f ON f.conv_id = b.conv_id AND f.post_id = b.post_id
GROUP BY b.conv_id, b.branch_no""")
def q_branch_features(spark, d):
    posts, pb = _present_branches(spark, d)
    feats = thread_features(posts, L.FIXTURE_SWEAR_LEXICON)
    bf = TR.branch_features(pb, feats, ["hasqmark", "hasnegation", "thread_rumour"])
    return bf.select("conv_id", "branch_no", F.array_join(F.transform(
        "features", lambda s: F.concat_ws(":", s["post_id"], s["hasqmark"].cast("string"),
                                          s["hasnegation"].cast("string"),
                                          s["thread_rumour"].cast("string"))), ";").alias("features"))


# --- T7 / T8 ------------------------------------------------------------------------------
@register("win_prev_post", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT b.conv_id, b.branch_no, b.pos, b.post_id,
  coalesce(lag(p.text) OVER (PARTITION BY b.conv_id, b.branch_no ORDER BY b.pos), '') AS text_prev
FROM present_bp b JOIN posts p ON p.conv_id = b.conv_id AND p.post_id = b.post_id""")
def q_prev(spark, d):
    posts, pb = _present_branches(spark, d)
    rows = pb.join(posts.select("conv_id", "post_id", "text"), ["conv_id", "post_id"])
    return EX.with_prev(rows).select("conv_id", "branch_no", "pos", "post_id", "text_prev")


@register("win_source_post", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT b.conv_id, b.branch_no, b.pos, b.post_id,
  CASE WHEN b.pos > 0 THEN first_value(p.text) OVER (PARTITION BY b.conv_id, b.branch_no ORDER BY b.pos)
       ELSE '' END AS text_src
FROM present_bp b JOIN posts p ON p.conv_id = b.conv_id AND p.post_id = b.post_id""")
def q_src(spark, d):
    posts, pb = _present_branches(spark, d)
    rows = pb.join(posts.select("conv_id", "post_id", "text"), ["conv_id", "post_id"])
    return EX.with_source(rows).select("conv_id", "branch_no", "pos", "post_id", "text_src")


# --- T9 / T10 / T11 ------------------------------------------------------------------------
DUCK_SHARED = duck_with("posts_shared", "edges_shared", recursive=True) + """,
posts AS (SELECT * FROM posts_shared), edges AS (SELECT * FROM edges_shared)""" + DUCK_TREE + DUCK_EXAMPLES


@register("win_first_occurrence", DUCK_SHARED + """
SELECT fold, post_id, conv_id, branch_no, CAST(pos AS INT) AS pos FROM firsts""")
def q_first(spark, d):
    """On threads that share post ids within a fold."""
    posts, edges = fixture(spark, d, "posts_shared"), fixture(spark, d, "edges_shared")
    ex = EX.first_occurrence(EX.example_nodes(posts, edges))
    return ex.select("fold", "post_id", "conv_id", "branch_no", "pos")


@register("win_example_id", duck_with("posts", "edges", recursive=True) + DUCK_TREE + DUCK_EXAMPLES + """
SELECT fold, id, post_id, branch_no, CAST(pos AS INT) AS pos FROM numbered""")
def q_example_id(spark, d):
    posts, edges = _posts_edges(spark, d)
    ex = EX.with_example_id(EX.first_occurrence(EX.example_nodes(posts, edges)))
    return ex.select("fold", "id", "post_id", "branch_no", "pos")


@register("proj_branch_id", duck_with("posts", "edges", recursive=True) + DUCK_TREE + DUCK_EXAMPLES + """
SELECT fold, id, CAST(branch_no AS VARCHAR) || '.' || CAST(pos AS VARCHAR) AS branch_id,
       CAST(pos AS VARCHAR) AS level FROM numbered""")
def q_branch_id(spark, d):
    posts, edges = _posts_edges(spark, d)
    ex = EX.with_example_id(EX.first_occurrence(EX.example_nodes(posts, edges)))
    bid = TX.branch_id("branch_no", "pos")
    return ex.select("fold", "id", bid.alias("branch_id"), TX.branch_level(bid).alias("level"))
