"""Queries for normalisation (N1-N11), evaluation (M1, M3-M12), profiling
(A1-A4, A6) and encoding/batching (E1-E9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.operators import batching as BA
from threadlens.operators import encode as EN
from threadlens.operators import evaluate as EV
from threadlens.operators import normalize as NO
from threadlens.operators import profile as PR
from threadlens.operators import tree as TR
from threadlens.plans.fixtures import duck_with, fixture, table
from threadlens.plans.q_threads import (DUCK_EXAMPLES_WITH, DUCK_TREE, _present_branches, duck_ints_str,
                                        examples_df, ints_str)
from threadlens.plans.registry import register
from threadlens.session import materialize

STANCE_CASE = ("CASE {c} WHEN 'support' THEN 0 WHEN 'comment' THEN 1 WHEN 'deny' THEN 2 "
               "WHEN 'query' THEN 3 END")


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- N1 / N2: Reddit-shaped posts built from the thread fixture -------------------------
DELETED = "turn > 0 AND (conv_id + turn) % 5 = 4"


def reddit_raw(spark, d):
    """Posts in the Reddit JSON shape: sources carry data.children[0].data,
    replies data.body / data.author; deleted replies have no body."""
    b = fixture(spark, d, "base")
    user = F.concat(F.col("role"), F.lit("_"), F.col("conv_id").cast("string"))
    deleted = F.expr(DELETED)
    child = F.struct(F.struct(F.col("dtext").alias("title"), user.alias("author")).alias("data"))
    data = F.struct(
        F.when(F.col("is_source"), F.array(child)).alias("children"),
        F.when(~F.col("is_source") & ~deleted, F.col("dtext")).alias("body"),
        F.when(~F.col("is_source"), user).alias("author"))
    return b.select("conv_id", "post_id", "is_source", data.alias("data"))


_REDDIT_ORACLE = duck_with("base") + f"""
SELECT conv_id, post_id, is_source,
  CASE WHEN {DELETED} THEN '' ELSE dtext END AS text,
  CASE WHEN {DELETED} THEN '' ELSE role || '_' || CAST(conv_id AS VARCHAR) END AS user
FROM base"""


@register("norm_posts", _REDDIT_ORACLE)
def q_norm_posts(spark, d):
    return NO.normalize_posts(reddit_raw(spark, d), "reddit")


@register("norm_deleted_posts", duck_with("base") + f"""
SELECT conv_id, post_id, '' AS text, '' AS user FROM base WHERE {DELETED}""")
def q_norm_deleted(spark, d):
    n = NO.normalize_posts(reddit_raw(spark, d), "reddit")
    return n.where(~F.col("is_source") & (F.col("text") == "")).select("conv_id", "post_id", "text", "user")


NULL_TEXT = "(conv_id * 7 + turn) % 13 = 5"


@register("norm_missing_text", duck_with("base") + f"""
SELECT conv_id, post_id FROM base WHERE {NULL_TEXT}""")
def q_missing_text(spark, d):
    b = fixture(spark, d, "base")
    raw = b.select("conv_id", "post_id", "is_source",
                   F.when(F.expr(NULL_TEXT), F.lit(None).cast("string")).otherwise(F.col("dtext")).alias("text"))
    return NO.missing_text(NO.normalize_posts(raw, "twitter"))


# --- N4-N7, N10, N11: labels -----------------------------------------------------------------
_BEST = duck_with("posts_all", "label_keys") + """,
best AS (
  SELECT post_id, split, label FROM label_keys
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY
    CASE split WHEN 'dev' THEN 0 WHEN 'train' THEN 1 ELSE 2 END, split, label) = 1),
att AS (
  SELECT p.conv_id, p.post_id, p.is_source, b.split, b.label,
         """ + STANCE_CASE.format(c="b.label") + """ AS stance
  FROM posts_all p LEFT JOIN best b ON b.post_id = p.post_id)
"""


def _attached(spark, d):
    posts = fixture(spark, d, "posts_all").select("conv_id", "post_id", "is_source", "text")
    return NO.attach_labels(posts, fixture(spark, d, "label_keys"))


@register("join_attach_labels", _BEST + "SELECT conv_id, post_id, split, label, stance FROM att")
def q_attach(spark, d):
    return _attached(spark, d).select("conv_id", "post_id", "split", "label", "stance")


@register("join_unlabelled_anti", duck_with("posts_all", "label_keys") + """
SELECT conv_id, post_id FROM posts_all p
WHERE NOT EXISTS (SELECT 1 FROM label_keys k WHERE k.post_id = p.post_id)""")
def q_unlabelled(spark, d):
    posts = fixture(spark, d, "posts_all")
    return NO.unlabelled(posts, fixture(spark, d, "label_keys")).select("conv_id", "post_id")


@register("agg_assign_fold", _BEST + """
SELECT conv_id, coalesce(max_by(split, post_id) FILTER (WHERE NOT is_source AND split IS NOT NULL), 'train') AS fold
FROM att GROUP BY conv_id""")
def q_assign_fold(spark, d):
    return NO.assign_fold(_attached(spark, d))


@register("agg_split_trees", _BEST + """
SELECT conv_id, count(DISTINCT split) AS n_splits FROM att WHERE split IS NOT NULL
GROUP BY conv_id HAVING count(DISTINCT split) > 1""")
def q_split_trees(spark, d):
    return NO.split_trees(_attached(spark, d))


NOISY_LABEL = "CASE WHEN length(post_id) % 7 = 3 AND split = 'train' THEN 'maybe' ELSE label END"


@register("proj_encode_label", duck_with("label_keys") + f"""
SELECT post_id, split, label, {STANCE_CASE.format(c='label')} AS stance
FROM (SELECT post_id, split, {NOISY_LABEL} AS label FROM label_keys)""")
def q_encode_label(spark, d):
    k = fixture(spark, d, "label_keys").select("post_id", "split", F.expr(NOISY_LABEL).alias("label"))
    return k.withColumn("stance", TX.encode_label("label"))


@register("agg_unknown_labels", duck_with("label_keys") + f"""
SELECT label, count(*) AS n FROM (SELECT {NOISY_LABEL} AS label FROM label_keys)
WHERE {STANCE_CASE.format(c='label')} IS NULL GROUP BY label""")
def q_unknown_labels(spark, d):
    k = fixture(spark, d, "label_keys").select(F.expr(NOISY_LABEL).alias("label"))
    return NO.unknown_labels(k)


# --- N8 / N9: tree repairs ----------------------------------------------------------------------
def duck_walk(edges: str, name: str) -> str:
    return f""",
{name} AS (
  SELECT conv_id, post_id, [sib_pos] AS ord, [post_id] AS path, 0 AS depth FROM {edges} WHERE parent_id IS NULL
  UNION ALL
  SELECT e.conv_id, e.post_id, list_append(w.ord, e.sib_pos), list_append(w.path, e.post_id), w.depth + 1
  FROM {name} w JOIN {edges} e ON e.conv_id = w.conv_id AND e.parent_id = w.post_id
  WHERE NOT list_contains(w.path, e.post_id))"""


MULTI_ROOT = "CASE WHEN turn = 5 THEN CAST(NULL AS STRING) ELSE parent_id END"


@register("tree_prune_roots", duck_with("base", recursive=True) + f""",
e2 AS (SELECT conv_id, {MULTI_ROOT} AS parent_id, post_id, sib_pos FROM base),
pruned AS (SELECT * FROM e2 WHERE parent_id IS NOT NULL OR post_id = CAST(conv_id AS VARCHAR) || '_0')"""
          + duck_walk("pruned", "pw") + """
SELECT conv_id, post_id, depth FROM pw""")
def q_prune(spark, d):
    b = fixture(spark, d, "base")
    e2 = b.select("conv_id", F.expr(MULTI_ROOT).alias("parent_id"), "post_id", "sib_pos")
    pruned = TR.prune_roots(e2, F.concat(F.col("conv_id").cast("string"), F.lit("_0")))
    return TR.walk(pruned).select("conv_id", "post_id", "depth")


@register("tree_graft", duck_with("base", "edges", recursive=True) + f""",
fixes AS (SELECT conv_id, post_id, CAST(conv_id AS VARCHAR) || '_0' AS new_parent, 0 AS fix_pos
          FROM base WHERE turn = 6),
grafted AS (
  SELECT e.conv_id, coalesce(f.new_parent, e.parent_id) AS parent_id, e.post_id,
         CAST(CASE WHEN f.new_parent IS NOT NULL THEN {TR.GRAFT_BASE} + f.fix_pos ELSE e.sib_pos END AS INT) AS sib_pos
  FROM edges e LEFT JOIN fixes f ON f.conv_id = e.conv_id AND f.post_id = e.post_id)"""
          + duck_walk("grafted", "gw") + """
SELECT conv_id, post_id, array_to_string(ord, ',') AS ord FROM gw""")
def q_graft(spark, d):
    b = fixture(spark, d, "base")
    fixes = b.where("turn = 6").select("conv_id", "post_id",
                                       F.concat(F.col("conv_id").cast("string"), F.lit("_0")).alias("new_parent"),
                                       F.lit(0).alias("fix_pos"))
    g = TR.graft(fixture(spark, d, "edges"), fixes)
    return TR.walk(g).select("conv_id", "post_id", F.array_join("ord", ",").alias("ord"))


# --- M1, M3-M9 on predictions -----------------------------------------------------------------------
@register("agg_class_weights", duck_with("posts_all") + """,
c AS (SELECT stance AS class, count(*) AS n FROM posts_all WHERE stance IS NOT NULL GROUP BY stance),
k AS (SELECT CAST(range AS INT) AS class FROM range(4))
SELECT k.class, coalesce(c.n, 0) AS n,
       round(max(coalesce(c.n, 0)) OVER () / nullif(coalesce(c.n, 0), 0), 6) AS weight
FROM k LEFT JOIN c ON c.class = k.class""")
def q_class_weights(spark, d):
    w = EV.class_weights(fixture(spark, d, "posts_all"), "stance")
    return w.withColumn("weight", r6("weight"))


def _preds(spark, d):
    return fixture(spark, d, "preds").withColumn("z", F.array("z0", "z1", "z2", "z3"))


@register("sc_softmax_argmax", duck_with("preds") + """,
m AS (SELECT *, greatest(z0, z1, z2, z3) AS mx FROM preds),
s AS (SELECT *, exp(z0 - mx) + exp(z1 - mx) + exp(z2 - mx) + exp(z3 - mx) AS den FROM m)
SELECT conv_id, post_id, round(exp(z0 - mx) / den, 6) AS p0, round(exp(z1 - mx) / den, 6) AS p1,
       round(exp(z2 - mx) / den, 6) AS p2, round(exp(z3 - mx) / den, 6) AS p3,
       CAST(CASE WHEN z0 = mx THEN 0 WHEN z1 = mx THEN 1 WHEN z2 = mx THEN 2 ELSE 3 END AS INT) AS argmax
FROM s""")
def q_softmax(spark, d):
    p = _preds(spark, d).withColumn("p", EV.softmax("z"))
    return p.select("conv_id", "post_id", *[r6(F.col("p")[i]).alias(f"p{i}") for i in range(4)],
                    EV.argmax("z").alias("argmax"))


@register("agg_accuracy", duck_with("preds") + """
SELECT fold, count(*) AS n, CAST(sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM preds GROUP BY fold""")
def q_accuracy(spark, d):
    return EV.accuracy(_preds(spark, d), group_cols=["fold"]).withColumn("accuracy", r6("accuracy"))


@register("agg_correct_per_level", duck_with("preds") + """
SELECT substr(branch_id, strpos(branch_id, '.') + 1) AS level, count(*) AS n,
       CAST(sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS rate
FROM preds GROUP BY 1""")
def q_correct_level(spark, d):
    return EV.correct_per_level(_preds(spark, d)).withColumn("rate", r6("rate"))


_PER_CLASS = """,
g AS (SELECT fold, gold AS class, count(*) AS n_gold,
             sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) AS tp FROM preds GROUP BY 1, 2),
p AS (SELECT fold, pred AS class, count(*) AS n_pred FROM preds GROUP BY 1, 2),
pc AS (
  SELECT coalesce(g.fold, p.fold) AS fold, coalesce(g.class, p.class) AS class,
         coalesce(n_gold, 0) AS n_gold, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp
  FROM g FULL OUTER JOIN p ON g.fold = p.fold AND g.class = p.class),
f AS (
  SELECT *, CASE WHEN tp = 0 THEN 0.0 ELSE
      2.0 * (tp / n_pred) * (tp / n_gold) / ((tp / n_pred) + (tp / n_gold)) END AS f1
  FROM pc)
"""


@register("agg_f1_macro", duck_with("preds") + _PER_CLASS + """
SELECT fold, round(avg(f1), 6) AS f1_macro FROM f GROUP BY fold""")
def q_f1_macro(spark, d):
    return EV.f1(_preds(spark, d), "macro", group_cols=["fold"]).withColumn("f1_macro", r6("f1_macro"))


@register("agg_f1_weighted", duck_with("preds") + _PER_CLASS + """
SELECT fold, round(sum(f1 * n_gold) / sum(n_gold), 6) AS f1_weighted FROM f GROUP BY fold""")
def q_f1_weighted(spark, d):
    return EV.f1(_preds(spark, d), "weighted", group_cols=["fold"]).withColumn("f1_weighted", r6("f1_weighted"))


@register("agg_weighted_loss", duck_with("preds") + """,
c AS (SELECT gold AS class, count(*) AS n FROM preds GROUP BY gold),
w AS (SELECT class, max(n) OVER () / n AS weight FROM c),
x AS (
  SELECT p.fold, w.weight,
    greatest(z0, z1, z2, z3) + ln(exp(z0 - greatest(z0, z1, z2, z3)) + exp(z1 - greatest(z0, z1, z2, z3))
      + exp(z2 - greatest(z0, z1, z2, z3)) + exp(z3 - greatest(z0, z1, z2, z3)))
    - CASE p.gold WHEN 0 THEN z0 WHEN 1 THEN z1 WHEN 2 THEN z2 ELSE z3 END AS nll
  FROM preds p JOIN w ON w.class = p.gold)
SELECT fold, round(sum(weight * nll) / sum(weight), 6) AS loss FROM x GROUP BY fold""")
def q_weighted_loss(spark, d):
    p = _preds(spark, d)
    w = EV.class_weights(p, "gold")
    return EV.weighted_log_loss(p, w, group_cols=["fold"]).withColumn("loss", r6("loss"))


@register("agg_confusion", duck_with("preds") + """
SELECT gold, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1,
       count(*) FILTER (WHERE pred = 2) AS pred_2, count(*) FILTER (WHERE pred = 3) AS pred_3
FROM preds GROUP BY gold""")
def q_confusion(spark, d):
    return EV.confusion(_preds(spark, d))


@register("agg_accuracy_documents", duck_with("docs_eval") + """
SELECT count(*) AS n, CAST(sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM docs_eval""")
def q_accuracy_docs(spark, d):
    return EV.accuracy(fixture(spark, d, "docs_eval")).withColumn("accuracy", r6("accuracy"))


# --- M10-M12 on epoch metrics ----------------------------------------------------------------------------
_RUNNING = duck_with("metrics") + """,
dev AS (SELECT * FROM metrics WHERE split = 'dev'),
rb0 AS (
  SELECT *, min(loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best
  FROM dev),
rb AS (
  SELECT run, epoch, loss,
    min(loss) OVER w AS best_loss, max(accuracy) OVER w AS best_accuracy, max(f1_macro) OVER w AS best_f1,
    max(CASE WHEN prev_best IS NULL OR loss < prev_best THEN epoch END) OVER w AS best_epoch
  FROM rb0 WINDOW w AS (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@register("win_running_best", _RUNNING + "SELECT * FROM rb")
def q_running_best(spark, d):
    return EV.running_best(fixture(spark, d, "metrics"))


@register("win_early_stop", _RUNNING + """,
st AS (SELECT run, min(epoch) FILTER (WHERE loss > best_loss AND epoch > best_epoch + 4) AS stop_epoch,
              max(epoch) AS last_epoch FROM rb GROUP BY run)
SELECT rb.run, st.stop_epoch, rb.best_epoch, rb.best_loss
FROM rb JOIN st ON st.run = rb.run WHERE rb.epoch = coalesce(st.stop_epoch, st.last_epoch)""")
def q_early_stop(spark, d):
    return EV.early_stop(fixture(spark, d, "metrics"), patience=4)


@register("agg_learning_curves", duck_with("metrics") + """
SELECT run, epoch, split, metric, value FROM metrics
UNPIVOT (value FOR metric IN (loss, accuracy, f1_macro, f1_weighted))""")
def q_learning_curves(spark, d):
    return EV.learning_curves(fixture(spark, d, "metrics"))


# --- A1-A4, A6 --------------------------------------------------------------------------------------------
@register("agg_branch_profile", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT count(*) AS n_occurrences, count(DISTINCT b.post_id) AS n_posts,
       CAST(sum(CASE WHEN p.is_source THEN 1 ELSE 0 END) AS BIGINT) AS n_source_occurrences
FROM present_bp b JOIN posts p ON p.conv_id = b.conv_id AND p.post_id = b.post_id""")
def q_branch_profile(spark, d):
    posts, pb = _present_branches(spark, d)
    rows = pb.join(posts.select("conv_id", "post_id", F.col("is_source").cast("int").alias("issource")),
                   ["conv_id", "post_id"])
    return PR.branch_profile(rows)


@register("agg_branch_profile_sketch", duck_with("posts", "edges", recursive=True) + DUCK_TREE + """
SELECT p.fold, count(*) AS n_occurrences, CAST(sum(CASE WHEN p.is_source THEN 1 ELSE 0 END) AS BIGINT) AS n_source_occurrences, TRUE AS near
FROM present_bp b JOIN posts p ON p.conv_id = b.conv_id AND p.post_id = b.post_id GROUP BY p.fold""")
def q_branch_profile_sketch(spark, d):
    """A1 by stored sketches: a profile per fold and folder (conv_id % 3),
    written, merged to folds; ``near``: the estimate is within 3 % of the count."""
    posts, pb = _present_branches(spark, d)
    rows = pb.join(posts.select("conv_id", "post_id", "fold", F.col("is_source").cast("int").alias("issource")), ["conv_id", "post_id"])
    rows = materialize(rows.withColumn("folder", F.col("conv_id") % 3), "branch-rows")
    stored = materialize(PR.profile_sketches(rows, ["fold", "folder"]), "profiles")
    merged = PR.profile_estimates(PR.merge_profiles(stored, ["fold"]))
    exact = rows.groupBy("fold").agg(F.countDistinct("post_id").alias("exact"))
    return merged.join(exact, "fold").select("fold", "n_occurrences", "n_source_occurrences", (F.abs(F.col("n_posts") - F.col("exact")) <= 0.03 * F.col("exact")).alias("near"))


@register("agg_class_balance", DUCK_EXAMPLES_WITH + """,
c AS (SELECT stance_label AS class, count(*) AS n, CAST(sum(issource) AS BIGINT) AS n_source
      FROM examples WHERE stance_label IS NOT NULL GROUP BY 1),
k AS (SELECT CAST(range AS INT) AS class FROM range(4))
SELECT k.class, coalesce(c.n, 0) AS n, coalesce(c.n_source, 0) AS n_source
FROM k LEFT JOIN c ON c.class = k.class""")
def q_class_balance(spark, d):
    return PR.class_balance(examples_df(spark, d))


@register("agg_label_histogram", duck_with("label_keys") + """
SELECT label, count(*) AS n FROM label_keys GROUP BY label""")
def q_label_histogram(spark, d):
    return PR.label_histogram(fixture(spark, d, "label_keys"))


@register("win_normalized_balance", duck_with("label_keys") + """
SELECT label, n, round(100.0 * n / sum(n) OVER (), 6) AS pct
FROM (SELECT label, count(*) AS n FROM label_keys GROUP BY label)""")
def q_normalized(spark, d):
    h = PR.label_histogram(fixture(spark, d, "label_keys"))
    return PR.normalized(h).withColumn("pct", r6("pct"))


@register("agg_fold_sizes", DUCK_EXAMPLES_WITH + """
SELECT fold, count(*) AS n FROM examples GROUP BY fold""")
def q_fold_sizes(spark, d):
    return PR.fold_sizes(examples_df(spark, d))


# --- E1-E9 ------------------------------------------------------------------------------------------------------
@register("proj_triple_text", DUCK_EXAMPLES_WITH + """
SELECT fold, id, raw_text_src || chr(10) || '-----------' || chr(10) || raw_text_prev || chr(10)
       || '-----------' || chr(10) || raw_text AS triple FROM examples""")
def q_triple(spark, d):
    e = examples_df(spark, d)
    return e.select("fold", "id", TX.triple_text("raw_text_src", "raw_text_prev", "raw_text").alias("triple"))


VOCAB_SIZE = L.DEFAULT_VOCAB_SIZE
DUCK_TOKS = "list_filter(string_split_regex(coalesce({c}, ''), '[ \\n]+'), lambda x: x <> '')"
DUCK_VOCAB = f""",
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + 4 AS INT) AS token_id, n FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest({DUCK_TOKS.format(c='clean_text')}) AS token FROM examples)
    GROUP BY token ORDER BY n DESC, token LIMIT {VOCAB_SIZE}))"""


def _vocab(spark, d):
    e = examples_df(spark, d)
    return e, EN.build_vocab(e, ["clean_text"], VOCAB_SIZE)


@register("agg_vocab_topk", DUCK_EXAMPLES_WITH + DUCK_VOCAB + "\nSELECT token, token_id, n FROM vocab")
def q_vocab(spark, d):
    return _vocab(spark, d)[1]


TOP = 300


@register("agg_vocab_sketch", f"""
SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + 4 AS INT) AS token_id, n FROM (
  SELECT token, count(*) AS n FROM (
    SELECT unnest({DUCK_TOKS.format(c='text')}) AS token FROM documents UNION ALL SELECT unnest({DUCK_TOKS.format(c='html')}) FROM pages)
  GROUP BY token ORDER BY n DESC, token LIMIT {TOP})""")
def q_vocab_sketch(spark, d):
    """E2 by the sketch of frequent tokens, over whole documents and pages:
    the cut is far above the rare tokens, which are never shuffled."""
    texts = table(spark, d, "documents").select("text").unionByName(table(spark, d, "pages").select(F.col("html").alias("text")))
    return EN.build_vocab(texts, ["text"], TOP, sketch=True)


def duck_encoded(max_length: int) -> str:
    budget = max_length - 3
    half = budget // 2
    tok = " UNION ALL ".join(
        f"SELECT fold, id, '{w}' AS which, unnest(t) AS token, generate_subscripts(t, 1) AS k "
        f"FROM (SELECT fold, id, {DUCK_TOKS.format(c=c)} AS t FROM examples)"
        for w, c in (("t", "clean_text"), ("p", "clean_text_prev"), ("s", "clean_text_src")))
    return DUCK_EXAMPLES_WITH + DUCK_VOCAB + f""",
tok AS ({tok}),
enc AS (SELECT fold, id, which, list(coalesce(v.token_id, 1) ORDER BY k) AS ids
        FROM tok LEFT JOIN vocab v ON v.token = tok.token GROUP BY fold, id, which),
seq AS (
  SELECT e.fold, e.id, e.hasqmark, e.hasemark, e.hashashtag, e.hasurl, e.haspic, e.hasnegation,
         e.hasswearwords, e.src_rumour, e.thread_rumour,
         list_concat(coalesce(s.ids, CAST([] AS INTEGER[])), coalesce(p.ids, CAST([] AS INTEGER[]))) AS a,
         coalesce(t.ids, CAST([] AS INTEGER[])) AS b
  FROM examples e
  LEFT JOIN enc t ON t.fold = e.fold AND t.id = e.id AND t.which = 't'
  LEFT JOIN enc p ON p.fold = e.fold AND p.id = e.id AND p.which = 'p'
  LEFT JOIN enc s ON s.fold = e.fold AND s.id = e.id AND s.which = 's'),
tr1 AS (SELECT * REPLACE (CASE WHEN len(a) + len(b) + 3 > {budget} THEN a[1:{half}] ELSE a END AS a) FROM seq),
tr2 AS (SELECT * REPLACE (CASE WHEN len(a) + len(b) + 3 > {budget} THEN b[1:{half}] ELSE b END AS b) FROM tr1),
enc_ex AS (
  SELECT *, list_concat([2], a, [3], b, [3]) AS text,
         list_concat(list_transform(range(len(a) + 2), lambda x: 0), list_transform(range(len(b) + 1), lambda x: 1))
           AS type_mask,
         list_transform(range(len(a) + len(b) + 3), lambda x: 1) AS input_mask
  FROM tr2)"""


def _encoded(spark, d, max_length):
    e, v = _vocab(spark, d)
    return EN.encode_examples(e, v, max_length)


@register("join_encode_tokens", DUCK_EXAMPLES_WITH + DUCK_VOCAB + f""",
tok AS (SELECT fold, id, unnest(t) AS token, generate_subscripts(t, 1) AS k
        FROM (SELECT fold, id, {DUCK_TOKS.format(c='clean_text')} AS t FROM examples)),
enc AS (SELECT fold, id, list(coalesce(v.token_id, 1) ORDER BY k) AS ids
        FROM tok LEFT JOIN vocab v ON v.token = tok.token GROUP BY fold, id)
SELECT e.fold, e.id, coalesce(array_to_string(enc.ids, ','), '') AS ids
FROM examples e LEFT JOIN enc ON enc.fold = e.fold AND enc.id = e.id""")
def q_encode(spark, d):
    e, v = _vocab(spark, d)
    return EN.encode(e, ["fold", "id"], "clean_text", v, "ids").select("fold", "id", ints_str("ids").alias("ids"))


@register("seq_segments", duck_encoded(100000) + """
SELECT fold, id, array_to_string(text, ',') AS text FROM enc_ex""")
def q_segments(spark, d):
    return _encoded(spark, d, 100000).select("fold", "id", ints_str("text").alias("text"))


TRUNC = 24


@register("seq_truncate", duck_encoded(TRUNC) + """
SELECT fold, id, len(a) AS len_a, len(b) AS len_b, len(text) AS n_ids FROM enc_ex""")
def q_truncate(spark, d):
    e, v = _vocab(spark, d)
    x = EN.encode_texts(e, ["fold", "id"], {"b": "clean_text", "_p": "clean_text_prev", "_s": "clean_text_src"}, v)
    x = x.withColumn("a", F.concat("_s", "_p"))
    x = EN.truncate(x, "a", "b", TRUNC)
    return x.select("fold", "id", F.size("a").alias("len_a"), F.size("b").alias("len_b"),
                    F.size(EN.segments("a", "b")).alias("n_ids"))


@register("seq_masks", duck_encoded(TRUNC) + """
SELECT fold, id, array_to_string(type_mask, ',') AS type_mask, array_to_string(input_mask, ',') AS input_mask
FROM enc_ex""")
def q_masks(spark, d):
    x = _encoded(spark, d, TRUNC)
    return x.select("fold", "id", ints_str("type_mask").alias("type_mask"), ints_str("input_mask").alias("input_mask"))


BATCH, TRUE_BATCH = 2, 8
_BATCHES = f""",
bb AS (SELECT *, len(text) AS seq_len,
              (row_number() OVER (PARTITION BY fold ORDER BY len(text) DESC, id) - 1) // {BATCH} AS batch_no
       FROM enc_ex)"""


def _batches(spark, d):
    return BA.bucket_batches(_encoded(spark, d, TRUNC), BATCH)


@register("win_bucket_batches", duck_encoded(TRUNC) + _BATCHES + """
SELECT fold, id, seq_len, batch_no FROM bb""")
def q_batches(spark, d):
    return _batches(spark, d).select("fold", "id", "seq_len", "batch_no")


@register("win_pad_batch", duck_encoded(TRUNC) + _BATCHES + """
SELECT fold, id, batch_no, batch_len,
       array_to_string(list_concat(text, list_transform(range(batch_len - len(text)), lambda x: 0)), ',') AS text
FROM (SELECT *, max(seq_len) OVER (PARTITION BY fold, batch_no) AS batch_len FROM bb)""")
def q_pad(spark, d):
    p = BA.pad_batch(_batches(spark, d))
    return p.select("fold", "id", "batch_no", "batch_len", ints_str("text").alias("text"))


@register("proj_update_group", duck_encoded(TRUNC) + _BATCHES + f"""
SELECT fold, id, batch_no, batch_no // {TRUE_BATCH // BATCH} AS update_group FROM bb""")
def q_update_group(spark, d):
    b = _batches(spark, d)
    return b.select("fold", "id", "batch_no", BA.update_group("batch_no", BATCH, TRUE_BATCH).alias("update_group"))


@register("proj_model_features", DUCK_EXAMPLES_WITH + """
SELECT fold, id, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in EN.MODEL_FEATURES) + """
FROM examples""")
def q_model_features(spark, d):
    e = EN.select_features(examples_df(spark, d))
    return e.select("fold", "id", *EN.MODEL_FEATURES)


# --- M2: MLlib classifier (rows-only check) -------------------------------------------------------------
@register("ml_fit_predict")
def q_fit_predict(spark, d):
    from threadlens.operators.model import fit_stance, predict
    # the fit scans its input many times: cut the lineage once (reliable
    # checkpoint in the shared spark.checkpoint.dir)
    e = examples_df(spark, d)
    model = fit_stance(e.where(F.col("fold") == "train"), with_features=True, max_iter=10, num_features=1 << 14)
    return predict(model, e).select("fold", "id", "stance_label", "pred")


def _fitted(spark, d):
    from threadlens.operators.model import fit_stance, predict
    e = examples_df(spark, d)
    model = fit_stance(e.where(F.col("fold") == "train"), with_features=True, max_iter=10, num_features=1 << 14)
    return predict(model, e)


@register("ml_fit_check", DUCK_EXAMPLES_WITH + """
SELECT fold, count(*) AS n_examples, count(*) AS n_predicted, 0 AS n_outside, TRUE AS beats_majority
FROM examples GROUP BY fold""")
def q_fit_check(spark, d):
    """M2, what must hold for any solver: one prediction an example, within
    the classes, and on the training fold better than the largest class."""
    p = _fitted(spark, d).select("fold", "id", "stance_label", "pred")
    lab = p.where(F.col("stance_label").isNotNull() & (F.col("fold") == "train"))
    biggest = lab.groupBy("stance_label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m"))
    right = lab.agg(F.sum((F.col("pred") == F.col("stance_label")).cast("long")).alias("r"))
    beats = right.crossJoin(biggest).select((F.col("r") > F.col("m")).alias("beats_majority"))  # one row
    per = p.groupBy("fold").agg(F.count(F.lit(1)).alias("n_examples"), F.countDistinct(F.when(F.col("pred").isNotNull(), F.col("id"))).alias("n_predicted"),
                                F.sum((~F.col("pred").between(0, 3)).cast("int")).cast("int").alias("n_outside"))
    return per.crossJoin(beats)


@register("ml_learning_curve")
def q_learning_curve(spark, d):
    """M2 + M4/M6-M8 per epoch and split, then M11 on it: the training loop's
    table (rows-only check: solver output is not SQL)."""
    from threadlens.operators.model import learning_curve
    curve = learning_curve(examples_df(spark, d), epochs=3, patience=4)
    return curve.select("run", "epoch", "split", r6("loss").alias("loss"), r6("accuracy").alias("accuracy"),
                        r6("f1_macro").alias("f1_macro"), r6("f1_weighted").alias("f1_weighted"))


@register("ml_epochs_check", DUCK_EXAMPLES_WITH + """
SELECT fold AS split, 6 AS n_epochs, TRUE AS in_range, CASE WHEN fold = 'train' THEN TRUE END AS loss_falls FROM examples WHERE stance_label IS NOT NULL GROUP BY fold""")
def q_epochs_check(spark, d):
    """M2 with carried weights, what must hold for any data: every epoch is
    measured on every split, and the training loss falls from the first to the last."""
    from threadlens.operators.epochs import fit_epochs
    c = fit_epochs(examples_df(spark, d), epochs=6, with_features=True).curve(spark)
    falls = F.max_by("loss", "epoch") < F.min_by("loss", "epoch")
    ok = F.min(F.col("accuracy").between(0, 1) & F.col("f1_macro").between(0, 1) & F.col("f1_weighted").between(0, 1) & (F.col("loss") >= 0))
    return c.groupBy("split").agg(F.countDistinct("epoch").cast("int").alias("n_epochs"), ok.alias("in_range"), falls.alias("f")) \
        .select("split", "n_epochs", "in_range", F.when(F.col("split") == "train", F.col("f")).alias("loss_falls"))


__all__ = ["duck_ints_str"]
