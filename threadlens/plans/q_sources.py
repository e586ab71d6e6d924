"""Queries for the sources and sinks (S1-S11, T1 on files, A5).

Each query first writes, from the fixture tables and with executors doing
the writing, the on-disk layout the reader expects (key documents, one JSON
file per post, structure.json, lexicon lines, example sets) into a fresh
folder below the shared ``spark.checkpoint.dir``, then reads it back with
the library's scanners.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.operators import normalize as NO
from threadlens.operators import profile as PR
from threadlens.plans import duck as D
from threadlens.plans.fixtures import duck_with, fixture, table
from threadlens.plans.q_eval import _REDDIT_ORACLE, DELETED, STANCE_CASE, reddit_raw
from threadlens.plans import prepare as PREP
from threadlens.plans.q_threads import (DUCK_EXAMPLES, DUCK_EXAMPLES_TABLE, DUCK_EXAMPLES_WITH, DUCK_TREE,
                                        EXAMPLE_COLS, duck_ints_str, examples_df, ints_str)
from threadlens.plans.registry import register
from threadlens.session import shared_dir
from threadlens.sources import examples_io as IO
from threadlens.sources import key_ranges as KR
from threadlens.sources import labels as LB
from threadlens.sources import layout as LY
from threadlens.sources import listing
from threadlens.sources import threads as TH
from threadlens.sources.lexicon import read_lexicon, strip_ws

SPLITS = ["train", "dev", "test"]


def _conv_of(post_id):
    return F.substring_index(F.col(post_id), "_", 1)


# --- S1 / S11 / A5 --------------------------------------------------------------------------
def _write_keys(spark, keys, name):
    """One NDJSON key folder per split; a document per conversation."""
    root = shared_dir(spark, name)
    paths = {}
    for s in SPLITS:
        docs = LB.label_documents(keys.where(F.col("split") == s), _conv_of("post_id"))
        docs.write.text(f"{root}/{s}")
        paths[s] = f"{root}/{s}"
    return paths


@register("src_label_keys", duck_with("label_keys") + "SELECT post_id, split, label FROM label_keys")
def q_label_keys(spark, d):
    paths = _write_keys(spark, fixture(spark, d, "label_keys"), "keys")
    return LB.read_label_keys(spark, paths, whole_file=False)


@register("src_label_keys_ranges", duck_with("label_keys") + "SELECT post_id, split, label FROM label_keys")
def q_label_keys_ranges(spark, d):
    """S1 by byte ranges: a few documents a split, each read by many tasks."""
    keys = fixture(spark, d, "label_keys")
    out = None
    for s in SPLITS:
        root = shared_dir(spark, "key-documents")
        part = F.pmod(F.xxhash64("post_id"), F.lit(4)).cast("string")
        docs = LB.label_documents(keys.where(F.col("split") == s).withColumn("part", part), F.col("part"))
        LY.write_files(docs.select(F.concat_ws("/", F.lit(root), F.concat(F.md5("value"), F.lit(".json"))).alias("path"), F.col("value").alias("content")))
        files = listing.children(spark.createDataFrame([(root,)], "path string"))
        rows = KR.key_rows(files.select("path", "size"), s, range_bytes=512)
        out = rows if out is None else out.unionByName(rows)
    return out


def _answers(spark, d):
    p = fixture(spark, d, "preds")
    names = {0: "support", 1: "comment", 2: "deny", 3: "query"}
    label = F.element_at(F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))]), F.col("pred"))
    root = shared_dir(spark, "answers")
    LB.label_documents(p.select("post_id", label.alias("label")), _conv_of("post_id")).write.text(root)
    return LB.read_answers(spark, root, whole_file=False)


_ANSWERS_ORACLE = duck_with("preds") + """,
ans AS (SELECT post_id, CASE pred WHEN 0 THEN 'support' WHEN 1 THEN 'comment' WHEN 2 THEN 'deny'
                                  ELSE 'query' END AS label FROM preds)
"""


@register("src_answers", _ANSWERS_ORACLE + "SELECT post_id, label FROM ans")
def q_answers(spark, d):
    return _answers(spark, d)


@register("agg_answer_balance", _ANSWERS_ORACLE + """,
c AS (SELECT """ + STANCE_CASE.format(c="label") + """ AS class, count(*) AS n FROM ans GROUP BY 1),
k AS (SELECT CAST(range AS INT) AS class FROM range(4))
SELECT k.class, coalesce(c.n, 0) AS n, coalesce(c.n, 0) * 0 AS n_source FROM k LEFT JOIN c ON c.class = k.class""")
def q_answer_balance(spark, d):
    a = _answers(spark, d).select(TX.encode_label("label").alias("stance_label"), F.lit(0).alias("issource"))
    return PR.class_balance(a)


# --- S2 / S6 / T1: Twitter layout -----------------------------------------------------------------
def _twitter_root(spark, d, missing: bool = False, only: str = "true"):
    """The Twitter layout of the thread fixture; with ``missing`` the posts
    the fixture marks missing have no file (their ids stay in structure.json)."""
    b = fixture(spark, d, "base").where(only)
    if missing:
        b = b.where(~F.col("missing"))
    root = shared_dir(spark, "twitter")
    topic = F.concat(F.lit("topic"), (F.col("conv_id") % 3).cast("string"))
    folder = F.concat(F.col("conv_id").cast("string"), F.lit("_0"))
    role = F.when(F.col("is_source"), F.lit("source-tweet")).otherwise(F.lit("replies"))
    posts = b.select(
        F.concat_ws("/", F.lit(root), topic, folder, role, F.concat(F.col("post_id"), F.lit(".json"))).alias("path"),
        F.to_json(F.struct(F.col("post_id").alias("id_str"), F.col("turn").alias("id"),
                           F.col("dtext").alias("text"))).alias("content"))
    docs = LY.tree_documents(fixture(spark, d, "edges").where(only))
    structs = docs.select(
        F.concat_ws("/", F.lit(root), topic, folder, F.lit("structure.json")).alias("path"),
        # an older tree on the first line: only the last line counts
        F.concat(F.lit('{"stale": []}\n'), F.col("value"), F.lit("\n")).alias("content"))
    LY.write_files(posts.unionByName(structs))
    return root


@register("src_twitter_posts", duck_with("base") + """
SELECT 'twitter' AS platform, 'topic' || CAST(conv_id % 3 AS VARCHAR) AS topic,
       CAST(conv_id AS VARCHAR) || '_0' AS conv_id, post_id, is_source, dtext AS text FROM base""")
def q_twitter(spark, d):
    root = _twitter_root(spark, d)
    return TH.scan_twitter(spark, root).drop("file_path", "line_no")


@register("tree_json_edges", duck_with("base") + """
SELECT CAST(conv_id AS VARCHAR) || '_0' AS conv_id, parent_id, post_id,
       CAST(row_number() OVER (PARTITION BY conv_id, parent_id ORDER BY turn) - 1 AS INT) AS sib_pos
FROM base""")
def q_tree_json(spark, d):
    root = _twitter_root(spark, d)
    return TH.scan_edges(spark, root, "twitter")


# --- S3 / S5: Reddit layout --------------------------------------------------------------------------
STRAY = "conv_id % 9 = 0"


def _reddit_root(spark, d, stray: bool = False, only: str = "true", trees: bool = False):
    raw = reddit_raw(spark, d).where(only)
    root = shared_dir(spark, "reddit")
    folder = F.concat(F.col("conv_id").cast("string"), F.lit("_0"))
    role = F.when(F.col("is_source"), F.lit("source-tweet")).otherwise(F.lit("replies"))
    files = raw.select(
        F.concat_ws("/", F.lit(root), folder, role, F.concat(F.col("post_id"), F.lit(".json"))).alias("path"),
        F.to_json(F.struct("data")).alias("content"))
    if stray:
        b = fixture(spark, d, "base").where(F.expr(STRAY) & (F.col("turn") == 0))
        # no post by its name, a post whose name begins with "_", a hidden file and a hidden folder
        for name in ("replies/notes.txt", "replies/_draft.json", "replies/.hidden.json", ".old/replies/1.json"):
            files = files.unionByName(b.select(F.concat_ws("/", F.lit(root), folder, F.lit(name)).alias("path"), F.lit("not a post").alias("content")))
    if trees:
        docs = LY.tree_documents(fixture(spark, d, "edges").where(only))
        files = files.unionByName(docs.select(F.concat_ws("/", F.lit(root), folder, F.lit("structure.json")).alias("path"), F.col("value").alias("content")))
    LY.write_files(files)
    return root


@register("src_reddit_posts", _REDDIT_ORACLE.replace(
    "SELECT conv_id, post_id,", "SELECT CAST(conv_id AS VARCHAR) || '_0' AS conv_id, post_id,"))
def q_reddit(spark, d):
    root = _reddit_root(spark, d)
    return NO.normalize_posts(TH.scan_reddit_raw(spark, root), "reddit").select(
        "conv_id", "post_id", "is_source", "text", "user")


@register("src_id_from_path", duck_with("base") + f"""
SELECT CAST(conv_id AS VARCHAR) || '_0' AS conv_id, post_id || '.json' AS file_name, TRUE AS is_json, post_id
FROM base
UNION ALL
SELECT CAST(conv_id AS VARCHAR) || '_0', 'notes.txt', FALSE, CAST(NULL AS VARCHAR) FROM base
WHERE {STRAY} AND turn = 0
UNION ALL
SELECT CAST(conv_id AS VARCHAR) || '_0', '_draft.json', TRUE, '_draft' FROM base
WHERE {STRAY} AND turn = 0""")
def q_id_from_path(spark, d):
    root = _reddit_root(spark, d, stray=True)
    return TH.list_post_files(spark, root, depth=1)


@register("set_union_platforms", duck_with("base") + f"""
SELECT 'twitter' AS platform, CAST(conv_id AS VARCHAR) || '_0' AS conv_id, post_id, is_source, dtext AS text,
       CAST(NULL AS VARCHAR) AS user FROM base
UNION ALL
SELECT 'reddit', CAST(conv_id AS VARCHAR) || '_0', post_id, is_source,
  CASE WHEN {'turn > 0 AND (conv_id + turn) % 5 = 4'} THEN '' ELSE dtext END,
  CASE WHEN {'turn > 0 AND (conv_id + turn) % 5 = 4'} THEN '' ELSE role || '_' || CAST(conv_id AS VARCHAR) END
FROM base""")
def q_union(spark, d):
    tw = NO.normalize_posts(TH.scan_twitter(spark, _twitter_root(spark, d)), "twitter")
    rd = NO.normalize_posts(TH.scan_reddit_raw(spark, _reddit_root(spark, d)), "reddit")
    u = NO.union_platforms(tw, rd)
    return u.select("platform", "conv_id", "post_id", "is_source", "text", "user")


# --- S8 / S9: example sets ----------------------------------------------------------------------------
def _written_examples(spark, d):
    root = shared_dir(spark, "examples")
    IO.write_examples(examples_df(spark, d), root)
    return root


_EX_SELECT = "SELECT " + EXAMPLE_COLS.replace(" ner,", " " + duck_ints_str("ner") + " AS ner,") + " FROM examples"


@register("sink_roundtrip", DUCK_EXAMPLES_WITH + "\n" + _EX_SELECT)
def q_sink(spark, d):
    back = IO.read_examples(spark, _written_examples(spark, d))
    return back.select(*[c.strip() for c in EXAMPLE_COLS.split(",")]).withColumn("ner", ints_str("ner"))


CAP = 50


@register("limit_examples", DUCK_EXAMPLES_WITH + "\n" + _EX_SELECT + f" WHERE id < {CAP}")
def q_limit(spark, d):
    back = IO.read_examples(spark, _written_examples(spark, d), max_examples=CAP)
    return back.select(*[c.strip() for c in EXAMPLE_COLS.split(",")]).withColumn("ner", ints_str("ner"))


# --- S10: lexicon file ----------------------------------------------------------------------------------
@register("src_lexicon", f"""
SELECT DISTINCT lower(regexp_replace(line, {D.q('^' + TX.WS + '|' + TX.WS + '$')}, '', 'g')) AS word
FROM (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM benchmark)""")
def q_lexicon(spark, d):
    b = table(spark, d, "benchmark")
    root = shared_dir(spark, "lexicon")
    b.select(F.explode(F.split(F.regexp_replace("text", "\r", " "), "\n")).alias("value")).write.text(root)
    return read_lexicon(spark, root)


# --- end to end: folders + key files -> example sets -------------------------------------------
# Twitter folders (posts missing), a Reddit folder with a given fold, and a Twitter test folder; the
# three hold different conversations, but all number them alike.
IN_TWITTER, IN_REDDIT, IN_TEST = "conv_id % 4 < 2", "conv_id % 4 = 2", "conv_id % 4 = 3"
_FOLDERS_ORACLE = duck_with("base", "label_keys", recursive=True) + """,
best AS (
  SELECT post_id, split, label FROM label_keys
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY
    CASE split WHEN 'dev' THEN 0 WHEN 'train' THEN 1 ELSE 2 END, split, label) = 1),
src AS (
  SELECT *, 0 AS folder, 0 AS platform_rank, 'topic' || CAST(conv_id % 3 AS VARCHAR) AS topic, dtext AS ptext FROM base WHERE """ + IN_TWITTER + """ AND NOT missing
  UNION ALL
  SELECT *, 1, 1, '', CASE WHEN """ + DELETED + """ THEN '' ELSE dtext END FROM base WHERE """ + IN_REDDIT + """
  UNION ALL
  SELECT *, 2, 0, 'topic' || CAST(conv_id % 3 AS VARCHAR), dtext FROM base WHERE """ + IN_TEST + """ AND NOT missing),
pa AS (
  SELECT [CAST(platform_rank AS VARCHAR), topic, CAST(b.conv_id AS VARCHAR) || '_0', CAST(folder AS VARCHAR)] AS conv_id, folder,
         b.post_id, b.is_source, b.ptext AS text, """ + STANCE_CASE.format(c="bl.label") + """ AS stance, bl.split
  FROM src b LEFT JOIN best bl ON bl.post_id = b.post_id),
cf AS (
  SELECT conv_id, CASE min(folder) WHEN 1 THEN 'dev' WHEN 2 THEN 'test' ELSE
           coalesce(max_by(split, post_id || '.json') FILTER (WHERE NOT is_source AND split IS NOT NULL), 'train') END AS fold
  FROM pa GROUP BY conv_id),
posts AS (SELECT pa.*, cf.fold FROM pa JOIN cf ON cf.conv_id = pa.conv_id),
edges AS (SELECT k.conv_id, parent_id, post_id, sib_pos FROM base JOIN
            (SELECT DISTINCT conv_id, conv_id[3] AS name FROM pa) k ON k.name = CAST(base.conv_id AS VARCHAR) || '_0'),
""" + D.features_cte("posts") + DUCK_TREE + DUCK_EXAMPLES + DUCK_EXAMPLES_TABLE + "\n" + _EX_SELECT


# a repair that puts the first reply below its own first reply: a circle that no root leads to
CIRCLE = "conv_id % 8 = 0"


def _prepared(spark, d, fixes=None):
    folders = [PREP.ThreadFolder(_twitter_root(spark, d, missing=True, only=IN_TWITTER), "twitter"),
               PREP.ThreadFolder(_reddit_root(spark, d, only=IN_REDDIT, trees=True), "reddit", fold="dev"),
               PREP.ThreadFolder(_twitter_root(spark, d, missing=True, only=IN_TEST), "twitter", fold="test")]
    keys = LB.read_label_keys(spark, _write_keys(spark, fixture(spark, d, "label_keys"), "keys"), whole_file=False)
    return PREP.prepare(spark, folders, keys, L.FIXTURE_SWEAR_LEXICON, fixes=fixes)


@register("examples_from_folders", _FOLDERS_ORACLE)
def q_from_folders(spark, d):
    """The whole preparation step from files: thread folders of both platforms
    and a test folder, key documents -> labels with priority, folds, pruned
    trees, examples."""
    return _prepared(spark, d).examples.select(*[c.strip() for c in EXAMPLE_COLS.split(",")]).withColumn("ner", ints_str("ner"))


@register("reports_from_folders", duck_with("base", "label_keys", recursive=True) + f""",
below AS (
  SELECT a.conv_id, a.post_id FROM base a JOIN base b ON b.conv_id = a.conv_id AND b.turn = 3 WHERE a.turn = 1 AND a.{CIRCLE}
  UNION ALL
  SELECT e.conv_id, e.post_id FROM below w JOIN base e ON e.conv_id = w.conv_id AND e.parent_id = w.post_id),
src AS (SELECT *, CAST(conv_id % 4 AS INT) AS part FROM base WHERE {IN_REDDIT} OR NOT missing)
SELECT 'unlabelled' AS report, count(*) AS n FROM src WHERE post_id NOT IN (SELECT post_id FROM label_keys)
UNION ALL SELECT 'missing_text', 0
UNION ALL SELECT 'unknown_labels', 0
UNION ALL SELECT 'corrupt_lines', 0
UNION ALL SELECT 'unreachable', count(*) FROM below
UNION ALL SELECT 'split_trees', count(*) FROM (
  SELECT conv_id FROM (
    SELECT s.conv_id, coalesce(max(CASE WHEN k.split = 'dev' THEN 'dev' END), max(CASE WHEN k.split = 'train' THEN 'train' END), min(k.split)) AS split
    FROM src s JOIN label_keys k ON k.post_id = s.post_id WHERE {IN_TWITTER} GROUP BY s.conv_id, s.post_id)
  GROUP BY conv_id HAVING count(DISTINCT split) > 1)""")
def q_reports(spark, d):
    """What the preparation reports while it loads, counted."""
    b = fixture(spark, d, "base").where(f"turn = 3 and {CIRCLE}")
    fixes = b.select(F.concat(F.col("conv_id").cast("string"), F.lit("_0")).alias("conv_id"), F.col("parent_id").alias("post_id"), F.col("post_id").alias("new_parent"), F.lit(0).alias("fix_pos"))
    out = None
    for name, df in _prepared(spark, d, fixes).reports.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")
        out = row if out is None else out.unionByName(row)
    return out
