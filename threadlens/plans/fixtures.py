"""Thread fixtures derived from the driver's parquet tables.

Every fixture is one SQL text in the subset that Spark SQL and DuckDB both
accept, so the Spark side (``spark.sql(text, conversations=df, ...)``) and
the DuckDB oracle (the same text as a CTE) start from identical inputs.
Only the date arithmetic differs per dialect.

X1  posts_all / posts      conversations as threads; ``posts`` lacks some replies
X2  decorated text         every signal of the lexical features fires somewhere
X3  edges                  heap tree on turn numbers (parent = (turn-1) div 2)
X4  label_keys, folds      gold class from the row, fold from conv_id
X5  preds                  predictions and logits with two error kinds per class
X6  metrics                epoch metrics per run and split from ``events``
X7  docs_eval              documents x labels: gold = quality, pred = length rule
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from threadlens.session import prepare

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

APOS = "chr(39)"
DECORATION = (
    "CASE turn % 6 WHEN 0 THEN ' Is this rumour true? Second of May, noon.' "
    "WHEN 1 THEN ' I cannot believe it, no no!' "
    "WHEN 2 THEN ' see http://t.co/ab_1 and pic.twitter.com/x #tag' "
    "WHEN 3 THEN ' @user_1 this is crap, hell crap.' "
    f"WHEN 4 THEN ' nobody isn' || {APOS} || 't gossip on Monday in French' ELSE '' END"
)


# appended to whole documents, so the rules that their invented prose never meets fire there too
DOC_DECORATION = (
    "CASE CAST(doc_id AS BIGINT) % 3 "
    f"WHEN 0 THEN ' I don' || {APOS} || 't, he can' || {APOS} || 't. Monday the third of May at noon, 12 in English!' "
    "WHEN 1 THEN ' @user_7 (see http://a_b.example.org/x?y=1.), seven.' ELSE '' END"
)


def label_name(e: str) -> str:
    return (f"CASE {e} WHEN 0 THEN 'support' WHEN 1 THEN 'comment' WHEN 2 THEN 'deny' "
            f"WHEN 3 THEN 'query' END")


def _id(conv: str, turn: str) -> str:
    return f"CAST({conv} AS STRING) || '_' || CAST({turn} AS STRING)"


def _shared(conv: str, turn: str) -> str:
    return (f"CASE WHEN {turn} % 6 = 5 THEN 's' || CAST(CAST(floor({conv} / 10) AS BIGINT) AS STRING) || '_' || CAST({turn} AS STRING) "
            f"ELSE {_id(conv, turn)} END")


_DAYS = {
    "spark": "datediff(CAST(ts AS DATE), DATE'2024-01-01')",
    "duck": "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))",
}

# name -> (dependencies, sql with {dep} placeholders, dialect-specific?)
FIXTURES: dict[str, tuple[list[str], str]] = {
    "base": (["conversations"], f"""
SELECT conv_id, turn, role,
  {_id('conv_id', 'turn')} AS post_id,
  CASE WHEN turn > 0 THEN {_id('conv_id', 'CAST(floor((turn - 1) / 2) AS BIGINT)')} END AS parent_id,
  CAST(turn AS INT) AS sib_pos,
  turn = 0 AS is_source,
  text AS plain_text,
  text || {DECORATION} AS dtext,
  CAST((conv_id * 3 + turn * 5 + length(text)) % 4 AS INT) AS gold,
  CASE conv_id % 10 WHEN 7 THEN 'dev' WHEN 8 THEN 'test' WHEN 9 THEN 'test' ELSE 'train' END AS fold,
  (conv_id * turn) % 11 = 10 AS unlabelled,
  turn > 0 AND (conv_id + turn) % 7 = 3 AS missing,
  CASE WHEN turn = 0 THEN 0 WHEN turn <= 2 THEN 1 WHEN turn <= 6 THEN 2 ELSE 3 END AS level
FROM {{conversations}}"""),
    "posts_all": (["base"], f"""
SELECT conv_id, post_id, is_source, dtext AS text,
  CASE WHEN unlabelled THEN CAST(NULL AS INT) ELSE gold END AS stance,
  CASE WHEN unlabelled THEN CAST(NULL AS STRING) ELSE {label_name('gold')} END AS label,
  fold
FROM {{base}}"""),
    "posts": (["posts_all", "base"], """
SELECT p.* FROM {posts_all} p JOIN {base} b ON p.conv_id = b.conv_id AND p.post_id = b.post_id
WHERE NOT b.missing"""),
    "edges": (["base"], """
SELECT conv_id, parent_id, post_id, sib_pos FROM {base}"""),
    # every reply of turn 1 mod 4 is there a second time, an older version in an earlier file
    "posts_repeated": (["posts"], """
SELECT *, 1 AS file_path FROM {posts}
UNION ALL
SELECT conv_id, post_id, is_source, 'old ' || text, CAST(NULL AS INT), CAST(NULL AS STRING), fold, 0 AS file_path
FROM {posts} WHERE NOT is_source AND length(text) % 4 = 1
UNION ALL
SELECT conv_id, post_id, FALSE, 'a reply with the id of the source', stance, label, fold, 2 AS file_path
FROM {posts} WHERE is_source AND conv_id % 2 = 0"""),
    "edges_repeated": (["edges"], """
SELECT * FROM {edges} UNION ALL SELECT conv_id, parent_id, post_id, sib_pos + 100 FROM {edges} WHERE conv_id % 3 = 0"""),
    # replies of turn 5 mod 6 share one id over ten conversations, so a post stands in many threads of a fold
    "base_shared": (["base"], f"""
SELECT conv_id, turn, {_shared('conv_id', 'turn')} AS post_id,
  CASE WHEN turn > 0 THEN {_shared('conv_id', 'CAST(floor((turn - 1) / 2) AS BIGINT)')} END AS parent_id,
  sib_pos, is_source, dtext, gold, fold, unlabelled
FROM {{base}}"""),
    "posts_shared": (["base_shared"], f"""
SELECT conv_id, post_id, is_source, dtext AS text, CASE WHEN unlabelled THEN CAST(NULL AS INT) ELSE gold END AS stance,
  CASE WHEN unlabelled THEN CAST(NULL AS STRING) ELSE {label_name('gold')} END AS label, fold
FROM {{base_shared}}"""),
    "edges_shared": (["base_shared"], """
SELECT conv_id, parent_id, post_id, sib_pos FROM {base_shared}"""),
    "docs_decorated": (["documents"], f"""
SELECT doc_id, text || {DOC_DECORATION} AS text FROM {{documents}}"""),
    "label_keys": (["base"], f"""
SELECT post_id, fold AS split, {label_name('gold')} AS label FROM {{base}} WHERE NOT unlabelled
UNION ALL
SELECT post_id, 'dev' AS split, {label_name('(gold + 1) % 4')} AS label FROM {{base}}
WHERE NOT unlabelled AND turn % 5 = 0 AND fold = 'train'"""),
    "preds": (["base"], """
SELECT conv_id, post_id, fold, gold,
  CAST(CASE WHEN (conv_id + turn) % 3 = 0 THEN (gold + 1 + turn % 2) % 4 ELSE gold END AS INT) AS pred,
  CAST((conv_id * 3 + turn * 1) % 11 AS DOUBLE) / 4.0 AS z0,
  CAST((conv_id * 4 + turn * 2) % 11 AS DOUBLE) / 4.0 AS z1,
  CAST((conv_id * 5 + turn * 3) % 11 AS DOUBLE) / 4.0 AS z2,
  CAST((conv_id * 6 + turn * 4) % 11 AS DOUBLE) / 4.0 AS z3,
  CAST(conv_id AS STRING) || '.' || CAST(level AS STRING) AS branch_id
FROM {base} WHERE NOT unlabelled"""),
    "metrics": (["events"], """
SELECT event_type AS run, CAST({DAYS} AS INT) AS epoch,
  CASE user_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END AS split,
  round(avg(value), 6) AS loss,
  round(avg(CAST(CASE WHEN value < 50 THEN 1 ELSE 0 END AS DOUBLE)), 6) AS accuracy,
  round(avg(CAST(CASE WHEN value < 25 THEN 1 ELSE 0 END AS DOUBLE)), 6) AS f1_macro,
  round(avg(CAST(CASE WHEN value < 75 THEN 1 ELSE 0 END AS DOUBLE)), 6) AS f1_weighted
FROM {events}
GROUP BY 1, 2, 3
UNION ALL
SELECT 'improving' AS run, CAST({DAYS} AS INT) AS epoch, split, round(1.0 / (1 + {DAYS}), 6) AS loss,
  round(CAST(least(0.99, {DAYS} / 1000.0) AS DOUBLE), 6) AS accuracy, round(CAST(least(0.99, {DAYS} / 1000.0) AS DOUBLE), 6) AS f1_macro,
  round(CAST(least(0.99, {DAYS} / 1000.0) AS DOUBLE), 6) AS f1_weighted
FROM (SELECT DISTINCT CAST(ts AS DATE) AS ts, CASE user_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END AS split FROM {events})"""),
    "docs_eval": (["documents", "labels"], """
SELECT d.doc_id, l.quality AS gold, CAST(d.n_chars > 500 AS INT) AS pred
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id"""),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out or n not in FIXTURES:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def _text(name: str, dialect: str) -> str:
    return FIXTURES[name][1].replace("{DAYS}", _DAYS[dialect])


def duck_with(*names: str, recursive: bool = False) -> str:
    """``WITH a AS (...), b AS (...)`` for the fixtures (and their
    dependencies) in DuckDB, where the driver's tables are views. The text
    ends with a comma-free newline; add more CTEs with ``,``."""
    parts = []
    for n in _order(list(names)):
        deps = {d: d for d in FIXTURES[n][0]}
        parts.append(f"{n} AS ({_text(n, 'duck').format(**deps)})")
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixture(spark: SparkSession, sf_dir: str, name: str, sources: dict | None = None) -> DataFrame:
    """The Spark DataFrame of a fixture (or a raw table); ``sources`` can
    replace raw tables (e.g. a streaming read of ``conversations``)."""
    prepare(spark)
    if sources and name in sources:
        return sources[name]
    if name not in FIXTURES:
        return table(spark, sf_dir, name)
    deps = {d: fixture(spark, sf_dir, d, sources) for d in FIXTURES[name][0]}
    return spark.sql(_text(name, "spark"), **deps)
