"""Thread folder scans.

Twitter:  <root>/<topic>/<conv>/source-tweet/<id>.json, replies/<id>.json,
          <conv>/structure.json (one JSON per line; the last line wins)
Reddit:   <root>/<conv>/source-tweet/<id>.json, replies/<id>.json,
          <conv>/structure.json (the whole file)

A post file is read as a whole and cut into lines, so the number of a line
stays known (of several versions of a post the last counts) and a line that is
no JSON object is kept as a corrupt line instead of an empty post. Topic,
conversation and role come from the path. Names starting with ``.`` are no
posts, names starting with ``_`` are. Folders are listed and files read in
tasks (``sources.listing``); a scan takes a root, or a ``Listed`` one that
several scans share.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.tree import tree_json_to_edges
from threadlens.session import materialize
from threadlens.sources import listing

TWEET_SCHEMA = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
])

REDDIT_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("data", T.StructType([
                T.StructField("title", T.StringType()),
                T.StructField("author", T.StringType()),
            ])),
        ]))),
        T.StructField("body", T.StringType()),
        T.StructField("author", T.StringType()),
    ])),
])

ROLE_DIRS = ("source-tweet", "replies")
#: Folder levels from the root to the conversations.
LEVELS = {"twitter": 2, "reddit": 1}


def post_id_from_path(path) -> Column:
    """File name without ``.json`` ('' when the name is not ``*.json``)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]+)\.json$", 1)


class Listed:
    """What lies below a root, listed once for several scans of it; ``stored``:
    files are opened once as well, their texts kept in the shared folder."""

    def __init__(self, spark: SparkSession, root: str, levels: int, stored: bool = False):
        self.spark, self.root, self.levels, self.stored = spark, root, levels, stored

    def _texts(self, files: DataFrame) -> DataFrame:
        texts = listing.read_texts(files)
        return materialize(texts, "texts") if self.stored else texts

    @cached_property
    def entries(self) -> DataFrame:
        """(path, name, is_dir, size) of what each conversation folder holds."""
        return listing.children(listing.folders(self.spark, self.root, self.levels))

    @cached_property
    def files(self) -> DataFrame:
        """(path, name, size) of every file in the role folders."""
        roles = self.entries.where(F.col("is_dir") & F.col("name").isin(*ROLE_DIRS))
        return listing.children(roles).where("not is_dir").select("path", "name", "size")

    @cached_property
    def posts(self) -> DataFrame:
        """(file_path, value) of every post file."""
        return self._texts(self.files.where(F.col("name").endswith(".json")))

    @cached_property
    def structures(self) -> DataFrame:
        """(file_path, value) of every ``structure.json``."""
        return self._texts(self.entries.where("not is_dir and name = 'structure.json'"))


def listed(spark: SparkSession, root: str | Listed, platform: str, stored: bool = False) -> Listed:
    return root if isinstance(root, Listed) else Listed(spark, root, LEVELS[platform], stored)


def _parsed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(file_path, line_no, j, corrupt): one JSON object a line."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    lines = df.select("file_path", F.posexplode(F.split("value", "\n")).alias("line_no", "_line")).where(F.trim(F.regexp_replace("_line", "\r", "")) != "")
    lines = lines.withColumn("j", F.from_json("_line", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("j").isNull() | F.col("j._corrupt").isNotNull()
    return lines.select("file_path", "line_no", "j", F.when(bad, F.col("_line")).alias("corrupt"))


def _path_parts(df: DataFrame, with_topic: bool) -> DataFrame:
    p = F.col("file_path")
    if with_topic:
        rx = r"/([^/]+)/([^/]+)/(source-tweet|replies)/[^/]+$"
        return df.select("*", F.regexp_extract(p, rx, 1).alias("topic"), F.regexp_extract(p, rx, 2).alias("conv_id"),
                         (F.regexp_extract(p, rx, 3) == "source-tweet").alias("is_source"))
    rx = r"/([^/]+)/(source-tweet|replies)/[^/]+$"
    return df.select("*", F.regexp_extract(p, rx, 1).alias("conv_id"),
                     (F.regexp_extract(p, rx, 2) == "source-tweet").alias("is_source"))


def corrupt_lines(spark: SparkSession, root: str | Listed, platform: str) -> DataFrame:
    """(file_path, line_no, line) of the lines that are no posts: no JSON
    object, or (Twitter) one without an id."""
    schema = TWEET_SCHEMA if platform == "twitter" else REDDIT_SCHEMA
    df = _parsed(listed(spark, root, platform).posts, schema)
    bad = F.col("corrupt").isNotNull()
    if platform == "twitter":
        bad = bad | F.col("j.id_str").isNull()
    return df.where(bad).select("file_path", "line_no", F.coalesce("corrupt", F.to_json("j")).alias("line"))


def scan_twitter(spark: SparkSession, root: str | Listed) -> DataFrame:
    """``(platform, topic, conv_id, post_id, is_source, text, file_path,
    line_no)``; the post id is the tweet's own ``id_str``; NULL text is kept
    (see missing_text); corrupt lines are in ``corrupt_lines``."""
    df = _parsed(listed(spark, root, "twitter").posts, TWEET_SCHEMA).where("corrupt is null and j.id_str is not null")
    df = _path_parts(df, True)
    return df.select(F.lit("twitter").alias("platform"), "topic", "conv_id", F.col("j.id_str").alias("post_id"),
                     "is_source", F.col("j.text").alias("text"), "file_path", "line_no")


def scan_reddit_raw(spark: SparkSession, root: str | Listed) -> DataFrame:
    """S3: raw Reddit posts ``(conv_id, post_id, is_source, data, file_path,
    line_no)``; the post id is the file name (S5). Normalise with ``normalize_posts``."""
    df = _parsed(listed(spark, root, "reddit").posts, REDDIT_SCHEMA).where("corrupt is null")
    df = _path_parts(df, False)
    return df.select(F.lit("reddit").alias("platform"), "conv_id", post_id_from_path("file_path").alias("post_id"),
                     "is_source", F.col("j.data").alias("data"), "file_path", "line_no")


def list_post_files(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """S5 report: every file below the role folders with the id taken from its
    name; ``is_json`` is false for names the scans do not read."""
    df = Listed(spark, root, depth).files
    return df.select(F.regexp_extract("path", r"/([^/]+)/(source-tweet|replies)/[^/]+$", 1).alias("conv_id"),
                     F.col("name").alias("file_name"), F.col("path").endswith(".json").alias("is_json"),
                     F.when(F.col("path").endswith(".json"), post_id_from_path("path")).alias("post_id"))


def scan_structures(spark: SparkSession, root: str | Listed, platform: str) -> DataFrame:
    """``(topic, conv_id, value)`` — the tree document of every conversation
    (Twitter: the last non-empty line of the file; Reddit: the whole file)."""
    topic = F.regexp_extract("file_path", r"/([^/]+)/[^/]+/structure\.json$", 1) if platform == "twitter" else F.lit("")
    raw = listed(spark, root, platform).structures.select(topic.alias("topic"), F.regexp_extract("file_path", r"/([^/]+)/structure\.json$", 1).alias("conv_id"), "value")
    if platform == "twitter":
        lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != F.lit(""))
        raw = raw.select("topic", "conv_id", F.element_at(lines, -1).alias("value"))
    return raw


def scan_edges(spark: SparkSession, root: str | Listed, platform: str, with_topic: bool = False) -> DataFrame:
    """S6 + T1: the reply edges of every conversation under ``root``; with
    ``with_topic`` the key is (topic, conv_id), for ids that recur in topics."""
    docs = scan_structures(spark, root, platform)
    if not with_topic:
        return tree_json_to_edges(docs)
    e = tree_json_to_edges(docs.withColumn("_key", F.to_json(F.struct("topic", "conv_id"))), conv_col="_key")
    key = F.from_json("conv_id", "topic string, conv_id string")
    return e.select(key["topic"].alias("topic"), key["conv_id"].alias("conv_id"), "parent_id", "post_id", "sib_pos")
