"""Label keys and prediction ("answer") files.

A key file is one JSON document ``{"<section>": {"<post_id>": "<label>"}}``.
The reader is thin — ``(value)`` rows, one document each — and the parser is
a DataFrame -> DataFrame function, so NDJSON key folders (one document per
line, the shape to prefer at scale) and the original single-document files
go through the same code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUE: the section name under which key and prediction documents
# keep their {post_id: label} map.
SECTION = "subtaskaenglish"


def read_documents(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """``value`` = one JSON document per file (``whole_file``) or per line."""
    return spark.read.text(path, wholetext=whole_file).where(F.trim("value") != "")


def parse_label_keys(raw: DataFrame, split: str | None = None, section: str = SECTION) -> DataFrame:
    """Flatten ``{section: {id: label}}`` documents into ``(post_id, split,
    label)`` rows. Duplicate ids (or sections) inside one document: the last
    one wins. A document is parsed by one task; for documents too large for
    that see ``sources.key_ranges``."""
    def last(m):
        # the parser keeps repeated keys; building the map anew drops all but the last
        return F.map_from_entries(F.map_entries(m))

    m = last(F.from_json("value", "map<string,map<string,string>>"))
    rows = raw.select(F.explode(last(F.element_at(m, F.lit(section)))).alias("post_id", "label"))
    return rows.select("post_id", F.lit(split).cast("string").alias("split"), "label")


def read_label_keys(spark: SparkSession, paths: Mapping[str, str], whole_file: bool = True,
                    section: str = SECTION) -> DataFrame:
    """All key files of ``{split: path}`` tagged with their split."""
    out = None
    for split, path in paths.items():
        df = parse_label_keys(read_documents(spark, path, whole_file), split, section)
        out = df if out is None else out.unionByName(df)
    return out


def read_answers(spark: SparkSession, path: str, whole_file: bool = True, section: str = SECTION) -> DataFrame:
    """A predictions file has the key-file shape; ``(post_id, label)``."""
    return parse_label_keys(read_documents(spark, path, whole_file), None, section).drop("split")


def label_documents(keys: DataFrame, doc_key, section: str = SECTION) -> DataFrame:
    """The inverse, for writing key files: one document per ``doc_key``
    group of ``(post_id, label)`` rows (groups must be bounded in size)."""
    g = keys.groupBy(doc_key.alias("_doc")).agg(
        F.map_from_entries(F.collect_list(F.struct("post_id", "label"))).alias("_m"))
    return g.select(F.to_json(F.create_map(F.lit(section), F.col("_m"))).alias("value"))
