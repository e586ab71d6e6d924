"""Lexicon files (S10): one entry per line, stripped and lower-cased."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.text import WS


def strip_ws(c):
    """Python ``str.strip``: whitespace of every kind at both ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{WS}|{WS}$", "")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``word`` entries of a text file (or folder of text files).
    The result is small by nature; ``features._lexicon_words`` collects it
    only after checking its size."""
    return spark.read.text(path).select(F.lower(strip_ws("value")).alias("word")).distinct()
