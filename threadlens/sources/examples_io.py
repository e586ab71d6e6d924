"""Example sets on disk.

Sink: NDJSON (or parquet) partitioned by ``fold`` — many files written in
parallel, not one ``{"Examples": [...]}`` document. The legacy single
document can still be read (it is one file, so one task parses it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXAMPLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("branch_id", T.StringType()),
    T.StructField("tweet_id", T.StringType()),
    T.StructField("stance_label", T.IntegerType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("raw_text_prev", T.StringType()),
    T.StructField("raw_text_src", T.StringType()),
    T.StructField("issource", T.IntegerType()),
    T.StructField("clean_text", T.StringType()),
    T.StructField("ner", T.ArrayType(T.IntegerType())),
    *[T.StructField(c, T.IntegerType()) for c in
      ("hasqmark", "hasemark", "hashashtag", "hasurl", "haspic", "hasnegation", "hasswearwords",
       "src_rumour", "thread_rumour")],
    T.StructField("clean_text_prev", T.StringType()),
    T.StructField("clean_text_src", T.StringType()),
])


def write_examples(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """One example set per fold (``<path>/fold=<fold>/part-*``)."""
    df.write.mode(mode).partitionBy("fold").format(fmt).save(path)


def read_examples(spark: SparkSession, path: str, fold: str | None = None, max_examples: int | None = None,
                  fmt: str = "json") -> DataFrame:
    """Read an example set back with its explicit schema; ``fold``
    prunes the partition folder; ``max_examples`` keeps the first n ids of
    each fold (a cap is the feature here: quick runs)."""
    schema = T.StructType([*EXAMPLE_SCHEMA.fields, T.StructField("fold", T.StringType())])
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(schema)
    df = reader.load(path)
    if fold is not None:
        df = df.where(F.col("fold") == fold)
    if max_examples is not None:
        from pyspark.sql import Window
        w = Window.partitionBy("fold").orderBy("id")
        # the window only has to rank the first n ids of each fold: Spark plans
        # a per-partition top-n (WindowGroupLimit) before the shuffle
        df = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_examples).drop("_rn")
    return df


def read_legacy_examples(spark: SparkSession, path: str) -> DataFrame:
    """The original ``{"Examples": [...]}`` document of one fold."""
    doc = spark.read.text(path, wholetext=True)
    arr = F.from_json("value", T.StructType([T.StructField("Examples", T.ArrayType(EXAMPLE_SCHEMA))]))
    return doc.select(F.explode(arr["Examples"]).alias("e")).select("e.*")
