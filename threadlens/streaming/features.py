"""Post features on a stream.

The row-local features (F1-F10, F12-F17: flags, lexicon counts, processed
text, entity vector) are plain column expressions, so the batch functions
apply unchanged to a ``readStream`` DataFrame. The thread flag (F11) needs
the whole conversation and stays a batch operator.

``run_feature_stream`` drives one source folder to a sink with the
``availableNow`` trigger (process what is there, then stop) — restartable
from its checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadlens.operators.features import post_features
from threadlens.session import shared_dir

POST_SCHEMA = T.StructType([
    T.StructField("conv_id", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("is_source", T.BooleanType()),
    T.StructField("text", T.StringType()),
])


def feature_stream(posts: DataFrame, lexicon, gazetteer=None) -> DataFrame:
    """Row-local features of a (streaming or batch) post DataFrame. ``lexicon``
    and ``gazetteer`` must be lists here (literal sets), not tables."""
    if not isinstance(lexicon, (list, tuple, set, frozenset)):
        raise ValueError("on a stream the lexicon must be a list of words")
    if gazetteer is not None and not isinstance(gazetteer, dict):
        raise ValueError("on a stream the gazetteer must be a dict of words")
    return post_features(posts, lexicon, gazetteer)


def only(path: str) -> str:
    """A pattern that fits this path alone. A stream takes a folder of part files
    as it is, a single file only by a pattern; this one reads either."""
    path = path.rstrip("/")
    return path if re.search(r"[*?\[\]{}\\]", path) else f"{path[:-1]}[{path[-1]}]"


def read_post_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                     glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream (new files under ``path`` become new rows)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    elif fmt == "parquet":
        r = r.schema(spark.read.parquet(path if glob is None else f"{path}/{glob}").schema)
    if glob is not None:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_feature_stream(features: DataFrame, path: str | None = None, checkpoint: str | None = None, fmt: str = "parquet"):
    """Run the stream with ``availableNow`` to its end, appending ``fmt`` files
    under ``path`` (default: a fresh folder in the shared location); returns
    (the finished query, the path)."""
    spark = features.sparkSession
    path = path or shared_dir(spark, "stream-out")
    q = (features.writeStream.outputMode("append").option("checkpointLocation", checkpoint or shared_dir(spark, "stream-ckpt"))
         .trigger(availableNow=True).format(fmt).option("path", path).start())
    q.awaitTermination()
    return q, path
