"""Row identity and rebuilding, shared by the two operators that cut
duplicate passages out of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A null id stands behind every other.
LAST = 2**63 - 1


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, oid, key, text. (oid, key) names a text: where all ids are
    distinct and not null the key is 0, else rows of one id are told apart by
    a hash of their text; rows equal in both have equal results anyway."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    repeated = d.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    key: Column = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    return d.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("oid"), key.alias("key"), "text")
