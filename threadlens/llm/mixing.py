"""Operator 2: mixing sources to target weights by hash-threshold histograms.

Each document has a fixed 40-bit hash of its id. Words are summed by source
and leading hash bits; per source the bucket in which the running sum crosses
the budget is the boundary bucket, and only the documents in it are summed
again by the next bits. After four levels the boundary is one hash value, so
the mix is a plain filter ``hash < threshold``: nothing is sorted and every
step is a partial aggregate.

Defined results: null text has size 0; a null source is a source of its own
and stands last; a null id hashes as the empty string; repeated ids share a
hash and are taken together; an empty table gives no rows. Extra columns of
the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.llm.common import WORD, documents, saved
from threadlens.llm.registry import query

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
LEVELS, LEVEL_BITS = 4, 10
HASH_BITS = LEVELS * LEVEL_BITS


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def hash40(doc_id: Column) -> Column:
    """The leading 40 bits of md5(id): the same number in any SQL engine."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight,
    no source above ``most`` times its size, the excess dealt again by weight.

    That is min(cap, level * weight) at the one level where the targets add
    up: with sources in order of cap / weight, the level that holds behind a
    prefix of capped sources is what is left over the weights left. Sources
    are one row each here, so the two windows run over that small table.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("_no") - 1) % len(weights) + 1).cast("int"))
    ranked = (by.withColumn("_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    # a source is capped as long as the level reaches its cap; the first that is not fixes the level
    open_ = F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.col("_level"))
    return (ranked.withColumn("_level", level)
            .withColumn("_fixed", F.first(open_, ignorenulls=True).over(everything))
            .withColumn("target", F.when(F.col("_fixed").isNull(), F.col("_cap"))
                        .otherwise(F.least(F.col("_cap"), F.col("_fixed") * F.col("_w"))))
            .select("source", "source_size", "target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, threshold): every document is taken
    ``whole`` times, and once more if its hash is below the threshold."""
    t = (targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
         .withColumn("_need", F.col("target") - F.col("whole") * F.col("source_size"))
         .withColumn("_below", F.lit(0).cast("long")).withColumn("_prefix", F.lit(0).cast("long")))
    keys = ["source", "source_size", "target", "whole", "_need"]
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        pairs = sizes.alias("d").join(t.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))
                                      & (F.shiftright(F.col("d.h"), shift + LEVEL_BITS) == F.col("t._prefix")))
        hist = (pairs.select(*[F.col(f"t.{k}").alias(k) for k in [*keys, "_below"]],
                             F.shiftright(F.col("d.h"), shift).alias("_bucket"), F.col("d.size").alias("size"))
                .groupBy(*keys, "_below", "_bucket").agg(F.sum("size").alias("_sum")))
        # at most 2^LEVEL_BITS buckets of a source are ordered here
        run = Window.partitionBy("source").orderBy("_bucket")
        upto = hist.withColumn("_upto", F.col("_below") + F.sum("_sum").over(run))
        crossing = F.when(F.col("_upto") > F.col("_need"), F.struct("_bucket", (F.col("_upto") - F.col("_sum")).alias("b"), F.col("_upto").alias("u")))
        last = F.max(F.struct("_bucket", (F.col("_upto") - F.col("_sum")).alias("b"), F.col("_upto").alias("u")))
        t = (upto.groupBy(*keys).agg(F.coalesce(F.min(crossing), last).alias("_x"))
             .select(*keys, F.col("_x.b").alias("_below"), F.col("_x._bucket").alias("_prefix"), F.col("_x.u").alias("_upto")))
    nearer = (F.col("_upto") - F.col("_need")) < (F.col("_need") - F.col("_below"))
    return t.withColumn("threshold", F.col("_prefix") + nearer.cast("long")).drop("_need", "_below", "_prefix", "_upto")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source of every document."""
    sizes = saved(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), hash40(F.col("doc_id")).alias("h")), "mix-sizes")
    cut = thresholds(sizes, source_targets(sizes, weights, share, most))
    j = sizes.alias("d").join(cut.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    copies = F.col("t.whole") + (F.col("d.h") < F.col("t.threshold")).cast("long")
    copies = F.least(copies, F.lit(most))
    return j.select("d.doc_id", "d.size", "t.source_size", "t.target", (copies * F.col("d.size")).alias("taken"),
                    copies.alias("copies"), F.col("d.source").alias("source"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents themselves, each as often as the mix takes it (``copy``
    from 1; a column of that name in the input gives way). Only the thresholds, a
    row a source, are joined to them."""
    sizes = saved(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), hash40(F.col("doc_id")).alias("h")), "mix-sizes")
    cut = thresholds(sizes, source_targets(sizes, **kw)).select(F.col("source").alias("__source"), F.col("whole").alias("__whole"), F.col("threshold").alias("__threshold"))
    j = docs.join(cut, docs["source"].eqNullSafe(cut["__source"]))
    copies = F.least(F.col("__whole") + (hash40(F.col("doc_id")) < F.col("__threshold")).cast("long"), F.lit(kw.get("most", MOST_COPIES)))
    return (j.withColumn("__copies", copies).where("__copies > 0")
            .select(*[c for c in docs.columns if c.lower() != "copy"], F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("copy")))


ORACLE = """
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 10) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no FROM s),
w AS (SELECT *, CAST([3, 1, 2][(no - 1) % 3 + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM r),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (SELECT (SELECT level FROM l WHERE level * w < cap ORDER BY cap / w, no LIMIT 1) AS fixed),
t AS (SELECT source, source_size, CASE WHEN fixed IS NULL THEN cap ELSE least(cap, fixed * w) END AS target FROM l, f),
n AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
x AS (
  SELECT d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS tie
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source),
e AS (
  SELECT *, CASE WHEN upto <= need THEN 1
                 WHEN upto - tie <= need AND upto - need < need - (upto - tie) THEN 1 ELSE 0 END AS extra
  FROM x)
SELECT doc_id, size, source_size, target, CAST(least(whole + extra, 2) * size AS BIGINT) AS taken,
       CAST(least(whole + extra, 2) AS BIGINT) AS copies, source
FROM e
"""


@query("op2_mix_sources", ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))
