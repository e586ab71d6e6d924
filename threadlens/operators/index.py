"""Running numbers over a total order without a global window.

``row_number() over (partition by fold order by ...)`` would put a whole fold
into one task. Instead:

1. the input is written once to the shared folder (it may be the end of a long
   plan; everything below only re-reads it);
2. ``repartitionByRange`` deals the rows by (group, order key) into ``buckets``
   ranges of about equal size, whatever the skew, because keys are unique; the
   range's number is written with the row, so no later re-run can disagree;
3. a running sum inside ``(group, bucket)`` is a window over one range;
4. the totals per (group, bucket) — ``buckets + #groups`` rows — are summed up
   and joined as offsets (AQE broadcasts them by their size at run time).

``group_cols`` should have low cardinality (e.g. ``fold``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.session import materialize

_BKT, _LOCAL, _OFF, _TOT = "_tl_bkt", "_tl_local", "_tl_off", "_tl_tot"


def range_bucketed(df: DataFrame, order_cols: Sequence[str], buckets: int | None = None,
                   out: str = _BKT, stored: bool = False) -> DataFrame:
    """The rows with the number of their range (0 to ``buckets`` - 1) of the
    ``order_cols`` key, stored in the shared folder. ``stored``: the input is
    a plain scan already and need not be written first."""
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = df if stored else materialize(df, "ranged-input")
    ranged = source.repartitionByRange(max(1, buckets), *[F.col(c).asc_nulls_first() for c in order_cols])
    return materialize(ranged.withColumn(out, F.spark_partition_id()), "ranged")


def prefix_sum(df: DataFrame, order_cols: Sequence[str], out: str, weight: str | Column | None = None,
               group_cols: Sequence[str] = (), buckets: int | None = None,
               inclusive: bool = False, stored: bool = False) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over rows before this one (exclusive by
    default) in the total order ``order_cols`` inside each ``group_cols`` group.

    ``order_cols`` must be unique inside a group for the result to be
    deterministic (a total order).
    """
    order_cols = list(order_cols)
    group_cols = list(group_cols)
    w = F.lit(1).cast("long") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight).cast("long")
    b = range_bucketed(df.withColumn("_tl_w", w), group_cols + order_cols, buckets, stored=stored)
    win = (Window.partitionBy(*group_cols, _BKT).orderBy(*order_cols)
           .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = b.withColumn(_LOCAL, F.coalesce(F.sum("_tl_w").over(win), F.lit(0)).cast("long"))
    totals = b.groupBy(*group_cols, _BKT).agg(F.sum("_tl_w").alias(_TOT))
    ow = (Window.partitionBy(*group_cols).orderBy(_BKT)
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(c).alias(f"_tl_g{i}") for i, c in enumerate(group_cols)], F.col(_BKT).alias("_tl_b"),
                            F.coalesce(F.sum(_TOT).over(ow), F.lit(0)).cast("long").alias(_OFF))
    on = F.col(_BKT) == F.col("_tl_b")
    for i, c in enumerate(group_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_tl_g{i}"))
    res = local.join(offsets, on, "left")
    return (res.withColumn(out, (F.col(_LOCAL) + F.coalesce(F.col(_OFF), F.lit(0))).cast("long"))
            .select(*df.columns, out))


def dense_index(df: DataFrame, order_cols: Sequence[str], out: str,
                group_cols: Sequence[str] = (), buckets: int | None = None, stored: bool = False) -> DataFrame:
    """0-based row number in the order ``order_cols`` within each group."""
    return prefix_sum(df, order_cols, out, None, group_cols, buckets, stored=stored)
