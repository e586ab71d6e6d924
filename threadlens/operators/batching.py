"""Length-bucketed batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.operators.index import dense_index


def bucket_batches(df: DataFrame, batch_size: int = L.DEFAULT_BATCH_SIZE, seq_col: str = "text",
                   group_cols: Sequence[str] = ("fold",), id_col: str = "id") -> DataFrame:
    """Sort by descending length (ties by id) and cut every
    ``batch_size`` rows, per fold. The running number uses range buckets, not
    a window over the whole fold."""
    d = df.withColumn("seq_len", F.size(seq_col)).withColumn("_neg", -F.col("seq_len"))
    d = dense_index(d, ["_neg", id_col], "_rank", group_cols)
    return d.withColumn("batch_no", F.expr(f"_rank div {int(batch_size)}")) \
        .drop("_neg", "_rank")


def pad_batch(df: DataFrame, seq_cols: Sequence[str] = ("text", "type_mask", "input_mask"),
              group_cols: Sequence[str] = ("fold",), pad_id: int = L.PAD_ID) -> DataFrame:
    """Pad every sequence to the longest of its batch (window = one batch)."""
    w = Window.partitionBy(*group_cols, "batch_no")
    d = df.withColumn("batch_len", F.max(F.size(seq_cols[0])).over(w))
    for c in seq_cols:
        d = d.withColumn(c, F.concat(F.col(c), F.array_repeat(F.lit(pad_id), F.col("batch_len") - F.size(c))))
    return d


def update_group(batch_no, batch_size: int = L.DEFAULT_BATCH_SIZE,
                 true_batch_size: int = L.DEFAULT_TRUE_BATCH_SIZE):
    """Batches accumulated into one optimiser step."""
    ratio = max(1, true_batch_size // batch_size)
    c = F.col(batch_no) if isinstance(batch_no, str) else batch_no
    return F.call_function("div", c, F.lit(ratio)).cast("long")
