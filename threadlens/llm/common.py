"""Small helpers the operators of this subpackage share.

Texts travel as Arrow string columns; numpy looks at their UTF-8 bytes
directly, so no Python string is made per word. All helpers take null as the
empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.session import checkpoint_dir, shared_dir, ship_package

#: A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy step looks at (a longer single text is one step).
STEP_BYTES = 4 << 20

#: Bytes of text hashed in one step where steps are joined to nothing: a worker
#: then holds a few times that, and the powers of the longest step it met.
PIECE = 1 << 19

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow with this package on the executors' path."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def words_of(c: Column) -> Column:
    """The words of a text as a native array (empty for null)."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def saved(df: DataFrame, name: str, sort_by: list[str] | None = None) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage is cut,
    the work is done once, and a lost executor costs a re-read only."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = shared_dir(spark, name)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (kept between calls, as many as
    were asked for, unless one very long text asked for them)."""
    if len(_POWERS.get("p", ())) < n:
        m = max(n, 1 << 16, min(2 * len(_POWERS.get("p", ())), STEP_BYTES + (STEP_BYTES >> 2)))
        made = {}
        for key, b in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            a = np.full(m, b, np.uint64)
            a[0] = 1
            made[key] = np.multiply.accumulate(a, dtype=np.uint64)
        if n > 2 * STEP_BYTES:
            return made["p"][:n], made["q"][:n]
        _POWERS.update(made)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets of n + 1) of an Arrow
    string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], (offs - offs[0]).astype(np.int64)


def steps(batch: pa.RecordBatch, text: str = "text", most: int = STEP_BYTES, also: str | None = None):
    """Slices of a batch of at most ``most`` bytes of text each (or one row);
    the bytes of a second column count as well if it is named."""
    if batch.num_rows == 0:
        return
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (text, also) if c)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right"))
        hi = max(hi, lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the index of its first word
    (n + 1 entries). Words never cross texts."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = IS_WORD[buf]
    first = np.zeros(n + 1, bool)
    first[offs] = True  # a text begins (or all end) here
    start = w.copy()
    start[1:] &= ~w[:-1] | first[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    if len(buf) == 0 or len(starts) == 0:
        return np.zeros(len(starts), np.uint64)
    p, q = powers(len(buf) + 1)
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[buf] * p[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all windows of k values (uint64), by start."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    p, q = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * p[:n], out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * q[: n - k + 1])


def minimizers(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w hashes (by start) the position of its leftmost
    smallest one."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64)
    w = min(w, n)
    pos = np.arange(n, dtype=np.int64)
    val, at, width = h, pos, 1
    while width * 2 <= w:  # doubling: minimum of [i, i + 2 width)
        a, b = val[:-width], val[width:]
        left = a <= b
        val, at, width = np.where(left, a, b), np.where(left, at[:-width], at[width:]), width * 2
    if width < w:
        s = w - width
        a, b = val[: n - w + 1], val[s: s + n - w + 1]
        at = np.where(a <= b, at[: n - w + 1], at[s: s + n - w + 1])
    return at[: n - w + 1]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    d = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return d[::2], d[1::2]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined, in order."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    first = np.flatnonzero(new)
    return s[first], e[np.concatenate((first[1:] - 1, [len(s) - 1]))]
