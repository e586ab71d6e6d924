"""S1 and S11 for key documents of any size: one JSON object read in byte ranges.

``{"<section>": {"<id>": "<label>", ...}}`` is one value, so a reader of whole
files gives it to one task. Here a file is cut into ranges. What a range needs
to know about the bytes before it is whether it begins inside a string, and at
which depth; a first pass over all ranges counts quotes (those behind an odd
number of backslashes are part of a string) and brackets for both answers, and
running sums over the ranges, a row each, settle them. A second pass cuts the
object at the commas of depth 2: an entry belongs to the range it begins in,
and the task reads on to its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.session import materialize, ship_package
from threadlens.sources.labels import SECTION
from threadlens.sources.layout import filesystem

RANGE_BYTES = 32 << 20
READ_ON = 64 << 10
_STATE = "path string, lo bigint, size bigint, quotes bigint, outside bigint, inside bigint"
_FOUND = "path string, pos bigint, section boolean, value string"


def _bytes(path: str, lo: int, hi: int) -> np.ndarray:
    fs, p = filesystem(path)
    with fs.open_input_file(p) as f:
        return np.frombuffer(f.read_at(max(0, hi - lo), lo), np.uint8)


def _backslashes(path: str, lo: int) -> int:
    """How many backslashes end right before ``lo``."""
    n, step = 0, 64
    while lo > n:
        b = _bytes(path, max(0, lo - n - step), lo - n)
        other = np.flatnonzero(b != 92)
        if len(other):
            return n + len(b) - 1 - int(other[-1])
        n, step = n + len(b), 2 * step
    return n


def quotes_of(b: np.ndarray, before: int) -> np.ndarray:
    """True where a quote begins or ends a string; ``before`` backslashes stand in front."""
    at = np.arange(len(b))
    last = np.maximum.accumulate(np.where(b != 92, at, -1 - before))
    slashes = at - 1 - np.concatenate(([-1 - before], last[:-1])) if len(b) else at
    return (b == 34) & (slashes % 2 == 0)


def _steps(b: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """+1 for an opening bracket, -1 for a closing one, outside of strings."""
    return (((b == 123) | (b == 91)).astype(np.int64) - ((b == 125) | (b == 93))) * ~inside


def _states(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, lo, size in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "size"))):
                b = _bytes(path, lo, min(size, lo + range_bytes))
                q = quotes_of(b, _backslashes(path, lo))
                odd = np.cumsum(q) % 2 == 1
                out.append((path, lo, size, int(q.sum()), int(_steps(b, odd).sum()), int(_steps(b, ~odd).sum())))
            types = (pa.string(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["path", "lo", "size", "quotes", "outside", "inside"])
    return run


class _Reader:
    """The bytes of a file from ``lo`` on, with the depth behind each and
    whether it is in a string; more is read when asked for."""

    def __init__(self, path: str, lo: int, hi: int, size: int, parity: int, depth: int):
        self.path, self.lo, self.end, self.size = path, lo, lo, size
        self.parity, self.deep, self.slashes = parity, depth, _backslashes(path, lo)
        self.b, self.depth, self.inside = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, bool)
        self.more(hi - lo)

    def more(self, n: int) -> bool:
        new = _bytes(self.path, self.end, min(self.size, self.end + n))
        if not len(new):
            return False
        inside = (np.cumsum(quotes_of(new, self.slashes)) + self.parity) % 2 == 1
        depth = self.deep + np.cumsum(_steps(new, inside))
        other = np.flatnonzero(new != 92)
        self.slashes = len(new) - 1 - int(other[-1]) if len(other) else self.slashes + len(new)
        self.parity, self.deep, self.end = int(inside[-1]), int(depth[-1]), self.end + len(new)
        self.b, self.depth, self.inside = (np.concatenate(x) for x in ((self.b, new), (self.depth, depth), (self.inside, inside)))
        return True


def _name_before(path: str, pos: int) -> str:
    """The key whose value opens at ``pos``."""
    n = 256
    while True:
        lo = max(0, pos - n)
        b = _bytes(path, lo, pos)
        ends = np.flatnonzero(quotes_of(b, _backslashes(path, lo)))
        if len(ends) >= 2 or lo == 0:
            return bytes(b[ends[-2]:ends[-1] + 1]).decode("utf-8", "replace") if len(ends) >= 2 else ""
        n *= 4


def _entries(range_bytes: int):
    def entries(path, lo, size, parity, depth):
        hi = min(size, lo + range_bytes)
        r = _Reader(path, lo, hi, size, parity, depth)
        n = hi - lo
        flat = ~r.inside[:n]
        opens = np.flatnonzero(flat & (r.b[:n] == 123) & (r.depth[:n] == 2))
        for i in opens.tolist():
            yield path, lo + i, True, _name_before(path, lo + i)
        starts = np.flatnonzero(flat & (((r.b[:n] == 123) | (r.b[:n] == 44)) & (r.depth[:n] == 2)))
        while True:
            stops = np.flatnonzero(~r.inside & (((r.b == 44) & (r.depth == 2)) | ((r.b == 125) & (r.depth == 1))))
            if not len(starts) or (len(stops) and stops[-1] > starts[-1]) or not r.more(READ_ON):
                break
        for i in starts.tolist():
            k = int(np.searchsorted(stops, i + 1))
            if k < len(stops):
                text = bytes(r.b[i + 1:stops[k]]).decode("utf-8", "replace")
                if text.strip():
                    yield path, lo + i, False, "{" + text + "}"

    def run(batches):
        for batch in batches:
            for args in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "size", "parity", "depth"))):
                out = list(entries(*args))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.string()))], ["path", "pos", "section", "value"])
    return run


def key_rows(files: DataFrame, split: str | None = None, section: str = SECTION, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(post_id, split, label) of key documents (path, size), the rows of
    ``labels.parse_label_keys`` for documents that are valid JSON: of an id
    given twice in a document the last label, sections of other names left
    out (a section given twice: the last). Ranges are dealt over the cluster."""
    spark = files.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("lo"), "size")
    states = materialize(ranges.repartition(n, "path", "lo").mapInArrow(_states(range_bytes), _STATE), "range-states")
    before = Window.partitionBy("path").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    at = states.withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    at = at.withColumn("step", F.when(F.col("parity") == 0, F.col("outside")).otherwise(F.col("inside"))).withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    found = materialize(at.select("path", "lo", "size", "parity", "depth").repartition(n, "path", "lo").mapInArrow(_entries(range_bytes), _FOUND), "range-entries")
    opened = Window.partitionBy("path").orderBy("pos")  # the sections of a document
    name = F.from_json(F.concat(F.lit('{"k":'), F.col("value"), F.lit("}")), "k string")["k"]
    sections = found.where("section").select("path", F.col("pos").alias("since"), F.lead("pos").over(opened).alias("until"), name.alias("name"))
    last = sections.where(F.col("name") == section).groupBy("path").agg(F.max(F.struct("since", "until")).alias("s")).select("path", "s.since", "s.until")
    e = found.where("not section").join(last, "path").where("pos >= since and (until is null or pos < until)")
    kv = e.select("path", "pos", F.explode(F.from_json("value", "map<string,string>")).alias("post_id", "label"))
    one = kv.groupBy("path", "post_id").agg(F.max(F.struct("pos", "label")).alias("m"))
    return one.select("post_id", F.lit(split).cast("string").alias("split"), F.col("m.label").alias("label"))
