"""Operator 10: benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a passage by ``m // CHARS_PER_ERROR``
edits. It is cut into one piece more than that, so in any passage within the
budget at least one piece stands unchanged: one automaton over all pieces finds
every candidate, and Myers' bit-parallel distance decides on the stretch of
text around each. Both sides are compared in lower case with single spaces.

Items are the stated query set. They are taken in blocks of at most BLOCK_CHARS
characters; each block is sent to the executors and meets every document in
one more narrow pass, so nothing is shuffled whatever the number of items.

Defined results: null or blank texts match nothing, null or blank items are
never found; equal items are each found; repeated documents are judged each on
its own; an empty benchmark leaves every document clean; an empty table gives
no rows; extra columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import documents, mapped, steps
from threadlens.llm.registry import query

CHARS_PER_ERROR = 20
BLOCK_CHARS = 1_000_000
ITEMS, DISTANCES = "__benchmark_items", "__benchmark_distances"


def normal(t: str | None) -> str:
    return " ".join((t or "").lower().split())


def budget(m: int, chars_per_error: int = CHARS_PER_ERROR) -> int:
    return m // chars_per_error


def pieces(m: int, k: int) -> list[tuple[int, int]]:
    """The spans of k pieces of near equal length."""
    return [(m * i // k, m * (i + 1) // k) for i in range(k)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(smallest edit distance of the pattern to a substring of the text, end
    of the first such substring), one word operation a character."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full  # a match may begin anywhere: nothing is carried in
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """The pieces of a block of items, found all at once."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        import ahocorasick

        self.items = [(i, t, budget(len(t), chars_per_error)) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for no, (_, t, e) in enumerate(self.items):
            for a, b in pieces(len(t), e + 1):
                where[t[a:b]].append((no, a))
        self.automaton = ahocorasick.Automaton()
        for p, at in where.items():
            self.automaton.add_word(p, (len(p), at))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item id, distance) of the items of the block found in the text."""
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (n, at) in self.automaton.iter(text):
            for no, a in at:
                starts[no].add(end + 1 - n - a)  # where the item would begin
        out = []
        for no, begins in starts.items():
            item, t, e = self.items[no]
            best, upto = e + 1, -1
            for s in sorted(begins):
                lo, hi = max(0, s - e), min(len(text), s + len(t) + e)
                if hi <= upto:
                    continue  # inside what was compared last
                upto = hi
                if text[max(s, 0):s + len(t)] == t:
                    best = 0
                    break
                # begins that lie close are compared in one stretch
                best = min(best, myers(t, text[lo:hi])[0])
            if best <= e:
                out.append((item, best))
        return sorted(out)


_MATCHERS: dict = {}


def _matching(items: list[tuple[int, str]], chars_per_error: int, token: str):
    def run(batches):
        if token not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[token] = Matcher(items, chars_per_error)
        m = _MATCHERS[token]
        for batch in batches:
            for b in steps(batch):
                found = [m.find(normal(t)) if t else [] for t in b.column("text").to_pylist()]
                ids = [x + [i for i, _ in f] for x, f in zip(b.column(ITEMS).to_pylist(), found)]
                dist = [x + [d for _, d in f] for x, f in zip(b.column(DISTANCES).to_pylist(), found)]
                cols = [pa.array(ids, pa.list_(pa.int64())) if n == ITEMS else pa.array(dist, pa.list_(pa.int32())) if n == DISTANCES else b.column(n) for n in b.schema.names]
                yield pa.RecordBatch.from_arrays(cols, b.schema.names)
    return run


def item_blocks(benchmark: DataFrame, most: int = BLOCK_CHARS):
    """Blocks of (item id, normalised text) of at most ``most`` characters (or
    one item); the driver holds one block at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        t = normal(r["text"])
        if t:
            if block and size + len(t) > most:
                yield block
                block, size = [], 0
            block.append((r["item_id"], t))
            size += len(t)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """The documents with two more columns, ITEMS and DISTANCES: the items they
    hold and how far each is from its passage."""
    d = docs.withColumn(ITEMS, F.array().cast("array<bigint>")).withColumn(DISTANCES, F.array().cast("array<int>"))
    schema = d.schema
    for block in item_blocks(benchmark):
        d = mapped(d, _matching(block, chars_per_error, uuid.uuid4().hex), schema)
    return d


def decontaminate(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """doc_id, n_items, item_ids, min_distance, contaminated of every document."""
    m = matches(docs.select("doc_id", "text"), benchmark, chars_per_error)
    return m.select("doc_id", F.size(ITEMS).cast("long").alias("n_items"), F.array_sort(ITEMS).alias("item_ids"),
                    F.array_min(DISTANCES).alias("min_distance"), (F.size(ITEMS) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """The documents that hold no item, all columns as they are."""
    return matches(docs, benchmark, chars_per_error).where(F.size(ITEMS) == 0).drop(ITEMS, DISTANCES)


@query("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
