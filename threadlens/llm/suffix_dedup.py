"""Operator 5: repeated 200-byte strings by two-stage suffix sorting.

Suffixes meet those they may be equal to before they are sorted: a 200-byte
window is dealt by its anchor, the smallest hash among its 161 40-byte grams,
so equal windows have the same anchor. Anchors that occur once in the whole
corpus are dropped; around the others the text is cut into segments, one for
each stretch of windows with one anchor. Equal segments become one with a
count, and a segment that occurs twice is repeated in full. What is left is
sorted, anchor by anchor, in blocks:

1. the suffixes smaller than their successors are sorted directly, by their
   first 200 bytes;
2. the others are induced: buckets (first bytes) are scanned in order, and
   each suffix found puts its predecessor, if that is larger, into the next
   free place of its own bucket;
3. neighbours whose common prefix reaches 200 bytes are repeated.

An anchor with more than HOT distinct segments is dealt anew by the place of
its windows beside it, which equal windows also share, and then by the whole
window, so no task gathers an unbounded group.

Defined results: null text has no bytes; texts under 200 bytes lose nothing;
repeated rows repeat each other; an empty table gives no rows; extra columns
are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import documents, mapped, merged, minimizers, rolling, runs, saved, steps, text_bytes
from threadlens.llm.registry import query
from threadlens.llm.rows import keyed

WINDOW = 200
GRAM = 40
NEAR = WINDOW - GRAM + 1
BLOCK = 1 << 20   # bytes of text sorted at a time
HOT = 20_000      # distinct segments of one anchor that one block takes
STOP = 0xFF       # between segments; never a byte of UTF-8
PIECE = 8 << 20   # bytes of one text scanned at a time

_VALUE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def window_anchors(raw: np.ndarray):
    """Stretches of windows with one anchor hash: (hash, first window, last
    window + 1, first anchor, number of its places), in order."""
    n = len(raw)
    if n < WINDOW:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, z
    hs, ats = [], []
    for lo in range(0, n - WINDOW + 1, PIECE):  # windows [lo, lo + PIECE)
        part = raw[lo:lo + PIECE + WINDOW - 1]
        g = rolling(_VALUE[part], GRAM)
        at = minimizers(g, NEAR)
        hs.append(g[at])
        ats.append(at + lo)
    h, at = np.concatenate(hs), np.concatenate(ats)
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    new_place = np.concatenate(([True], at[1:] != at[:-1]))
    return h[first], first, np.concatenate((first[1:], [len(h)])), at[first], np.add.reduceat(new_place.astype(np.int64), first)


def _texts(batch):
    for b in steps(batch):
        buf, offs = text_bytes(b.column("text"))
        for i in range(b.num_rows):
            yield b, i, buf[offs[i]:offs[i + 1]]


def _anchors(batches):
    for batch in batches:
        out, row = ([], [], []), -1
        for _, _, raw in _texts(batch):
            row += 1
            h, _, _, _, places = window_anchors(raw)
            u, inv = np.unique(h, return_inverse=True)
            if len(u):
                for x, y in zip(out, (u.view(np.int64), np.bincount(inv, places).astype(np.int32), np.full(len(u), row))):
                    x.append(y)
        if out[0]:
            h, c, r = (np.concatenate(x) for x in out)
            ids, keys = batch.column("oid").to_numpy(zero_copy_only=False), batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[r]), pa.array(keys[r]), pa.array(c)], ["h", "oid", "key", "n"])


_SEGMENT = "oid bigint, key bigint, h bigint, sid binary, at int, anchor int, piece binary, text string"
_SEG_NAMES = ["oid", "key", "h", "sid", "at", "anchor", "piece", "text"]


def _segments(batches):
    """A document and its repeated anchors -> its segments, and its text."""
    for batch in batches:
        hits, row = batch.column("hits"), -1
        for b, i, raw in _texts(batch):
            row += 1
            h, a, e, at, _ = window_anchors(raw)
            known = np.unique(hits[row].values.to_numpy(zero_copy_only=False).view(np.uint64))
            pick = np.flatnonzero(np.isin(h, known))
            whole = raw.tobytes()
            pieces = [whole[x:y + WINDOW - 1] for x, y in zip(a[pick].tolist(), e[pick].tolist())]
            n = len(pick)
            oid, key = b.column("oid")[i].as_py(), b.column("key")[i].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + 1, oid)), pa.array(np.full(n + 1, key)), pa.array([*h[pick].view(np.int64).tolist(), None], pa.int64()),
                 pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in pieces] + [None], pa.binary()), pa.array([*a[pick].tolist(), None], pa.int32()),
                 pa.array([*(at - a)[pick].tolist(), None], pa.int32()), pa.array([*pieces, None], pa.binary()), pa.array([None] * n + [whole], pa.binary()).cast(pa.string())], _SEG_NAMES)


def two_stage(text: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """All suffixes of a byte text in the order of their first ``depth`` bytes
    (the order among equal ones is open)."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    t = text.astype(np.int16)
    nxt = np.append(t[1:], -1)
    # a suffix is smaller than its successor if its first byte is, or, in a run of one byte, what follows the run is larger
    change = np.flatnonzero(t != nxt)
    up = np.repeat(t[change] < nxt[change], np.diff(np.concatenate(([-1], change))))
    small = np.flatnonzero(up)
    # stage 1: direct sort by the first bytes
    padded = np.concatenate((text, np.zeros(depth, np.uint8)))
    heads = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[small]).view(f"S{depth}").ravel()
    order = small[np.argsort(heads, kind="stable")]
    # stage 2: scan the buckets in order of their byte; larger suffixes come first in theirs
    first_small = np.searchsorted(t[order], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not up[n - 1]:
        waiting[t[n - 1]].append(np.array([n - 1]))  # behind the last suffix stands the empty one, the smallest
    out = []

    def induce(found: np.ndarray, c: int) -> np.ndarray:
        """Puts the larger predecessors of found suffixes (in order) into
        their buckets; those of bucket c are handed back."""
        prev = found[found > 0] - 1
        prev = prev[~up[prev]]
        b = t[prev]
        prev = prev[np.argsort(b, kind="stable")]
        b = np.sort(b, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else []
        own = prev[:0]
        for x, y in zip(cuts, [*cuts[1:], len(b)]):
            if b[x] == c:
                own = prev[x:y]
            else:
                waiting[b[x]].append(prev[x:y])
        return own

    for c in range(256):
        part = np.concatenate(waiting[c]) if waiting[c] else small[:0]
        while len(part):  # a run of c's is induced from within its own bucket
            out.append(part)
            part = induce(part, c)
        part = order[first_small[c]:first_small[c + 1]]
        if len(part):
            out.append(part)
            induce(part, c)
    return np.concatenate(out)


def common_prefix_at_least(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Whether the suffixes a and b share their first ``depth`` bytes (which
    both have)."""
    same = np.ones(len(a), bool)
    i = np.arange(len(a))
    for k in range(0, depth, 8):
        w = min(8, depth - k)
        eq = np.ones(len(i), bool)
        for j in range(w):
            eq &= text[a[i] + k + j] == text[b[i] + k + j]
        same[i[~eq]] = False
        i = i[eq]
        if not len(i):
            break
    return same


def repeated_windows(pieces: list[bytes]) -> list[np.ndarray]:
    """Per piece the flags of its windows that also start elsewhere in the pieces."""
    text = np.frombuffer(bytes([STOP]).join(pieces) + bytes([STOP]), np.uint8)
    lens = np.array([len(p) for p in pieces])
    at = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    whole = np.zeros(len(text), bool)
    for x, n in zip(at.tolist(), lens.tolist()):
        whole[x:max(x, x + n - WINDOW + 1)] = True
    sa = two_stage(text)
    sa = sa[whole[sa]]
    twice = np.zeros(len(text), bool)
    if len(sa) > 1:
        eq = common_prefix_at_least(text, sa[:-1], sa[1:])
        twice[sa[:-1][eq]] = True
        twice[sa[1:][eq]] = True
    return [twice[x:max(x, x + n - WINDOW + 1)] for x, n in zip(at.tolist(), lens.tolist())]


def _sorted_blocks(batches):
    """Distinct segments in order of their anchor -> (sid, a, b): the windows
    that are repeated. Anchors are never split between two blocks."""
    def solve(rows):
        sids, al, bl = [], [], []
        counts = [c for _, _, c, _ in rows]
        by_h: dict = {}
        for i, (h, *_ ) in enumerate(rows):
            by_h.setdefault(h, []).append(i)
        unsure = [i for ix in by_h.values() if any(counts[i] == 1 for i in ix) for i in ix]
        flags = dict(zip(unsure, repeated_windows([rows[i][3] for i in unsure]))) if unsure else {}
        for i, (_, sid, c, piece) in enumerate(rows):
            if c > 1:
                x, y = [0], [len(piece) - WINDOW + 1]
            else:
                x, y = runs(flags[i])
            sids += [sid] * len(x)
            al += list(x)
            bl += list(y)
        return pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array(al, pa.int32()), pa.array(bl, pa.int32())], ["sid", "a", "b"])

    rows, size, last = [], 0, None
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("h", "sid", "c", "piece"))):
            if size >= BLOCK and r[0] != last:
                yield solve(rows)
                rows, size = [], 0
            rows.append(r)
            size += len(r[3])
            last = r[0]
    if rows:
        yield solve(rows)


def _windows(batches):
    """Segments of hot anchors -> their windows one by one, each with a digest
    (of the 200 bytes) by which equal ones meet."""
    for batch in batches:
        for sid, c, piece in zip(*(batch.column(x).to_pylist() for x in ("sid", "c", "piece"))):
            n = len(piece) - WINDOW + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(piece[i:i + WINDOW], digest_size=16).digest() for i in range(n)], pa.binary()), pa.array([sid] * n, pa.binary()),
                 pa.array(range(n), pa.int32()), pa.array([c] * n, pa.int64())], ["w", "sid", "a", "c"])


def _cut(batches):
    for batch in batches:
        out, row = [], -1
        spans = batch.column("spans")
        for b, i, raw in _texts(batch):
            row += 1
            s = spans[row].values
            a, e = merged(*(s.field(f).to_numpy(zero_copy_only=False) for f in ("a", "b")))
            keep = np.ones(len(raw), bool)
            for x, y in zip(a, e):
                keep[x:y] = False
            kept = raw[keep].tobytes()
            out.append((b.column("oid")[i].as_py(), b.column("key")[i].as_py(), int(len(raw) - keep.sum()), len(a), kept, hashlib.sha256(kept).hexdigest()))
        if out:
            o, k, r, n, t, h = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(k, pa.int64()), pa.array(r, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.binary()), pa.array(h)],
                                             ["oid", "key", "n_removed", "n_spans", "kept", "kept_sha256"])


def repeated_spans(segs: DataFrame, hot: int = HOT) -> DataFrame:
    """(sid, a, b): repeated windows [a, b) of each distinct segment."""
    spark = segs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = saved(segs.groupBy("h", "sid").agg(F.count("*").alias("c"), F.first("piece").alias("piece")), "segments-distinct")
    crowded = saved(distinct.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("h"), "anchors-hot")
    calm = distinct.join(crowded, "h", "left_anti")
    spans = "sid binary, a int, b int"
    done = calm.repartition(n, "h").sortWithinPartitions("h").mapInArrow(_sorted_blocks, spans)
    # hot anchors: windows one by one, counted by digest; equal windows share anchor and digest
    w = distinct.join(crowded, "h", "left_semi").mapInArrow(_windows, "w binary, sid binary, a int, c bigint")
    twice = w.groupBy("w").agg(F.sum("c").alias("n")).where("n > 1").select("w")
    return done.unionByName(w.join(twice, "w").select("sid", "a", (F.col("a") + 1).alias("b")))


def removed_strings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """oid, key, n_removed, n_spans, kept, kept_sha256 of documents that lose bytes."""
    d = docs.select("oid", "key", "text")
    anchors = saved(mapped(d, _anchors, "h bigint, oid bigint, key bigint, n int"), "anchors")
    # stored, so both sides of the join are dealt anew and a frequent anchor can be split
    index = saved(anchors.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "anchor-index")
    hits = anchors.join(index, "h").groupBy("oid", "key").agg(F.collect_list("h").alias("hits"))
    segs = saved(d.join(hits, ["oid", "key"]).mapInArrow(_segments, _SEGMENT), "segments")
    pieces = segs.where("h is not null")
    found = saved(repeated_spans(pieces.select("h", "sid", "piece"), hot), "repeated")
    spans = (pieces.select("oid", "key", "sid", "at").join(found, "sid")
             .select("oid", "key", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b") + (WINDOW - 1)).alias("b"))
             .groupBy("oid", "key").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    texts = segs.where("text is not null").select("oid", "key", "text").dropDuplicates(["oid", "key"])
    return texts.join(spans, ["oid", "key"]).mapInArrow(_cut, "oid bigint, key bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")


def suffix_dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    d = keyed(docs)
    cut = removed_strings(d, hot).select("oid", "key", "n_removed", "n_spans", F.col("kept_sha256").alias("_sha"))
    whole = d.select("doc_id", "oid", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("_whole"))
    return whole.join(cut, ["oid", "key"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("_sha", "_whole").alias("kept_sha256"))


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))
