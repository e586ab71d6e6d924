"""Operator 6: repeated 50-word passages by relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed by anchors: of every 25 neighbouring
26-word grams the one with the smallest hash. A 50-word window holds 25 such
grams, so two equal windows hold the same anchor, and windows whose anchor no
other document has need no look. The index is dealt by anchor hash; each of its
blocks names, for an anchor, the first document that has it and the place.

A document is then parsed from left to right. A factor goes on as long as its
anchors point to one reference document at one distance; anchors are at most 25
words apart and 26 long, so their hashes cover every word of the factor and a
factor of 50 words or more is a duplicate without further checks. At factor
boundaries, where a window belongs to no single factor, each window is looked
up itself: its hash meets those of the other boundary windows and of first
occurrences. (The first document with a window has it in no factor, so it is
always among them.)

Defined results: null text has no words; fewer than 50 words lose nothing; a
null id stands behind every other; rows with one id are no references of each
other, repeated rows are cut alike; an empty table gives no rows; extra columns
are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import (
    WORD, documents, mapped, merged, minimizers, rolling, saved, span_hashes, steps, text_bytes, word_bounds, words_of,
)
from threadlens.llm.registry import query
from threadlens.llm.rows import keyed

WINDOW = 50
NEAR = 25                # anchors are the smallest of so many neighbouring grams
GRAM = WINDOW - NEAR + 1


def _documents(batch):
    """(row, word hashes) of the documents of a batch that have a window."""
    for b in steps(batch):
        buf, offs = text_bytes(b.column("text"))
        starts, ends, at = word_bounds(buf, offs)
        h = span_hashes(buf, starts, ends)
        for i in range(b.num_rows):
            yield b, i, h[at[i]:at[i + 1]], (buf, starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]])


def _anchors(batches):
    for batch in batches:
        ids, keys = batch.column("oid").to_numpy(zero_copy_only=False), batch.column("key").to_numpy(zero_copy_only=False)
        out, row = ([], [], []), -1
        for _, _, h, _ in _documents(batch):
            row += 1
            if len(h) >= WINDOW:
                g = rolling(h, GRAM)
                p = np.unique(minimizers(g, NEAR))
                for x, y in zip(out, (g[p].view(np.int64), p, np.full(len(p), row))):
                    x.append(y)
        if out[0]:
            h, p, r = (np.concatenate(x) for x in out)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[r]), pa.array(keys[r]), pa.array(p.astype(np.int32))], ["h", "oid", "key", "pos"])


_OUT = pa.schema([("oid", pa.int64()), ("key", pa.int64()), ("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("text", pa.string())])


def _rows(oid, key, h, a, b, text=None):
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, oid)), pa.array(np.full(n, key)), pa.nulls(n, pa.int64()) if h is None else pa.array(h.view(np.int64)),
         pa.array(np.asarray(a, np.int32)), pa.nulls(n, pa.int32()) if b is None else pa.array(np.asarray(b, np.int32)),
         pa.nulls(n, pa.string()) if text is None else pa.array([text])], schema=_OUT)


def factors(oid: int, pos: np.ndarray, ref: np.ndarray, ref_pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans of the greedy factors, from a document's anchors in order
    and the index entries (first document, place) they point to."""
    go_on = (np.diff(pos) <= NEAR) & (ref[1:] == ref[:-1]) & (np.diff(ref_pos) == np.diff(pos))
    first = np.flatnonzero(np.concatenate(([True], ~go_on)))
    last = np.concatenate((first[1:] - 1, [len(pos) - 1]))
    a, b = pos[first], pos[last] + GRAM
    long_ = (ref[first] < oid) & (b - a >= WINDOW)
    return a[long_], b[long_]


def _parse(batches):
    """A document and its repeated anchors -> its long factors (a, b), the
    windows to look up (h, a), and its text if anything may go."""
    for batch in batches:
        hits, row = batch.column("hits"), -1
        for b, i, h, _ in _documents(batch):
            row += 1
            if len(h) < WINDOW:
                continue
            oid, key = b.column("oid")[i].as_py(), b.column("key")[i].as_py()
            found = hits[row].values
            pos, ref, ref_pos = (found.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("pos", "ref", "ref_pos"))
            pos, order = np.unique(pos, return_index=True)
            ref, ref_pos = ref[order], ref_pos[order]
            g = rolling(h, GRAM)
            hit = np.zeros(len(g), bool)
            hit[pos] = True
            look = hit[minimizers(g, NEAR)]  # windows that some other document may have
            a, e = factors(oid, pos, ref, ref_pos)
            for x, y in zip(a, e):
                look[x:y - WINDOW + 1] = False
            if len(a):
                yield _rows(oid, key, None, a, e)
            s = np.flatnonzero(look)
            if len(s):
                yield _rows(oid, key, rolling(h, WINDOW)[s], s, None)
            if (ref < oid).any():
                yield _rows(oid, key, None, [0], None, b.column("text")[i].as_py())


def _cut(batches):
    """A text and its removed word spans -> what is left, digested."""
    for batch in batches:
        out, row = [], -1
        spans = batch.column("spans")
        for b, i, h, (buf, starts, ends) in _documents(batch):
            row += 1
            s = spans[row].values
            keep = np.ones(len(h), bool)
            if s is not None:
                for x, y in zip(*merged(*(s.field(f).to_numpy(zero_copy_only=False) for f in ("a", "b")))):
                    keep[x:y] = False
            lo = int(starts[0]) if len(h) else 0
            raw = buf[lo:int(ends[-1])].tobytes() if len(h) else b""
            kept = b" ".join([raw[x:y] for x, y in zip((starts[keep] - lo).tolist(), (ends[keep] - lo).tolist())])
            out.append((b.column("oid")[i].as_py(), b.column("key")[i].as_py(), int(len(h) - keep.sum()), kept))
        if out:
            o, k, r, t = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(k, pa.int64()), pa.array(r, pa.int64()), pa.array(t, pa.binary()).cast(pa.string()),
                                              pa.array([hashlib.sha256(x).hexdigest() for x in t])], ["oid", "key", "n_removed", "kept_text", "kept_sha256"])


def removed_passages(docs: DataFrame) -> DataFrame:
    """oid, key, n_removed, kept_text, kept_sha256 of the documents that may lose words."""
    d = docs.select("oid", "key", "text")
    anchors = saved(mapped(d, _anchors, "h bigint, oid bigint, key bigint, pos int"), "anchors")
    # stored, so both sides of the join are dealt anew and a frequent anchor can be split
    index = saved(anchors.groupBy("h").agg(F.min(F.struct("oid", "pos")).alias("m"), F.max("oid").alias("last")).where("m.oid < last")
                  .select("h", F.col("m.oid").alias("ref"), F.col("m.pos").alias("ref_pos")), "anchor-index")
    hits = (anchors.join(index, "h").groupBy("oid", "key").agg(F.collect_list(F.struct("pos", "ref", "ref_pos")).alias("hits")))
    parsed = d.join(hits, ["oid", "key"]).mapInArrow(_parse, "oid bigint, key bigint, h bigint, a int, b int, text string")
    parsed = saved(parsed, "factors")
    look = parsed.where("h is not null").select("h", "oid", "key", "a")
    first = saved(look.groupBy("h").agg(F.min("oid").alias("ref"), F.max("oid").alias("last")).where("ref < last").select("h", "ref"), "window-index")
    windows = look.join(first, "h").where("ref < oid").select("oid", "key", "a", (F.col("a") + WINDOW).alias("b"))
    spans = (parsed.where("b is not null").select("oid", "key", "a", "b").unionByName(windows)
             .groupBy("oid", "key").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    texts = parsed.where("text is not null").select("oid", "key", "text").dropDuplicates(["oid", "key"])
    return texts.join(spans, ["oid", "key"]).mapInArrow(_cut, "oid bigint, key bigint, n_removed bigint, kept_text string, kept_sha256 string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    d = keyed(docs)
    cut = removed_passages(d).select("oid", "key", "n_removed", F.col("kept_sha256").alias("_sha"))
    whole = d.select("doc_id", "oid", "key", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
                     F.sha2(F.concat_ws(" ", words_of(F.col("text"))).cast("binary"), 256).alias("_whole"))
    return whole.join(cut, ["oid", "key"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("_sha", "_whole").alias("kept_sha256"))


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))
