"""Operator 3: token counts by overlap resynchronisation.

Documents up to CHUNK characters are encoded where they stand. Longer ones
are cut into chunks that overlap; the chunks are rows of their own, spread
over all tasks, and each is encoded with offsets. Two neighbours are spliced
at a boundary that both encodings share: the pre-tokenizer reads from left to
right and forgets what lies behind a pre-token, so from a common start of a
pre-token on both see the same text and cut it alike, and the left encoding is
right up to there unless the text's end (MARGIN) took part. Documents in which
some pair has no such boundary are cut again with wider overlaps and longer
chunks, at last in one piece.

Short documents are cut at single spaces between printable characters, which
is always a pre-token's start, and equal pieces of a batch are encoded once.

Defined results: null text has 0 bytes and 0 tokens; special strings inside
texts are the library's own default (one token); repeated rows are counted
each on its own; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import documents, mapped, saved, steps
from threadlens.llm.registry import query

TOKENIZER = "byte_bpe_50k.json"
CHUNK, OVERLAP = 32_768, 1_024  # characters
MARGIN = 16                     # longer than any special string and the one character of look-ahead
LIMIT = 1024                    # over_limit: more tokens than this
CACHE = 400_000                 # pieces a worker remembers

_LOADED: dict = {}


def tokenizer(name: str):
    """The public tokenizer of that file name (or path), loaded once a worker."""
    if name not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        _LOADED[name] = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
    return _LOADED[name]


def _plain(c: str) -> bool:
    """Surely not white space in any definition."""
    return "!" <= c <= "~" or c.isalnum()


def _pieces(text: str, safe: dict) -> list[str]:
    """The text cut before single spaces between plain characters; every
    piece but the first stands for itself with a space before it."""
    parts = text.split(" ")
    for p in parts:
        if p not in safe:
            safe[p] = bool(p) and _plain(p[0]) and _plain(p[-1])
    if all(map(safe.__getitem__, parts)):
        return parts
    out = [parts[0]]
    for p in parts[1:]:
        if p and _plain(p[0]) and out[-1] and _plain(out[-1][-1]):
            out.append(p)
        else:
            out[-1] += " " + p
    return out


def _count(texts: list[str], tok, cache: dict, safe: dict) -> list[int]:
    cut = [_pieces(t, safe) if t else [] for t in texts]
    new = list({p for ps in cut for p in ps[1:]}.difference(cache))
    for lo in range(0, len(new), 20_000):
        part = new[lo:lo + 20_000]
        cache.update(zip(part, map(len, tok.encode_batch_fast([" " + p for p in part], add_special_tokens=False))))
    firsts = tok.encode_batch_fast([ps[0] if ps else "" for ps in cut], add_special_tokens=False)
    out = [len(f) + sum(map(cache.__getitem__, ps[1:])) for f, ps in zip(firsts, cut)]
    if len(cache) > CACHE:
        cache.clear()
        safe.clear()
    return out


def _short(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, cache, safe = tokenizer(name), {}, {}
        for batch in batches:
            for b in steps(batch):
                n = _count([t or "" for t in b.column("text").to_pylist()], tok, cache, safe)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Rows (key, doc_id, n_bytes, text) -> overlapping parts."""
    def run(batches):
        for batch in batches:
            for key, doc, size, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "n_bytes", "text"))):
                for part, at in enumerate(range(0, max(1, len(text)), chunk)):
                    last = at + chunk >= len(text)
                    piece = text[at:] if last else text[at:at + chunk + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([doc], batch.schema.field("doc_id").type), pa.array([size], pa.int64()), pa.array([part], pa.int64()), pa.array([at], pa.int64()), pa.array([last]), pa.array([piece])],
                        ["key", "doc_id", "n_bytes", "part", "at", "last", "piece"])
    return run


def _encode(name: str, overlap: int):
    """A part -> its tokens, and where pre-tokens start in its first and last
    ``overlap`` characters with the tokens before them."""
    def run(batches):
        tok = tokenizer(name)
        for batch in batches:
            rows = {"n": [], "head_at": [], "head_n": [], "tail_at": [], "tail_n": []}
            for at, last, piece in zip(*(batch.column(c).to_pylist() for c in ("at", "last", "piece"))):
                e = tok.encode(piece, add_special_tokens=False)
                n = len(e)
                starts = np.fromiter((a for a, _ in e.offsets), np.int64, n)
                word = np.fromiter((-1 if w is None else w for w in e.word_ids), np.int64, n)
                first = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), word[1:] != word[:-1])))
                pos = starts[first]
                head = pos < overlap if at else np.zeros(len(pos), bool)
                tail = (pos >= len(piece) - overlap) & (pos <= len(piece) - MARGIN) if not last else np.zeros(len(pos), bool)
                rows["n"].append(n)
                for k, m in (("head", head), ("tail", tail)):
                    rows[k + "_at"].append((pos[m] + at).tolist())
                    rows[k + "_n"].append(first[m].tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "doc_id", "n_bytes", "part")] + [pa.array(rows["n"], pa.int64())] + [pa.array(rows[k], longs) for k in ("head_at", "head_n", "tail_at", "tail_n")],
                ["key", "doc_id", "n_bytes", "part", "n", "head_at", "head_n", "tail_at", "tail_n"])
    return run


def _with_keys(batches):
    from pyspark import TaskContext

    no, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        keys = pa.array([f"{task}-{no + i}" for i in range(batch.num_rows)], pa.string())
        no += batch.num_rows
        yield pa.RecordBatch.from_arrays([keys, *batch.columns], ["key", *batch.schema.names])


def long_counts(rows: DataFrame, name: str, chunk: int, overlap: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens of documents longer than a chunk. ``rows``:
    doc_id, n_bytes, text."""
    spark = rows.sparkSession
    id_type = rows.schema["doc_id"].dataType.simpleString()
    left = saved(mapped(rows, _with_keys, f"key string, doc_id {id_type}, n_bytes bigint, text string"), "token-texts")
    done = None
    while True:
        parts = left.mapInArrow(_cut(chunk, overlap), f"key string, doc_id {id_type}, n_bytes bigint, part bigint, at bigint, last boolean, piece string")
        coded = saved(parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "part").mapInArrow(
            _encode(name, overlap),
            f"key string, doc_id {id_type}, n_bytes bigint, part bigint, n bigint, head_at array<bigint>, head_n array<bigint>, tail_at array<bigint>, tail_n array<bigint>"), "token-parts")
        a = coded.select("key", "part", "tail_at", "tail_n")
        b = coded.select("key", (F.col("part") - 1).alias("part"), "head_at", "head_n")
        cut = F.array_min(F.array_intersect("tail_at", "head_at"))
        pairs = a.join(b, ["key", "part"]).select("key", "part", "tail_at", "tail_n", "head_at", "head_n", cut.alias("cut"))
        # tokens of the left part behind the cut and of the right part before it are dropped
        at = lambda x, n: F.get(n, F.array_position(x, F.col("cut")).cast("int") - 1)
        pairs = saved(pairs.select("key", "part", F.col("cut").isNull().alias("failed"), at("tail_at", F.col("tail_n")).alias("keep"), at("head_at", F.col("head_n")).alias("skip")), "token-splices")
        ends = coded.select("key", "doc_id", "n_bytes", "part", "n").join(pairs.select("key", "part", "failed", "keep"), ["key", "part"], "left")
        skips = pairs.select("key", (-F.col("skip")).alias("t"))
        whole = ends.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
                                        F.sum(F.coalesce("keep", "n")).alias("t"), F.max(F.coalesce("failed", F.lit(False))).alias("failed"))
        whole = whole.join(skips.groupBy("key").agg(F.sum("t").alias("s")), "key", "left")
        ok = whole.where(~F.col("failed")).select("doc_id", "n_bytes", (F.col("t") + F.coalesce("s", F.lit(0))).alias("n_tokens"))
        done = ok if done is None else done.unionByName(ok)
        failed = pairs.where("failed").select("key").distinct()
        if not failed.limit(1).count():
            return done
        left = left.join(failed, "key", "left_semi")
        overlap *= 8
        chunk = max(chunk, 4 * overlap)


def token_counts(docs: DataFrame, name: str = TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document."""
    d = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce("text", F.lit("")).alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    short = mapped(d.where(F.length("text") <= chunk), _short(name), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return short.unionByName(long_counts(d.where(F.length("text") > chunk), name, chunk, overlap))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > LIMIT)
