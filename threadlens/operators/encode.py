"""Sequence encoding.

Tokens are those of the processed text (blank/newline separated). The
vocabulary is built from the corpus (pretrained word-piece vocabularies are
not part of this library): token counts -> top-k -> ids from 4, with
[PAD] 0, [UNK] 1, [CLS] 2, [SEP] 3.

A vocabulary of at most MAX_SENT_VOCAB rows is sent to the
tasks, and a vectorised function looks the tokens up where they stand: no
token is exploded or shuffled. A larger one is joined, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.session import materialize, ship_package

MAX_SENT_VOCAB = 1_000_000
MAX_NAMED, MAX_TRACKED = 100_000, 1_000_000  # the most a frequent-items sketch names and keeps (Spark's limits)


def text_tokens(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(F.coalesce(c, F.lit("")), "[ \n]+"), lambda x: x != F.lit(""))


def all_tokens(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """(token): a row for every token of the text columns."""
    toks = None
    for c in text_cols:
        t = df.select(F.explode(text_tokens(c)).alias("token"))
        toks = t if toks is None else toks.unionByName(t)
    return toks


def heavy_hitters(tokens: DataFrame, size: int, named: int | None = None, tracked: int | None = None) -> DataFrame:
    """(token, n) of at least the ``size`` most frequent tokens, counted
    exactly, without a shuffle of all distinct tokens.

    Each task keeps a frequent-items sketch; the merged one names candidates,
    and only these (sent to the tasks, at most ``MAX_NAMED``) are counted. A
    token that is not named occurs at most as often as the last one named, or
    as twice the sketch's error (3.5 / counters kept, of all tokens). So the
    result holds if the ``size``-th exact count is above both, or if the named
    tokens are all there are (their counts add up to the whole). If neither can
    be shown the sketch is widened fourfold, and beyond Spark's limits all
    tokens are counted."""
    named, tracked = named or 2 * size, tracked or max(8 * size, 1 << 13)
    while named <= MAX_NAMED and tracked <= MAX_TRACKED:
        sketch = materialize(tokens.agg(F.count(F.lit(1)).alias("all"), F.expr(f"approx_top_k(token, {int(named)}, {int(tracked)})").alias("top")), "sketch")
        found = sketch.select("all", F.size("top").alias("k"), F.coalesce(F.array_min(F.transform("top", lambda x: x["count"])), F.lit(0)).alias("least")).first()
        names = sketch.select(F.explode("top.item").alias("token"))
        counts = materialize(tokens.join(F.broadcast(names), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "candidates")
        unnamed = max(found["least"] if found["k"] >= named else 0, -(-7 * found["all"] // tracked))
        last = counts.orderBy(F.desc("n")).limit(size).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).first()
        if (last["k"] == size and last["n"] > unnamed) or (counts.agg(F.sum("n")).first()[0] or 0) == found["all"]:
            return counts
        named, tracked = 4 * named, 4 * tracked
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(df: DataFrame, text_cols: Sequence[str], size: int = L.DEFAULT_VOCAB_SIZE, sketch: bool = False) -> DataFrame:
    """(token, token_id, n) for the ``size`` most frequent tokens (ties
    by token). Counting is a partial aggregation; the cut is a top-k. With
    ``sketch`` only likely tokens are counted (``heavy_hitters``): the same
    rows, for corpora whose distinct tokens are far more than the vocabulary,
    at the price of reading the texts twice."""
    toks = all_tokens(df, text_cols)
    counts = heavy_hitters(toks, size) if sketch else toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("token")).limit(size)
    # at most `size` rows from here on: numbering them in one window is bounded
    w = Window.orderBy(F.desc("n"), F.asc("token"))
    return top.select("token", (F.row_number().over(w) - 1 + L.FIRST_TOKEN_ID).cast("int").alias("token_id"), "n")


def _looked_up(ids: dict[str, int]):
    """A vectorised ARRAY<STRING> -> ARRAY<INT> look-up."""
    @F.arrow_udf("array<int>")
    def look(tokens: pa.Array) -> pa.Array:
        flat = tokens.flatten()
        enc = pc.dictionary_encode(flat) if len(flat) else None
        if enc is None:
            got = pa.array([], pa.int32())
        else:
            values = pa.array([ids.get(t, L.UNK_ID) for t in enc.dictionary.to_pylist()], pa.int32())
            got = values.take(enc.indices)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, got)

    return look


def encode_texts(df: DataFrame, key_cols: Sequence[str], texts: dict[str, str], vocab: DataFrame,
                 most: int = MAX_SENT_VOCAB) -> DataFrame:
    """E2 for several text columns at once; ``texts`` maps output -> input.
    Unknown tokens are [UNK]; a text without tokens is an empty array. The key
    columns must be unique where the vocabulary is joined."""
    key_cols = list(key_cols)
    outs = list(texts)
    v = vocab.select("token", "token_id")
    rows = v.limit(most + 1).collect()
    if len(rows) <= most:
        ship_package(df.sparkSession)
        look = _looked_up({r["token"]: r["token_id"] for r in rows})
        return df.select("*", *[look(text_tokens(texts[o])).alias(o) for o in outs])

    def tag(j):
        return lambda t, i: F.struct(F.lit(j).alias("w"), i.alias("p"), t.alias("token"))

    def of(j):
        return lambda s: s["w"] == j

    parts = [F.transform(text_tokens(texts[o]), tag(j)) for j, o in enumerate(outs)]
    ex = df.select(*key_cols, F.explode(F.concat(*parts)).alias("_e")) \
        .select(*key_cols, "_e.w", "_e.p", "_e.token")
    j = ex.join(v, "token", "left").withColumn("token_id", F.coalesce("token_id", F.lit(L.UNK_ID)))
    g = j.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct("w", "p", "token_id"))).alias("_s"))
    g = g.select(*key_cols, *[F.transform(F.filter("_s", of(j)), lambda s: s["token_id"]).alias(o)
                              for j, o in enumerate(outs)])
    out = df.join(g, key_cols, "left")
    for o in outs:
        out = out.withColumn(o, F.coalesce(F.col(o), F.array().cast("array<int>")))
    return out


def encode(df: DataFrame, key_cols: Sequence[str], text_col: str, vocab: DataFrame, out: str,
           most: int = MAX_SENT_VOCAB) -> DataFrame:
    """Ids of the tokens of ``text_col`` as ``(key_cols..., out ARRAY<INT>)``."""
    return encode_texts(df.select(*key_cols, text_col), key_cols, {out: text_col}, vocab, most).select(*key_cols, out)


def segments(a, b) -> Column:
    """[CLS] a [SEP] b [SEP]."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.concat(F.array(F.lit(L.CLS_ID)), a, F.array(F.lit(L.SEP_ID)), b, F.array(F.lit(L.SEP_ID)))


def truncate(df: DataFrame, a: str, b: str, max_length: int = L.DEFAULT_MAX_LENGTH) -> DataFrame:
    """Budget L = max_length - 3 (the specials are then counted again);
    over budget -> cut A to L//2; still over -> cut B to L//2."""
    budget = max_length - 3
    half = budget // 2
    total = F.size(a) + F.size(b) + 3
    a2 = F.when(total > budget, F.slice(a, 1, half)).otherwise(F.col(a))
    df = df.withColumn(a, a2)
    total2 = F.size(a) + F.size(b) + 3
    return df.withColumn(b, F.when(total2 > budget, F.slice(b, 1, half)).otherwise(F.col(b)))


def masks(a, b) -> tuple[Column, Column]:
    """E5: segment ids (0 x (|A|+2), 1 x (|B|+1)) and the all-ones mask."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    type_mask = F.concat(F.array_repeat(F.lit(0), F.size(a) + 2), F.array_repeat(F.lit(1), F.size(b) + 1))
    input_mask = F.array_repeat(F.lit(1), F.size(a) + F.size(b) + 3)
    return type_mask, input_mask


def encode_examples(examples: DataFrame, vocab: DataFrame, max_length: int = L.DEFAULT_MAX_LENGTH) -> DataFrame:
    """Text ids, type mask and input mask per example."""
    e = encode_texts(examples, ["fold", "id"],
                     {"_b": "clean_text", "_p": "clean_text_prev", "_s": "clean_text_src"}, vocab)
    e = e.withColumn("_a", F.concat("_s", "_p"))
    e = truncate(e, "_a", "_b", max_length)
    tm, im = masks("_a", "_b")
    return e.select(*[c for c in examples.columns],
                    segments("_a", "_b").alias("text"), tm.alias("type_mask"), im.alias("input_mask"))


MODEL_FEATURES = ["hasqmark", "hasemark", "hashashtag", "hasurl", "haspic", "hasnegation",
                  "hasswearwords", "src_rumour", "thread_rumour"]


def select_features(df: DataFrame, with_features: bool = True) -> DataFrame:
    """The nine numeric features as DOUBLE (optional)."""
    if not with_features:
        return df.drop(*MODEL_FEATURES)
    return df.select(*[F.col(c).cast("double").alias(c) if c in MODEL_FEATURES else F.col(c)
                       for c in df.columns])
