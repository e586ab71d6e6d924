"""Per-post feature table.

All flags are column expressions evaluated in one projection (no shuffle);
the thread flag (F11) needs one per-conversation aggregate joined back — an
aggregate, not a window, so map-side combine applies and AQE can split a hot
conversation on the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.functions.entities import entity_vector
from threadlens.session import materialize

FEATURE_FLAGS = ["hasqmark", "hasemark", "hashashtag", "hasurl", "haspic",
                 "hasnegation", "hasswearwords", "src_rumour", "thread_rumour"]


def one_post(posts: DataFrame, key_cols: Sequence[str] = ("conv_id", "post_id"),
             order_cols: Sequence[str] = ("file_path", "line_no")) -> DataFrame:
    """One row per post: the source before a reply, then the last by
    ``order_cols`` (those the table has), ties by the other columns. An
    aggregate, so a post repeated very often never gathers in one task."""
    keys = list(key_cols)
    first = [c for c in ("is_source", *order_cols) if c in posts.columns and c not in keys]
    rest = [c for c in posts.columns if c not in keys and c not in first]
    m = F.max(F.struct(*first, *rest)).alias("_m")
    return posts.groupBy(*keys).agg(m).select(*[F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in posts.columns])


def lexicon_hits_join(df: DataFrame, tokens_col: str, lexicon: DataFrame, out: str,
                      key_cols: Sequence[str]) -> DataFrame:
    """F9 for a lexicon too large for a literal: explode tokens, join the
    lexicon table, count per post, join back (0 when none)."""
    lex = lexicon.select(F.col(lexicon.columns[0]).alias("_tok")).distinct()
    ex = df.select(*key_cols, F.explode(tokens_col).alias("_tok"))
    hits = ex.join(lex, "_tok").groupBy(*key_cols).agg(F.count(F.lit(1)).cast("int").alias(out))
    return df.join(hits, list(key_cols), "left").withColumn(out, F.coalesce(out, F.lit(0)))


def phrase_table(gazetteer: DataFrame) -> DataFrame:
    """(first, len, gram, cls) of a gazetteer (phrase, entity): its tokens
    lower-cased and joined by blanks; a phrase listed for several classes takes
    the first, one of an unknown class or without a token is left out."""
    ids = F.create_map(*[x for i, c in enumerate(L.ENTITY_CLASSES) for x in (F.lit(c), F.lit(i))])
    toks = F.regexp_extract_all(F.lower(F.col(gazetteer.columns[0])), F.lit(TX.R5_TOKEN), 0)
    rows = gazetteer.select(toks.alias("_t"), F.try_element_at(ids, F.col(gazetteer.columns[1])).alias("_cls")).where("_cls is not null and size(_t) > 0")
    rows = rows.select(F.element_at("_t", 1).alias("first"), F.size("_t").alias("len"), F.array_join("_t", " ").alias("gram"), "_cls")
    return rows.groupBy("first", "len", "gram").agg(F.min("_cls").alias("cls"))


def _spans(matches):
    """Leftmost-longest, non-overlapping of (p, -len, cls) in order: an array of (p, len, cls)."""
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<p:int,len:int,cls:int>>").alias("got"))

    def step(acc, m):
        took = F.struct((m["p"] - m["neg"]).alias("next"), F.concat(acc["got"], F.array(F.struct(m["p"].alias("p"), (-m["neg"]).alias("len"), m["cls"].alias("cls")))).alias("got"))
        return F.when(m["p"] >= acc["next"], took).otherwise(acc)

    return F.aggregate(matches, start, step, lambda acc: acc["got"])


def entity_vector_join(df: DataFrame, sents_col: str, gazetteer: DataFrame, out: str,
                       key_cols: Sequence[str]) -> DataFrame:
    """F18 with the gazetteer as a table (phrase, entity) of any size, by the
    rule of ``functions.entities``. Tokens are rows; those that begin a phrase
    are looked up once for each length their phrases have, with the tokens
    behind them (the window is one sentence); the longest from the left win.
    ``key_cols`` must be unique."""
    keys = list(key_cols)
    gaz = materialize(phrase_table(gazetteer), "gazetteer")
    longest = gaz.agg(F.max("len")).first()[0] or 1
    sent = df.select(*keys, F.posexplode(sents_col).alias("_s", "_a"))
    # the null behind the last token is the sentence's [EOS]
    tok = sent.select(*keys, "_s", F.posexplode(F.concat(TX.lower_tokens("_a"), F.array(F.lit(None).cast("string")))).alias("_p", "_tok"))
    at = [*keys, "_s"]
    w = Window.partitionBy(*at).orderBy("_p")
    ahead = tok.select(*at, "_p", "_tok", *[F.lead("_tok", k).over(w).alias(f"_n{k}") for k in range(1, longest)])
    first = gaz.groupBy(F.col("first").alias("_tok")).agg(F.collect_set("len").alias("_lens"))
    grams = ahead.join(first, "_tok").select(*at, "_p", F.array("_tok", *[f"_n{k}" for k in range(1, longest)]).alias("_w"), F.explode("_lens").alias("len"))
    grams = grams.where(F.col("_w")[F.col("len") - 1].isNotNull()).select(*at, "_p", F.array_join(F.slice("_w", F.lit(1), F.col("len")), " ").alias("gram"), "len")
    hits = grams.join(gaz.select("gram", "cls"), "gram")
    spans = hits.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct(F.col("_p").alias("p"), (-F.col("len")).alias("neg"), "cls"))).alias("_m"))
    spans = spans.select(*at, F.explode(_spans(F.col("_m"))).alias("_x"))
    taken = spans.select(*at, F.explode(F.sequence(F.col("_x.p"), F.col("_x.p") + F.col("_x.len") - 1)).alias("_p"), F.col("_x.cls").alias("_cls"))
    j = tok.join(taken, [*at, "_p"], "left").withColumn(
        "_cls", F.coalesce("_cls", F.when(TX.is_numeral(F.col("_tok")), F.lit(L.ENTITY_CLASSES.index("CARDINAL"))), F.lit(0)))
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_s", "_p", "_cls"))).alias("_v"))
    g = g.select(*keys, F.transform("_v", lambda x: x["_cls"]).alias(out))
    return df.join(g, keys, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<int>")))


def post_features(posts: DataFrame, lexicon, gazetteer=None) -> DataFrame:
    """Row-local features of every post (everything but the thread flag).

    ``lexicon``: a list of words (a literal set) or a one-column DataFrame (a
    join, any size). ``gazetteer``: a dict class -> words and phrases, a
    (phrase, entity) DataFrame, or None for the default one. Tables need one row per post.
    """
    words = list(lexicon) if isinstance(lexicon, (list, tuple, set, frozenset)) else None
    listed = gazetteer is None or isinstance(gazetteer, dict)
    text = TX.safe_text("text")
    base = posts.select(
        "conv_id", "post_id", "is_source", text.alias("raw_text"),
        *[c for c in posts.columns if c in ("stance", "label", "split", "fold")],
    )
    flags = TX.flag_columns("raw_text")
    df = base.select(
        "*",
        F.col("is_source").cast("int").alias("issource"),
        *[v.alias(k) for k, v in flags.items()],
        TX.lex_tokens("raw_text").alias("_lex"),
        TX.sent_tokens("raw_text").alias("_sents"),
    )
    df = df.select(
        "*",
        TX.lexicon_distinct("_lex", L.NEGATION_WORDS).alias("hasnegation"),
        *([TX.lexicon_hits("_lex", words).alias("hasswearwords")] if words is not None else []),
        TX.contains_any("_lex", L.RUMOUR_WORDS).alias("src_rumour"),
        TX.processed_text_from_tokens("_sents").alias("clean_text"),
        *([entity_vector("_sents", gazetteer).alias("ner")] if listed else []),
    )
    if words is None:
        df = lexicon_hits_join(df, "_lex", lexicon, "hasswearwords", ["conv_id", "post_id"])
    if not listed:
        df = entity_vector_join(df, "_sents", gazetteer, "ner", ["conv_id", "post_id"])
    return df.drop("_lex", "_sents")


def thread_flags(df: DataFrame, flag: str = "src_rumour", out: str = "thread_rumour") -> DataFrame:
    """for a reply, the flag anywhere in its thread (itself included);
    for the source, the flag in any reply only."""
    per_conv = df.groupBy("conv_id").agg(
        F.max(flag).alias("_any_all"),
        F.max(F.when(~F.col("is_source"), F.col(flag))).alias("_any_reply"))
    j = df.join(per_conv, "conv_id", "left")
    return j.withColumn(out, F.when(F.col("is_source"), F.coalesce("_any_reply", F.lit(0)))
                        .otherwise(F.coalesce("_any_all", F.lit(0))).cast("int")) \
        .drop("_any_all", "_any_reply")


def thread_features(posts: DataFrame, lexicon, gazetteer=None) -> DataFrame:
    """every post feature, one row per post (see ``one_post``)."""
    return thread_flags(post_features(one_post(posts), lexicon, gazetteer))


def feature_vector(df: DataFrame, feature_set: Sequence[str], out: str = "features") -> DataFrame:
    """scalars appended, list features spliced, as ARRAY<DOUBLE>.
    String features are skipped (they are not numeric)."""
    parts = []
    for name in feature_set:
        dt = df.schema[name].dataType.simpleString()
        if dt.startswith("array"):
            parts.append(F.col(name).cast("array<double>"))
        elif dt == "string":
            continue
        else:
            parts.append(F.array(F.col(name).cast("double")))
    return df.withColumn(out, F.concat(*parts))


def check_alignment(df: DataFrame, text_col: str = "clean_text", ner_col: str = "ner") -> DataFrame:
    """rows whose token count differs from their entity vector length
    (must be empty)."""
    return df.where(TX.token_count(text_col) != F.size(ner_col))
