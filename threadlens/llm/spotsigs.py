"""Operator 13: document fingerprints by SpotSigs, in native functions.

Spots are the places in a text where common words stand: a run of common words
and the CHAIN content words that follow make one signature, so headlines, menus
and other text without running prose add few. Common words are learned: for
each language that holds at least LANGUAGE_SHARE of the texts the COMMON words
in most of its documents (a word counts once a document). A frequent-items
sketch over all documents names the candidates, an exact count over all
documents chooses among them. Every EVERY-th content word is a spot too, so text
without any common word has signatures as well. A fingerprint is the sorted set
of the 32-bit hashes of a text's signatures, eight hex digits each.

Likeness is the Jaccard similarity of two sets; ``similar_pairs`` searches it:
sets are parted by length, so that two whose similarity can reach the threshold
are in the same or in adjoining parts, they meet through the rarest of their
signatures only, and are compared in full if their sizes and places leave room.

Defined results: a null text is empty; a text without words has the empty
fingerprint, which is like another empty one (1) and like nothing else (0);
equal texts have equal fingerprints; documents stand in the order of their id
(null first, as in SQL), equal ids in the order of the hash of their text, and
rows equal in both are one document in that order and have equal results; after
the last document comes the first, a single one is followed by itself; an empty
table gives no rows; other columns but ``lang`` are not looked at, and without
that column, or where it is null, texts are of one language.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.llm.common import documents, saved
from threadlens.llm.registry import query
from threadlens.operators.index import dense_index

CHAIN = 3                # content words of a signature
EVERY = 8                # content words from one spot to the next where no common word stands
COMMON = 32              # common words of a language
CANDIDATES, TRACKED = 128, 8192  # per language: words the sketch names, and counters it keeps
LANGUAGE_SHARE = 0.001
BLANK = r"[\x20\x09-\x0D]+"
PUNCTUATION = ".,;:!?()[]\"'"
MARK = "\u0001"          # ends a common word


def spot_words(text: Column) -> Column:
    """The words of a text, lower-cased, without punctuation around them (a
    word of punctuation alone stays as it is)."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANK), lambda w: w != "")
    return F.transform(words, lambda w: F.coalesce(F.nullif(F.btrim(w, F.lit(PUNCTUATION)), F.lit("")), w))


def common_words(docs: DataFrame, common: int = COMMON) -> list[str]:
    """The common words of all languages, at most ``common`` / LANGUAGE_SHARE."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    words = docs.select(lang.alias("lang"), F.explode(F.array_distinct(spot_words(F.col("text")))).alias("word"))
    top = words.groupBy("lang").agg(F.expr(f"approx_top_k(word, {CANDIDATES}, {TRACKED})").alias("top")).select("lang", F.explode("top.item").alias("word"))
    total = docs.groupBy(lang.alias("lang")).agg(F.count("*").alias("n"))
    share = total.withColumn("all", F.sum("n").over(Window.partitionBy())).where(F.col("n") >= F.col("all") * LANGUAGE_SHARE).select("lang")
    # at most CANDIDATES / LANGUAGE_SHARE rows
    named = [(r["lang"], r["word"]) for r in top.join(share, "lang").collect()]
    if not named:
        return []
    listed = sorted({w for _, w in named})
    counts = words.where(F.col("word").isin(listed)).groupBy("lang", "word").agg(F.count("*").alias("n")).join(share, "lang")
    best = counts.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(f"no <= {int(common)}")
    return sorted({r["word"] for r in best.select("word").distinct().collect()})


def signatures(text: Column, common: list[str]) -> Column:
    """The sorted distinct signature hashes of a text."""
    words = spot_words(text)
    if common:
        words = F.transform(words, lambda w: F.concat(w, F.when(w.isin(common), MARK).otherwise(" ")))
        # a common word and what follows up to a content word are one token
        tokens = F.split(F.array_join(words, ""), " ")
    else:
        tokens = words

    def content(token: Column) -> Column:
        return F.substring_index(token, MARK, -1)

    def spots(tokens: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            chain = [content(F.get(tokens, i + k)) for k in range(1, CHAIN)]
            return F.when((F.contains(w, F.lit(MARK)) | (i % EVERY == 0)) & (content(w) != ""), F.hash(F.concat_ws(" ", w, *chain)))
        return F.array_sort(F.array_distinct(F.filter(F.transform(tokens, at), lambda x: x.isNotNull())))

    # the one-element array binds the tokens to a name, so they are made once
    return F.transform(F.array(tokens), spots)[0]


def as_text(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda v: F.lpad(F.lower(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / F.greatest(union, F.lit(1)))


def following(docs: DataFrame) -> DataFrame:
    """doc_id, th, next_id, next_th, take: each text (th: its hash) with the
    one after it and a quarter of its own length. Thin rows only."""
    thin = docs.groupBy("doc_id", "th").agg(F.first("n_chars").alias("n_chars"))
    ranked = saved(dense_index(thin, ["doc_id", "th"], "no"), "order")
    total = ranked.count()
    after = ranked.select(F.pmod(F.col("no") - 1, F.lit(max(1, total))).alias("no"), F.col("doc_id").alias("next_id"), F.col("th").alias("next_th"))
    return ranked.join(after, "no").select("doc_id", "th", "next_id", "next_th", F.floor(F.col("n_chars") / 4).cast("int").alias("take"))


def fingerprints(docs: DataFrame, common: list[str] | None = None) -> DataFrame:
    """doc_id, sigs, n_sigs of every row."""
    common = common_words(docs) if common is None else common
    return docs.select("doc_id", signatures(F.col("text"), common).alias("sigs")).withColumn("n_sigs", F.size("sigs"))


def edited_fingerprints(docs: DataFrame, common: list[str] | None = None) -> DataFrame:
    """Every row with its fingerprint, that of the text whose last quarter
    gives way to the beginning of the next document, and both likenesses.
    A document sends its beginning and its set to the one before it."""
    common = common_words(docs) if common is None else common
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("text")).withColumn("th", F.xxhash64("text"))
    order = saved(following(d.select("doc_id", "th", F.length("text").alias("n_chars"))), "following")
    gives = order.select(F.col("next_id").alias("g_id"), F.col("next_th").alias("g_th"), F.col("doc_id").alias("r_id"), F.col("th").alias("r_th"), "take")
    sent = d.join(gives, d["doc_id"].eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")))
    sent = sent.select("r_id", "r_th", "take", F.substring(F.col("text"), F.lit(1), F.col("take")).alias("tail"), signatures(F.col("text"), common).alias("next_sigs")).dropDuplicates(["r_id", "r_th"])
    j = d.join(sent, d["doc_id"].eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")))
    n = F.length("text")
    j = j.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.substring(F.col("text"), F.lit(1), n - F.col("take")), F.col("tail")).alias("edited"),
                 signatures(F.col("text"), common).alias("sigs"), "next_sigs")
    return j.withColumn("edited_sigs", signatures(F.col("edited"), common))


def similar_pairs(prints: DataFrame, threshold: float = 0.8, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(pairs, members). Documents of one set are one class, named by its
    smallest id: members (id, class_id) has every row with a signature, pairs
    (u, v, likeness) every two classes at or above the threshold. A set meets
    others of its part and the next shorter one through its first
    n - ceil(t n) + 1 signatures, rarest first; a frequent signature's list is
    joined like any other, so AQE may split it."""
    rows = prints.where(F.size("sigs") > 0).select(F.col(id_col).alias("id"), "sigs")
    rows = saved(rows.withColumn("set_id", F.sha2(F.array_join("sigs", ",").cast("string"), 256)), "sets")
    classes = saved(rows.groupBy("set_id").agg(F.min("id").alias("class_id"), F.first("sigs").alias("sigs")).select("class_id", "set_id", "sigs", F.size("sigs").alias("n")), "set-classes")
    members = rows.select("id", "set_id").join(classes.select("set_id", "class_id"), "set_id").select("id", "class_id")
    one = classes.select("class_id", "n", F.explode("sigs").alias("s"))
    rare = one.groupBy("s").agg(F.count("*").alias("f"))
    ordered = one.join(rare.where("f > 1"), "s", "left").groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "s"))).alias("x"))
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(threshold)).cast("int") + 1
    first = ordered.select("class_id", "n", F.posexplode(F.slice("x", F.lit(1), keep)).alias("at", "e")).where("e.f > 1")
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1 / threshold))).cast("int")
    first = saved(first.select("class_id", "n", "at", F.col("e.s").alias("s"), part.alias("part")), "prefixes")
    v = first.select(F.col("class_id").alias("v"), F.col("n").alias("nv"), F.col("at").alias("av"), "s", F.col("part").alias("pv"))
    u = first.select(F.col("class_id").alias("u"), F.col("n").alias("nu"), F.col("at").alias("au"), "s", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("pv"))
    most = F.least(F.col("nu") - F.col("au"), F.col("nv") - F.col("av"))  # what both can still have in common
    room = most * (1 + threshold) >= threshold * (F.col("nu") + F.col("nv")) - 1e-6
    ahead = (F.col("nu") > F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("u") > F.col("v")))
    pairs = u.join(v, ["s", "pv"]).where(ahead & room).select("u", "v").distinct()
    sets = classes.select("class_id", "sigs")
    full = pairs.join(sets.select(F.col("class_id").alias("u"), F.col("sigs").alias("a")), "u").join(sets.select(F.col("class_id").alias("v"), F.col("sigs").alias("b")), "v")
    return full.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), likeness(F.col("a"), F.col("b")).alias("likeness")).where(F.col("likeness") >= threshold), members


@query("op13_spot_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = edited_fingerprints(documents(spark, sf_dir))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sigs")).alias("fingerprint"), as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
                      likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
