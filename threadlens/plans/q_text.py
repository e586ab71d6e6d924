"""Queries for the lexical features (F1-F21) on decorated posts and on the
whole texts of ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.functions.entities import entity_vector, phrase_index
from threadlens.operators import features as FE
from threadlens.plans import duck as D
from threadlens.plans.fixtures import duck_with, fixture, table
from threadlens.plans.q_threads import duck_ints_str, ints_str
from threadlens.plans.registry import register

POSTS_FEAT = duck_with("posts_all") + "," + D.features_cte("posts_all")


def _posts(spark, d):
    return fixture(spark, d, "posts_all")


@register("txt_lex_tokens", duck_with("posts_all") + f"""
SELECT conv_id, post_id, array_to_string({D.lex_tokens('text')}, ' ') AS tokens FROM posts_all""")
def q_lex_tokens(spark, d):
    return _posts(spark, d).select("conv_id", "post_id",
                                   F.array_join(TX.lex_tokens("text"), " ").alias("tokens"))


@register("txt_flags", POSTS_FEAT + """
SELECT conv_id, post_id, issource, hasqmark, hasemark, hasperiod, hashashtag, hasurl, haspic FROM f1""")
def q_flags(spark, d):
    p = _posts(spark, d)
    flags = TX.flag_columns("text")
    return p.select("conv_id", "post_id", F.col("is_source").cast("int").alias("issource"),
                    *[flags[k].alias(k) for k in ["hasqmark", "hasemark", "hasperiod", "hashashtag",
                                                   "hasurl", "haspic"]])


@register("txt_negation_count", POSTS_FEAT + """
SELECT conv_id, post_id, hasnegation FROM f1""")
def q_negation(spark, d):
    return _posts(spark, d).select(
        "conv_id", "post_id", TX.lexicon_distinct(TX.lex_tokens("text"), L.NEGATION_WORDS).alias("hasnegation"))


@register("txt_lexicon_hits", POSTS_FEAT + """
SELECT conv_id, post_id, hasswearwords FROM f1""")
def q_lexicon_hits(spark, d):
    return _posts(spark, d).select(
        "conv_id", "post_id",
        TX.lexicon_hits(TX.lex_tokens("text"), L.FIXTURE_SWEAR_LEXICON).alias("hasswearwords"))


@register("txt_lexicon_hits_join", POSTS_FEAT + """
SELECT conv_id, post_id, hasswearwords FROM f1""")
def q_lexicon_hits_join(spark, d):
    """F9 through the table path (explode + join + count), for lexicons too
    large to inline; the lexicon here is a DataFrame."""
    p = _posts(spark, d).select("conv_id", "post_id", TX.lex_tokens("text").alias("_lex"))
    lex = p.sparkSession.createDataFrame([(w,) for w in L.FIXTURE_SWEAR_LEXICON], "word string")
    return FE.lexicon_hits_join(p, "_lex", lex, "hasswearwords", ["conv_id", "post_id"]) \
        .select("conv_id", "post_id", "hasswearwords")


@register("txt_src_rumour", POSTS_FEAT + """
SELECT conv_id, post_id, src_rumour FROM f1""")
def q_src_rumour(spark, d):
    return _posts(spark, d).select(
        "conv_id", "post_id", TX.contains_any(TX.lex_tokens("text"), L.RUMOUR_WORDS).alias("src_rumour"))


@register("win_thread_rumour", POSTS_FEAT + """
SELECT conv_id, post_id, src_rumour, thread_rumour FROM feat""")
def q_thread_rumour(spark, d):
    p = _posts(spark, d).select("conv_id", "post_id", "is_source",
                                TX.contains_any(TX.lex_tokens("text"), L.RUMOUR_WORDS).alias("src_rumour"))
    return FE.thread_flags(p).select("conv_id", "post_id", "src_rumour", "thread_rumour")


# --- F13-F17 on whole web pages and documents ---------------------------------------
_PAGE_TEXT = "url || ' ' || html"


@register("txt_mask_urls", f"""
SELECT page_id, regexp_replace(trim(regexp_replace({_PAGE_TEXT}, {D.q(TX.WS)}, ' ', 'g')),
                               {D.q(TX.R1_URL)}, '$URL$', 'g') AS masked FROM pages""")
def q_mask_urls(spark, d):
    pg = table(spark, d, "pages")
    return pg.select("page_id", TX.mask_urls(F.concat_ws(" ", "url", "html")).alias("masked"))


@register("txt_mask_mentions", duck_with("docs_decorated") + f"""
SELECT doc_id, regexp_replace(trim(regexp_replace(text, {D.q(TX.WS)}, ' ', 'g')),
                              {D.q(TX.R2_MENTION)}, '$MENTION$', 'g') AS masked FROM docs_decorated""")
def q_mask_mentions(spark, d):
    doc = fixture(spark, d, "docs_decorated")
    return doc.select("doc_id", TX.mask_mentions(TX.canon_ws("text")).alias("masked"))


@register("txt_negated_contraction", duck_with("docs_decorated") + f"""
SELECT doc_id, regexp_replace(trim(regexp_replace(text, {D.q(TX.WS)}, ' ', 'g')),
                              {D.q(TX.R3_NT)}, ' not\\1', 'g') AS text_not FROM docs_decorated""")
def q_negated(spark, d):
    doc = fixture(spark, d, "docs_decorated")
    return doc.select("doc_id", TX.negated_contraction(TX.canon_ws("text")).alias("text_not"))


@register("txt_sent_tokens", f"""
SELECT doc_id, len(s) AS n_sentences,
       array_to_string(list_transform(s, lambda a: array_to_string(a, ' ')), chr(10)) AS sentences
FROM (SELECT doc_id, {D.sent_tokens('text')} AS s FROM documents)""")
def q_sent_tokens(spark, d):
    doc = table(spark, d, "documents").select("doc_id", TX.sent_tokens("text").alias("s"))
    return doc.select("doc_id", F.size("s").alias("n_sentences"),
                      F.array_join(F.transform("s", lambda a: F.array_join(a, " ")), "\n").alias("sentences"))


@register("txt_processed_text", f"""
SELECT doc_id, {D.processed(D.sent_tokens('text'))} AS clean_text FROM documents
UNION ALL
SELECT page_id AS doc_id, {D.processed(D.sent_tokens(_PAGE_TEXT))} AS clean_text FROM pages""")
def q_processed(spark, d):
    doc = table(spark, d, "documents").select("doc_id", TX.processed_text("text").alias("clean_text"))
    pg = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"),
                                         TX.processed_text(F.concat_ws(" ", "url", "html")).alias("clean_text"))
    return doc.unionByName(pg)


@register("join_entity_vector", duck_with("docs_decorated") + f"""
SELECT doc_id, {duck_ints_str(D.entity_vector(D.sent_tokens('text')))} AS ner FROM docs_decorated""")
def q_entity_vector(spark, d):
    doc = fixture(spark, d, "docs_decorated")
    return doc.select("doc_id", ints_str(entity_vector(TX.sent_tokens("text"))).alias("ner"))


@register("join_entity_vector_gazetteer", POSTS_FEAT + f"""
SELECT conv_id, post_id, {duck_ints_str('ner')} AS ner FROM f1""")
def q_entity_vector_gaz(spark, d):
    """F18 with the gazetteer given as a (token, entity) table."""
    spark_ = spark
    rows = [(w, cls) for cls, ws in L.DEFAULT_GAZETTEER.items() for w in ws]
    gaz = spark_.createDataFrame(rows, "token string, entity string")
    f = FE.post_features(_posts(spark, d), L.FIXTURE_SWEAR_LEXICON, gazetteer=gaz)
    return f.select("conv_id", "post_id", ints_str("ner").alias("ner"))


# names of one to three tokens that overlap, tie and begin alike, on the sentences of the decorated posts
PHRASES = {
    "EVENT": ["rumour true", "true? Second"],          # the second crosses a sentence
    "DATE": ["second of May", "monday", "May", "on Monday in"],
    "ORDINAL": ["second"],
    "LAW": ["of may", "no no!"],
    "NORP": ["in French", "Monday"],                   # Monday is a DATE already
    "WORK_OF_ART": ["this rumour", "hell crap", "crap, hell"],
    "ORG": ["crap", "not believe it"],
    "GPE": ["user_1"],                                 # the mention is masked
}
_PHRASE_ROWS = ", ".join(f"([{', '.join(D.q(t) for t in toks)}], {cls})" for entries in phrase_index(PHRASES).values() for toks, cls in entries)
_PHRASES_ORACLE = duck_with("posts_all", recursive=True) + f""",
gaz AS (SELECT * FROM (VALUES {_PHRASE_ROWS}) v(toks, cls)),
sent AS (SELECT conv_id, post_id, unnest(s) AS a, generate_subscripts(s, 1) AS sno FROM (SELECT conv_id, post_id, {D.sent_tokens('text')} AS s FROM posts_all)),
low AS (SELECT conv_id, post_id, sno, list_transform(a, lambda t: lower(t)) AS a FROM sent),
hit AS (
  SELECT conv_id, post_id, sno, p, max(len(toks)) AS n, arg_max(cls, len(toks)) AS cls
  FROM (SELECT *, unnest(range(1, len(a) + 1)) AS p FROM low) l JOIN gaz ON l.a[p:p + len(toks) - 1] = gaz.toks GROUP BY ALL),
scan AS (
  SELECT conv_id, post_id, sno, CAST(1 AS BIGINT) AS p FROM low
  UNION ALL
  SELECT s.conv_id, s.post_id, s.sno, s.p + coalesce(h.n, 1) FROM scan s JOIN low l ON l.conv_id = s.conv_id AND l.post_id = s.post_id AND l.sno = s.sno
  LEFT JOIN hit h ON h.conv_id = s.conv_id AND h.post_id = s.post_id AND h.sno = s.sno AND h.p = s.p WHERE s.p <= len(l.a)),
tok AS (
  SELECT s.conv_id, s.post_id, s.sno, s.p + k AS p, coalesce(h.cls, CASE WHEN regexp_full_match(l.a[s.p], '[0-9]+') THEN {L.ENTITY_CLASSES.index('CARDINAL')} ELSE 0 END) AS cls
  FROM (SELECT s.*, coalesce(h.n, 1) AS n, h.cls FROM scan s LEFT JOIN hit h ON h.conv_id = s.conv_id AND h.post_id = s.post_id AND h.sno = s.sno AND h.p = s.p) s
  JOIN low l ON l.conv_id = s.conv_id AND l.post_id = s.post_id AND l.sno = s.sno AND s.p <= len(l.a)
  LEFT JOIN hit h ON h.conv_id = s.conv_id AND h.post_id = s.post_id AND h.sno = s.sno AND h.p = s.p, LATERAL (SELECT unnest(range(s.n)) AS k)
  UNION ALL
  SELECT conv_id, post_id, sno, len(a) + 1, 0 FROM low)
SELECT p.conv_id, p.post_id, coalesce(v.ner, '') AS ner FROM posts_all p
LEFT JOIN (SELECT conv_id, post_id, string_agg(CAST(cls AS VARCHAR), ',' ORDER BY sno, p) AS ner FROM tok GROUP BY conv_id, post_id) v ON v.conv_id = p.conv_id AND v.post_id = p.post_id"""


@register("join_entity_phrases", _PHRASES_ORACLE)
def q_entity_phrases(spark, d):
    """F18 with names of several tokens, the gazetteer as a table."""
    gaz = spark.createDataFrame([(w, cls) for cls, ws in PHRASES.items() for w in ws], "phrase string, entity string")
    p = _posts(spark, d).select("conv_id", "post_id", TX.sent_tokens("text").alias("_sents"))
    return FE.entity_vector_join(p, "_sents", gaz, "ner", ["conv_id", "post_id"]).select("conv_id", "post_id", ints_str("ner").alias("ner"))


@register("txt_entity_phrases", _PHRASES_ORACLE)
def q_entity_phrases_listed(spark, d):
    """The same with the gazetteer as a list."""
    return _posts(spark, d).select("conv_id", "post_id", ints_str(entity_vector(TX.sent_tokens("text"), PHRASES)).alias("ner"))


@register("chk_alignment", f"""
SELECT count(*) AS n_checked,
       count(*) FILTER (WHERE len(list_filter(string_split_regex(clean_text, '[ \\n]'), lambda x: x <> ''))
                              <> len(ner)) AS n_misaligned
FROM (SELECT {D.processed('s')} AS clean_text, {D.entity_vector('s')} AS ner
      FROM (SELECT {D.sent_tokens('text')} AS s FROM documents))""")
def q_alignment(spark, d):
    doc = table(spark, d, "documents").select(TX.sent_tokens("text").alias("s"))
    feats = doc.select(TX.processed_text_from_tokens("s").alias("clean_text"),
                       entity_vector("s").alias("ner"))
    bad = FE.check_alignment(feats).agg(F.count(F.lit(1)).alias("n_misaligned"))
    return doc.agg(F.count(F.lit(1)).alias("n_checked")).crossJoin(bad)  # one row beside one row


@register("proj_feature_vector", POSTS_FEAT + """
SELECT conv_id, post_id, array_to_string(list_transform(
  flatten([[issource, hasqmark, hasemark, hashashtag, hasurl, haspic, hasnegation, hasswearwords,
            src_rumour, thread_rumour], ner]), lambda x: CAST(x AS VARCHAR)), ',') AS features
FROM feat""")
def q_feature_vector(spark, d):
    f = FE.thread_features(_posts(spark, d), L.FIXTURE_SWEAR_LEXICON)
    fs = ["issource", "hasqmark", "hasemark", "hashashtag", "hasurl", "haspic", "hasnegation",
          "hasswearwords", "src_rumour", "thread_rumour", "ner"]
    v = FE.feature_vector(f, fs)
    return v.select("conv_id", "post_id", F.array_join(
        F.transform("features", lambda x: x.cast("long").cast("string")), ",").alias("features"))


@register("features_all", POSTS_FEAT + f"""
SELECT conv_id, post_id, issource, raw_text, clean_text, {duck_ints_str('ner')} AS ner, hasqmark, hasemark,
       hasperiod, hashashtag, hasurl, haspic, hasnegation, hasswearwords, src_rumour, thread_rumour
FROM feat""")
def q_features_all(spark, d):
    f = FE.thread_features(_posts(spark, d), L.FIXTURE_SWEAR_LEXICON)
    return f.select("conv_id", "post_id", "issource", "raw_text", "clean_text", ints_str("ner").alias("ner"),
                    "hasqmark", "hasemark", "hasperiod", "hashashtag", "hasurl", "haspic", "hasnegation",
                    "hasswearwords", "src_rumour", "thread_rumour")


# --- stateless features on a stream ------------------------------------------------
@register("stream_post_features", POSTS_FEAT + f"""
SELECT conv_id, post_id, issource, hasqmark, hasemark, hasperiod, hashashtag, hasurl, haspic, hasnegation,
       hasswearwords, src_rumour, clean_text, {duck_ints_str('ner')} AS ner FROM f1""")
def q_stream_features(spark, d):
    """The conversations table (a file or a folder of part files) read as a
    stream (file source, availableNow), decorated by the same fixture SQL,
    row-local features, written as files."""
    from threadlens.streaming import features as SF
    conv = SF.read_post_stream(spark, SF.only(f"{d}/conversations.parquet"))
    posts = fixture(spark, d, "posts_all", sources={"conversations": conv})
    feats = SF.feature_stream(posts, L.FIXTURE_SWEAR_LEXICON)
    _, path = SF.run_feature_stream(feats)
    out = spark.read.schema(feats.schema).parquet(path)
    return out.select("conv_id", "post_id", "issource", "hasqmark", "hasemark", "hasperiod", "hashashtag",
                      "hasurl", "haspic", "hasnegation", "hasswearwords", "src_rumour", "clean_text",
                      ints_str("ner").alias("ner"))
