"""Column expressions for the lexical features (JVM-side, codegen friendly).

Everything here is Column -> Column built from ``pyspark.sql.functions``; no
Python runs per row, so the same expressions also work on a stream.

Text rules (ours, stated once, DuckDB uses the same patterns):
  WS        whitespace of Python's ``str.split``; canonicalised to one blank
  LEX_DROP  everything but blank, letters and digits (Python ``([^\\s\\w]|_)+``)
  R1 URL, R2 MENTION, R3 n't, R4 sentence end, R5 token: see below.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L

WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}]+"
LEX_DROP = r"[^ \p{L}\p{N}]+"
WORD = r"[\p{L}\p{N}_]"
# FIXED VALUE: the URL pattern, with the word class written out for all scripts.
R1_URL = (r"(http|ftp|https)://([\p{L}\p{N}_-]+(?:(?:\.[\p{L}\p{N}_-]+)+))"
          r"([\p{L}\p{N}_.,@?^=%&:/~+#-]*[\p{L}\p{N}_@?^=%&/~+#-])?")
R2_MENTION = r"@[\p{L}\p{N}_]+"
R3_NT = r"n't([^\p{L}\p{N}_]|$)"
R4_SENTENCE = r"([.!?]+) +"
R5_TOKEN = r"\$[A-Z]+\$|[\p{L}\p{N}_]+|[^ \p{L}\p{N}_]"
SENT_MARK = "\u0001"
EOS = "[EOS]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_text(text) -> Column:
    """NULL text becomes '' (reported separately by ``missing_text``)."""
    return F.coalesce(_col(text), F.lit(""))


def canon_ws(text) -> Column:
    """Collapse every whitespace run to one blank and strip the ends."""
    return F.trim(F.regexp_replace(safe_text(text), WS, " "))


# --- F1: tokens for lexicon look-up ---------------------------------------
def lex_tokens(text) -> Column:
    """lower -> drop non letter/digit -> split on blanks -> contraction splits."""
    t = F.regexp_replace(F.lower(safe_text(text)), WS, " ")
    t = F.regexp_replace(t, LEX_DROP, "")
    toks = F.filter(F.split(t, " "), lambda x: x != F.lit(""))
    return F.flatten(F.transform(toks, _contraction_case))


def _contraction_case(x: Column) -> Column:
    expr = None
    for word, parts in L.CONTRACTION_SPLITS:
        arr = F.array(*[F.lit(p) for p in parts])
        expr = F.when(x == word, arr) if expr is None else expr.when(x == word, arr)
    return expr.otherwise(F.array(x))


# --- F2-F7, F12: substring flags ------------------------------------------
def has_any(text, needles: Iterable[str]) -> Column:
    """1 when the raw text contains any of the substrings, else 0."""
    t = safe_text(text)
    cond = None
    for n in needles:
        c = F.contains(t, F.lit(n))
        cond = c if cond is None else (cond | c)
    return cond.cast("int")


def flag_columns(text) -> dict[str, Column]:
    return {
        "hasqmark": has_any(text, ["?"]),
        "hasemark": has_any(text, ["!"]),
        "hasperiod": has_any(text, ["."]),
        "hashashtag": has_any(text, ["#"]),
        "hasurl": has_any(text, L.URL_MARKERS),
        "haspic": has_any(text, L.PIC_MARKERS),
    }


# --- F8-F10: lexicon features on the token array ---------------------------
def lexicon_distinct(tokens, words: Iterable[str]) -> Column:
    """Number of distinct words of ``words`` present among the tokens (F8)."""
    return F.size(F.array_intersect(_col(tokens), F.array(*[F.lit(w) for w in words])))


def lexicon_hits(tokens, words: Iterable[str]) -> Column:
    """Number of token occurrences found in the lexicon.

    ``x IN (...)`` inside the lambda is rewritten by the optimizer to a hash
    set look-up (InSet), so the cost per token does not grow with the list.
    """
    words = sorted(set(words))
    if not words:
        return F.lit(0)
    return F.size(F.filter(_col(tokens), lambda x: x.isin(words)))


def contains_any(tokens, words: Iterable[str]) -> Column:
    """1 when any of the words is a token (F10), else 0."""
    return F.arrays_overlap(_col(tokens), F.array(*[F.lit(w) for w in words])).cast("int")


# --- F13-F17: processed text ---------------------------------------------
def mask_urls(text) -> Column:
    return F.regexp_replace(canon_ws(text), R1_URL, r"\$URL\$")


def mask_mentions(text) -> Column:
    return F.regexp_replace(_col(text), R2_MENTION, r"\$MENTION\$")


def negated_contraction(text) -> Column:
    return F.regexp_replace(_col(text), R3_NT, " not$1")


def masked_text(text) -> Column:
    """F13 + F14 + F16 on canonical whitespace."""
    return negated_contraction(mask_mentions(mask_urls(text)))


def sent_tokens(text) -> Column:
    """ARRAY<ARRAY<STRING>>, one token array per non-empty sentence."""
    marked = F.regexp_replace(masked_text(text), R4_SENTENCE, "$1" + SENT_MARK)
    sents = F.filter(F.split(marked, SENT_MARK), lambda s: s != F.lit(""))
    toks = F.transform(sents, lambda s: F.regexp_extract_all(s, F.lit(R5_TOKEN), 0))
    return F.filter(toks, lambda a: F.size(a) > 0)


def processed_text_from_tokens(sents) -> Column:
    """F17 from F15: tokens joined by blank, ' [EOS]' per sentence, newline between."""
    return F.array_join(
        F.transform(_col(sents), lambda a: F.concat(F.array_join(a, " "), F.lit(" " + EOS))), "\n")


def processed_text(text) -> Column:
    return processed_text_from_tokens(sent_tokens(text))


def lower_tokens(tokens) -> Column:
    """The tokens of a sentence in lower case, lowered as one string (tokens
    hold no blank)."""
    t = _col(tokens)
    return F.when(F.size(t) > 0, F.split(F.lower(F.array_join(t, " ")), " ")).otherwise(F.array().cast("array<string>"))


def is_numeral(token: Column) -> Column:
    """All ASCII digits; the first character decides for most tokens."""
    return F.substring(token, 1, 1).between("0", "9") & (F.translate(token, "0123456789", "") == "")


def token_count(processed) -> Column:
    """Number of blank/newline separated tokens of a processed text."""
    return F.size(F.filter(F.split(_col(processed), "[ \n]"), lambda x: x != F.lit("")))


# --- N10: label -> class id ------------------------------------------------
def encode_label(label) -> Column:
    """support 0, comment 1, deny 2, query 3; anything else NULL."""
    c = _col(label)
    expr = None
    for i, name in enumerate(L.STANCE_CLASSES):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr


# --- T11: branch id string and its depth part ------------------------------
def branch_id(branch_no, pos) -> Column:
    return F.concat_ws(".", _col(branch_no).cast("string"), _col(pos).cast("string"))


def branch_level(bid) -> Column:
    """Everything after the first '.' (the position inside the branch)."""
    return F.element_at(F.split(_col(bid), r"\.", 2), -1)


# --- E1: triple text -------------------------------------------------------
def triple_text(src, prev, text) -> Column:
    return F.concat_ws(L.TRIPLE_SEPARATOR, safe_text(src), safe_text(prev), safe_text(text))
