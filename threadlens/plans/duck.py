"""DuckDB SQL snippets for the oracle side: the written text rules of
``threadlens.functions.text`` in DuckDB syntax (RE2 regex, lambda syntax of
DuckDB 2.0, ``\\1`` group references)."""

from __future__ import annotations

from threadlens.functions import lexicons as L
from threadlens.functions import text as TX


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(words) -> str:
    return ", ".join(q(w) for w in words)


def lex_tokens(e: str) -> str:
    t = f"regexp_replace(regexp_replace(lower(coalesce({e}, '')), {q(TX.WS)}, ' ', 'g'), {q(TX.LEX_DROP)}, '', 'g')"
    toks = f"list_filter(string_split({t}, ' '), lambda x: x <> '')"
    case = "CASE " + " ".join(
        f"WHEN x = {q(w)} THEN [{qlist(p)}]" for w, p in L.CONTRACTION_SPLITS) + " ELSE [x] END"
    return f"flatten(list_transform({toks}, lambda x: {case}))"


def masked_text(e: str) -> str:
    t = f"trim(regexp_replace(coalesce({e}, ''), {q(TX.WS)}, ' ', 'g'))"
    t = f"regexp_replace({t}, {q(TX.R1_URL)}, '$URL$', 'g')"
    t = f"regexp_replace({t}, {q(TX.R2_MENTION)}, '$MENTION$', 'g')"
    return f"regexp_replace({t}, {q(TX.R3_NT)}, ' not\\1', 'g')"


def sent_tokens(e: str) -> str:
    marked = f"regexp_replace({masked_text(e)}, {q(TX.R4_SENTENCE)}, '\\1' || chr(1), 'g')"
    sents = f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"
    toks = f"list_transform({sents}, lambda s: regexp_extract_all(s, {q(TX.R5_TOKEN)}))"
    return f"list_filter({toks}, lambda a: len(a) > 0)"


def processed(sents: str) -> str:
    return f"array_to_string(list_transform({sents}, lambda a: array_to_string(a, ' ') || ' [EOS]'), chr(10))"


def entity_class(t: str) -> str:
    parts = []
    for cls in L.ENTITY_CLASSES:
        words = L.DEFAULT_GAZETTEER.get(cls)
        if words:
            parts.append(f"WHEN lower({t}) IN ({qlist(sorted(set(words)))}) THEN {L.ENTITY_CLASSES.index(cls)}")
    parts.append(f"WHEN regexp_full_match({t}, '[0-9]+') THEN {L.ENTITY_CLASSES.index('CARDINAL')}")
    return "CASE " + " ".join(parts) + " ELSE 0 END"


def entity_vector(sents: str) -> str:
    return f"flatten(list_transform({sents}, lambda a: list_append(list_transform(a, lambda t: {entity_class('t')}), 0)))"


def int_list_str(e: str) -> str:
    return f"array_to_string({e}, ',')"


def features_cte(src: str = "posts", swear=None) -> str:
    """CTEs f0, f1, conv_flags, feat: every post feature of ``src``."""
    swear = L.FIXTURE_SWEAR_LEXICON if swear is None else swear
    return f"""
f0 AS (
  SELECT conv_id, post_id, is_source, stance, fold, coalesce(text, '') AS raw_text,
         {lex_tokens('text')} AS lex, {sent_tokens('text')} AS sents
  FROM {src}),
f1 AS (
  SELECT *, CAST(is_source AS INT) AS issource,
    CAST(contains(raw_text, '?') AS INT) AS hasqmark,
    CAST(contains(raw_text, '!') AS INT) AS hasemark,
    CAST(contains(raw_text, '.') AS INT) AS hasperiod,
    CAST(contains(raw_text, '#') AS INT) AS hashashtag,
    CAST(contains(raw_text, 'urlurlurl') OR contains(raw_text, 'http') AS INT) AS hasurl,
    CAST(contains(raw_text, 'picpicpic') OR contains(raw_text, 'pic.twitter.com')
         OR contains(raw_text, 'instagr.am') AS INT) AS haspic,
    CAST(len(list_distinct(list_filter(lex, lambda x: x IN ({qlist(L.NEGATION_WORDS)})))) AS INT) AS hasnegation,
    CAST(len(list_filter(lex, lambda x: x IN ({qlist(sorted(set(swear)))}))) AS INT) AS hasswearwords,
    CAST(list_has_any(lex, [{qlist(L.RUMOUR_WORDS)}]) AS INT) AS src_rumour,
    {processed('sents')} AS clean_text,
    {entity_vector('sents')} AS ner
  FROM f0),
conv_flags AS (
  SELECT conv_id, max(src_rumour) AS any_all,
         max(CASE WHEN NOT is_source THEN src_rumour END) AS any_reply
  FROM f1 GROUP BY conv_id),
feat AS (
  SELECT f1.*, CAST(CASE WHEN is_source THEN coalesce(any_reply, 0) ELSE any_all END AS INT) AS thread_rumour
  FROM f1 JOIN conv_flags USING (conv_id))"""
