"""entity classes of the tokens of a text, from a gazetteer of words and
phrases.

Rule: inside a sentence, from left to right, the longest listed phrase that
begins at a token takes all its tokens (a phrase listed for several classes the
first of them); matching goes on behind it, so phrases never overlap and never
cross a sentence. A token in no phrase is CARDINAL if it is all ASCII digits,
else 0. Each sentence's [EOS] is 0, so the vector is aligned with the
processed text (F19).

A gazetteer given as a dict is sent to the tasks as a look-up by first token:
one look-up for each distinct token of a batch, and phrases are tried only
where their first token stands. A gazetteer table of any size is joined
(``operators.features.entity_vector_join``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.session import ship_package

_PHRASE_TOKEN = re.compile(r"\w+|[^\w\s]")
_DIGITS = re.compile("[0-9]+")
CARDINAL = L.ENTITY_CLASSES.index("CARDINAL")


def phrase_tokens(phrase: str) -> tuple[str, ...]:
    """The tokens of a listed phrase, as a sentence's are made."""
    return tuple(_PHRASE_TOKEN.findall(phrase.lower()))


def phrase_index(gazetteer: Mapping[str, Iterable[str]]) -> dict[str, list[tuple[tuple[str, ...], int]]]:
    """First token -> its phrases, the longest first, with their class."""
    best: dict[tuple[str, ...], int] = {}
    for cls, name in enumerate(L.ENTITY_CLASSES):
        for phrase in gazetteer.get(name) or ():
            toks = phrase_tokens(phrase)
            if toks:
                best.setdefault(toks, cls)
    out: dict[str, list] = {}
    for toks in sorted(best, key=lambda t: (-len(t), t)):
        out.setdefault(toks[0], []).append((toks, best[toks]))
    return out


def sentence_classes(tokens: list[str], index: dict) -> list[int]:
    """The classes of a sentence's lower-cased tokens (without [EOS])."""
    out, i = [], 0
    while i < len(tokens):
        for phrase, cls in index.get(tokens[i], ()):
            if tuple(tokens[i:i + len(phrase)]) == phrase:
                out += [cls] * len(phrase)
                i += len(phrase)
                break
        else:
            out.append(CARDINAL if _DIGITS.fullmatch(tokens[i]) else 0)
            i += 1
    return out


def _vectors(index: dict):
    @F.arrow_udf("array<int>")
    def look(sents: pa.Array) -> pa.Array:
        n = len(sents)
        rows = pc.fill_null(pc.list_value_length(sents), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        inner = sents.flatten()                      # a token list a sentence
        sizes = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False).astype(np.int64) if len(inner) else np.zeros(0, np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        enc = inner.flatten().dictionary_encode() if begin[-1] else None
        words = [w.lower() for w in enc.dictionary.to_pylist()] if enc is not None else []
        codes = enc.indices.to_numpy(zero_copy_only=False) if enc is not None else np.zeros(0, np.int64)
        # what a distinct token is on its own, and whether a longer phrase may begin with it
        alone = np.array([next((c for p, c in index.get(w, ()) if len(p) == 1), CARDINAL if _DIGITS.fullmatch(w) else 0) for w in words] or [0], np.int32)
        longer = np.array([any(len(p) > 1 for p, _ in index.get(w, ())) for w in words] or [False])
        cls = alone[codes] if len(codes) else np.zeros(0, np.int32)
        end_of = np.repeat(begin[1:], sizes)
        # candidates from left to right; what a phrase has taken no other may begin in
        done, last = 0, -1
        for i in np.flatnonzero(longer[codes]).tolist() if len(codes) else ():
            if i < done and end_of[i] == last:
                continue
            for phrase, c in index[words[codes[i]]]:
                m = len(phrase)
                if m > 1 and i + m <= end_of[i] and all(words[codes[i + k]] == phrase[k] for k in range(1, m)):
                    cls[i:i + m] = c
                    done, last = i + m, end_of[i]
                    break
        # [EOS] behind each sentence
        flat = np.insert(cls, begin[1:], 0) if len(sizes) else cls
        per_row = np.concatenate(([0], np.cumsum(rows)))
        offsets = np.concatenate(([0], begin[1:] + np.arange(1, len(sizes) + 1)))[per_row] if n else np.zeros(1, np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))

    return look


def entity_vector(sents, gazetteer: Mapping[str, Iterable[str]] | None = None) -> Column:
    """The class vector of tokenised sentences (ARRAY<ARRAY<STRING>>)."""
    ship_package(SparkSession.active())
    return _vectors(phrase_index(L.DEFAULT_GAZETTEER if gazetteer is None else gazetteer))(F.col(sents) if isinstance(sents, str) else sents)
