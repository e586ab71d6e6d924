"""Operator 13 against a plain version."""

import hashlib
import re

import pytest

from threadlens.llm import spotsigs as S


def brute_chains(text, common):
    """The distinct signatures of a text, as strings."""
    words = [w.strip(S.PUNCTUATION) or w for w in re.split(S.BLANK, (text or "").lower()) if w]
    tokens, run = [], []
    for w in words:
        if w in common:
            run.append(w)
        else:
            tokens.append((tuple(run), w))
            run = []
    out = set()
    for i, (anchors, w) in enumerate(tokens):
        if anchors or i % S.EVERY == 0:
            out.add((anchors, *[t[1] for t in tokens[i:i + S.CHAIN]]))
    return out


def like(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def unpacked(print_):
    return {print_[i:i + 8] for i in range(0, len(print_), 8)}


def brute(docs, common):
    """{doc_id: (n_chars, sha, near_edited, near_next)} for distinct ids."""
    ids = sorted(docs)
    out = {}
    for i, d in enumerate(ids):
        text, after = docs[d] or "", docs[ids[(i + 1) % len(ids)]] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        own = brute_chains(text, common)
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), like(own, brute_chains(edited, common)), like(own, brute_chains(after, common)))
    return out


def rows_of(spark, df, common):
    from pyspark.sql import functions as F
    own, edited, after = F.col("sigs"), F.col("edited_sigs"), F.col("next_sigs")
    return S.edited_fingerprints(df, common).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), S.as_text(own).alias("own"), S.as_text(edited).alias("ed"),
        S.likeness(own, edited).alias("near_edited"), S.likeness(own, after).alias("near_next")).collect()


def test_against_plain(spark, small):
    df, docs = small
    common = S.common_words(df)
    assert 0 < len(common) <= 4 * S.COMMON
    want = brute(docs, set(common))
    got = rows_of(spark, df, common)
    assert len(got) == len(docs)
    prints = {}
    for r in got:
        n, sha, near_edited, near_next = want[r.doc_id]
        assert (r.n_chars, r.sha) == (n, sha)
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)
        assert len(r.own) == 8 * len(brute_chains(docs[r.doc_id], set(common))) and r.near_edited == pytest.approx(like(unpacked(r.own), unpacked(r.ed)))
        assert prints.setdefault(docs[r.doc_id] or "", r.own) == r.own


def test_common_words_are_the_exact_top(spark, small):
    from collections import Counter
    df, _ = small
    by = {}
    for r in df.collect():
        ws = {w.strip(S.PUNCTUATION) or w for w in re.split(S.BLANK, (r.text or "").lower()) if w}
        by.setdefault(r.lang or "", Counter()).update(ws)
    want = {w for c in by.values() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:5]}
    assert set(S.common_words(df, 5)) == want


def test_odd_table(spark, odd):
    """Null and repeated ids, repeated rows: every row is answered."""
    got = rows_of(spark, odd, ["a"])
    assert len(got) == odd.count()
    assert sum(r.doc_id is None for r in got) == 3
    assert all(0.0 <= x <= 1.0 for r in got for x in (r.near_edited, r.near_next))
    same = {}
    for r in got:  # rows equal in id and text have equal results
        same.setdefault((r.doc_id, r.own, r.n_chars), set()).add((r.sha, r.ed))
    assert all(len(v) == 1 for v in same.values())


def test_empty_and_single(spark, empty):
    assert S.common_words(empty) == []
    assert rows_of(spark, empty, []) == []
    one = spark.createDataFrame([(5, "the cat sat on the mat")], "doc_id long, text string")
    r = rows_of(spark, one, ["the", "on"])[0]
    assert r.sha == hashlib.sha256(b"the cat sat on ththe c").hexdigest() and r.near_next == 1.0


def test_similar_pairs(spark, small):
    df, docs = small
    common = S.common_words(df)
    pairs, members = S.similar_pairs(S.fingerprints(df, common), 0.6)
    sets = {d: brute_chains(t, set(common)) for d, t in docs.items()}
    sets = {d: s for d, s in sets.items() if s}
    names = {}
    for d in sorted(sets):
        names.setdefault(frozenset(sets[d]), d)
    assert {(r.id, r.class_id) for r in members.collect()} == {(d, names[frozenset(s)]) for d, s in sets.items()}
    reps = sorted(names.values())
    want = {(a, b) for a in reps for b in reps if a < b and like(sets[a], sets[b]) >= 0.6}
    got = pairs.collect()
    assert len(want) > 3 and len(got) == len(want) and {(r.u, r.v) for r in got} == want
