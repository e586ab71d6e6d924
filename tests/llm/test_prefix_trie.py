"""Operator 12 against a plain trie of Python dicts, at several limits of its groups and chunks."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from threadlens.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, key string, p string, words string"


def brute_nodes(seqs):
    """{(conv_id, depth): row} of the trie of {conv_id: [(role, text)]}."""
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    def words(path):
        return len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0

    leaves, saves = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        saves[path] = (len(members[path]) - 1) * words(path) + sum(saves[k] for k in below)
    out = []
    for path, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(seqs[c]) == len(path))))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids.get(path, [])), leaves[path], saves[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_rebuilt(rows):
    conv = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            conv.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in conv.items()}

    def rest(c):
        return c - (c % 20 if c >= 0 else -(-c % 20))

    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(rest(c), [])[:h] + v[h:]
    return out


def conversations(seed=4, n=260):
    r = random.Random(seed)
    vocab = ["a b", "c", "dd  e", "", "ff\tgg hh", None]
    rows = []
    for c in [*range(n), -7, -20, -45, 10**15]:
        hot = c % 3 == 0  # a third begin alike for twelve turns
        for t in range(r.choice([1, 2, 3, 5, 15, 30])):
            text = f"same {t}" if hot and t < 12 else r.choice(vocab) if r.random() < 0.7 else f"{c} {t}"
            rows.append((c, t, "user" if hot else r.choice(["user", "assistant", None]), text, "x", "y", "z"))
        if c % 7 == 0:
            rows.append((c, None, "system", "before all", "x", "y", "z"))
        if c % 11 == 0:
            rows += [(c, 1, "user", "a tie", "x", "y", "z")] * 2
    rows += [(None, 1, "user", "nobody's", "x", "y", "z")]
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_turns,chunk_turns", [(1, 1), (40, 100), (P.GROUP_TURNS, P.CHUNK_TURNS)])
def test_against_dicts(spark, group_turns, chunk_turns):
    rows = conversations()
    turns = P.saved(P.turn_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)), "t")
    built, ids = P.rebuilt(turns)
    got = result(P.prefix_trie(P.saved(built, "b"), ids, group_turns, chunk_turns))
    assert got == brute_nodes(brute_rebuilt(rows))


def test_copies_in_blocks(spark, monkeypatch):
    """Thousands of copies of one conversation: one class, its ids in blocks."""
    rows = [(c, t, "user", f"w {t}", "x", "y", "z") for c in range(0, 60_000, 20) for t in range(2)] + [(1, 0, "u", "q", "x", "y", "z")]
    turns = P.saved(P.turn_rows(spark.createDataFrame(rows, SCHEMA)), "t")
    ids = turns.select("conv_id").distinct()
    monkeypatch.setattr(P, "BLOCK_IDS", 100)
    seqs = {}
    for c, t, r, x, *_ in rows:
        seqs.setdefault(c, []).append((r, x))
    assert result(P.prefix_trie(turns, ids)) == brute_nodes(seqs)


def test_one_long_conversation(spark):
    rows = [(c, t, "user", f"w {t}" if t < 3000 else f"{c} {t}", "x", "y", "z") for c in (20, 40) for t in range(3050)]
    turns = P.saved(P.turn_rows(spark.createDataFrame(rows, SCHEMA)), "t")
    got = result(P.prefix_trie(turns, turns.select("conv_id").distinct(), 1000, 1000))
    seqs = {c: [("user", f"w {t}" if t < 3000 else f"{c} {t}") for t in range(3050)] for c in (20, 40)}
    assert len(got) == 1 + 3000 + 100
    root = next(r for r in got if r[1] == 0)
    assert root[3:7] == (2, 1, 2, 6000) and {r[7] for r in got if r[1] == 3050} == {hashlib.sha256(str(c).encode()).hexdigest() for c in seqs}


def test_turnless_and_empty(spark):
    # 21 takes its only turn from 20, which is absent, and has none of its own after h
    c = next(i for i in range(21, 40) if zlib.crc32(str(i).encode()) % 4 >= 1)
    rows = [(c, 0, "user", "gone", "x", "y", "z"), (45, 0, None, None, "x", "y", "z")]
    built, ids = P.rebuilt(P.saved(P.turn_rows(spark.createDataFrame(rows, SCHEMA)), "t"))
    assert result(P.prefix_trie(P.saved(built, "b"), ids)) == brute_nodes(brute_rebuilt(rows))
    built, ids = P.rebuilt(P.saved(P.turn_rows(spark.createDataFrame([], SCHEMA)), "t"))
    assert result(P.prefix_trie(P.saved(built, "b"), ids)) == []


def test_double_array():
    r = random.Random(2)
    seqs = sorted({tuple(r.randrange(30) for _ in range(r.randint(1, 8))) for _ in range(500)})
    ids = np.array([x for s in seqs for x in s])
    length = np.array([len(s) for s in seqs])
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    trie = P.packed(ids, first, length)
    prefixes = {s[:d] for s in seqs for d in range(1, len(s) + 1)}
    seen = {(): 0}
    for p in sorted(prefixes, key=len):
        at = int(trie.step(np.array([seen[p[:-1]]]), np.array([p[-1]]))[0])
        assert at > 0 and at not in seen.values()
        seen[p] = at
    for p in list(seen)[:200]:  # no child that was not put in
        for label in range(30):
            assert (trie.step(np.array([seen[p]]), np.array([label]))[0] > 0) == ((*p, label) in prefixes)
    assert (trie.check[:trie.end] >= 0).sum() == len(prefixes) + 1
