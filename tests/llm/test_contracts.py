"""Each operator against a plain version, and on awkward tables."""

import brute as B
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlens.llm import common, decontaminate, lm_score, mixing, near_dups, pii, quality_model, quality_rules, substring_dedup, suffix_dedup, token_counts


def table(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *cols).collect()}


def test_near_dups(small):
    df, docs = small
    got = table(near_dups.near_dups(df, 3, 85, 100), "n_shingles", "component_id", "kept")
    want = B.near_dups(docs.items())
    assert got == {i: (*v, v[1] == i) for i, v in want.items()}
    assert sum(1 for v in got.values() if not v[2]) > 5


def test_near_dups_five_words(small):
    df, docs = small
    got = table(near_dups.near_dups(df), "n_shingles", "component_id")
    assert got == B.near_dups(docs.items(), 5, 4, 5)


def test_near_dups_crowded_prefixes(spark):
    """Hundreds of near copies of one text beside others: one component."""
    import random
    r = random.Random(1)
    w = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(600):
        v = list(w)
        for _ in range(3):
            v[r.randrange(400)] = f"x{r.randrange(50)}"
        rows.append((i, " ".join(v)))
    rows += [(1000 + i, " ".join(f"y{i}_{j}" for j in range(100))) for i in range(20)]
    got = table(near_dups.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100), "component_id")
    assert {got[i][0] for i in range(600)} == {0}
    assert all(got[1000 + i][0] == 1000 + i for i in range(20))


def test_near_dups_beside_an_unlinked_crowd(spark):
    """A linked pair of short pages on each template, among hundreds of longer
    ones that are below the threshold among themselves and with the pair."""
    rows, pairs = [], []
    for t in range(4):
        template = " ".join(f"t{t}_{i}" for i in range(322))
        for i in range(600):
            d = 10_000 * t + i
            rows.append((d, f"{template} " + " ".join(f"w{d}_{j}" for j in range(20 if i < 2 else 60))))
        pairs.append((10_000 * t, 10_000 * t + 1))
    got = table(near_dups.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100), "component_id")
    assert [got[b][0] for _, b in pairs] == [a for a, _ in pairs]
    assert all(got[d][0] == d for d, _ in rows if d % 10_000 != 1)


def test_near_dups_main_component_in_blocks(spark):
    """Blocks of one row lose no pair."""
    r, sets = __import__("random").Random(3), {}
    base = [r.getrandbits(62) for _ in range(60)]
    for i in range(40):
        v = list(base)
        for _ in range(r.randrange(8)):
            v[r.randrange(60)] = r.getrandbits(62)
        sets[bytes([i])] = set(v)
    rows = [(k, b"\0" if k[0] % 3 else k, b"".join(x.to_bytes(8, "little") for x in sorted(v))) for k, v in sets.items()]
    root = {k: x for k, x, _ in rows}
    want = {(a, b) for a in sets for b in sets if a < b and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    for block in (1, 7, 4096):
        got = {(bytes(x.u), bytes(x.v)) for x in near_dups.beyond(spark.createDataFrame(rows, "node binary, root binary, set binary"), 85, 100, block).collect()}
        assert want and want <= got
        assert all(root[a] != root[b] for a, b in got)


def test_near_dups_crowd_below_the_threshold(spark):
    """Classes that share a template and, two by two, a rare shingle, but are no
    links: hardly a pair becomes a row, and none of the links is missing."""
    r, sets = __import__("random").Random(5), {}
    base, pool = ([r.getrandbits(62) for _ in range(n)] for n in (160, 200))
    for i in range(200):
        sets[bytes([i])] = set(base) | set(r.sample(pool, 20))
    for i in range(20):  # and some links
        sets[bytes([i, 1])] = sets[bytes([i])] - {r.choice(base)}
    rows = [(k, k, b"".join(x.to_bytes(8, "little") for x in sorted(v))) for k, v in sets.items()]
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    got = {(bytes(x.u), bytes(x.v)) for x in near_dups.beyond(spark.createDataFrame(rows, "node binary, root binary, set binary"), 85, 100).collect()}
    assert len(want) >= 20 and want <= got
    assert len(got) < 5 * len(want), (len(got), len(want))


def test_token_counts(small):
    import public_tokenizers as P
    df, docs = small
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {i: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for i, x in docs.items()}
    assert table(token_counts.token_counts(df), "n_bytes", "n_tokens") == want
    # short chunks: nearly every text is spliced, long pre-tokens make overlaps widen
    assert table(token_counts.token_counts(df, chunk=256, overlap=64), "n_bytes", "n_tokens") == want


def test_suffix_dedup(small):
    df, docs = small
    flags = B.byte_spans(list(docs.values()))
    want = {i: B.byte_row(t, f) for (i, t), f in zip(docs.items(), flags)}
    cols = "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert table(suffix_dedup.suffix_dedup(df), *cols) == want
    assert table(suffix_dedup.suffix_dedup(df, hot=1), *cols) == want  # every anchor dealt as a hot one


def test_substring_dedup(small):
    df, docs = small
    assert table(substring_dedup.substring_dedup(df), "n_words", "n_removed", "kept_sha256") == B.word_rows(docs.items())


def test_personal_data(small):
    df, docs = small
    got = table(pii.find_pii(df, pii.train(df, epochs=2)), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, t in docs.items():
        s = B.base_spans(t)
        assert got[i][:4] == tuple(sum(k == x for x, _, _ in s) for k in pii.KINDS)
        assert got[i][4] == B.sha(B.joined(s).encode())
        assert {x for x in B.joined(s).split(",") if x} <= set(got[i][5].split(","))
    assert table(pii.find_pii(df, None), "spans")[next(i for i, t in docs.items() if t and t.startswith("mail"))][0].count("email") == 2


def test_lm_score(small):
    df, docs = small
    want = B.unigram(docs.items())
    for block, per in ((2_000, 500), (lm_score.BLOCK, lm_score.PER_BUCKET)):  # many blocks and buckets, one
        got = table(lm_score.lm_scores(df, block, per), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "open_score")
        for i, w in want.items():
            assert got[i][:4] == w[:4]
            assert got[i][4] == pytest.approx(w[4], abs=1e-6)
            assert got[i][5] < 0 and got[i][6] <= got[i][5] + 1e-6
        held = [g for g in got.values() if g[0]]
        assert sum(g[5] for g in held) > sum(g[4] for g in held)


def test_lm_score_packs_numbers_by_their_entropy():
    r = np.random.default_rng(2)
    x = np.minimum(r.zipf(1.3, 200_000), 60_000).astype(np.int64)
    packed = lm_score.planes(x)
    assert (lm_score.numbers(packed) == x).all() and len(packed) < 1.4 * len(x)
    for few in (np.zeros(0, np.int64), np.array([0]), np.array([2**40, 3])):
        assert lm_score.numbers(lm_score.planes(few)).tolist() == few.tolist()


def test_workers_hold_small_pieces_of_a_batch(monkeypatch):
    import tracemalloc

    r = np.random.default_rng(11)
    texts = [" ".join(f"w{i}" for i in r.integers(0, 5_000, 18_000)) for _ in range(60)]
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts, "lang": ["en"] * 60, "source": ["a"] * 60})
    sets = [np.unique(r.integers(0, 2**63, 4_000, dtype=np.uint64)).tobytes() for _ in range(400)]
    node = [bytes([i % 256, i // 256]) * 8 for i in range(400)]
    links = pa.RecordBatch.from_pydict({"u": node, "v": node[::-1], "set_u": sets, "set_v": sets[:200] + sets[:200]})
    vocab = quality_model.Vocabulary(r.integers(0, 2**63, 1_000, dtype=np.uint64))
    for run, batch, most in ((near_dups._signed(5), docs, 60), (near_dups._sets(5), docs, 60), (quality_model._counted(vocab, quality_model.Names([])), docs, 60),
                             (near_dups._exploded, links.select(["u", "set_u"]).rename_columns(["node", "set"]), 70), (near_dups._confirmed(4, 5), links, 70)):
        monkeypatch.setattr(common, "_POWERS", {})  # a worker's table begins empty
        tracemalloc.start()
        got = [b for b in run(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) > 1 and peak < most << 20, (run, len(got), peak >> 20)
        rows = pa.Table.from_batches(got).to_pylist()
        alone = pa.Table.from_batches([b for i in range(batch.num_rows) for b in run(iter([batch.slice(i, 1)]))]).to_pylist()
        assert rows == alone
    assert [x["u"] for x in rows] == node[:200]


def test_lm_score_packs_states_counts_and_spellings_small():
    r = np.random.default_rng(5)
    c = np.sort(r.zipf(1.6, 3_000).clip(max=50_000))[::-1]
    gid = np.arange(3_000) * 5 + 2
    at = r.permutation(3_000)
    sent = lm_score.ranked(c[at], gid[at])  # a word's number is its rank by count, so counts are steps down
    assert (lm_score.counts_of(sent, gid[at]) == c[at]).all() and len(sent) < len(lm_score.planes(c[at])) / 2
    for n in (0, 1):
        assert (lm_score.counts_of(lm_score.ranked(c[:n], gid[:n]), gid[:n]) == c[:n]).all()
    state = np.concatenate((c - 0.6 * r.integers(1, 3, 3_000), r.normal(-20, 5, 3_000), [0.0, -0.0, np.inf, -np.inf]))
    for kind in (np.float64, np.float32):
        x = state.astype(kind)
        packed = lm_score.bits(x)
        assert lm_score.floats(packed, kind).tobytes() == x.tobytes() and len(packed) < 0.85 * x.nbytes
    words = [f"word{i % 97}".encode() for i in range(500)] + [b""]
    row = {"words": lm_score.squeezed(b"".join(words)), "lens": lm_score.planes(np.array([len(w) for w in words]))}
    raw, offs = lm_score.word_bytes(row)
    assert [raw[i:j].tobytes() for i, j in zip(offs[:-1], offs[1:])] == words and len(row["words"]) < len(raw) / 2
    assert lm_score.word_bytes({"words": lm_score.squeezed(b""), "lens": lm_score.planes(np.array([0]))})[1].tolist() == [0, 0]


def test_lm_score_seats_by_parts_as_one_by_one():
    """Dishes seated together, ordered by customers, get the tables each gets alone."""
    r = np.random.default_rng(4)
    c = np.minimum(r.zipf(1.3, 300), 5_000).astype(np.float64)
    c[::7] = 0
    q, weight, key = r.random(300) * 0.01, 1 + 0.6 * r.integers(1, 900, 300), r.integers(0, 2**63, 300, dtype=np.uint64)
    together = lm_score.seated(c, q, weight, 0.6, key, 9)
    alone = [lm_score.seated(c[i:i + 1], q[i:i + 1], weight[i:i + 1], 0.6, key[i:i + 1], 9)[0] for i in range(300)]
    assert together.tolist() == alone and ((together >= (c > 0)) & (together <= c)).all()


def test_hashes_of_small_texts_keep_small_tables(monkeypatch):
    monkeypatch.setattr(common, "_POWERS", {})
    buf = np.frombuffer(b"some words " * 5_000, np.uint8)
    common.span_hashes(buf, np.array([0, 5]), np.array([4, 10]))
    assert sum(x.nbytes for x in common._POWERS.values()) <= 2 << 20


def test_lm_score_has_word_contexts(spark):
    """A learned order scores above its shuffles, contexts beat the unigram on
    held-out text, and the scores of all texts of up to two words stay below 1."""
    import random
    import zlib

    r = random.Random(3)
    follow = {"the": ["dog", "cat", "bird"], "dog": ["ran", "sat"], "cat": ["ran", "sat"], "bird": ["ran"], "ran": ["after", "home"], "sat": ["home", "after"], "after": ["the"], "home": ["the"]}

    def walk(n):
        out = ["the"]
        while len(out) < n:
            out.append(r.choice(follow[out[-1]]))
        return " ".join(out)

    train_ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 != 1]
    held_ids = iter([i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 1])
    texts = [(i, walk(12)) for i in train_ids[:200]]
    known = sorted(follow)
    short = ["", *known, "zebra", *(f"{a} {b}" for a in [*known, "zebra"] for b in [*known, "zebra"])]
    probes = ["the dog ran after the cat", "cat the after ran dog the", "dog the cat the after ran", *[walk(12) for _ in range(20)]]
    ids = {t: next(held_ids) for t in dict.fromkeys([*short, *probes])}
    df = spark.createDataFrame(texts + [(i, t) for t, i in ids.items()], "doc_id long, text string").repartition(3)
    got = table(lm_score.lm_scores(df, 1_000, 300), "held_out", "n_tokens", "base_score", "score")
    right, *wrong = [got[ids[t]][3] for t in probes[:3]]
    assert all(right > w + 2 for w in wrong)
    assert sum(got[ids[t]][3] for t in probes[3:]) > 0.8 * sum(got[ids[t]][2] for t in probes[3:])
    assert sum(10 ** got[ids[t]][3] for t in short) <= 1 + 1e-6


def test_quality_rules(small):
    df, docs = small
    got = table(quality_rules.judge(df), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, t in docs.items():
        want = B.quality(t)
        assert got[i][:6] == want
        assert not (want[5] and got[i][6])


def test_mixing(small):
    df, docs = small
    out = mixing.mix(df).collect()
    total = sum(len(B.words(t)) for t in docs.values())
    by = {}
    for r in out:
        assert r.size == len(B.words(docs[r.doc_id])) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by.setdefault(r.source, []).append(r)
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(1.5 * total)
    for rs in by.values():
        assert rs[0].target <= 2 * rs[0].source_size + 1e-6
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)
    again = {r.doc_id: r.taken for r in mixing.mix(df.repartition(3)).collect()}
    assert again == {r.doc_id: r.taken for r in out}
    copies = {r.doc_id: r["count"] for r in mixing.mixed_documents(df).groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in out if r.copies}


def test_decontaminate(spark, small):
    df, docs = small
    long_ = next(t for t in docs.values() if t and len(B.words(t)) == 12000)
    passage = long_[2000:2300]
    edited = passage[:100] + "Q" + passage[101:200] + passage[203:]
    far = "".join(c if i % 7 else "Q" for i, c in enumerate(passage))
    items = spark.createDataFrame([(1, passage.upper()), (2, edited), (3, far), (4, None), (5, "  "), (6, "no such passage anywhere in the texts at all")], "item_id long, text string")
    got = table(decontaminate.decontaminate(df, items), "n_items", "item_ids", "min_distance", "contaminated")
    i = next(i for i, t in docs.items() if t == long_)
    assert got[i] == (2, [1, 2], 0, True)
    assert all(v == (0, [], None, False) for k, v in got.items() if k != i)
    assert decontaminate.clean(df, items).columns == df.columns
    assert decontaminate.clean(df, items.limit(0)).count() == df.count()


def test_myers_and_pieces():
    import random
    r = random.Random(2)
    for _ in range(200):
        p = "".join(r.choice("ab ") for _ in range(r.randint(1, 60)))
        t = "".join(r.choice("ab ") for _ in range(r.randint(0, 80)))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
            row = new
        assert decontaminate.myers(p, t)[0] == min(row)
    assert decontaminate.pieces(10, 3) == [(0, 3), (3, 6), (6, 10)]


def labelled(spark, n=600):
    import random
    r = random.Random(4)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [r.choice(words) for _ in range(80)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w[r.randrange(80)] = r.choice(["vile", "nasty"])
        docs.append((i, " ".join(w), "en", f"s{i % 3}", 400))
        if i % 2 == 0 or i < 40:
            labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels + [(1, None, 0), (10**6, 0, 0)], "doc_id long, quality int, toxic int"))


def test_quality_model_held_out(spark):
    docs, labels = labelled(spark)
    model = quality_model.train(docs, labels, max_labelled=400)
    got = table(quality_model.score(docs, model), "kept")
    wrong = sum(got[i][0] == (i % 4 == 0) for i in got)
    assert len(got) == 600 and wrong <= 12
    assert quality_model.keep_good(docs, model).columns == docs.columns


def test_quality_model_metadata_and_pool(spark):
    """Ten sources in five languages, none like another to the metadata view;
    the views are handed documents from all that have no label."""
    import random
    r = random.Random(11)
    langs, sources = ["en", "de", "fr", "es", None], [f"site{i}" for i in range(10)]
    docs, labels = [], []
    for i in range(1500):
        source = r.choice(sources)
        bad = source in ("site3", "site7")
        words = [r.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(60)]
        if bad and r.random() < 0.9:
            words[::3] = [w[::-1] for w in words[::3]]  # lengths tell nothing
        docs.append((i, " ".join(words), r.choice(langs), source))
        if i < 400:
            labels.append((i, 1, int(bad)))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    model = quality_model.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(model.names) == 15 and model.handed["text"] > 100 and model.handed["meta"] > 100
    got = {x.doc_id: x for x in quality_model.score(df, model).collect()}
    assert all((got[i].meta_score < 0.5) == (d[3] in ("site3", "site7")) for i, d in enumerate(docs))
    assert sum(got[i].kept == (d[3] in ("site3", "site7")) for i, d in enumerate(docs)) <= 15
    batch = pa.RecordBatch.from_pylist([{"lang": v, "source": "new"} for v in [*langs, "it"]])
    numbers = model.names.find(batch)
    assert len(set(numbers[:5, 0])) == 5 and min(numbers[:5, 0]) >= 0 and numbers[5, 0] == -1 and set(numbers[:, 1]) == {-1}


def test_tagger_learns(spark):
    """Held-out accuracy of the tagger on spans written in other ways."""
    import random
    r = random.Random(6)

    def doc(i):
        n = "".join(r.choice("23456789") for _ in range(7))
        kind = [f"+1 (555) {n[:3]}-{n[3:]}", f"user.{n[:2]}@mail{i % 7}.example.com", f"{r.randint(11, 99)}.{r.randint(11, 99)}.{r.randint(1, 9)}.{r.randint(11, 99)}"][i % 3]
        return f"some words before {kind} and words behind, version {i % 5}.0 of it"

    train = spark.createDataFrame([(i, doc(i)) for i in range(900)], "doc_id long, text string")
    t = pii.train(train)
    hits = 0
    for i in range(200):
        n = "".join(r.choice("23456789") for _ in range(7))
        text = f"please call 555-{n[:3]}-{n[3:]} soon, it is version 3.0 of the words"
        hits += any(k == "phone" for k, _, _ in pii.find(text, t)[1])
    assert hits >= 150
    clean = ["nothing here but words and version 2.0", "token = 'a5fa9ea468653f690' and words"]
    assert all(not pii.find(c, t)[1] for c in clean)


class _Everywhere:
    """A tagger that takes every run without a space or bracket for an email,
    as far as its window shows it."""

    def decode(self, ids):
        c = ids + 31
        return ((ids > 0) & (c != 32)) * 2


def test_spelled_out_email_needs_no_digit():
    far = "plain words " * 30
    for mail in ("jane.doe(at)example.com", "jane[at]example[dot]com", "JANE.DOE(AT)EXAMPLE.COM", "x" * 100 + "(at)" + "y" * 100 + ".com"):
        t = f"{far}{mail} {far}"
        assert pii.find(t, _Everywhere())[1] == [("email", len(far), len(far) + len(mail))]
        import pyarrow as pa
        batch = pa.RecordBatch.from_pydict({"text": [far, t, None, "meet me at\u00a0noon"]})
        assert pii._worth(batch).tolist() == [False, True, False, True]


def test_rare_spans_are_trained_on(spark):
    """A handful of labelled spans among many documents: all are used."""
    rows = [(i, f"words {i} of a page with version {i % 7}" + (f" mail a{i}@b.org" if i % 300 == 7 else "")) for i in range(3000)]
    t = pii.train(spark.createDataFrame(rows, "doc_id long, text string"), max_docs=100, max_windows=80, epochs=1)
    assert t is not None and t.used["email"] == 20 and 0 < t.used["none"] <= 60
    assert pii.shares({-1: 10**6, 0: 5, 1: 900, 2: 10**6}, 2400) == {-1: 600, 0: 5, 1: 897, 2: 898}
    assert pii.shares({-1: 9, 3: 10**6}, 2400) == {-1: 9, 3: 2391}
    assert pii.shares({-1: 50}, 2400) == {-1: 50}


OPS = {
    "near_dups": lambda d, s: near_dups.near_dups(d),
    "keep_one": lambda d, s: near_dups.keep_one(d),
    "token_counts": lambda d, s: token_counts.token_counts(d, chunk=500, overlap=64),
    "suffix": lambda d, s: suffix_dedup.suffix_dedup(d),
    "substring": lambda d, s: substring_dedup.substring_dedup(d),
    "pii": lambda d, s: pii.find_pii(d, pii.train(d, epochs=1)),
    "mask": lambda d, s: pii.mask_pii(d, pii.train(d, epochs=1)),
    "lm": lambda d, s: lm_score.lm_scores(d),
    "rules": lambda d, s: quality_rules.judge(d),
    "mix": lambda d, s: mixing.mix(d),
    "mixed": lambda d, s: mixing.mixed_documents(d),
    "decontaminate": lambda d, s: decontaminate.decontaminate(d, s.createDataFrame([(1, "one two three")], "item_id long, text string")),
    "model": lambda d, s: quality_model.score(d, quality_model.train(d, s.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))),
}
ROW_PER_DOCUMENT = set(OPS) - {"keep_one", "mixed"}


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, empty, name):
    out = OPS[name](empty, spark)
    assert out.count() == 0 and "doc_id" in out.columns


@pytest.mark.parametrize("name", OPS)
def test_odd_table(spark, odd, name):
    out = OPS[name](odd, spark).cache()
    if name in ROW_PER_DOCUMENT:
        assert out.count() == odd.count()
        a = {r[0]: r[1] for r in odd.groupBy("doc_id").count().collect()}
        assert {r[0]: r[1] for r in out.groupBy("doc_id").count().collect()} == a
    assert out.count() > 0


def test_repeated_rows_are_cut_alike(spark, odd):
    twice = odd.groupBy("doc_id", "text").count().where("count > 1 and doc_id is not null").collect()
    for f in (suffix_dedup.suffix_dedup, substring_dedup.substring_dedup):
        got = f(odd).collect()
        for r in twice:
            same = {g for g in got if g.doc_id == r.doc_id}
            assert len([g for g in got if g.doc_id == r.doc_id]) >= 2 and len(same) == 1


def test_personal_data_long_runs():
    """Runs of a megabyte, digits beyond Python's limit, and matches that follow each other inside a run."""
    import re
    import time
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    r = __import__("random").Random(8)
    for _ in range(3000):
        t = "".join(r.choice("ab1._@-@ .+") for _ in range(r.randint(0, 30)))
        assert pii.emails(t) == [m.span() for m in plain.finditer(t)], t
        assert [(a, b) for k, a, b in pii.base_spans(t) if k == "ip"] == [m.span() for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", t) if all(int(p) <= 255 for p in m.group().split("."))]
    start = time.time()
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]
    assert pii.base_spans("9" * 5000 + ".1.1.1") == []
    assert pii.plausible("ip", "0" * 5000 + "1 1 1 1") and not pii.plausible("ip", "9" * 5000 + " 1 1 1")
    million = 1_000_000
    assert pii.base_spans("7" * million) == []
    assert pii.base_spans("a" * million + "@b.c") == [("email", 0, million + 4)]
    assert pii.base_spans("@" + "b-" * (million // 2)) == pii.base_spans("a@" + "b-" * (million // 2)) == []
    assert pii.base_spans("1." * (million // 2)) is not None
    assert time.time() - start < 10


def test_mix_of_a_table_with_a_copy_column(spark, small):
    df, _ = small
    want = mixing.mixed_documents(df)
    got = mixing.mixed_documents(df.withColumn("copy", F.lit("x")))
    assert got.columns == want.columns and got.count() == want.count()
