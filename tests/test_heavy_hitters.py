"""The sketch of frequent tokens gives the exact vocabulary, or widens."""

import random
from collections import Counter

from threadlens.operators import encode as EN


def corpus(spark, seed, words, weight):
    r = random.Random(seed)
    vocab = [f"t{i:05}" for i in range(words)]
    texts = [" ".join(r.choices(vocab, [1 / (i + 1) ** weight for i in range(words)], k=400)) for _ in range(50)]
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(6), Counter(w for t in texts for w in t.split())


def top(counts, k):
    return {w: n for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]}


def test_exact_top(spark):
    for weight, words, k in ((1.3, 5000, 20), (0.0, 3000, 50), (1.0, 40, 100)):
        df, counts = corpus(spark, 3, words, weight)
        a, b = (sorted(map(tuple, EN.build_vocab(df, ["t"], k, sketch=s).collect())) for s in (False, True))
        assert a == b and {w: n for w, _, n in b} == top(counts, k)


def test_a_narrow_sketch_is_widened(spark):
    """Too few counters for the bound: the result is exact all the same."""
    df, counts = corpus(spark, 4, 4000, 0.6)
    got = EN.heavy_hitters(EN.all_tokens(df, ["t"]), 30, named=32, tracked=64).collect()
    have = {r.token: r.n for r in got}
    want = top(counts, 30)
    assert {w: have[w] for w in want} == want and all(counts[w] == n for w, n in have.items())


def test_only_candidates_are_shuffled(spark):
    df, counts = corpus(spark, 5, 20_000, 1.6)
    got = EN.heavy_hitters(EN.all_tokens(df, ["t"]), 10)
    assert got.count() == 20 < len(counts) / 4


def test_empty(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "i int, t string")
    assert EN.build_vocab(df, ["t"], 5, sketch=True).count() == 0
