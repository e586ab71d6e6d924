"""Invariants on the fixture tables, and the skew behaviour of the dense index."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadlens.operators import encode as EN
from threadlens.operators import tree as TR
from threadlens.operators.index import dense_index, prefix_sum, range_bucketed
from threadlens.plans.fixtures import fixture
from threadlens.plans.q_threads import examples_df


def test_branches_equal_leaves(spark, sf_small):
    edges = fixture(spark, sf_small, "edges")
    nd = TR.nodes(edges)
    n_leaves = nd.where("is_leaf").count()
    n_branches = TR.branches(nd).select("conv_id", "branch_no").distinct().count()
    assert n_leaves == n_branches
    # path length = depth + 1
    assert nd.where(F.size("path") != F.col("depth") + 1).count() == 0


def test_examples_once_per_present_post_ids_dense(spark, sf_small):
    posts = fixture(spark, sf_small, "posts")
    ex = examples_df(spark, sf_small)
    assert ex.count() == posts.count()
    assert ex.groupBy("fold", "tweet_id").count().where("count > 1").count() == 0
    dense = ex.groupBy("fold").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    assert all(r.lo == 0 and r.hi == r.n - 1 for r in dense.collect())
    # the previous post is a present ancestor: same thread, earlier position
    assert ex.where((F.col("raw_text_prev") == "") != F.col("branch_id").endswith(".0")).count() == 0


def test_encoded_lengths_agree(spark, sf_small):
    ex = examples_df(spark, sf_small)
    vocab = EN.build_vocab(ex, ["clean_text"], 100)
    enc = EN.encode_examples(ex, vocab, 40)
    bad = enc.where((F.size("text") != F.size("type_mask")) | (F.size("text") != F.size("input_mask")))
    assert bad.count() == 0
    assert enc.agg(F.max(F.size("text"))).first()[0] <= 2 * ((40 - 3) // 2) + 3


def test_dense_index_matches_row_number_under_skew(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        # one conversation holds a third of all rows
        conv = 0 if i % 3 == 0 else rnd.randint(1, 400)
        rows.append((("a", "b")[i % 2], conv, [rnd.randint(0, 5) for _ in range(rnd.randint(1, 4))], i))
    df = spark.createDataFrame(rows, "fold string, conv_id int, ord array<int>, uid int")
    got = dense_index(df, ["conv_id", "ord", "uid"], "idx", ["fold"], buckets=16)
    w = Window.partitionBy("fold").orderBy("conv_id", "ord", "uid")
    ref = df.withColumn("ref", F.row_number().over(w) - 1)
    j = got.join(ref, ["fold", "uid"])
    assert j.where(F.col("idx") != F.col("ref")).count() == 0
    # the hot conversation is spread over several buckets
    b = range_bucketed(df, ["fold", "conv_id", "ord", "uid"], buckets=16, out="b")
    hot = b.where("conv_id = 0").select("b").distinct().count()
    assert hot > 3


def test_prefix_sum_weights(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)], "k int, w int")
    got = {r.k: r.s for r in prefix_sum(df, ["k"], "s", "w", buckets=7).collect()}
    assert all(got[k] == sum(j % 2 for j in range(k)) for k in range(100))
