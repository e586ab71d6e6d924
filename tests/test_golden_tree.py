"""Hand-derived cases for the tree and example operators (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from threadlens.operators import examples as EX
from threadlens.operators import tree as TR


def edges_of(spark, trees):
    raw = spark.createDataFrame(list(trees.items()), "conv_id string, value string")
    return TR.tree_json_to_edges(raw)


def branch_lists(spark, edges):
    b = TR.branches(TR.nodes(edges)).collect()
    out = {}
    for r in b:
        out.setdefault((r.conv_id, r.branch_no), []).append((r.pos, r.post_id))
    return ["-".join(p for _, p in sorted(v)) for _, v in sorted(out.items())]


def posts_of(spark, conv, ids, fold="train"):
    rows = [(conv, i, i == ids[0], f"text {i}", 1, fold) for i in ids]
    return spark.createDataFrame(rows, "conv_id string, post_id string, is_source boolean, text string, "
                                       "stance int, fold string")


TREE = '{"1":{"2":{"3":[]},"4":[],"5":{"6":[],"7":[]}}}'


def test_tree_branches(spark):
    assert branch_lists(spark, edges_of(spark, {"c": TREE})) == ["1-2-3", "1-4", "1-5-6", "1-5-7"]


def test_sibling_order_is_file_order(spark):
    e = edges_of(spark, {"c": '{"9":{"2":{"3":[]},"1":[],"5":{"7":[],"6":[]}}}'})
    assert branch_lists(spark, e) == ["9-2-3", "9-1", "9-5-7", "9-5-6"]


def test_lone_root_and_empty_object_leaf(spark):
    assert branch_lists(spark, edges_of(spark, {"c": '{"1":[]}'})) == ["1"]
    assert branch_lists(spark, edges_of(spark, {"c": '{"1":{"2":{}}}'})) == ["1-2"]


def test_first_root_a_leaf_walks_all_roots(spark):
    assert branch_lists(spark, edges_of(spark, {"c": '{"1":[],"2":[]}'})) == ["1", "2"]


def test_examples_of_full_tree(spark):
    edges = edges_of(spark, {"c": TREE})
    posts = posts_of(spark, "c", [str(i) for i in range(1, 8)])
    ex = EX.build_examples(posts, edges, ["hell"]).orderBy("id").collect()
    got = " ".join(f"{r.branch_id}:{r.tweet_id}" for r in ex)
    assert got == "0.0:1 0.1:2 0.2:3 1.1:4 2.1:5 2.2:6 3.2:7"
    assert [r.id for r in ex] == list(range(7))
    by = {r.tweet_id: r for r in ex}
    assert by["1"].raw_text_prev == "" and by["1"].raw_text_src == ""
    assert by["6"].raw_text_prev == "text 5" and by["6"].raw_text_src == "text 1"


def test_missing_post_takes_nearest_present_ancestor(spark):
    edges = edges_of(spark, {"c": TREE})
    posts = posts_of(spark, "c", ["1", "3", "4", "5", "6", "7"])
    ex = {r.tweet_id: r for r in EX.build_examples(posts, edges, ["hell"]).collect()}
    assert "2" not in ex
    assert ex["3"].branch_id == "0.1"
    assert ex["3"].raw_text_prev == "text 1" and ex["3"].raw_text_src == "text 1"


def test_missing_root(spark):
    edges = edges_of(spark, {"c": '{"1":{"2":{"3":[]},"4":[]}}'})
    posts = posts_of(spark, "c", ["2", "3", "4"])
    ex = {r.tweet_id: r for r in EX.build_examples(posts, edges, ["hell"]).collect()}
    # branches 1-2-3 -> [2,3], 1-4 -> [4]
    assert ex["2"].branch_id == "0.0" and ex["2"].raw_text_prev == ""
    assert ex["3"].branch_id == "0.1" and ex["3"].raw_text_src == "text 2"
    assert ex["4"].branch_id == "1.0" and ex["4"].raw_text_src == ""


def test_prune_and_graft(spark):
    trees = {"1": '{"1":{"2":[]},"8":{"9":[]}}'}
    e = edges_of(spark, trees)
    assert branch_lists(spark, e) == ["1-2", "8-9"]
    pruned = TR.prune_roots(e, F.col("conv_id"))
    assert branch_lists(spark, pruned) == ["1-2"]
    fixes = spark.createDataFrame([("1", "9", "1", 0)], "conv_id string, post_id string, new_parent string, fix_pos int")
    assert branch_lists(spark, TR.prune_roots(TR.graft(e, fixes), F.col("conv_id"))) == ["1-2", "1-9"]


def test_post_in_two_threads_of_a_fold(spark):
    edges = edges_of(spark, {"a": '{"1":{"2":[]}}', "b": '{"3":{"2":[]}}'})
    posts = posts_of(spark, "a", ["1", "2"]).unionByName(posts_of(spark, "b", ["3", "2"]))
    ex = EX.build_examples(posts, edges, ["hell"]).orderBy("id").collect()
    assert [(r.branch_id, r.tweet_id) for r in ex] == [("0.0", "1"), ("0.1", "2"), ("1.0", "3")]


def test_cycle_in_parent_table_is_cut(spark):
    e = spark.createDataFrame([("c", None, "1", 0), ("c", "1", "2", 0), ("c", "2", "3", 0), ("c", "3", "2", 0)],
                              "conv_id string, parent_id string, post_id string, sib_pos int")
    w = TR.walk(e).collect()
    assert sorted(r.post_id for r in w) == ["1", "2", "3"]


def test_branch_numbers_run_over_the_fold(spark):
    edges = edges_of(spark, {"a": '{"1":{"2":[],"3":[]}}', "b": '{"4":{"5":[]}}'})
    posts = posts_of(spark, "a", ["1", "2", "3"]).unionByName(posts_of(spark, "b", ["4", "5"]))
    ex = EX.build_examples(posts, edges, ["hell"]).orderBy("id").collect()
    assert [(r.id, r.branch_id) for r in ex] == [(0, "0.0"), (1, "0.1"), (2, "1.1"), (3, "2.0"), (4, "2.1")]


def test_present_branches_and_labels(spark):
    edges = edges_of(spark, {"c": TREE})
    posts = posts_of(spark, "c", ["1", "3", "4"])
    pb = TR.present_branches(TR.branches(TR.nodes(edges)), posts)
    rows = sorted((r.branch_no, r.pos, r.post_id) for r in pb.collect())
    assert rows == [(0, 0, "1"), (0, 1, "3"), (1, 0, "1"), (1, 1, "4"), (2, 0, "1"), (3, 0, "1")]
    labels = {r.branch_no: r.labels for r in TR.branch_labels(pb, posts).collect()}
    assert labels[0] == [1, 1]
