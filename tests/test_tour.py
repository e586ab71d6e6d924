"""The Euler tour against a plain walk, and on a chain without end."""

import random

from pyspark.sql import functions as F

from threadlens.operators import tour as TO
from threadlens.operators import tree as TR

EDGE = "conv_id string, parent_id string, post_id string, sib_pos int"


def plain(rows):
    """(conv, post) -> (enter, depth, size, branch_no, n_leaves) by recursion."""
    out = {}
    for conv in {r[0] for r in rows}:
        kids = {}
        for _, p, i, pos in rows:
            if _ == conv:
                kids.setdefault(p, []).append((pos, i))
        counter = [0, 0]

        def visit(i, depth):
            enter, before = counter
            counter[0] += 1
            for _, k in sorted(kids.get(i, [])):
                visit(k, depth + 1)
            counter[1] += i not in kids
            out[conv, i] = (enter, depth, counter[0] - enter, before, counter[1] - before)

        for _, root in sorted(kids.get(None, [])):
            visit(root, 0)
    return out


def test_random_trees(spark, monkeypatch):
    monkeypatch.setattr(TO, "CHUNK", 3)
    r = random.Random(3)
    rows = []
    for c in range(8):
        for i in range(r.randint(1, 60)):
            parent = None if i < 1 + c % 3 else f"{r.randrange(i):03}"
            rows.append((f"c{c}", parent, f"{i:03}", r.randrange(3)))
    rows += [("hot", None, "top", 0), *[("hot", "top", f"k{i:04}", i) for i in range(500)]]
    rows += [("lone", None, "only", 5)]
    want = plain(rows)
    # what no root leads to is left out: a circle, one post below it, an orphan with a child
    lost = [("c0", "y", "x", 0), ("c0", "x", "y", 0), ("c0", "y", "z", 1), ("c0", "s", "s", 0), ("c1", "gone", "o", 0), ("c1", "o", "p", 0), ("none", "a", "b", 0)]
    edges = spark.createDataFrame(rows + rows[:20] + lost, EDGE)
    tour = TO.euler_tour(edges).cache()
    assert {(x.conv_id, x.post_id): tuple(x)[2:] for x in tour.collect()} == want
    assert all(t.dataType.simpleString() in ("string", "bigint") for t in tour.schema)
    paths = {}
    for x in TO.tour_branches(tour).collect():
        paths.setdefault((x.conv_id, x.branch_no), {})[x.pos] = x.post_id
    above = {(c, i): p for c, p, i, _ in rows}
    assert len(paths) == sum(v[2] == 1 for v in want.values())
    for (conv, no), posts in paths.items():
        way = [posts[k] for k in range(len(posts))]
        assert want[conv, way[-1]][2:] == (1, no, 1) and [above[conv, i] for i in way] == [None, *way[:-1]]


def test_tour_agrees_with_the_walk(spark):
    r = random.Random(4)
    rows = [(f"c{c}", None if i == 0 else f"p{r.randrange(i)}", f"p{i}", i) for c in range(5) for i in range(40)]
    edges = spark.createDataFrame(rows, EDGE)
    a, b = TR.branches(TR.nodes(edges)), TO.tour_branches(TO.euler_tour(edges))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_several_parents_and_no_edges(spark):
    rows = [("c", None, "r", 0), ("c", "r", "b", 0), ("c", "r", "a", 0), ("c", "a", "x", 0), ("c", "b", "x", 0), ("c", "b", "r", 0)]
    got = {x.post_id: (x.enter, x.depth) for x in TO.euler_tour(spark.createDataFrame(rows, EDGE)).collect()}
    assert got == {"r": (0, 0), "a": (1, 1), "x": (2, 2), "b": (3, 1)}
    assert TO.tour_branches(TO.euler_tour(spark.createDataFrame([], EDGE))).count() == 0


def test_long_chain(spark):
    n = 100_000
    ids = spark.range(n).select(F.lit("c").alias("conv_id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent_id"), F.col("id").cast("string").alias("post_id"), F.lit(0).alias("sib_pos"))
    got = TO.euler_tour(ids).where("enter = cast(post_id as long) and depth = enter and size = 100000 - enter and branch_no = 0 and n_leaves = 1")
    assert got.count() == n
