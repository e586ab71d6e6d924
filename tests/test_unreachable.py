"""Posts that no root leads to: circles, ways into them, orphans."""

import random

from threadlens.operators import tree as TR

EDGE = "conv_id string, parent_id string, post_id string, sib_pos int"


def report(spark, rows):
    return {(r.conv_id, r.post_id): (r.reason, r.top) for r in TR.unreachable(spark.createDataFrame(rows, EDGE)).collect()}


def test_circles_and_orphans(spark):
    rows = [("c", None, "r", 0), ("c", "r", "a", 0),
            ("c", "z", "x", 0), ("c", "x", "y", 0), ("c", "y", "z", 0),     # x -> y -> z -> x
            ("c", "y", "in", 0), ("c", "in", "deep", 0),                    # a way into it
            ("c", "self", "self", 0), ("c", "gone", "o", 0), ("c", "o", "p", 0),
            ("d", None, "x", 0), ("d", "x", "y", 0),                        # the same ids, reachable here
            ("d", "y", "two", 0), ("d", "nobody", "two", 0)]                # reachable by one of its parents
    assert report(spark, rows) == {
        ("c", "x"): ("cycle", "x"), ("c", "y"): ("cycle", "x"), ("c", "z"): ("cycle", "x"), ("c", "in"): ("cycle", "x"), ("c", "deep"): ("cycle", "x"),
        ("c", "self"): ("cycle", "self"), ("c", "o"): ("orphan", "gone"), ("c", "p"): ("orphan", "gone")}
    assert report(spark, rows[:2]) == {} and report(spark, []) == {}


def test_random_pointers(spark):
    r = random.Random(6)
    rows, want = [], {}
    for c in range(12):
        n = r.randint(1, 40)
        parent = {f"{i:02}": r.choice([None, "missing", *[f"{j:02}" for j in range(n)], *[f"{j:02}" for j in range(n)]]) for i in range(n)}
        rows += [(str(c), p, i, 0) for i, p in parent.items()]
        for i in parent:
            seen, at = [], i
            while at in parent and at not in seen:
                seen.append(at)
                at = parent[at]
            if at == "missing":
                want[str(c), i] = ("orphan", "missing")
            elif at is not None:
                want[str(c), i] = ("cycle", min(seen[seen.index(at):]))
    assert any(v[0] == "cycle" for v in want.values()) and report(spark, rows) == want
