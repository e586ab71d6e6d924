"""A key document in byte ranges equals the whole parse; stored profile sketches merge."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from threadlens.operators import profile as PR
from threadlens.session import shared_dir
from threadlens.sources import key_ranges as KR
from threadlens.sources import labels as LB

ODD = ['a"b', "back\\", "\\\\", '\\"', "{", "}", "[,]", "comma, colon: x", "é ", "", " ", '"', "\n", '","', '":{"']


def stored(spark, texts):
    root = shared_dir(spark, "key-files").removeprefix("file:")
    os.makedirs(root)
    for i, t in enumerate(texts):
        with open(f"{root}/{i}.json", "w", encoding="utf-8") as f:
            f.write(t)
    rows = [(f"{root}/{i}.json", len(t.encode())) for i, t in enumerate(texts)]
    return root, spark.createDataFrame(rows, "path string, size long")


def documents():
    r = random.Random(2)
    keys = [*ODD, *[f"id{i}" for i in range(40)]]
    big = {k: r.choice([*ODD, "support", "deny"]) for k in keys}
    return [json.dumps({"other": {"x": "no", 'q"}': "no"}, LB.SECTION: big, "last": {"id1": "no"}}), json.dumps({LB.SECTION: big}, indent=3, ensure_ascii=False), "{}", '{"%s": {}}' % LB.SECTION,
            '{"%s": {"a": "1", "b": "2", "a": "3"}}' % LB.SECTION, json.dumps({LB.SECTION: {"long": "x\\" * 300 + "y" * 2000, "after": "z"}})]


@pytest.mark.parametrize("size", [1, 7, 64, 10_000_000])
def test_ranges_equal_the_whole(spark, size):
    texts = documents() if size > 1 else documents()[2:5]
    root, files = stored(spark, texts)
    whole = LB.parse_label_keys(LB.read_documents(spark, root), "train")
    got = KR.key_rows(files, "train", range_bytes=size)
    assert got.columns == whole.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_sketches_merge(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("fold"), (F.col("id") % 7).alias("folder"), (F.col("id") % 9001).alias("post_id"), (F.col("id") % 5 == 0).cast("int").alias("issource"))
    parts = PR.profile_sketches(rows.where("folder < 3"), ["fold", "folder"]).unionByName(PR.profile_sketches(rows.where("folder >= 3"), ["fold", "folder"]))
    whole = PR.merge_profiles(PR.profile_sketches(rows, ["fold"]))
    a, b = (PR.profile_estimates(x).first() for x in (PR.merge_profiles(PR.merge_profiles(parts, ["fold"])), whole))
    exact = PR.branch_profile(rows).first()
    assert a == b and (a.n_occurrences, a.n_source_occurrences) == (exact.n_occurrences, exact.n_source_occurrences)
    assert abs(a.n_posts - exact.n_posts) < 0.03 * exact.n_posts
