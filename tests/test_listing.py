"""Folders listed in tasks, files dealt by size."""

import json
import os

import pytest
from pyspark.sql import functions as F

from threadlens.session import shared_dir
from threadlens.sources import listing as LI
from threadlens.sources import threads as TH


def put(root, files):
    root = root.removeprefix("file:")
    for name, text in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)


def test_names(spark):
    """Hidden files and folders are left out on every level, ``_`` names are not."""
    root = shared_dir(spark, "names")
    put(root, {"t/1/replies/2.json": "{}", "t/1/replies/_3.json": "{}", "t/1/replies/.4.json": "{}", "t/1/source-tweet/1.json": "{}", "t/1/structure.json": "{}",
               "t/1/other/5.json": "{}", "t/.1/replies/6.json": "{}", ".t/1/replies/7.json": "{}", "_t/_1/replies/8.json": "{}", "t/notes.json": "{}", "t/1/replies/9.json/x": ""})
    got = {(r.name, r.path.split("/")[-4]) for r in TH.Listed(spark, root, 2).files.collect()}
    assert got == {("2.json", "t"), ("_3.json", "t"), ("1.json", "t"), ("8.json", "_t")}
    assert {r.name for r in TH.Listed(spark, root, 2).entries.where("not is_dir").collect()} == {"structure.json"}


def test_empty_root_and_missing_root(spark):
    root = shared_dir(spark, "none")
    os.makedirs(root.removeprefix("file:"))
    assert TH.scan_twitter(spark, root).count() == 0 and TH.scan_edges(spark, root, "reddit").count() == 0
    with pytest.raises(Exception, match="FileNotFound|No such file"):
        TH.scan_twitter(spark, root + "-x").count()


def test_texts_are_dealt_by_size(spark):
    """One large file among small ones has a task of its own; all are read whole."""
    root = shared_dir(spark, "sizes")
    texts = {f"c/replies/{i}.json": "é" * (10 + i) for i in range(40)} | {"c/replies/5.json": "x" * (4 << 20)}
    put(root, texts)
    df = LI.read_texts(TH.Listed(spark, root, 1).files, 1 << 20).withColumn("part", F.spark_partition_id())
    rows = df.collect()
    assert {r.file_path.split(root.removeprefix("file:") + "/")[1]: r.value for r in rows} == texts
    by = {}
    for r in rows:
        by.setdefault(r.part, []).append(len(r.value))
    assert len(by) > 1 and sorted(by[max(by, key=lambda p: max(by[p]))])[-1] == 4 << 20
    assert max(len(v) for v in by.values()) < 40


def test_a_hundred_thousand_files(spark):
    """Listed from rows; the plan holds one path, whatever there is below it."""
    root = shared_dir(spark, "many").removeprefix("file:")
    for c in range(100):
        d = f"{root}/{c}/replies"
        os.makedirs(d)
        for i in range(1000):
            os.close(os.open(f"{d}/{c}_{i}.json", os.O_CREAT | os.O_WRONLY))
    files = TH.Listed(spark, root, 1).files
    assert files.count() == 100_000
    assert files.select(F.countDistinct("name")).first()[0] == 100_000
    assert len(files._jdf.queryExecution().toString()) < 20_000


def test_reddit_scan(spark):
    root = shared_dir(spark, "reddit")
    put(root, {"c/source-tweet/a.json": json.dumps({"data": {"children": [{"data": {"title": "t", "author": "u"}}]}}), "c/replies/_b.json": json.dumps({"data": {"body": "x", "author": "v"}})})
    assert {(r.post_id, r.is_source) for r in TH.scan_reddit_raw(spark, root).collect()} == {("a", True), ("_b", False)}
