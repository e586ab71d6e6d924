"""File sources: folder scans, hidden files, key documents, legacy example
documents, and the whole preparation from folders."""

import json

from threadlens.plans.prepare import ThreadFolder, prepare_examples
from threadlens.session import shared_dir
from threadlens.sources import examples_io as IO
from threadlens.sources import labels as LB
from threadlens.sources import layout as LY
from threadlens.sources import threads as TH


def write(spark, root, files):
    df = spark.createDataFrame([(f"{root}/{k}", v) for k, v in files.items()], "path string, content string")
    assert LY.write_files(df) == len(files)


def tweet(i, text):
    return json.dumps({"id_str": i, "id": int(i), "text": text})


def test_twitter_scan_skips_hidden_files_and_takes_last_structure_line(spark):
    root = shared_dir(spark, "t-hidden")
    write(spark, root, {
        "t/1/source-tweet/1.json": tweet("1", "source"),
        "t/1/replies/2.json": tweet("2", "reply"),
        "t/1/replies/.3.json": tweet("3", "hidden"),
        "t/1/structure.json": '{"1": []}\n{"1": {"2": []}}\n',
    })
    posts = {r.post_id: r for r in TH.scan_twitter(spark, root).collect()}
    assert set(posts) == {"1", "2"}
    assert posts["1"].is_source and posts["1"].topic == "t" and posts["1"].conv_id == "1"
    edges = sorted((r.parent_id or "", r.post_id) for r in TH.scan_edges(spark, root, "twitter").collect())
    assert edges == [("", "1"), ("1", "2")]


def test_label_keys_whole_file_last_duplicate_wins(spark):
    root = shared_dir(spark, "keys")
    write(spark, root, {"dev-key.json": '{"subtaskaenglish": {"a": "deny", "b": "query", "a": "support"}}'})
    got = {r.post_id: (r.split, r.label) for r in LB.read_label_keys(spark, {"dev": f"{root}/dev-key.json"}).collect()}
    assert got == {"a": ("dev", "support"), "b": ("dev", "query")}


def test_legacy_example_document(spark):
    root = shared_dir(spark, "legacy")
    ex = {"id": 0, "branch_id": "0.0", "tweet_id": "1", "stance_label": 3, "raw_text": "x", "raw_text_prev": "",
          "raw_text_src": "", "issource": 1, "clean_text": "x [EOS]", "ner": [0, 0], "hasqmark": 0}
    write(spark, root, {"train.json": json.dumps({"Examples": [ex, dict(ex, id=1, tweet_id="2")]})})
    rows = IO.read_legacy_examples(spark, f"{root}/train.json").collect()
    assert [(r.id, r.tweet_id, r.ner) for r in rows] == [(0, "1", [0, 0]), (1, "2", [0, 0])]


def test_prepare_examples_twitter_then_reddit(spark):
    tw, rd, keys = shared_dir(spark, "tw"), shared_dir(spark, "rd"), shared_dir(spark, "k")
    write(spark, tw, {
        "topic/1/source-tweet/1.json": tweet("1", "Is it true?"),
        "topic/1/replies/2.json": tweet("2", "no"),
        "topic/1/structure.json": '{"1": {"2": []}, "9": []}',
    })
    write(spark, rd, {
        "r1/source-tweet/r1.json": json.dumps({"data": {"children": [{"data": {"title": "Title", "author": "a"}}]}}),
        "r1/replies/r2.json": json.dumps({"data": {"body": "reply", "author": "b"}}),
        "r1/replies/r3.json": json.dumps({"data": {"author": "[deleted]"}}),
        "r1/structure.json": '{"r1": {"r2": [], "r3": []}}',
    })
    write(spark, keys, {"train-key.json": json.dumps({"subtaskaenglish": {
        "1": "query", "2": "comment", "r1": "support", "r2": "deny", "r3": "comment"}})})
    labels = LB.read_label_keys(spark, {"train": f"{keys}/train-key.json"})
    ex = prepare_examples(spark, [ThreadFolder(rd, "reddit", fold="train"), ThreadFolder(tw, "twitter")], labels, ["hell"])
    got = [(r.fold, r.id, r.branch_id, r.tweet_id, r.stance_label, r.raw_text, r.raw_text_src)
           for r in ex.orderBy("id").collect()]
    assert got == [
        ("train", 0, "0.0", "1", 3, "Is it true?", ""),
        ("train", 1, "0.1", "2", 1, "no", "Is it true?"),
        ("train", 2, "1.0", "r1", 0, "Title", ""),
        ("train", 3, "1.1", "r2", 2, "reply", "Title"),
        ("train", 4, "2.1", "r3", 1, "", "Title"),
    ]


def test_stored_texts_open_each_file_once(spark):
    root = shared_dir(spark, "t-stored")
    write(spark, root, {"t/1/source-tweet/1.json": tweet("1", "source"), "t/1/replies/2.json": tweet("2", "reply") + "\nno tweet"})
    once = TH.listed(spark, root, "twitter", stored=True)
    assert {r.post_id for r in TH.scan_twitter(spark, once).collect()} == {"1", "2"}
    write(spark, root, {"t/1/replies/2.json": "another text"})  # what was read stays
    assert [r.line for r in TH.corrupt_lines(spark, once, "twitter").collect()] == ["no tweet"]
