"""Repeated posts and edges, folds, deep and hot threads, hidden and corrupt
files, lexicons and gazetteers as tables, rules that must fire."""

import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from threadlens import session as S
from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.operators import encode as EN
from threadlens.operators import examples as EX
from threadlens.operators import features as FE
from threadlens.operators import model as MO
from threadlens.operators import profile as PR
from threadlens.operators import tree as TR
from threadlens.operators.index import dense_index
from threadlens.plans.prepare import ThreadFolder, prepare
from threadlens.sources import labels as LB
from threadlens.sources import layout as LY
from threadlens.sources import threads as TH

POST = "conv_id string, post_id string, is_source boolean, text string, stance int, fold string"
EDGE = "conv_id string, parent_id string, post_id string, sib_pos int"
CHAIN = [("c", None, "1", 0), ("c", "1", "2", 0), ("c", "2", "3", 0)]


def posts(spark, rows):
    return spark.createDataFrame([("c", i, i == "1", t, 1, f) for i, t, f in rows], POST)


def examples(spark, rows, edges=CHAIN):
    ex = EX.build_examples(posts(spark, rows), spark.createDataFrame(edges, EDGE), ["hell"])
    return sorted((r.fold, r.id, r.branch_id, r.tweet_id, r.raw_text, r.raw_text_prev) for r in ex.collect())


ONCE = [("1", "a", "train"), ("2", "b", "train"), ("3", "c", "train")]


def test_a_repeated_post_is_one_post(spark):
    want = [("train", 0, "0.0", "1", "a", ""), ("train", 1, "0.1", "2", "b", "a"), ("train", 2, "0.2", "3", "c", "b")]
    assert examples(spark, ONCE) == want
    assert examples(spark, ONCE + [("2", "b", "train"), ("3", "b", "train")]) == want


def test_the_source_wins_over_a_reply_with_its_id(spark):
    df = posts(spark, ONCE).unionByName(spark.createDataFrame([("c", "1", False, "zzz", 1, "train")], POST))
    got = {r.post_id: r.text for r in FE.one_post(df).collect()}
    assert got == {"1": "a", "2": "b", "3": "c"}


def test_the_last_line_of_the_last_file_wins(spark):
    df = spark.createDataFrame([("c", "2", False, "old", "f1", 3), ("c", "2", False, "new", "f2", 0), ("c", "2", False, "newer", "f2", 1)],
                               "conv_id string, post_id string, is_source boolean, text string, file_path string, line_no int")
    assert [r.text for r in FE.one_post(df).collect()] == ["newer"]


def test_doubled_edges_are_one_edge(spark):
    e = spark.createDataFrame(CHAIN + CHAIN + [("c", "1", "2", 7)], EDGE)
    assert sorted(r.post_id for r in TR.walk(e).collect()) == ["1", "2", "3"]
    assert examples(spark, ONCE, CHAIN + CHAIN) == examples(spark, ONCE)


def test_a_conversation_in_two_folds_is_in_both(spark):
    got = examples(spark, ONCE + [(i, t, "test") for i, t, _ in ONCE])
    assert [(g[0], g[3]) for g in got] == [("test", "1"), ("test", "2"), ("test", "3"), ("train", "1"), ("train", "2"), ("train", "3")]


def test_a_chain_of_any_depth(spark):
    n = 1500
    edges = [("c", None, "p0", 0)] + [("c", f"p{i - 1}", f"p{i}", 0) for i in range(1, n)]
    w = TR.walk(spark.createDataFrame(edges, EDGE))
    assert w.count() == n and w.agg(F.max("depth")).first()[0] == n - 1
    doc = "".join(f'{{"p{i}":' for i in range(n)) + "[]" + "}" * n
    e = TR.tree_json_to_edges(spark.createDataFrame([("c", doc)], "conv_id string, value string"))
    assert sorted(map(tuple, e.collect()), key=lambda x: int(x[2][1:])) == edges


def test_tree_documents_odd(spark):
    docs = {"a": '{"1": {"2": [], "2": {"3": {}}}, "4": null}', "b": '["x"]', "c": "{broken", "d": None, "e": "", "f": '{"q\\"1": []}'}
    e = TR.tree_json_to_edges(spark.createDataFrame(list(docs.items()), "conv_id string, value string"))
    got = sorted((r.conv_id, r.parent_id or "", r.post_id, r.sib_pos) for r in e.collect())
    assert got == [("a", "", "1", 0), ("a", "", "4", 1), ("a", "1", "2", 0), ("a", "2", "3", 0), ("f", "", 'q"1', 0)]


def test_a_post_under_two_parents_has_two_paths(spark):
    e = spark.createDataFrame([("c", None, "1", 0), ("c", "1", "2", 0), ("c", "1", "3", 1), ("c", "2", "4", 0), ("c", "3", "4", 0)], EDGE)
    assert sorted("-".join(r.path) for r in TR.walk(e).collect()) == ["1", "1-2", "1-2-4", "1-3", "1-3-4"]


def test_one_thread_holds_half_of_all_posts(spark):
    rows = [("hot", "h", True, "source", 1, "train")] + [("hot", f"h{i}", False, f"text {i}", 1, "train") for i in range(600)]
    edges = [("hot", None, "h", 0)] + [("hot", "h", f"h{i}", i) for i in range(600)]
    for i in range(300):
        rows += [(f"c{i}", f"c{i}_0", True, "s", 1, "train"), (f"c{i}", f"c{i}_1", False, "r", 1, "train")]
        edges += [(f"c{i}", None, f"c{i}_0", 0), (f"c{i}", f"c{i}_0", f"c{i}_1", 0)]
    ex = EX.build_examples(spark.createDataFrame(rows, POST), spark.createDataFrame(edges, EDGE), ["hell"])
    assert ex.count() == 1201
    assert ex.where("raw_text_src = 'source' and raw_text_prev = 'source'").count() == 600
    # as planned where tables are too large to broadcast: both sides of the context joins are
    # dealt by the join itself, so AQE may split either
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = ex.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\((?:conv_id#\d+, (?:post_id|prev_id|src_id))[^\n]*ENSURE_REQUIREMENTS", plan)) == 6


def test_same_numbers_whatever_the_buckets(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"), (F.col("id") % 3).alias("g"))
    a = {(r.g, r.k): r.i for r in dense_index(df, ["k"], "i", ["g"], buckets=3).collect()}
    b = {(r.g, r.k): r.i for r in dense_index(df, ["k"], "i", ["g"], buckets=64).collect()}
    assert a == b and max(a.values()) == 166


# --- files --------------------------------------------------------------------
def write(spark, root, files):
    LY.write_files(spark.createDataFrame([(f"{root}/{k}", v) for k, v in files.items()], "path string, content string"))


def tweet(i, text):
    return json.dumps({"id_str": i, "text": text})


def test_underscore_names_and_corrupt_lines(spark):
    root = S.shared_dir(spark, "t-odd")
    write(spark, root, {
        "t/1/source-tweet/1.json": tweet("1", "source"),
        "t/1/replies/_2.json": tweet("2", "under"),
        "t/1/replies/3.json": tweet("3", "first") + "\n{broken\n" + tweet("3", "last") + "\n" + json.dumps({"text": "no id"}),
        "t/1/structure.json": '{"1": {"2": [], "3": []}}',
    })
    got = {(r.post_id, r.text, r.line_no) for r in TH.scan_twitter(spark, root).collect()}
    assert got == {("1", "source", 0), ("2", "under", 0), ("3", "first", 0), ("3", "last", 2)}
    assert {r.line_no for r in TH.corrupt_lines(spark, root, "twitter").collect()} == {1, 3}
    assert "_2.json" in {r.file_name for r in TH.list_post_files(spark, root, depth=2).collect()}


def test_prepare_with_repairs_two_topics_and_reports(spark):
    root, keys = S.shared_dir(spark, "t-fix"), S.shared_dir(spark, "k-fix")
    write(spark, root, {
        "a/1/source-tweet/1.json": tweet("1", "src a"), "a/1/replies/2.json": tweet("2", "x"), "a/1/replies/9.json": tweet("9", None),
        "a/1/structure.json": '{"1": {"2": []}, "8": {"9": []}}',
        "b/1/source-tweet/1.json": tweet("1b", "src b"), "b/1/replies/5.json": tweet("5", "y"),
        "b/1/structure.json": '{"1": {"5": []}}',
    })
    write(spark, keys, {"train.json": json.dumps({"subtaskaenglish": {"1": "query", "2": "comment", "9": "nonsense"}}),
                        "dev.json": json.dumps({"subtaskaenglish": {"9": "nonsense"}})})
    labels = LB.read_label_keys(spark, {"train": f"{keys}/train.json", "dev": f"{keys}/dev.json"})
    fixes = spark.createDataFrame([("1", "9", "1", 0)], "conv_id string, post_id string, new_parent string, fix_pos int")
    p = prepare(spark, [ThreadFolder(root, "twitter")], labels, ["hell"], fixes=fixes)
    got = {(r.tweet_id, r.raw_text_src) for r in p.examples.collect()}
    assert got == {("1", ""), ("2", "src a"), ("9", "src a"), ("5", "")}
    n = {k: df.count() for k, df in p.reports.items()}
    assert n == {"missing_text": 1, "unlabelled": 2, "split_trees": 1, "unknown_labels": 1, "corrupt_lines": 0, "unreachable": 0}


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

        getConf = get

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        S.checkpoint_dir(Session())


# --- lexicons, gazetteers, encodings --------------------------------------------
def test_tables_and_lists_agree(spark):
    p = spark.createDataFrame([("c", "1", True, "Hell of a crap Monday. In French, the third; 12 of May", 0, "train"), ("c", "2", False, None, 0, "train"),
                               ("c", "3", False, "isn't ", 0, "train")], POST)
    gaz = {**L.DEFAULT_GAZETTEER, "GPE": [f"town{i}" for i in range(100_001)]}
    table = spark.createDataFrame([(w, c) for c, ws in gaz.items() for w in ws], "token string, entity string")
    words = spark.createDataFrame([(w,) for w in L.FIXTURE_SWEAR_LEXICON], "word string")
    a = FE.post_features(p, L.FIXTURE_SWEAR_LEXICON).select("post_id", "ner", "hasswearwords").orderBy("post_id").collect()
    b = FE.post_features(p, words, table).select("post_id", "ner", "hasswearwords").orderBy("post_id").collect()
    assert a == b and a[0].hasswearwords == 2 and {1, 12, 17, 11, 18} - {1} <= set(a[0].ner)


def test_encoding_by_look_up_and_by_join_agree(spark):
    df = spark.createDataFrame([(1, "a b b c"), (2, ""), (3, None), (4, "zz a")], "id int, t string")
    v = EN.build_vocab(df, ["t"], 2)
    a = sorted(map(tuple, EN.encode(df, ["id"], "t", v, "o").collect()))
    b = sorted(map(tuple, EN.encode(df, ["id"], "t", v, "o", most=0).collect()))
    assert a == b == [(1, [5, 4, 4, 1] if a[0][1][0] == 5 else [4, 5, 5, 1]), (2, []), (3, []), (4, a[3][1])]


def test_distinct_posts_of_the_profile(spark):
    rows = spark.createDataFrame([("a", "1", 1), ("b", "1", 0), ("b", "2", 0)], "conv_id string, post_id string, issource int")
    assert [PR.branch_profile(rows, approx=x).first().n_posts for x in (False, True)] == [2, 2]


def test_classifier_on_separable_data(spark):
    names = ["support it", "comment on", "deny that", "query why"]
    rows = [("train", i, i % 4, names[i % 4] + f" word{i % 7}") for i in range(120)]
    df = spark.createDataFrame(rows, "fold string, id int, stance_label int, clean_text string").withColumn("clean_text_src", F.lit("")).withColumn("clean_text_prev", F.lit(""))
    p = MO.predict(MO.fit_stance(df, max_iter=30, num_features=1 << 10), df)
    assert p.where("pred <> stance_label").count() == 0 and p.count() == 120


# --- rules against Python's re ----------------------------------------------------
TRICKY = ["see http://a_b.example.org/x_(1).", "HTTP://NO.example", "ftp://ä.example/ü, end", "https://x.y/z?q=1&r=2#f!", "http://nodot/x",
          "a@b @user_1, @ü! x@", "don't DON'T n't isn'ta can't.", "It works... Really?! yes.no  end.", "naïve café 東京 $URL$ x_y"]


@pytest.mark.parametrize("text", TRICKY)
def test_text_rules(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    url = r"(http|ftp|https)://([\w_-]+(?:(?:\.[\w_-]+)+))([\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?"
    canon = " ".join(text.split())
    got = df.select(TX.mask_urls("t").alias("u"), TX.mask_mentions(F.lit(canon)).alias("m"), TX.negated_contraction(F.lit(canon)).alias("n")).first()
    assert got.u == re.sub(url, "$URL$", canon)
    assert got.m == re.sub(r"@\w+", "$MENTION$", canon)
    assert got.n == re.sub(r"n't(\W|$)", r" not\1", canon)


# --- the registered queries meet the cases they are for ----------------------------
def test_rules_fire_in_the_registered_queries(spark, sf_small):
    q = {k: E.queries()[k](spark, sf_small) for k in ("join_entity_vector", "join_entity_vector_gazetteer", "txt_negated_contraction",
                                                      "txt_mask_mentions", "win_first_occurrence", "win_early_stop")}
    for k in ("join_entity_vector", "join_entity_vector_gazetteer"):
        classes = {c for r in q[k].collect() for c in r.ner.split(",")}
        assert {"11", "12", "17"} <= classes, k
    assert q["txt_negated_contraction"].where("text_not like '% not%'").count() > 0
    assert q["txt_mask_mentions"].where("masked like '%$MENTION$%'").count() > 0
    from threadlens.plans.fixtures import fixture
    shared = fixture(spark, sf_small, "posts_shared")
    assert q["win_first_occurrence"].count() < shared.count()
    stops = [r.stop_epoch for r in q["win_early_stop"].collect()]
    assert None in stops and any(s is not None for s in stops)
