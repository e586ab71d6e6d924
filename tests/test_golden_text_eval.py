"""Hand-derived cases for text features, encoding and evaluation."""

from pyspark.sql import functions as F

from threadlens.functions import text as TX
from threadlens.functions.entities import entity_vector
from threadlens.operators import batching as BA
from threadlens.operators import encode as EN
from threadlens.operators import evaluate as EV
from threadlens.operators import features as FE
from threadlens.operators import normalize as NO


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"t {dtype}").select(col.alias("r")).first().r


def test_lexicon_tokens(spark):
    assert one(spark, TX.lex_tokens("t"), "Don't x_y, cannot! É 日本") == ["dont", "xy", "can", "not", "é", "日本"]
    assert one(spark, TX.lex_tokens("t"), "") == []
    assert one(spark, TX.lex_tokens("t"), None) == []


def test_negation_is_distinct_and_hits_count_tokens(spark):
    assert one(spark, TX.lexicon_distinct(TX.lex_tokens("t"), ["no", "never"]), "no no never") == 2
    assert one(spark, TX.lexicon_hits(TX.lex_tokens("t"), ["crap", "hell"]), "crap hell crap") == 3


def test_flags(spark):
    df = spark.createDataFrame([("see http://x.y pic.twitter.com/a #t ?!.",)], "t string")
    r = df.select(*[v.alias(k) for k, v in TX.flag_columns("t").items()]).first()
    assert (r.hasqmark, r.hasemark, r.hasperiod, r.hashashtag, r.hasurl, r.haspic) == (1, 1, 1, 1, 1, 1)


def test_processed_text(spark):
    got = one(spark, TX.processed_text("t"), "I don't know.  See https://a.b/c?d=1, @bob_1! Really?")
    assert got == "I do not know . [EOS]\nSee $URL$ , $MENTION$ ! [EOS]\nReally ? [EOS]"
    assert one(spark, TX.processed_text("t"), "") == ""
    assert one(spark, TX.processed_text("t"), "   ") == ""


def test_entity_vector_aligned(spark):
    df = spark.createDataFrame([("On Monday 3 people spoke English. Second try!",)], "t string")
    r = df.select(TX.processed_text("t").alias("p"),
                  entity_vector(TX.sent_tokens("t")).alias("v")).first()
    toks = r.p.split()
    assert len(toks) == len(r.v)
    assert dict(zip(toks, r.v))["Monday"] == 12 and dict(zip(toks, r.v))["3"] == 18
    assert r.v[toks.index("[EOS]")] == 0


def test_thread_flag(spark):
    rows = [("a", "a0", True, "this is a rumour"), ("a", "a1", False, "ok"), ("a", "a2", False, "fine"),
            ("b", "b0", True, "x"), ("b", "b1", False, "gossip here"), ("b", "b2", False, "y")]
    posts = spark.createDataFrame(rows, "conv_id string, post_id string, is_source boolean, text string")
    got = {r.post_id: r.thread_rumour for r in FE.thread_features(posts, ["hell"]).collect()}
    assert got == {"a0": 0, "a1": 1, "a2": 1, "b0": 1, "b1": 1, "b2": 1}


def test_truncation_and_masks(spark):
    df = spark.createDataFrame([(list(range(9)), list(range(4)))], "a array<int>, b array<int>")
    t = EN.truncate(df, "a", "b", 13).select(F.size("a").alias("na"), F.size("b").alias("nb"),
                                             F.size(EN.segments("a", "b")).alias("n")).first()
    assert (t.na, t.nb, t.n) == (5, 4, 12)
    df = spark.createDataFrame([([5, 6], [7])], "a array<int>, b array<int>")
    tm, im = EN.masks("a", "b")
    r = df.select(tm.alias("tm"), im.alias("im"), EN.segments("a", "b").alias("s")).first()
    assert r.tm == [0, 0, 0, 0, 1, 1] and r.im == [1] * 6 and r.s == [2, 5, 6, 3, 7, 3]


def test_batches(spark):
    df = spark.createDataFrame([("f", i, list(range(n))) for i, n in enumerate([5, 3, 9, 4])],
                               "fold string, id long, text array<int>")
    b = BA.pad_batch(BA.bucket_batches(df, 2), seq_cols=("text",))
    got = {}
    for r in b.collect():
        got.setdefault(r.batch_no, []).append((r.id, r.batch_len, len(r.text)))
    assert sorted(got[0]) == [(0, 9, 9), (2, 9, 9)] and sorted(got[1]) == [(1, 4, 4), (3, 4, 4)]


def test_class_weights(spark):
    labels = [0] * 4 + [1] * 8 + [2] * 2
    df = spark.createDataFrame([(x,) for x in labels], "stance_label int")
    w = {r["class"]: r.weight for r in EV.class_weights(df).collect()}
    assert w == {0: 2.0, 1: 1.0, 2: 4.0, 3: None}


def test_f1(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "gold int, pred int")
    assert abs(EV.f1(df, "macro").first()[0] - 11 / 15) < 1e-12
    assert abs(EV.f1(df, "weighted").first()[0] - 11 / 15) < 1e-12
    conf = {r.gold: (r.pred_0, r.pred_1) for r in EV.confusion(df).collect()}
    assert conf == {0: (1, 1), 1: (0, 2)}


def test_early_stop(spark):
    rows = [("r", e, "dev", loss, 0.5, 0.5, 0.5) for e, loss in enumerate([3.0, 2.0, 4.0, 4.0, 4.0])]
    m = spark.createDataFrame(rows, "run string, epoch int, split string, loss double, accuracy double, "
                                    "f1_macro double, f1_weighted double")
    r = EV.early_stop(m, patience=1).first()
    assert (r.stop_epoch, r.best_epoch, r.best_loss) == (3, 1, 2.0)


def test_softmax_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "z array<double>")
    r = df.select(EV.softmax("z").alias("p"), EV.argmax("z").alias("a")).first()
    assert r.a == 1 and abs(sum(r.p) - 1) < 1e-12


def test_unknown_label_and_deleted_reply(spark):
    df = spark.createDataFrame([("maybe",), ("deny",)], "label string")
    assert [r.s for r in df.select(TX.encode_label("label").alias("s")).collect()] == [None, 2]
    assert [(r.label, r.n) for r in NO.unknown_labels(df).collect()] == [("maybe", 1)]
    raw = spark.createDataFrame(
        [("c", "r1", False, (None, None, "someone"))],
        "conv_id string, post_id string, is_source boolean, "
        "data struct<children: array<struct<data: struct<title: string, author: string>>>, body: string, author: string>")
    r = NO.normalize_posts(raw, "reddit").first()
    assert (r.text, r.user) == ("", "")


def test_label_priority(spark):
    keys = spark.createDataFrame([("p1", "train", "deny"), ("p1", "dev", "query"), ("p2", "train", "support")],
                                 "post_id string, split string, label string")
    posts = spark.createDataFrame([("c", "p1", False), ("c", "p2", False), ("c", "p3", False)],
                                  "conv_id string, post_id string, is_source boolean")
    got = {r.post_id: (r.split, r.stance) for r in NO.attach_labels(posts, keys).collect()}
    assert got == {"p1": ("dev", 3), "p2": ("train", 0), "p3": (None, None)}
    assert [r.post_id for r in NO.unlabelled(posts, keys).collect()] == ["p3"]


def test_branch_profile_exact_and_approx(spark):
    from threadlens.operators import profile as PR
    rows = [("c", 0, 0, "1", 1), ("c", 0, 1, "2", 0), ("c", 1, 0, "1", 1), ("c", 1, 1, "3", 0)]
    df = spark.createDataFrame(rows, "conv_id string, branch_no int, pos int, post_id string, issource int")
    exact = PR.branch_profile(df).first()
    assert (exact.n_occurrences, exact.n_posts, exact.n_source_occurrences) == (4, 3, 2)
    assert PR.branch_profile(df, approx=True).first().n_posts == 3
