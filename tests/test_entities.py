"""Phrases of the gazetteer: leftmost-longest in a sentence, as a list and as a table."""

import random

from threadlens.functions import entities as EN
from threadlens.functions import lexicons as L
from threadlens.functions import text as TX
from threadlens.functions.entities import entity_vector
from threadlens.operators import features as FE

IDS = {c: i for i, c in enumerate(L.ENTITY_CLASSES)}


def both(spark, texts, gaz):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", TX.sent_tokens("t").alias("s"))
    table = spark.createDataFrame([(w, c) for c, ws in gaz.items() for w in ws], "phrase string, entity string")
    listed = {r.i: r.v for r in df.select("i", entity_vector("s", gaz).alias("v")).collect()}
    joined = {r.i: r.v for r in FE.entity_vector_join(df, "s", table, "v", ["i"]).collect()}
    assert listed == joined
    return [listed[i] for i in range(len(texts))]


def test_rules(spark):
    gaz = {"GPE": ["New York", "York"], "ORG": ["New York Times", "times"], "PERSON": ["york times square"], "FAC": ["New York"], "NONSENSE": ["x"]}
    f, g, o, c = IDS["FAC"], IDS["GPE"], IDS["ORG"], IDS["CARDINAL"]  # New York is listed twice: FAC comes first
    assert both(spark, ["In NEW York 7", "new york times square", "new. york", "the york times", "new new york", None, "", "york York\nyork", "new york, times"], gaz) == [
        [0, f, f, c, 0], [o, o, o, 0, 0], [0, 0, 0, g, 0], [0, g, o, 0], [0, f, f, 0], [], [], [g, g, g, 0], [f, f, 0, o, 0]]


def test_random_texts(spark):
    r = random.Random(3)
    gaz = {c: [" ".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(5)] for c in ("LOC", "LAW", "DATE")}
    texts = [" ".join(r.choice(["a", "b", "c", "d", "c.", "12"]) for _ in range(r.randint(0, 40))) for _ in range(60)]
    index = EN.phrase_index(gaz)
    got = both(spark, texts, gaz)
    for t, v in zip(texts, got):
        want = []
        for s in [x for x in t.replace(". ", ".\0").split("\0") if x.strip()]:
            want += [*EN.sentence_classes(s.replace(".", " .").split(), index), 0]
        assert v == want, t


def test_long_sentence_and_long_phrase(spark):
    phrase = " ".join(f"w{i}" for i in range(12))
    v = both(spark, [f"{phrase} " * 500 + "w0 w1"], {"EVENT": [phrase], "LOC": ["w0 w1 w2", "w1"]})[0]
    assert v == [IDS["EVENT"]] * 6000 + [0, IDS["LOC"], 0]


def test_empty_gazetteer(spark):
    assert both(spark, ["a 1"], {})[0] == [0, IDS["CARDINAL"], 0]
