"""Epochs that carry their weights on."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.operators import epochs as EP
from threadlens.operators import evaluate as EV
from threadlens.operators.encode import MODEL_FEATURES

WORDS = ["agree yes", "look at", "no wrong", "really why"]


def examples(spark, n=120, noise=0.0, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        y = r.randrange(4)
        said = WORDS[r.randrange(4) if r.random() < noise else y]
        rows.append((["train", "train", "dev", "test"][i % 4], i, None if i % 17 == 0 else y, f"{said} w{r.randrange(30)}", "before", None if i % 5 else "source", *[i % 2] * len(MODEL_FEATURES)))
    cols = "fold string, id long, stance_label int, clean_text string, clean_text_prev string, clean_text_src string, " + ", ".join(f"{c} int" for c in MODEL_FEATURES)
    return spark.createDataFrame(rows, cols).repartition(3)


@pytest.mark.parametrize("with_features", [False, True])
def test_separable(spark, with_features):
    df = examples(spark)
    m = EP.fit_epochs(df, 8, with_features, num_features=512)
    train = [x for x in m.metrics if x[2] == "train"]
    assert [x[1] for x in train] == list(range(8)) and train[-1][3] < 0.3 * train[0][3] and train[-1][4] == 1.0
    assert next(x for x in m.metrics[::-1] if x[2] == "test")[4] > 0.6  # chance is a quarter
    got = {r.id: r.pred for r in EP.predict(m, df, with_features).collect()}
    want = df.where("stance_label is not null and fold = 'train'").collect()
    assert len(got) == 120 and all(got[r.id] == r.stance_label for r in want)


def test_one_pass_against_plain_numpy(spark):
    """Gradient and loss of all rows, by a dense matrix."""
    df = examples(spark, 60, 0.5)
    weights = EV.class_weights(df.where("fold = 'train' and stance_label is not null"))
    rows = EP.prepared(df, weights, 64, True)
    idf = EP.inverse_frequencies(rows.where("fold = 'train'"), 64)
    w = np.random.default_rng(0).normal(0, 0.1, (64 + 1 + len(MODEL_FEATURES), 4))
    g, folds = EP.one_pass(rows, w, idf, "train")
    want, loss, total = np.zeros_like(w), 0.0, 0.0
    cw = {r["class"]: r["weight"] for r in weights.collect()}
    for r in rows.where("fold = 'train' and gold is not null").collect():
        x = np.bincount(r.tokens, minlength=64) * idf
        x = np.concatenate((x / (np.linalg.norm(x) or 1), [1.0], r.extra))
        p = np.exp(x @ w) / np.exp(x @ w).sum()
        loss, total = loss - cw[r.gold] * np.log(p[r.gold]), total + cw[r.gold]
        want += cw[r.gold] * np.outer(x, p - np.eye(4)[r.gold])
    assert np.allclose(g, want / total) and folds["train"][1] == pytest.approx((loss, total))


def test_scores_are_those_of_the_operators(spark):
    df = examples(spark, 100, 0.6)
    m = EP.fit_epochs(df, 2, num_features=256)
    pred = EP.predict(m, df).select("fold", "id", "pred", "z").join(df.select("id", F.col("stance_label").alias("gold")), "id").where("gold is not null")
    weights = EV.class_weights(df.where("fold = 'train' and stance_label is not null"))
    last = {x[2]: x[3:] for x in m.metrics if x[1] == 1}
    for name, col, at in ((EV.accuracy(pred, group_cols=["fold"]), "accuracy", 1), (EV.f1(pred, "macro", group_cols=["fold"]), "f1_macro", 2),
                          (EV.f1(pred, "weighted", group_cols=["fold"]), "f1_weighted", 3), (EV.weighted_log_loss(pred, weights, group_cols=["fold"]), "loss", 0)):
        for r in name.collect():
            assert r[col] == pytest.approx(last[r.fold][at])


def test_early_stop_inside_the_loop(spark):
    df = examples(spark, 80, 1.0)  # nothing to learn: the dev loss rises
    m = EP.fit_epochs(df, 30, num_features=512, patience=1)
    dev = [x for x in m.metrics if x[2] == "dev"]
    assert len(dev) < 30
    stop = EV.early_stop(m.curve(spark), patience=1).collect()[0]
    assert stop.stop_epoch == dev[-1][1] and stop.best_epoch == m.best_epoch
