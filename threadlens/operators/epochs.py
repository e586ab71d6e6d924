"""M2 with M10/M11: training by epochs that carry their weights on.

The classifier is a class-weighted multinomial logistic regression on hashed
TF-IDF tokens (rows of unit length) [+ the numeric features]. Token numbers and
document frequencies are computed once and stored. An epoch is one pass over
the stored rows: each task adds up the gradient of its training rows and, for
every fold, counts of (gold, predicted) and the weighted loss; Spark sums them,
and the driver takes one Adam step on the weights, whose size is that of the
model, whatever the data. What a pass counts belongs to the weights it began
with, so E epochs read the data E + 1 times: the last pass only measures.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions import lexicons as L
from threadlens.operators.encode import MODEL_FEATURES
from threadlens.operators.evaluate import class_weights
from threadlens.session import materialize, ship_package

CLASSES = len(L.STANCE_CLASSES)
SUMS = "fold string, a int, b int, n bigint, x array<double>"
CURVE = "run string, epoch int, split string, loss double, accuracy double, f1_macro double, f1_weighted double"


@dataclass
class Epochs:
    """A fitted model and the metrics of each epoch."""
    weights: np.ndarray                 # (num_features + 1 + numeric features, classes)
    idf: np.ndarray
    metrics: list[tuple] = field(default_factory=list)
    best_epoch: int = -1
    best_weights: np.ndarray | None = None

    def curve(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.metrics, CURVE)


def prepared(examples: DataFrame, weights: DataFrame, num_features: int, with_features: bool) -> DataFrame:
    """(fold, id, gold, cw, tokens ARRAY<INT>, extra ARRAY<DOUBLE>), stored;
    ``weights``: (class, weight), a row a class."""
    text = F.lower(F.concat_ws(" [SEP] ", *[F.coalesce(c, F.lit("")) for c in ("clean_text_src", "clean_text_prev", "clean_text")]))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    number = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(num_features)).cast("int"))
    extra = F.array(*[F.col(c).cast("double") for c in MODEL_FEATURES]) if with_features else F.array().cast("array<double>")
    rows = examples.select("fold", "id", F.col("stance_label").cast("int").alias("gold"), number.alias("tokens"), extra.alias("extra"))
    w = weights.select(F.col("class").alias("gold"), F.col("weight").alias("cw"))
    return materialize(rows.join(F.broadcast(w), "gold", "left").withColumn("cw", F.coalesce("cw", F.lit(1.0))), "epoch-rows")


def inverse_frequencies(rows: DataFrame, num_features: int) -> np.ndarray:
    """log((n + 1) / (df + 1)) by token number; a row a number comes to the driver."""
    n = rows.count()
    df = np.zeros(num_features)
    for r in rows.select(F.explode(F.array_distinct("tokens")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r["t"]] = r["n"]
    return np.log((n + 1) / (df + 1))


def sparse_rows(tokens: pa.Array, extra: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): unit TF-IDF rows, then the bias and the numeric features."""
    n, width = len(tokens), len(idf)
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(n, dtype=np.int64), sizes)
    pair, count = np.unique(at * width + tokens.flatten().to_numpy(zero_copy_only=False), return_counts=True)
    row, feat = pair // width, pair % width
    value = count * idf[feat]
    norm = np.sqrt(np.bincount(row, value * value, n))
    value = value / np.where(norm > 0, norm, 1)[row]
    k = len(extra.flatten()) // n if n else 0
    more = extra.flatten().to_numpy(zero_copy_only=False).reshape(n, k)
    return (np.concatenate((row, np.arange(n), np.repeat(np.arange(n), k))), np.concatenate((feat, np.full(n, width), np.tile(width + 1 + np.arange(k), n))),
            np.concatenate((value, np.ones(n), more.ravel())))


def logits(row: np.ndarray, feat: np.ndarray, value: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(row, value * weights[feat, k], n) for k in range(CLASSES)], axis=1)


def _pass(weights: np.ndarray, idf: np.ndarray, train_fold: str, gradient: bool):
    def run(batches):
        total = np.zeros_like(weights)
        counts: dict[tuple, np.ndarray] = {}
        for b in batches:
            b = b.filter(b.column("gold").is_valid())
            n = b.num_rows
            if not n:
                continue
            row, feat, value = sparse_rows(b.column("tokens"), b.column("extra"), idf)
            z = logits(row, feat, value, weights, n)
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            gold, cw = b.column("gold").to_numpy(), b.column("cw").to_numpy()
            fold, pred = b.column("fold").to_pylist(), z.argmax(axis=1)
            loss = -np.log(np.maximum(p[np.arange(n), gold], 1e-300)) * cw
            for i in range(n):
                c = counts.setdefault((fold[i], int(gold[i]), int(pred[i])), np.zeros(3))
                c += (1, loss[i], cw[i])
            if gradient:
                learns = np.array([f == train_fold for f in fold])
                d = p.copy()
                d[np.arange(n), gold] -= 1
                d *= (cw * learns)[:, None]
                for k in range(CLASSES):
                    total[:, k] += np.bincount(feat, value * d[row, k], len(weights))
        moved = np.flatnonzero(total.any(axis=1))
        keys = sorted(counts, key=str)
        x = [*total[moved].tolist(), *[[counts[k][1], counts[k][2], 0.0, 0.0] for k in keys]]
        yield pa.RecordBatch.from_arrays([
            pa.array([None] * len(moved) + [k[0] for k in keys], pa.string()), pa.array(moved.tolist() + [k[1] for k in keys], pa.int32()),
            pa.array([None] * len(moved) + [k[2] for k in keys], pa.int32()), pa.array([0] * len(moved) + [int(counts[k][0]) for k in keys], pa.int64()),
            pa.array(x, pa.list_(pa.float64()))], ["fold", "a", "b", "n", "x"])
    return run


def one_pass(rows: DataFrame, weights: np.ndarray, idf: np.ndarray, train_fold: str, gradient: bool = True) -> tuple[np.ndarray, dict]:
    """(gradient of the mean training loss, {fold: (counts (gold, pred), loss, weight)})."""
    cols = rows.select("fold", "gold", "cw", "tokens", "extra")
    sums = cols.mapInArrow(_pass(weights, idf, train_fold, gradient), SUMS).groupBy("fold", "a", "b").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("x")[k]) for k in range(CLASSES)]).alias("x")).collect()
    g, folds = np.zeros_like(weights), {}
    for r in sums:
        if r["fold"] is None:
            g[r["a"]] = r["x"]
        else:
            counts, part = folds.setdefault(r["fold"], (np.zeros((CLASSES, CLASSES), np.int64), np.zeros(2)))
            counts[r["a"], r["b"]] += r["n"]
            part += r["x"][:2]
    done = folds.get(train_fold)
    return g / (done[1][1] if done is not None and done[1][1] else 1.0), folds


def scores(counts: np.ndarray, loss: float, weight: float) -> tuple[float, float, float, float]:
    """Weighted loss (M8), accuracy (M4), macro and weighted F1 (M6, M7) of a confusion matrix."""
    gold, pred, right = counts.sum(axis=1), counts.sum(axis=0), np.diag(counts)
    seen = (gold + pred) > 0
    f1 = np.where(seen, 2 * right / np.maximum(gold + pred, 1), 0.0)
    return float(loss / weight), float(right.sum() / counts.sum()), float(f1[seen].mean()), float((f1 * gold).sum() / gold.sum())


def fit_epochs(examples: DataFrame, epochs: int = 2, with_features: bool = False, run: str = "lr", train_fold: str = "train", num_features: int = 1 << 16,
               patience: int | None = None, rate: float = 0.5, reg: float = 1e-4, dev_fold: str = "dev") -> Epochs:
    """Adam on the full gradient, one step an epoch. With ``patience`` the
    loop ends after the first epoch whose loss on ``dev_fold`` is above the
    best and that is more than ``patience`` epochs behind it (M11)."""
    ship_package(examples.sparkSession)
    train = examples.where((F.col("fold") == train_fold) & F.col("stance_label").isNotNull())
    rows = prepared(examples, class_weights(train), num_features, with_features)
    idf = inverse_frequencies(rows.where(F.col("fold") == train_fold), num_features)
    w = np.zeros((num_features + 1 + (len(MODEL_FEATURES) if with_features else 0), CLASSES))
    first, second = np.zeros_like(w), np.zeros_like(w)
    out, best = Epochs(w, idf), np.inf
    for step in range(epochs + 1):
        g, folds = one_pass(rows, w, idf, train_fold, gradient=step < epochs)
        if step:
            for fold in sorted(folds):
                out.metrics.append((run, step - 1, fold, *scores(folds[fold][0], *folds[fold][1])))
            dev = folds.get(dev_fold, folds.get(train_fold))
            loss = dev[1][0] / dev[1][1] if dev is not None else np.inf
            if loss < best:
                best, out.best_epoch, out.best_weights = loss, step - 1, w
            elif patience is not None and loss > best and step - 1 > out.best_epoch + patience:
                break
        if step < epochs:
            g = g + reg * w
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            w = w - rate / np.sqrt(step + 1) * (first / (1 - 0.9 ** (step + 1))) / (np.sqrt(second / (1 - 0.999 ** (step + 1))) + 1e-8)
            out.weights = w
    return out


def predict(model: Epochs, examples: DataFrame, with_features: bool = False) -> DataFrame:
    """(fold, id, pred, z) of every example, by the last weights."""
    weights, idf = model.weights, model.idf
    none = examples.sparkSession.createDataFrame([], "class int, weight double")

    def run(batches):
        for b in batches:
            row, feat, value = sparse_rows(b.column("tokens"), b.column("extra"), idf)
            z = logits(row, feat, value, weights, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("fold"), b.column("id"), pa.array(z.argmax(axis=1).astype(np.int32)), pa.array(z.tolist(), pa.list_(pa.float64()))], ["fold", "id", "pred", "z"])

    rows = prepared(examples, none, len(idf), with_features)
    return rows.select("fold", "id", "tokens", "extra").mapInArrow(run, f"fold string, id {rows.schema['id'].dataType.simpleString()}, pred int, z array<double>")
