"""Operator 4: a quality classifier by co-training.

Two classifiers see a document from two sides: one its words, their first
letters and the way its characters are used, one only its metadata (language,
source, length, layout). Both are logistic regressions in numpy, fitted on at
most MAX_LABELLED labelled documents, taken by hash of their id. All documents
without a label are the pool: their features are counted once and stored. In
each round both classifiers are fitted, calibrated on labelled documents kept
aside, and score the whole pool; each hands the HANDED documents of either kind
it is surest of, with its own label, to the other. At last a third regression
over the two calibrated scores, fitted on the documents kept aside, combines
them, and all documents are scored in one narrow pass.

Which words and word beginnings the text view keeps is counted by Spark over
the labelled sample; the driver gets the VOCABULARY most telling ones and each
sample document's counts of those. The metadata view has one weight for each
language and each source that MIN_DOCS labelled documents of the sample have.

A document is good if its label says quality 1 and toxic 0; a null label
counts as no label.

Defined results: null text has no words and is scored like an empty one; an id
labelled twice is good only if all its labels are; with no labels, or of one
kind only, every document gets that kind's share (1.0 if none) as its score;
repeated rows are scored each on its own, and of an id given several times one
row is learned from; null ids are scored only; an empty table gives no rows; extra
columns are not looked at; a missing ``lang`` or ``source`` is null.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import LOWER, PIECE, documents, mapped, mixed, saved, span_hashes, steps, text_bytes
from threadlens.llm.registry import query

MAX_LABELLED = 10_000     # labelled documents the classifiers are fitted on
VOCABULARY = 3_000        # words and beginnings the text view keeps, by how much they tell
MIN_DOCS = 5              # documents of the sample a kept one stands in
BEGINNINGS = (5, 6, 7, 8) # bytes of the word beginnings
ROUNDS, HANDED, SURE = 3, 100, 0.98  # HANDED of either kind, from each view to the other
ASIDE = 4                 # one labelled document in so many is kept aside
THRESHOLD = 0.5

#: Letters of a word here: ASCII letters and all bytes beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER, _DIGIT, _SPACE, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _DIGIT[48:58] = _SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL[[ord(c) for c in "#*$%&|<>@=_~^{}[]\\/+!?"]] = True
N_STYLE, N_META = 8, 4
VIEWS = (("text", "meta"), ("meta", "text"))
FEATURES = "cols binary, vals binary, names binary, dense binary"


class Vocabulary:
    """Kept hashes in order, and a table of their leading bits that sorts out
    most others at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.lead = np.zeros(1 << 16, bool)
        self.lead[self.hashes >> np.uint64(48)] = True

    def __len__(self):
        return len(self.hashes)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, columns) of the kept ones."""
        at = np.flatnonzero(self.lead[h >> np.uint64(48)])
        col = np.minimum(np.searchsorted(self.hashes, h[at]), max(0, len(self.hashes) - 1))
        hit = self.hashes[col] == h[at] if len(self.hashes) else np.zeros(0, bool)
        return at[hit], col[hit]


class Names:
    """The languages and sources that have a weight of their own."""

    COLUMNS = ("lang", "source")

    def __init__(self, values: list[tuple[str, str | None]]):
        self.at = {v: i for i, v in enumerate(values)}

    def __len__(self):
        return len(self.at)

    def find(self, b: pa.RecordBatch) -> np.ndarray:
        """Per row the numbers of its language and its source, -1 if not known."""
        out = np.full((b.num_rows, len(self.COLUMNS)), -1, np.int32)
        for j, name in enumerate(self.COLUMNS):
            e = b.column(name).cast(pa.string()).dictionary_encode()
            numbers = np.array([self.at.get((name, v), -1) for v in [*e.dictionary.to_pylist(), None]], np.int32)
            out[:, j] = numbers[e.indices.fill_null(len(e.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)]
        return out


class Features(NamedTuple):
    """What the two views see of some documents."""

    words: tuple[np.ndarray, np.ndarray, np.ndarray]  # rows, columns, values
    names: np.ndarray
    style: np.ndarray
    meta: np.ndarray

    def of(self, view: str):
        """(rows, columns, values, dense numbers) of a view."""
        if view == "text":
            return *self.words, self.style
        row, j = np.nonzero(self.names >= 0)
        return row, self.names[row, j].astype(np.int64), np.ones(len(row)), self.meta

    def packed(self) -> list[pa.Array]:
        r, c, v = self.words
        cut = np.searchsorted(r, np.arange(len(self.style) + 1))
        return [pa.array([c[x:y].astype(np.int32).tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary()),
                pa.array([v[x:y].astype(np.float32).tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary()),
                pa.array([x.tobytes() for x in self.names], pa.binary()), pa.array([x.tobytes() for x in np.hstack((self.style, self.meta))], pa.binary())]

    @staticmethod
    def unpacked(cols: list[bytes], vals: list[bytes], names: list[bytes], dense: list[bytes]) -> "Features":
        d = np.frombuffer(b"".join(dense)).reshape(-1, N_STYLE + N_META)
        rows = np.repeat(np.arange(len(cols)), [len(c) // 4 for c in cols])
        return Features((rows, np.frombuffer(b"".join(cols), np.int32).astype(np.int64), np.frombuffer(b"".join(vals), np.float32).astype(float)),
                        np.frombuffer(b"".join(names), np.int32).reshape(-1, len(Names.COLUMNS)), d[:, :N_STYLE], d[:, N_STYLE:])

    def take(self, on: np.ndarray) -> "Features":
        place = np.full(len(self.style), -1)
        place[on] = np.arange(len(on))
        r, c, v = self.words
        k = place[r] >= 0
        return Features((place[r[k]], c[k], v[k]), self.names[on], self.style[on], self.meta[on])

    def __add__(self, other: "Features") -> "Features":
        (r, c, v), (r2, c2, v2) = self.words, other.words
        return Features((np.concatenate((r, r2 + len(self.style))), np.concatenate((c, c2)), np.concatenate((v, v2))),
                        np.vstack((self.names, other.names)), np.vstack((self.style, other.style)), np.vstack((self.meta, other.meta)))


def words(b: pa.RecordBatch):
    """(hash of each word and word beginning, its row), words in each row."""
    buf, offs = text_bytes(b.column("text"))
    low = LOWER[buf]
    letter = _LETTER[low]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    start, end = letter.copy(), letter.copy()
    if len(buf):
        start[1:] &= ~letter[:-1] | edge[1:len(buf)]
        end[:-1] &= ~letter[1:] | edge[1:len(buf)]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    row = np.searchsorted(offs, starts, "right") - 1
    n = np.bincount(row, minlength=b.num_rows)
    hs, rows = [span_hashes(low, starts, ends)], [row]
    for k in BEGINNINGS:
        long_ = ends - starts > k
        hs.append(mixed(span_hashes(low, starts[long_], starts[long_] + k) + np.uint64(k)))
        rows.append(row[long_])
    same = np.bincount(row[1:], (hs[0][1:] == hs[0][:-1]) & (row[1:] == row[:-1]), b.num_rows) if len(row) > 1 else np.zeros(b.num_rows)
    return np.concatenate(hs), np.concatenate(rows), n, same


def counts(b: pa.RecordBatch, vocab: Vocabulary, names: Names) -> Features:
    """The features of a batch. A word's value is its count, over the root of
    the document's length."""
    h, row, n, same = words(b)
    at, col = vocab.find(h)
    pair, c = np.unique(row[at].astype(np.int64) * max(1, len(vocab)) + col, return_counts=True)
    r, col = pair // max(1, len(vocab)), pair % max(1, len(vocab))
    value = np.minimum(c / np.sqrt(np.maximum(n[r], 30) / 300), 8.0)
    buf, offs = text_bytes(b.column("text"))
    size = np.maximum(1, np.diff(offs))
    share = [np.diff(np.concatenate(([0], np.cumsum(m[buf])))[offs]) / size for m in (_UPPER, _DIGIT, _SPACE, _SYMBOL)]
    lines = 1 + np.diff(np.concatenate(([0], np.cumsum(buf == 10)))[offs])
    style = np.column_stack((*share, same / np.maximum(1, n), n / size * 5, np.log1p(n) / 10, size / np.maximum(1, n) / 10))
    meta = np.zeros((b.num_rows, N_META))
    meta[:, 0], meta[:, 1], meta[:, 2], meta[:, 3] = np.log1p(size) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 10, lines > 1
    return Features((r, col, value.astype(np.float32).astype(float)), names.find(b), style, meta)


class Logistic:
    """Regularised logistic regression by full-batch Newton-like steps on
    sparse words or names (row, column pairs) and dense numbers."""

    def __init__(self, n_words: int):
        self.n_words = n_words

    @staticmethod
    def scaled(x, mean, sd):
        return np.clip((x - mean) / sd, -5, 5)

    def fit(self, rows, cols, vals, dense, y, weight, steps_=200, l2=0.3):
        n = len(y)
        self.mean, self.sd = dense.mean(0), dense.std(0) + 1e-3
        x = self.scaled(dense, self.mean, self.sd)
        self.b = 0.0
        self.w, self.v = np.zeros(self.n_words), np.zeros(x.shape[1])
        g2 = [np.full_like(self.w, 1e-8), np.full_like(self.v, 1e-8), 1e-8]
        for _ in range(steps_):
            p = 1 / (1 + np.exp(-self._margin(rows, cols, vals, x, n)))
            d = weight * (p - y)
            grads = [np.bincount(cols, vals * d[rows], self.n_words) + l2 * self.w, x.T @ d + l2 * self.v, d.sum()]
            for k, g in enumerate(grads):  # Adagrad
                g2[k] = g2[k] + g * g
            self.w -= 0.3 * grads[0] / np.sqrt(g2[0])
            self.v -= 0.3 * grads[1] / np.sqrt(g2[1])
            self.b -= 0.3 * grads[2] / np.sqrt(g2[2])
        return self

    def _margin(self, rows, cols, vals, x, n):
        m = np.bincount(rows, vals * self.w[cols], n) if self.n_words and len(rows) else np.zeros(n)
        return np.clip(m + x @ self.v + self.b, -30, 30)

    def margin(self, rows, cols, vals, dense):
        return self._margin(rows, cols, vals, self.scaled(dense, self.mean, self.sd), len(dense))


class Platt:
    """p = 1 / (1 + exp(-(a margin + b))), by Newton steps with a small prior."""

    def fit(self, m, y):
        m = np.atleast_2d(m.T).T
        x = np.column_stack((m, np.ones(len(m))))
        self.w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ self.w, -30, 30)))
            h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.05 * np.eye(len(self.w))
            self.w -= np.linalg.solve(h, x.T @ (p - y) + 0.05 * self.w)
        return self

    def __call__(self, m):
        m = np.atleast_2d(m.T).T
        return 1 / (1 + np.exp(-np.clip(np.column_stack((m, np.ones(len(m)))) @ self.w, -30, 30)))


class CoTrained:
    """The two fitted views, their calibration and their combination."""

    constant: float | None = None

    def fit(self, vocab: Vocabulary, names: Names, known: Features, y, aside, surest):
        """``known``, ``y`` and ``aside`` of the labelled documents.
        ``surest(model, cal)`` gives, for each view, the features and the labels
        of the documents the other view is surest of and has not handed yet."""
        n = len(y)
        if n == 0 or y.min() == y.max():
            self.constant = float(y[0]) if n else 1.0
            return self
        self.vocab, self.names = vocab, names
        if not aside.any() or aside.all() or y[aside].min() == y[aside].max() or y[~aside].min() == y[~aside].max():
            fit_on = cal_on = np.arange(n)  # too few to keep any aside
        else:
            fit_on, cal_on = np.flatnonzero(~aside), np.flatnonzero(aside)
        learned = {view: (known.take(fit_on), y[fit_on]) for view, _ in VIEWS}
        check, target = known.take(cal_on), y[cal_on]
        for turn in range(ROUNDS + 1):
            self.model, self.cal = {}, {}
            for view, _ in VIEWS:
                f, t = learned[view]
                weight = np.where(t > 0, 0.5 / max(t.mean(), 1e-6), 0.5 / max(1 - t.mean(), 1e-6))
                self.model[view] = Logistic(len(vocab) if view == "text" else len(names)).fit(*f.of(view), t, weight)
                self.cal[view] = Platt().fit(self.model[view].margin(*check.of(view)), target)
            if turn == ROUNDS:
                break
            more = surest(self.model, self.cal)
            for view, (f, t) in more.items():
                learned[view] = (learned[view][0] + f, np.concatenate((learned[view][1], t)))
            if not more:
                break  # nothing is sure any more: the next round would be this one
        self.handed = {view: len(t) - len(fit_on) for view, (_, t) in learned.items()}
        self.both = Platt().fit(np.column_stack([_logit(self.view(v, check)) for v, _ in VIEWS]), target)
        return self

    def view(self, view: str, f: Features):
        """Calibrated scores of one view."""
        return self.cal[view](self.model[view].margin(*f.of(view)))

    def __call__(self, b: pa.RecordBatch):
        """(text score, metadata score, combined score) of a batch of documents."""
        if self.constant is not None:
            c = np.full(b.num_rows, self.constant)
            return c, c, c
        f = counts(b, self.vocab, self.names)
        t, m = self.view("text", f), self.view("meta", f)
        return t, m, self.both(np.column_stack((_logit(t), _logit(m))))


def _logit(p):
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))


def _told(batches):
    """Sample documents to learn from -> (hash, documents, good ones) of a batch."""
    for batch in batches:
        for b in steps(batch, most=PIECE):
            h, row, _, _ = words(b)
            good = b.column("good").to_numpy(zero_copy_only=False)
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            once = np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
            u, inv = np.unique(h[once], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(inv, minlength=len(u)).astype(np.int64)), pa.array(np.bincount(inv, good[row[once]], len(u)).astype(np.int64))], ["h", "n", "pos"])


def _counted(vocab: Vocabulary, names: Names):
    def run(batches):
        for batch in batches:
            for b in steps(batch, most=PIECE):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts(b, vocab, names).packed()], ["doc_id", "cols", "vals", "names", "dense"])
    return run


def _sure_of(model: dict[str, Logistic], cal: dict[str, Platt], used: dict[str, list]):
    """Stored features -> thin rows of the documents a view is sure of and that
    it has not handed yet."""
    def run(batches):
        for b in batches:
            f = Features.unpacked(*(b.column(c).to_pylist() for c in ("cols", "vals", "names", "dense")))
            for view, other in VIEWS:
                p = cal[view](model[view].margin(*f.of(view)))
                sure = np.maximum(p, 1 - p)
                free = ~pc.is_in(b.column("doc_id"), value_set=pa.array(used[other], b.schema.field("doc_id").type)).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(free & (sure >= SURE))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at)), pa.array([other] * len(at), pa.string()), pa.array((p[at] >= 0.5).astype(np.int32)), pa.array(sure[at])],
                                                 ["doc_id", "other", "label", "sure"])
    return run


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("doc_id", "text", "lang", "source")])


def _one_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of features for each document id, the same one in any order."""
    return rows.groupBy("doc_id", *keys).agg(F.min(F.struct("dense", "cols", "vals", "names")).alias("f")).select("doc_id", *keys, "f.*")


def _features(rows: list) -> Features:
    return Features.unpacked(*([bytes(r[c]) for r in rows] for c in ("cols", "vals", "names", "dense")))


def _asked(pool: DataFrame, known: DataFrame, id_type: str, handed: int):
    """The question the classifiers put to the pool after each round. ``pool``
    holds the features of all documents; those with a label in ``known`` are
    taken out of the thin rows, so no features or texts are shuffled."""
    used = {view: [] for view, _ in VIEWS}

    def surest(model, cal):
        sure = mapped(pool, _sure_of(model, cal, used), f"doc_id {id_type}, other string, label int, sure double")
        sure = sure.groupBy("doc_id", "other", "label").agg(F.max("sure").alias("sure"))
        near = saved(sure.join(known.select("doc_id"), "doc_id", "left_anti"), "sure").withColumn("h", F.xxhash64("doc_id"))
        picks = None
        for view, _ in VIEWS:
            for label in (0, 1):
                part = near.where((F.col("other") == view) & (F.col("label") == label)).orderBy(F.desc("sure"), "h", "doc_id").limit(handed).select(F.col("doc_id").alias("_id"), "other", "label")
                picks = part if picks is None else picks.unionByName(part)
        # at most 4 * handed ids go out, at most as many rows of features come back
        rows = _one_each(pool.join(F.broadcast(picks), F.col("doc_id") == F.col("_id")), "other", "label").collect()
        out = {}
        for view, _ in VIEWS:
            mine = sorted((r for r in rows if r["other"] == view), key=lambda r: (r["doc_id"], r["label"]))
            if mine:
                used[view] += [r["doc_id"] for r in mine]
                out[view] = _features(mine), np.array([r["label"] for r in mine], float)
        return out
    return surest


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, handed: int = HANDED) -> CoTrained:
    """Fits on at most ``max_labelled`` labelled documents and those that the
    views hand each other out of all documents without a label."""
    d = _columns(docs)
    id_type = d.schema["doc_id"].dataType.simpleString()
    labelled = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = saved(labelled.groupBy("doc_id").agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("double")).alias("good")), "known")
    ids = d.select("doc_id").where("doc_id is not null")
    # a bounded list of ids, sent to all tasks
    some = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = F.broadcast(some.select(F.col("doc_id").alias("_id"), "good", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(ASIDE)) == 0).alias("aside")))
    sample = saved(d.join(chosen, F.col("doc_id") == F.col("_id")).drop("_id"), "labelled")
    told = mapped(sample.where("not aside"), _told, "h bigint, n bigint, pos bigint").groupBy("h").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    share = sample.where("not aside").agg(F.avg("good")).first()[0] or 0.5
    expect = F.col("n") * F.lit(float(share))
    chi = F.pow(F.col("pos") - expect, F.lit(2.0)) / F.greatest(expect * F.lit(1 - float(share)), F.lit(1e-9))
    top = told.where(F.col("n") >= MIN_DOCS).orderBy(chi.desc(), "h").limit(VOCABULARY).select("h").collect()
    vocab = Vocabulary(np.array([r["h"] for r in top], np.int64).view(np.uint64))
    named = [sample.groupBy(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")).agg(F.countDistinct("doc_id").alias("n")) for c in Names.COLUMNS]
    values = named[0].unionByName(named[1]).where(F.col("n") >= MIN_DOCS).collect()  # bounded by the sample
    names = Names(sorted(((r["c"], r["v"]) for r in values), key=lambda x: (x[0], x[1] is not None, x[1] or "")))
    schema = f"doc_id {id_type}, {FEATURES}"
    got = _one_each(mapped(sample.select("doc_id", "text", "lang", "source"), _counted(vocab, names), schema)).join(chosen, F.col("doc_id") == F.col("_id")).collect()
    got.sort(key=lambda r: r["doc_id"])
    y = np.array([r["good"] for r in got], float)
    surest = None
    if len(y) and y.min() != y.max():
        pool = saved(mapped(d.where("doc_id is not null"), _counted(vocab, names), schema), "pool")
        surest = _asked(pool, known, id_type, handed)
    return CoTrained().fit(vocab, names, _features(got), y, np.array([r["aside"] for r in got], bool), surest)


def _scores(model: CoTrained):
    def run(batches):
        for batch in batches:
            for b in steps(batch, most=PIECE):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.asarray(x, float)) for x in model(b))], ["doc_id", "text_score", "meta_score", "score"])
    return run


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept of every document."""
    t = docs.schema["doc_id"].dataType.simpleString()
    out = mapped(_columns(docs), _scores(model), f"doc_id {t}, text_score double, meta_score double, score double")
    return out.withColumn("kept", F.col("score") >= THRESHOLD)


def keep_good(docs: DataFrame, model: CoTrained) -> DataFrame:
    """The documents the classifier keeps, all columns as they are. They need
    the columns text, lang and source."""
    def run(batches):
        for batch in batches:
            for b in steps(batch, most=PIECE):
                yield b.filter(pa.array(model(b)[2] >= THRESHOLD))
    return mapped(docs, run, docs.schema)


@query("op4_quality_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    return score(d, train(d, spark.read.parquet(f"{sf_dir}/labels.parquet")))
