"""Operator 11: embedding whitening by mixed-precision refinement.

Vectors are put on a lattice, x = floor(scale * c) + offset, so that counts,
sums and the covariance are sums of integers: each task adds up its own rows
centred at the whole number nearest the mean, Spark adds the tasks' sums, and
what is left of the mean (less than a half) is taken off in integers as well.
The result does not depend on how the rows are dealt. Only d * (d + 1) / 2
sums reach the driver.

The eigenvectors of that covariance are found in float32 and corrected by the
iterations of Ogita and Aishima ("Iterative refinement for symmetric eigenvalue
decomposition", I and II), which are matrix products in extended precision:
with R = I - X'X and S = X'AX the correction of column j by column i is
(S_ij + l_j R_ij) / (l_j - l_i). Eigenvalues closer than the present error are
a cluster: its columns are only made orthogonal by that step, and then turned
by the eigenvectors of the small matrix X_J' (A - m I) X_J, which is solved on
its own, shifted and scaled, so that the differences inside the cluster show.

Defined results: a vector that is null, or holds a null or non-finite entry, is
left out, and so is one of another length than most (ties: the longer); an
entry beyond 2^52 after scaling stands at 2^52; a component whose eigenvalue is
not above 1e-13 of the trace has no direction and is not returned, so equal
vectors, a single vector or an empty table give no rows; a squared deviation
beyond 64 bits is null; ids are carried as they are, null and repeated ones
too; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import mapped
from threadlens.llm.registry import query

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
MOST = 2.0**52        # entries of the lattice, before the offset
NO_DIRECTION = 1e-13  # share of the trace below which an eigenvalue counts as zero
ROUNDS = 40


# --- rows on the lattice ---------------------------------------------------------------
def lattice(col: pa.Array, dim: int, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, int64 matrix) of the vectors of a batch that count."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    if not len(rows) or not dim:
        return rows[:0], np.zeros((0, dim), np.int64)
    # a null entry becomes NaN
    flat = pc.list_flatten(col.take(pa.array(rows))).cast(pa.float64()).to_numpy(zero_copy_only=False)
    c = np.asarray(flat, np.float64).reshape(len(rows), dim)
    good = np.isfinite(c).all(axis=1)
    rows, c = rows[good], c[good]
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(scale * c), -MOST, MOST).astype(np.int64) + offset
    return rows, x


def largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact column sums as Python integers."""
    small = largest(x) * len(x) < 2**62
    return (x if small else x.astype(object)).sum(axis=0, initial=0).astype(object)


def gram(y: np.ndarray) -> np.ndarray:
    """y'y exactly, as Python integers: in floating point as long as every sum
    is a whole number below 2^53, else in integers."""
    most = largest(y)
    step = 2**53 // max(1, most * most)
    out = np.zeros((y.shape[1], y.shape[1]), object)
    if step < 16:
        z = y.astype(object)
        return out + z.T @ z
    step = min(step, 1 << 20)
    for lo in range(0, len(y), step):
        f = y[lo:lo + step].astype(np.float64)
        out += (f.T @ f).astype(np.int64).astype(object)
    return out


def _whole(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _summed(dim: int, scale: float, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for b in batches:
            _, x = lattice(b.column(0), dim, scale, offset)
            n, total = n + len(x), total + column_sums(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array([n] * dim, pa.int64()), _whole(total)], ["i", "n", "s"])
    return run


def _crossed(dim: int, scale: float, offset: int, centre: list[int]):
    def run(batches):
        total, any_ = np.zeros((dim, dim), object), False
        for b in batches:
            _, x = lattice(b.column(0), dim, scale, offset)
            if len(x):
                total, any_ = total + gram(x - np.array(centre, np.int64)), True
        if any_:
            i, j = np.tril_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _whole(total[i, j])], ["i", "j", "g"])
    return run


# --- eigenvectors ------------------------------------------------------------------------
def clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Index sets of eigenvalues that hang together by steps of at most ``apart``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def orthogonal(x: np.ndarray, steps: int = 2) -> np.ndarray:
    """Columns that are nearly orthonormal made so, by Newton-Schulz steps."""
    for _ in range(steps):
        x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def refined_eigh(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns, the entry largest
    in size positive) of a symmetric matrix given in extended precision."""
    wide = np.longdouble
    a = np.asarray(a, wide)
    a = (a + a.T) / 2
    d = len(a)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(d), np.eye(d)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    one, eps = np.eye(d, dtype=wide), np.finfo(np.float64).eps
    norm = np.sqrt((a * a).sum())
    values, best = None, None
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= error
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        change = np.abs(e).max()
        x = x + x @ e
        for group in clusters(values, error):
            v = x[:, group]
            t = v.T @ a @ v
            t = t - np.eye(len(group), dtype=wide) * np.diag(t).mean()
            spread = np.abs(t).max()
            if spread > 8 * np.finfo(wide).eps * norm:  # below that any basis of the cluster will do
                x[:, group] = v @ orthogonal(np.linalg.eigh(((t + t.T) / (2 * spread)).astype(np.float32))[1].astype(wide))
        if change <= eps / 8 and error <= eps * norm and best is not None and change >= best / 2:
            break  # as small as it gets
        best = change if best is None else min(best, change)
    x = orthogonal(x)
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order] * size
    at = np.abs(x).argmax(axis=0)
    x = x * np.sign(x[at, np.arange(d)])
    return values.astype(np.float64), x.astype(np.float64)


# --- fit -----------------------------------------------------------------------------------
@dataclass
class Whitening:
    """What a fit leaves: all sizes are bounded by the dimension."""
    dim: int
    n: int
    sums: list[int]          # of x, by dimension
    centre: list[int]        # the whole number nearest the mean
    values: np.ndarray       # eigenvalues of the components, falling
    vectors: np.ndarray      # (dim, components)
    trace: float
    scale: float
    offset: int

    @property
    def rest(self) -> list[int]:
        """n * (mean - centre), less than n / 2 in size."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre)]

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of lattice rows."""
        y = (x - np.array(self.centre, np.int64)).astype(np.float64) - np.array([r / self.n for r in self.rest])
        return y @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n * x - S)^2, None beyond 64 bits."""
        y, rest = x - np.array(self.centre, np.int64), self.rest
        most = self.n * (largest(y) + 1)
        if most * most * max(1, self.dim) < 2**63:
            z = self.n * y - np.array(rest, np.int64)
            return (z * z).sum(axis=1).tolist()
        z = self.n * y.astype(object) - np.array(rest, object)
        return [v if v < 2**63 else None for v in (z * z).sum(axis=1).tolist()]


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET) -> Whitening:
    """Two passes over the vector column: counts and sums, then the covariance."""
    v = vectors.select(F.col(vector_col).alias("v")).where("v is not null")
    sizes = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = sizes["d"] if sizes else 0
    none = Whitening(dim, 0, [0] * dim, [0] * dim, np.zeros(0), np.zeros((dim, 0)), 0.0, scale, offset)
    if not dim:
        return none
    got = mapped(v, _summed(dim, scale, offset), "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    if not got:
        return none
    n, sums = got[0]["n"], [int(r["s"]) for r in got]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    cells = mapped(v, _crossed(dim, scale, offset, centre), "i int, j int, g decimal(38,0)").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    rest = [s - n * c for s, c in zip(sums, centre)]
    exact = np.zeros((dim, dim), object)  # n^2 times the covariance
    for r in cells:
        exact[r["i"], r["j"]] = exact[r["j"], r["i"]] = n * int(r["g"]) - rest[r["i"]] * rest[r["j"]]
    trace = int(np.trace(exact))
    if not trace:
        return Whitening(dim, n, sums, centre, np.zeros(0), np.zeros((dim, 0)), 0.0, scale, offset)
    # an integer has more digits than a double: both halves go into the extended number
    hi = exact.astype(np.float64)
    lo = (exact - np.array([[int(x) for x in row] for row in hi], object)).astype(np.float64)
    values, x = refined_eigh((hi.astype(np.longdouble) + lo) / np.longdouble(n) / np.longdouble(n))
    total = float(np.longdouble(trace) / n / n)
    keep = min(components, int((values > NO_DIRECTION * total).sum()))
    return Whitening(dim, n, sums, centre, values[:keep], x[:, :keep], total, scale, offset)


# --- apply ---------------------------------------------------------------------------------
def _whitened(model: Whitening):
    def run(batches):
        for b in batches:
            rows, x = lattice(b.column("v"), model.dim, model.scale, model.offset)
            if len(rows):
                w = model.project(x)
                flat = pa.array(w.ravel())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(rows)), pa.array(model.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * w.shape[1]), flat)], ["id", "deviation", "whitened"])
    return run


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, deviation, whitened (array, one value a component): one narrow pass."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    id_type = v.schema["id"].dataType.simpleString()
    return mapped(v, _whitened(model), f"id {id_type}, deviation bigint, whitened array<double>").withColumnRenamed("id", id_col)


def _squared(model: Whitening):
    def run(batches):
        k = len(model.values)
        total, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            _, x = lattice(b.column(0), model.dim, model.scale, model.offset)
            w = model.project(x)
            total, sums = total + w.T @ w, sums + w.sum(axis=0)
        i, j = np.tril_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, np.full(k, -1)).astype(np.int32)), pa.array(np.append(j, np.arange(k)).astype(np.int32)),
                                          pa.array(np.append(total[i, j], sums))], ["i", "j", "g"])
    return run


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the covariance of the whitened values,
    measured over all rows, minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    cells = mapped(vectors.select(F.col(vector_col).alias("v")), _squared(model), "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in cells:
        if r["i"] < 0:
            mean[r["j"]] = r["g"] / model.n
        else:
            cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["g"] / model.n
    return round(float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max()), 12)


@query("op11_whitened_embeddings")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = fit(vectors)
    error = identity_error(vectors, model)
    out = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("no", "whitened"))
    share = F.array(*[F.lit(float(x)) for x in model.explained]) if len(model.values) else F.array(F.lit(0.0))
    return out.select("vec_id", (F.col("no") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(share, F.col("no") + 1).alias("explained"), F.lit(error).alias("identity_error"))
