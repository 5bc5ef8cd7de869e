"""Whitening of embeddings by refined eigenvectors of their covariance.

Entries become integers first, ``floor(SCALE * entry)``, so sums are exact (for entries
below 2^46 in size; larger ones are rounded to 53 bits). A constant added to all entries would
change nothing: all that is returned is centred.

1. One pass adds up the integers by dimension; a second one multiplies the vectors,
   centred at the nearest integers to the means, and adds the products, in integers
   as well (what the rounding of the centre leaves is taken off afterwards, exactly).
   A task sends one matrix; matrices are added in groups of tasks, then over all.
2. The eigenvectors of the covariance in single precision are the start. Each step of
   Ogita and Aishima multiplies matrices in the highest precision at hand, measures how
   far the vectors are from being orthogonal (R) and diagonalising (S), and corrects all
   of them at once by E = (S + R diag(e)) / (e_j - e_i). Eigenvalues that the step cannot
   tell apart are a cluster: there E is R / 2, the covariance less the cluster's mean is
   projected on it, and the small problem is solved and turns the vectors. The next step
   sees the gaps inside. The corrections shrink quadratically.
3. Vectors, centred, are projected and divided by the root of the eigenvalue; a last pass
   measures the covariance of the results against the identity.

The driver holds matrices of dimension x dimension only, whatever the number of rows.

Cases: rows whose vector is null or empty, or holds null or non-finite entries, are left
out, and so are vectors of another length than the most frequent one (of equally frequent
ones the longest counts); repeated rows each count and each come back; a null id is kept;
a direction without variance (constant or dependent dimensions, a single row) has no
whitened value (null) and no part in the identity error; an empty table gives an empty
result; columns other than the two named are not read, so no names clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlog.llm.common import ship_package

SCALE = 64
COMPONENTS = 32
STEPS = 12                  # refinement steps at most; they stop when corrections vanish
GROUPS = 64                 # matrices of tasks are first added in so many groups
EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    """Not null, not empty, all entries finite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def most_frequent_length(vectors: DataFrame, vec_col: str) -> int:
    row = (vectors.groupBy(F.size(vec_col).alias("k")).agg(F.count("*").alias("c"))
           .agg(F.max_by("k", F.struct("c", "k")).alias("k")).first())
    return row["k"] or 0


def _matrix(column, dim: int) -> np.ndarray:
    """A batch's vectors as rows of float64 integers floor(SCALE * entry)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dim)


def _exact_products(d: np.ndarray) -> np.ndarray:
    """d^T d of integers in float64, multiplied in runs short enough that every sum is exact."""
    most = float(np.abs(d).max(initial=1.0))
    if most * most >= EXACT:
        whole = np.array([[int(v) for v in line] for line in d], dtype=object)
        return whole.T @ whole
    run = int(max(1, min(len(d), EXACT // (most * most))))
    total = np.zeros((d.shape[1], d.shape[1]), dtype=object if most * most * len(d) >= 2.0 ** 62 else np.int64)
    for a in range(0, len(d), run):
        total = total + (d[a:a + run].T @ d[a:a + run]).astype(np.int64)
    return total


def _add_up(parts: DataFrame) -> list[list[int]]:
    """Sums of the rows ``values`` (lists of integers as text) of equal ``line``, in two levels of groups."""
    def added(table: pa.Table) -> pa.Table:
        total = None
        for blob in table.column("values").to_pylist():
            values = np.array([int(x) for x in blob], dtype=object)
            total = values if total is None else total + values
        return pa.table({"line": pa.array([table.column("line")[0].as_py()], pa.int32()),
                         "part": pa.array([0], pa.int32()), "values": pa.array([[str(x) for x in total]], pa.list_(pa.string()))})

    schema = "line int, part int, values array<string>"
    grouped = parts.withColumn("part", F.pmod("part", F.lit(GROUPS)).cast("int")).groupBy("line", "part").applyInArrow(added, schema)
    whole = grouped.groupBy("line").applyInArrow(added, schema).collect()
    return [[int(x) for x in r["values"]] for r in sorted(whole, key=lambda r: r["line"])]


def _per_task(vectors: DataFrame, vec_col: str, dim: int, products) -> DataFrame:
    """One matrix for each task: the sum of ``products(matrix)`` over its batches, as rows (line, part, values)."""
    def run(batches):
        total, part = None, 0
        for batch in batches:
            if batch.num_rows:
                own = products(_matrix(batch.column(vec_col), dim))
                part = batch.column("part")[0].as_py()
                total = own.astype(object) if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([part] * len(total), pa.int32()),
                 pa.array([[str(int(x)) for x in line] for line in total], pa.list_(pa.string()))], names=["line", "part", "values"])

    return vectors.select(vec_col, F.spark_partition_id().alias("part")).mapInArrow(run, "line int, part int, values array<string>")


def exact_covariance(vectors: DataFrame, vec_col: str, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Rows n, sums of the integers, and n^2 times their covariance, all exact."""
    def sums(x):
        small = float(np.abs(x).sum(axis=0).max(initial=0.0)) < EXACT
        return np.array([[len(x)] * dim, [int(v) for v in x.sum(axis=0)] if small else [sum(map(int, c)) for c in x.T]], dtype=object)

    count, total = _add_up(_per_task(vectors, vec_col, dim, sums))
    n = count[0]
    centre = np.array([round(s / n) if abs(s) < EXACT else (2 * s + n) // (2 * n) for s in total], dtype=np.float64)
    products = np.array(_add_up(_per_task(vectors, vec_col, dim, lambda x: _exact_products(x - centre))), dtype=object)
    left = np.array([s - n * int(c) for s, c in zip(total, centre)], dtype=object)      # sums of the centred entries
    return n, total, n * products - np.outer(left, left)


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of eigenvalues whose neighbours lie within ``width``; single ones left out."""
    order = np.argsort(-values, kind="stable")
    cut = np.flatnonzero(np.abs(np.diff(values[order])) > width) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def refine(cov: np.ndarray, x: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of ``cov`` from approximate vectors ``x``, in the precision of ``cov``."""
    kind = cov.dtype.type
    x = x.astype(kind)
    eps = np.finfo(kind).eps
    identity = np.eye(len(cov), dtype=kind)
    norm = float(np.sqrt(float((cov * cov).sum()))) or 1.0
    before = np.inf
    for _ in range(steps):
        r = identity - x.T @ x
        s = x.T @ (cov @ x)
        e = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(e)
        width = 2 * (float(np.sqrt(float((off * off).sum()))) + norm * float(np.sqrt(float((r * r).sum()))))
        gap = e[None, :] - e[:, None]
        apart = np.abs(gap) > width
        with np.errstate(divide="ignore", invalid="ignore"):
            correction = np.where(apart, (s + e[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ correction
        for inside in _clusters(e, width):
            own = x[:, inside]
            # the covariance on the cluster, less its mean: only the gaps inside are left
            small = own.T @ (cov @ own - own * e[inside].mean())
            scale = float(np.abs(small).max(initial=0.0))
            if scale > 0:
                turn = np.linalg.eigh((small / kind(scale)).astype(np.float64))[1]
                x[:, inside] = own @ turn.astype(kind)
        size = float(np.abs(correction).max(initial=0.0))
        if max(size, before) < 64 * eps:        # twice, so that a cluster's turn has been corrected too
            break
        before = size
    for _ in range(2):      # unit length and right angles to the last digit; a cluster keeps its span
        x = x + x @ ((identity - x.T @ x) / 2)
    e = np.einsum("ij,ij->j", x, cov @ x)
    order = np.argsort(-e, kind="stable")
    return e[order], x[:, order]


def eigen(scaled: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and vectors of the covariance whose n^2-fold is the integer matrix ``scaled``, and its trace."""
    trace = sum(int(scaled[i, i]) for i in range(len(scaled)))
    if not trace:
        return np.zeros(len(scaled)), np.eye(len(scaled)), 0.0
    high = np.longdouble
    # integers to the highest precision at hand, as a high and a low part
    top = scaled.astype(np.float64)
    low = np.array([[int(v) - int(t) for v, t in zip(a, b)] for a, b in zip(scaled, top)], dtype=object).astype(np.float64)
    cov = (top.astype(high) + low.astype(high)) / high(trace)
    start = np.linalg.eigh(cov.astype(np.float32))[1][:, ::-1]
    values, vectors = refine(cov, start)
    scale = high(trace) / high(n) / high(n)
    return (values * scale).astype(np.float64), vectors.astype(np.float64), float(scale)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row: id, ``n``, ``deviation`` (decimal) and the arrays ``whitened`` and ``explained`` by component,
    with ``identity_error``. The components are those of the largest eigenvalues, ``components`` of them at most."""
    ship_package(embeddings.sparkSession)
    good = embeddings.select(F.col(id_col).alias("vid"), F.col(vec_col).alias("vec")).where(usable(F.col(vec_col)))
    dim = most_frequent_length(good, "vec")
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not dim:
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = good.where(F.size("vec") == dim)
    n, total, scaled = exact_covariance(vectors, "vec", dim)
    values, directions, trace = eigen(scaled, n)
    keep = min(components, dim)
    live = values[:keep] > max(1e-13 * (values[0] if len(values) else 0), 0)
    centre = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.float64)
    left = np.array([(s - n * int(c)) / n for s, c in zip(total, centre)])
    onto = np.where(live[None, :], directions[:, :keep] / np.sqrt(np.where(live, values[:keep], 1)), 0.0)
    explained = (values[:keep] / trace if trace else np.zeros(keep)).clip(min=0)

    def projected(x: np.ndarray) -> np.ndarray:
        return ((x - centre) - left) @ onto

    def measure(batches):
        gram, first, rows = np.zeros((keep, keep)), np.zeros(keep), 0
        for batch in batches:
            if batch.num_rows:
                w = projected(_matrix(batch.column("vec"), dim))
                gram, first, rows = gram + w.T @ w, first + w.sum(axis=0), rows + len(w)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(keep), pa.int32()), pa.array(gram.tolist(), pa.list_(pa.float64())),
                                              pa.array(first.tolist(), pa.float64())], names=["line", "products", "total"])

    sums = (vectors.select("vec").mapInArrow(measure, "line int, products array<double>, total double")
            .select("line", "total", F.posexplode("products").alias("at", "product"))
            .groupBy("line", "at").agg(F.sum("product").alias("product"), F.sum("total").alias("total")).collect())
    second, first = np.zeros((keep, keep)), np.zeros(keep)
    for r in sums:
        second[r["line"], r["at"]], first[r["line"]] = r["product"], r["total"]
    measured = second / n - np.outer(first / n, first / n)
    error = float(np.abs((measured - np.eye(keep))[np.ix_(live, live)]).max(initial=0.0))
    whole = [s - n * int(c) for s, c in zip(total, centre)]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), dim)
            w = projected(x)
            d = x - centre
            most = n * float(np.abs(d).max(initial=0.0)) + max(abs(v) for v in whole)
            if most * most * dim < 2.0 ** 62:
                squares = pa.array(((n * d.astype(np.int64) - np.array(whole, np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
            else:
                exact = [sum((n * int(v) - t) ** 2 for v, t in zip(row, whole)) for row in d]
                squares = pa.array([str(v) for v in exact], pa.string()).cast(pa.decimal128(38, 0))
            m = len(x)
            values = pa.array(w.ravel(), mask=np.tile(~live, m)) if not live.all() else pa.array(w.ravel())
            offsets = pa.array(np.arange(0, keep * m + 1, keep, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vid"), pa.array(np.full(m, n, np.int64)), squares, pa.ListArray.from_arrays(offsets, values),
                 pa.ListArray.from_arrays(offsets, pa.array(np.tile(explained, m))), pa.array(np.full(m, error))],
                names=[id_col, "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
