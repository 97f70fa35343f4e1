"""Embedding whitening: exact counts and sums, a distributed centred covariance, its leading eigenvectors, a projection.

Entries become whole numbers (``grid`` steps to one, moved by ``offset``), so
counts, sums and deviations are exact. Spark keeps each distinct vector once
(an aggregate, so copies meet after a partial one), sums it up per task in
numpy and adds the tasks' sums in a second aggregate. The driver sees one
covariance, dimensions squared, and takes its leading eigenpairs (``eigen``);
mean and components, dimensions times components, go out with the tasks that
project every row.

Centring. With m the whole number nearest to the mean, y = x - m is exact and
small; the sum of y_i * y_j is taken of centred entries, exact in a double while
it stays below 2**53, and what is left of the mean (less than one step) is
taken out at the end. So the model does not depend on the order of tasks.

Defined results. Rows whose vector is null or holds a null or non-finite entry
give no rows; nor do vectors without entries (no component) and empty tables.
Null and repeated ids stay, row for row. Vectors of another length are a table
of their own, with their own fit list. Entries beyond 2**53 steps count as
2**53 steps. Components with no variance (fewer distinct vectors than
dimensions, or constant dimensions) have ``explained`` 0 and ``whitened`` null;
``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow, store
from tempora.llm.eigen import leading_eigenpairs

LIMIT = 2.0**53  # steps beyond which a double holds no whole numbers
CELLS = 1 << 20  # entries worked on at a time
FIT = "dim int, x array<long>"
SUMS = "dim int, i int, j int, hi long, lo long, value double"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def steps(vectors: DataFrame, grid: int, offset: int, column: str = "embedding") -> DataFrame:
    """(vec_id, dim, x): sound vectors as whole numbers, floor(grid * entry) + offset."""
    sound = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(column, lambda c: F.floor(F.greatest(F.least(c.cast("double") * grid, F.lit(LIMIT)), F.lit(-LIMIT))) + offset)
    return (vectors.where(F.col(column).isNotNull()).where(sound).where(F.size(column) > 0)
            .select("vec_id", F.size(column).alias("dim"), whole.alias("x")))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix of whole numbers) per vector length, at most ``CELLS`` entries at a time."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    lists = batch.column("x")
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        for some in np.array_split(rows, max(1, -(-len(rows) * int(dim) // CELLS))):
            if len(some):
                yield int(dim), some, lists.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(len(some), int(dim))


def _entries(dim: int, i, j, value, hi=None, lo=None) -> pa.RecordBatch:
    n = len(i)
    zero = np.zeros(n, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, dim, dtype=np.int32)), pa.array(np.asarray(i, dtype=np.int32)), pa.array(np.asarray(j, dtype=np.int32)),
         pa.array(zero if hi is None else hi), pa.array(zero if lo is None else lo), pa.array(np.asarray(value, dtype=np.float64))],
        names=["dim", "i", "j", "hi", "lo", "value"])


def _summed(fit: DataFrame, fn: Callable) -> DataFrame:
    """The tasks' sums added per matrix entry; whole numbers as high and low halves, which cannot overflow."""
    big = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("hi", "lo")]
    return map_arrow(fit, fn, SUMS).groupBy("dim", "i", "j").agg(*big, F.sum("value").alias("value"))


def _column_sums(batches):
    """Per length: entry (i, -1) sums column i in halves of 32 bits, entry (-1, -1) counts the vectors."""
    sums: dict[int, list] = {}
    for batch in batches:
        for dim, _, x in _matrices(batch):
            s = sums.setdefault(dim, [0, np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64)])
            s[0] += len(x)
            s[1] += (x >> 32).sum(axis=0)
            s[2] += (x & 0xFFFFFFFF).sum(axis=0)
    for dim, (n, hi, lo) in sums.items():
        yield _entries(dim, np.arange(dim), np.full(dim, -1), np.zeros(dim), hi, lo)
        yield _entries(dim, [-1], [-1], [float(n)])


def _products(centre: dict[int, np.ndarray], to: Callable):
    """A task's sums of products of the entries of ``to``(x - centre), upper triangle, and of the entries themselves (i, -1)."""

    def fn(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch):
                z = to(dim, (x - centre[dim]).astype(np.float64))
                s = found.setdefault(dim, [0.0, 0.0])
                s[0] = s[0] + z.T @ z
                s[1] = s[1] + z.sum(axis=0)
        for dim, (products, sums) in found.items():
            if len(sums):
                i, j = np.triu_indices(len(sums))
                yield _entries(dim, i, j, products[i, j])
                yield _entries(dim, np.arange(len(sums)), np.full(len(sums), -1), sums)

    return fn


def _symmetric(rows: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of product sums, vector of sums) from entries."""
    products, sums = np.zeros((size, size)), np.zeros(size)
    for r in rows:
        if r["j"] < 0:
            sums[r["i"]] = r["value"]
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = r["value"]
    return products, sums


def _by_length(rows: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["dim"], []).append(r)
    return out


def fit_whitening(x: DataFrame, components: int) -> dict[int, dict]:
    """The model per vector length: n, whole sums, mean, values, vectors, explained, and how far it is from the identity."""
    fit = store(x.select("dim", "x").distinct(), "whitening-fit")
    model: dict[int, dict] = {}
    for dim, rows in _by_length(_summed(fit, _column_sums).collect()).items():  # one row per dimension
        total = np.zeros(dim, dtype=object)
        n = 0
        for r in rows:
            if r["i"] < 0:
                n = int(r["value"])
            else:
                total[r["i"]] = (int(r["hi"]) << 32) + int(r["lo"])
        nearest = np.array([(2 * int(s) + n) // (2 * n) for s in total], dtype=np.int64)
        rest = np.array([int(s) - n * int(m) for s, m in zip(total, nearest)], dtype=object)  # n times the mean of y
        model[dim] = {"n": n, "sums": total, "nearest": nearest, "rest": rest,
                      "shift": np.array([int(r) / n for r in rest], dtype=np.float64)}
    if not model:
        return model
    centre = {dim: m["nearest"] for dim, m in model.items()}
    for dim, rows in _by_length(_summed(fit, _products(centre, lambda _, z: z)).collect()).items():  # dimensions squared
        m = model[dim]
        products, _ = _symmetric(rows, dim)
        cov = products / m["n"] - np.outer(m["shift"], m["shift"])
        values, vectors = leading_eigenpairs(cov, components)
        trace = float(np.trace(cov))
        live = values > max(trace, 0.0) * dim * np.finfo(np.float64).eps
        scale = np.where(live, 1.0 / np.sqrt(np.where(live, values, 1.0)), np.nan)
        m |= {"values": values, "vectors": vectors, "map": vectors * scale, "live": live,
              "explained": np.where(live, values / (trace if trace > 0 else 1.0), 0.0)}
    shift = {dim: (m["shift"], m["map"][:, m["live"]]) for dim, m in model.items()}
    whiten = lambda dim, y: (y - shift[dim][0]) @ shift[dim][1]
    found = _by_length(_summed(fit, _products(centre, whiten)).collect())  # components squared
    for dim, m in model.items():
        size = int(m["live"].sum())
        products, sums = _symmetric(found.get(dim, []), size)
        mean = sums / m["n"]
        m["identity_error"] = float(np.abs(products / m["n"] - np.outer(mean, mean) - np.eye(size)).max(initial=0.0))
    return model


def _deviation(y: np.ndarray, n: int, rest: np.ndarray) -> list:
    """Per row the sum over dimensions of (n*x - S)**2 = (n*y - rest)**2, exact; None beyond a long."""
    reach = max(int(np.abs(y).max(initial=0)), 1) * n + max(abs(int(r)) for r in rest)
    if reach * reach * len(rest) < 2**63:
        return ((y * n - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - int(r)) ** 2 for a, r in zip(row, rest)) for row in y.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten_embeddings(vectors: DataFrame, components: int = 16, grid: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row per sound vector and leading component; columns as in ``OUT`` (see the module for odd rows)."""
    x = steps(vectors, grid, offset)
    model = fit_whitening(x, components)

    def project(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, rows, part in _matrices(batch):
                m = model[dim]
                y, k = part - m["nearest"], len(m["values"])
                white = (y.astype(np.float64) - m["shift"]) @ m["map"]
                n = len(rows) * k
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(n, m["n"], dtype=np.int64)),
                    pa.array(_deviation(y, m["n"], m["rest"]), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(np.tile(m["explained"], len(rows))),
                    pa.array(np.full(n, m["identity_error"]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(x, project, OUT)
