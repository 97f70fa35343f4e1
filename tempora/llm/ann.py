"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt to shards by hash of the id; a task builds each shard's
graph (see ``vamana``). Queries go to every shard in blocks, each search task
holding one graph and one block, and the shards' answers are merged by exact
distance. A shard keeps equal vectors as one point, so copies cannot crowd a
beam.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import group_arrow, map_arrow, pin, python_ready
from tempora.llm.vamana import BATCH, beam_search, build

SHARD = 4096  # vectors in a shard, on average
BLOCK = 2048  # queries in a block, on average
DEGREE, BUILD_BEAM, SEARCH_BEAM = 32, 64, 224


def is_usable() -> F.Column:
    """True for rows with an id and a vector that is not null, empty, zero or without a finite number; else false."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the rows that ``is_usable``."""
    v = F.col("embedding")
    return vectors.where(is_usable()).select(F.col("vec_id").cast("long"), v.cast("array<double>").alias("v"), F.size(v).alias("dim"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(-1, dim)


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _once(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, ascending, with the smallest of its vectors (entry by entry), whatever order the rows came in."""
    kept, first = np.unique(ids, return_index=True)
    if len(kept) < len(ids):
        by = np.lexsort((*x.T[::-1], ids))
        first = by[np.unique(ids[by], return_index=True)[1]]
    return kept, x[first]


def _unit(*arrays: np.ndarray) -> float:
    """1, or for values whose squares leave the range of a double the power of two to divide by (exactly) first."""
    top = max((np.abs(a).max(initial=0.0) for a in arrays), default=0.0)
    exponent = int(np.frexp(top)[1])
    return 2.0**exponent if abs(exponent) > 400 and top else 1.0


def build_shards(rows: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, graph): a packed graph per shard of (vec_id, v, dim)."""

    def run(key, table):
        dim = key[0].as_py()
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("v"), dim)
        ids, x = _once(ids, x)
        points, of = np.unique(x, axis=0, return_inverse=True)
        by = np.lexsort((ids, of.ravel()))
        edges, entry = build(points / _unit(points), DEGREE, BUILD_BEAM)
        graph = _pack(points=points, edges=edges.astype(np.int32), entry=entry, ids=ids[by], of=of.ravel()[by])
        return pa.table({"dim": [dim], "shard": pa.array([key[1].as_py()], pa.int32()), "graph": pa.array([graph], pa.binary())})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # a graph is little data and much work: a number that adaptive execution does not coalesce
    dealt = dealt.repartition(2 * shards, "dim", "shard")
    return group_arrow(dealt, ["dim", "shard"], run, "dim long, shard int, graph binary")


def search_graph(graph: dict, ids: np.ndarray, q: np.ndarray, k: int):
    """(query row, vec_id, distance) of the k nearest found of each query in a packed graph, its own id left out."""
    points, edges, first = graph["points"], graph["edges"], np.searchsorted(graph["of"], np.arange(len(graph["points"]) + 1))
    scale = _unit(points, q)
    x, out = points / scale, []
    for start in range(0, len(q), BATCH):
        part = q[start:start + BATCH] / scale
        nodes, _, _ = beam_search(x, edges, part, int(graph["entry"]), max(SEARCH_BEAM, k + 1))
        row, col = np.nonzero(nodes < len(x))
        node = nodes[row, col]
        gap = x[node] - part[row]
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap)) * scale
        size = np.minimum(first[node + 1] - first[node], k + 1)  # k of a point's copies are enough, one may be the query
        which = np.repeat(np.arange(len(node)), size)
        copy = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        vec, row, d = graph["ids"][first[node[which]] + copy], row[which] + start, d[which]
        other = vec != ids[row]
        vec, row, d = vec[other], row[other], d[other]
        by = np.lexsort((vec, d, row))
        vec, row, d = vec[by], row[by], d[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        out.append((row[rank < k], vec[rank < k], d[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD) -> DataFrame:
    """The k nearest vectors of each query: query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).

    In: vec_id and embedding of either side, other columns are ignored. Ties
    go to the smaller vec_id; a query is not its own answer; fewer candidates
    give fewer rows. Rows without an id, and vectors that are null, empty,
    zero or hold null or non-finite components, take no part. Vectors are
    compared with those of their own length. A repeated id counts once on
    either side, with the smallest of its vectors entry by entry. No vectors or queries give no rows. Recall is measured
    against brute force by ``recall``.
    """
    rows, asked = usable(vectors), usable(queries)
    n, m = rows.count(), asked.count()
    if not n or not m:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards, blocks = -(-n // shard_rows), -(-m // BLOCK)
    graphs = pin(build_shards(rows, shards)).select("dim", "shard", "graph", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("dim", F.col("dim").cast("long"))

    def run(key, left, right):
        names, types = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(names, types)})
        with np.load(io.BytesIO(left.column("graph")[0].as_py())) as f:
            graph = dict(f)
        ids, q = _once(right.column("vec_id").to_numpy(), matrix(right.column("v"), key[0].as_py()))
        row, vec, d = search_graph(graph, ids, q, k)
        return pa.table({"query_id": ids[row], "vec_id": vec, "score": d})

    python_ready(vectors.sparkSession)
    keys = ["dim", "shard", "block"]
    found = graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int = 10) -> DataFrame:
    """Exact answers of a bounded list of queries (of one length): every vector is compared, each batch sends its k best."""
    ids = np.array([q for q, _ in queries], np.int64)
    q = np.array([v for _, v in queries], np.float64)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches):
        ids, q = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            vec, x = b.column(0).to_numpy(), matrix(b.column(1), q.shape[1])
            out = []
            for i in range(len(q)):
                d = np.sqrt(((x - q[i]) ** 2).sum(axis=1))
                d[vec == ids[i]] = np.inf
                best = np.lexsort((vec, d))[:k]
                best = best[np.isfinite(d[best])]
                out.append((np.full(len(best), ids[i]), vec[best], d[best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    rows = usable(vectors).where(F.col("dim") == q.shape[1]).select("vec_id", "v")
    found = map_arrow(rows, run, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answers that were found."""
    got = exact.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return float(got.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0] or 1.0)
