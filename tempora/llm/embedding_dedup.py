"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Equal vectors become one point with a count.
2. Points are assigned to their nearest clusters, several each, so that the
   clusters overlap; a cluster with too many points is cut in blocks, and
   every pair of blocks is a shard of its own.
3. Each shard builds a robust-pruned graph; the adjacency lists a point got
   in different shards are united.
4. Each shard searches the united lists of its points: from its medoid
   greedily to each point, then on through everything in range.
5. Pairs found are verified by cosine in double precision. A task returns a
   count per point and a spanning forest, never pairs; a pair that shares
   several shards is counted in the first of them.
6. Recall is audited against brute force on points drawn until enough of them
   have a link, per link and per point; below the goal the overlap is widened
   and the search repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.ann import is_usable, matrix, usable
from tempora.llm.common import group_arrow, map_arrow, merge_labels, pin
from tempora.llm.components import connected_components
from tempora.llm.vamana import BATCH, both_ways, build, range_search

CLUSTER = 1024  # points per cluster before overlap
CLUSTERS = 4096  # clusters at most; larger ones are cut in blocks
SAMPLE = 32  # sampled points per cluster that the centroids are fitted on
SHARD = 4096  # points of a shard
OVERLAP = 3  # clusters per point to begin with
DEGREE, BEAM = 24, 32
AUDIT, GOAL = 200, 0.95  # points of the first draw of an audit, and the recall asked for per link and per point
LINKED, DRAWN = 100, 16384  # audited points that must have a link, and points drawn for them at most


def centroids(points: DataFrame, n: int, dim: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on at most SAMPLE points per cluster, the first by hash of the id."""
    k = min(CLUSTERS, -(-n // CLUSTER))
    rows = points.orderBy(F.xxhash64("rep"), "rep").limit(k * SAMPLE).select("v").toArrow()
    x = unit(matrix(rows.column(0), dim))
    c = x[np.random.default_rng(7).permutation(len(x))[:k]]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = unit(np.where(np.abs(total).sum(axis=1, keepdims=True) > 0, total, c))
    return c


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that very large and very small numbers keep their direction."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def assign(points: DataFrame, centers: np.ndarray, overlap: int) -> DataFrame:
    """points with ``near``, the ids of the ``overlap`` nearest clusters, nearest first."""
    shared = points.sparkSession.sparkContext.broadcast(centers)  # CLUSTERS rows at most
    take = min(overlap, len(centers))

    def run(batches):
        centers = shared.value
        for b in batches:
            x = unit(matrix(b.column(2), centers.shape[1])) if b.num_rows else np.zeros((0, centers.shape[1]))
            near = [np.argsort(-(x[i:i + 4096] @ centers.T), axis=1, kind="stable")[:, :take] for i in range(0, len(x), 4096)]
            near = np.concatenate(near).astype(np.int32) if near else np.zeros((0, take), np.int32)
            near = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, take, dtype=np.int32)), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, near], names=["rep", "n", "v", "near"])

    return map_arrow(points.select("rep", "n", "v"), run, "rep long, n long, v array<double>, near array<int>")


def deal(assigned: DataFrame, shard: int) -> DataFrame:
    """A row per point and shard (c, i, j): cluster and blocks; ``own`` is the point's block. A cluster of one block has i = j = 0."""
    rows = assigned.withColumn("c", F.explode("near"))
    sizes = rows.groupBy("c").count().where(F.col("count") > shard).collect()  # CLUSTERS rows at most
    large = {r[0]: -(-r[1] // (shard // 2)) for r in sizes}
    blocks = F.lit(1)
    if large:
        table = F.create_map(*[F.lit(x) for kv in large.items() for x in kv])
        blocks = F.coalesce(F.try_element_at(table, F.col("c")), F.lit(1))
    rows = rows.withColumn("m", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.expr("sequence(0, m - 1)")))
    return rows.select("rep", "n", "v", "near", "c", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own")


def _ordered(rows: pa.Table):
    ids = rows.column("rep").to_numpy()
    by = np.argsort(ids)
    return ids[by], unit(matrix(rows.column("v"), len(rows.column("v")[0])))[by], by


def adjacency(shards: DataFrame) -> DataFrame:
    """(rep, nbrs): the united neighbour lists of the shards' graphs."""

    def run(key, rows):
        ids, x, _ = _ordered(rows)
        edges, _ = build(x.astype(np.float32), DEGREE, BEAM)
        ends = np.cumsum((edges >= 0).sum(axis=1))
        nbrs = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids[edges[edges >= 0]]))
        return pa.table({"rep": ids, "nbrs": nbrs})

    lists = group_arrow(shards.select("c", "i", "j", "rep", "v"), ["c", "i", "j"], run, "rep long, nbrs array<long>")
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"))


def search(shards: DataFrame, lists: DataFrame, cosine: float) -> DataFrame:
    """(rep, links, root): per point and shard the rows linked (counted by multiplicity) and an edge of the shard's forest."""
    radius2 = 2 - 2 * cosine + 1e-5  # of float vectors; verified below

    def run(key, rows):
        c, i, j = (k.as_py() for k in key)
        ids, x, by = _ordered(rows)
        n, own = (rows.column(f).to_numpy()[by] for f in ("n", "own"))
        near = matrix(rows.column("near"), len(rows.column("near")[0]))[by]
        lists = rows.column("nbrs").combine_chunks().take(pa.array(by))
        size = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy()
        at = np.searchsorted(ids, flat)
        here = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == flat)
        owner = np.repeat(np.arange(len(ids)), size)[here]
        at = at[here]
        width = np.bincount(owner, minlength=len(ids))
        edges = np.full((len(ids), max(1, int(width.max(initial=0)))), -1, np.int64)
        edges[owner, np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)] = at
        xs = x.astype(np.float32)
        links = both_ways(edges)
        entry = int((x @ x.mean(axis=0)).argmax())
        found = np.zeros((len(ids), len(ids)), bool)
        for start in range(0, len(ids), BATCH):
            row, node = range_search(xs, edges, links, xs[start:start + BATCH], entry, radius2, BEAM)
            exact = np.einsum("ij,ij->i", x[row + start], x[node]) >= cosine
            found[row[exact] + start, node[exact]] = True
        found |= found.T
        np.fill_diagonal(found, False)
        if i != j:  # pairs inside a block belong to that block's own shard
            found &= own[:, None] != own[None, :]
        u, v = np.nonzero(found)
        label = merge_labels(np.arange(len(ids)), u[u < v], v[u < v])
        for other in np.unique(near[near < c]):  # pairs counted in an earlier cluster
            both = np.flatnonzero((near == other).any(axis=1))
            found[np.ix_(both, both)] = False
        return pa.table({"rep": ids, "links": (found @ n.astype(np.float64)).astype(np.int64), "root": ids[label]})

    rows = shards.join(lists, "rep")
    return group_arrow(rows, ["c", "i", "j"], run, "rep long, links long, root long")


def audit(points: DataFrame, counted: DataFrame, dim: int, cosine: float, sample: int = AUDIT, linked: int = LINKED) -> float | None:
    """Recall on points drawn by hash of the id, each compared with every point: the lower of per link and mean per point.

    Draws grow from ``sample`` points until ``linked`` of them have an exact
    link, all points are drawn or DRAWN are; None if none has a link.
    """
    drawn, take, got = 0, sample, np.zeros(4)
    while True:
        rows = points.orderBy(F.xxhash64("rep", F.lit(2)), "rep").offset(drawn).limit(take).select("rep", "v").toArrow()
        if len(rows):
            got += _compare(points, counted, rows.column("rep").to_numpy(), unit(matrix(rows.column("v"), dim)), cosine)
        drawn += len(rows)
        if got[3] >= linked or len(rows) < take or drawn >= DRAWN:
            return float(min(got[0] / got[1], got[2] / got[3])) if got[3] else None
        take = min(3 * drawn, DRAWN - drawn)


def _compare(points: DataFrame, counted: DataFrame, ids: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    """Of the points ``ids``: links found, links there are, sum of the points' recalls, points with a link."""
    shared = points.sparkSession.sparkContext.broadcast((ids, q))  # DRAWN rows at most

    def run(batches):
        ids, q = shared.value
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            if b.num_rows:
                x, rep, n = unit(matrix(b.column(2), q.shape[1])), b.column(0).to_numpy(), b.column(1).to_numpy()
                for i in range(0, len(ids), 512):
                    near = x @ q[i:i + 512].T >= cosine
                    near &= rep[:, None] != ids[None, i:i + 512]
                    total[i:i + 512] += n @ near
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], names=["id", "exact"])

    exact = map_arrow(points.select("rep", "n", "v"), run, "id long, exact long").groupBy("id").agg(F.sum("exact").alias("exact"))
    each = exact.join(counted, exact.id == counted.rep, "left").select("exact", F.least("exact", F.coalesce("links", F.lit(0))).alias("found"))
    got = each.agg(F.sum("found"), F.sum("exact"), F.sum(F.col("found") / F.col("exact")), F.count("*")).first()
    return np.array([float(x or 0) for x in got])


def link_points(points: DataFrame, dim: int, cosine: float, shard: int = SHARD, goal: float = GOAL) -> tuple[DataFrame, DataFrame, float | None]:
    """(rep, links), (u, v) forest edges and the audited recall (None: no link met), for points (rep, n, v) of one length."""
    n = points.count()
    centers = centroids(points, n, dim)
    overlap = min(OVERLAP, len(centers))
    while True:
        shards = pin(deal(assign(points, centers, overlap), shard))
        found = pin(search(shards, pin(adjacency(shards)), cosine))
        counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
        reached = audit(points, counted, dim, cosine)
        if reached is None or reached >= goal or overlap == len(centers):
            return counted, found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")), reached
        overlap = min(2 * overlap, len(centers))


def link_lengths(reps: DataFrame, cosine: float, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(rep, links, recall) and (u, v) for points (rep, n, v, dim) of any number of lengths, each of one cluster's points: the length is the cluster."""
    shards = pin(deal(reps.select("rep", "n", "v", F.array("dim").alias("near")), shard))
    found = pin(search(shards, pin(adjacency(shards)), cosine))
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))

    def run(key, rows):
        ids, x, by = _ordered(rows)
        n = rows.column("n").to_numpy()[by]
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        return pa.table({"id": ids, "dim": pa.array(np.full(len(ids), key[0].as_py(), np.int32)), "exact": near @ n})

    # at most CLUSTER points each, so all of them are audited
    exact = group_arrow(reps.select("dim", "rep", "n", "v"), ["dim"], run, "id long, dim int, exact long")
    each = pin(exact.join(counted, exact.id == counted.rep).select("rep", "dim", "links", "exact", F.least("links", "exact").alias("got")))
    recall = each.where("exact > 0").groupBy(F.col("dim").alias("d")).agg(
        F.least(F.sum("got") / F.sum("exact"), F.avg(F.col("got") / F.col("exact"))).alias("recall"))
    counted = each.join(recall, F.col("dim") == F.col("d"), "left").select("rep", "links", "recall")
    return counted, found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v"))


def embedding_near_dedup(vectors: DataFrame, cosine: float = 0.9, shard: int = SHARD) -> DataFrame:
    """Link classes of vectors: vec_id, n_links, component_id, kept, recall (audited) for every row.

    In: vec_id and embedding, other columns are ignored. Vectors are linked at
    cosine ``cosine`` or more, in double precision; only vectors of one length
    are compared. A vector that is null, empty, zero or holds null or
    non-finite components, and a row without an id, links with nothing and is
    its own class. Repeated rows link with each other; an id with
    several vectors has a row for each, and they are linked only as their vectors are. The class id is the
    smallest vec_id that links reach; ``kept`` marks it. ``recall`` is null
    where nothing was measured. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    sound = pin(usable(rows))
    reps = sound.groupBy("dim", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    reps = pin(reps.withColumn("rep", F.monotonically_increasing_id()))  # a key per distinct vector: one id may have several
    sizes = pin(reps.groupBy(F.col("dim").alias("d")).count())
    parts = None
    if not (small := sizes.where(F.col("count") <= CLUSTER)).isEmpty():
        parts = link_lengths(pin(reps.join(small, F.col("dim") == F.col("d")).select("rep", "n", "v", "dim")), cosine, shard)
    for dim in sorted(r[0] for r in sizes.where(F.col("count") > CLUSTER).collect()):  # one length in CLUSTER points at most
        points = pin(reps.where(F.col("dim") == dim).select("rep", "n", "v"))
        counted, edges, reached = link_points(points, dim, cosine, shard)
        part = counted.select("rep", "links", F.lit(reached).cast("double").alias("recall")), edges
        parts = part if parts is None else tuple(a.unionByName(b) for a, b in zip(parts, part))
    names = ["vec_id", "n_links", "component_id", "kept", "recall"]
    alone = (F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
             F.lit(None).cast("double").alias("recall"))
    if parts is None:
        return rows.select("vec_id", *alone)
    counted, edges = parts
    classes = connected_components(edges)
    placed = pin(reps.join(counted, "rep").join(classes, F.col("rep") == F.col("node"), "left").withColumn("class", F.coalesce("component", "rep")))
    smallest = placed.groupBy("class").agg(F.min("least").alias("component_id"))
    known = placed.join(smallest, "class").select(
        F.col("dim").alias("d"), F.col("v").alias("w"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id", "recall")
    linked = sound.join(known, (F.col("dim") == F.col("d")) & (F.col("v") == F.col("w"))).withColumn(
        "kept", F.col("vec_id") == F.col("component_id")).select(*names)
    return linked.unionByName(rows.where(~is_usable()).select("vec_id", *alone))
