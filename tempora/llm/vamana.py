"""Robust-pruned proximity graphs in numpy, for use inside tasks.

Points are inserted in random order in growing batches: a greedy beam search
from the medoid proposes neighbours, robust pruning keeps those that are
``alpha`` times nearer to the point than to a kept neighbour, and reverse
edges are added and pruned again where a list overflows. All steps work on a
batch of points at once.
"""

from __future__ import annotations

import numpy as np

BATCH = 256


def medoid(x: np.ndarray) -> int:
    """The point nearest to the mean."""
    return int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())


def _distances(x: np.ndarray, q: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    gap = x[nodes] - q[rows]
    return np.einsum("ij,ij->i", gap, gap)


def beam_search(x: np.ndarray, edges: np.ndarray, q: np.ndarray, entry: int, beam: int, width: int = 4, within: float | None = None):
    """Greedy search of each row of q: (nodes, squared distances) of the ``beam`` nearest met, nearest first, and who was met.

    ``edges`` has -1 in place of missing neighbours; in the result missing
    nodes are len(x) at infinite distance. ``width`` nodes are expanded per
    step. With ``within`` also (rows, nodes, squared distances) of all that
    was met at that squared distance or less, in the beam or not.
    """
    n, k = len(x), len(q)
    met = np.zeros((k, n + 1), bool)
    met[:, n] = met[:, entry] = True
    nodes = np.full((k, beam), n, np.int64)
    dist = np.full((k, beam), np.inf, x.dtype)
    done = np.ones((k, beam), bool)
    every = np.arange(k)
    nodes[:, 0], done[:, 0] = entry, False
    dist[:, 0] = _distances(x, q, every, nodes[:, 0])
    live = every
    ranged = []
    if within is not None:
        near = np.flatnonzero(dist[:, 0] <= within)
        ranged.append((near, nodes[near, 0], dist[near, 0]))
    while len(live):
        open_ = ~done[live]
        turn = open_ & (np.cumsum(open_, axis=1) <= width)
        some = turn.any(axis=1)
        live, turn = live[some], turn[some]
        if not len(live):
            break
        row, col = np.nonzero(turn)
        owner = live[row]
        done[owner, col] = True
        near = edges[nodes[owner, col]]
        at, near = np.repeat(owner, near.shape[1]), near.ravel()
        ok = near >= 0
        at, near = at[ok], near[ok]
        ok = ~met[at, near]
        flat = np.unique(at[ok] * (n + 1) + near[ok])
        at, near = flat // (n + 1), flat % (n + 1)
        met[at, near] = True
        d = _distances(x, q, at, near)
        if within is not None:
            ok = d <= within
            ranged.append((at[ok], near[ok], d[ok]))
        better = d < dist[at, -1]
        at, near, d = at[better], near[better], d[better]
        if not len(at):
            continue
        rows, first, size = np.unique(at, return_index=True, return_counts=True)
        place = np.arange(len(at)) - np.repeat(first, size)
        more = int(size.max())
        new_nodes = np.full((len(rows), more), n, np.int64)
        new_dist = np.full((len(rows), more), np.inf, x.dtype)
        line = np.repeat(np.arange(len(rows)), size)
        new_nodes[line, place], new_dist[line, place] = near, d
        all_dist = np.concatenate((dist[rows], new_dist), axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        dist[rows] = np.take_along_axis(all_dist, order, 1)
        nodes[rows] = np.take_along_axis(np.concatenate((nodes[rows], new_nodes), axis=1), order, 1)
        done[rows] = np.take_along_axis(np.concatenate((done[rows], new_nodes == n), axis=1), order, 1)
    if within is not None:
        return nodes, dist, met, tuple(np.concatenate(c) for c in zip(*ranged))
    return nodes, dist, met


def robust_prune(x: np.ndarray, near: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours per row: candidates by distance (missing: len(x)); the nearest is kept, and those it covers go, again and again."""
    k, c = near.shape
    pts = np.concatenate((x, np.zeros((1, x.shape[1]), x.dtype)))[near]
    norm = np.einsum("ijk,ijk->ij", pts, pts)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(pts, pts.transpose(0, 2, 1))
    alive = near < len(x)
    out = np.full((k, degree), -1, np.int64)
    every = np.arange(k)
    for r in range(degree):
        pick = alive.argmax(axis=1)
        has = alive[every, pick]
        if not has.any():
            break
        out[has, r] = near[has, pick[has]]
        alive &= ~((alpha * alpha * between[every, pick] <= dist) & has[:, None])
        alive[every, pick] = False
    return out


def build(x: np.ndarray, degree: int, beam: int, alpha: float = 1.2, seed: int = 7) -> tuple[np.ndarray, int]:
    """(edges n x degree, -1 where missing; entry point) of the graph of distinct points x."""
    n = len(x)
    edges = np.full((n, degree), -1, np.int64)
    if n == 0:
        return edges, 0
    entry = medoid(x)
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != entry]
    at = 0
    while at < len(order):
        batch = order[at:at + min(BATCH, max(1, (at + 1) // 2))]
        at += len(batch)
        near, dist, _ = beam_search(x, edges, x[batch], entry, beam)
        edges[batch] = robust_prune(x, near, dist, degree, alpha)
        _add_reverse(x, edges, batch, degree, alpha)
    return edges, entry


def _add_reverse(x: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    """Point the neighbours of the batch back at it."""
    ends = edges[batch]
    to, of = ends[ends >= 0], np.repeat(batch, (ends >= 0).sum(axis=1))
    by = np.lexsort((of, to))
    to, of = to[by], of[by]
    nodes, first, size = np.unique(to, return_index=True, return_counts=True)
    have = (edges[nodes] >= 0).sum(axis=1)
    fits = have + size <= degree
    line = np.repeat(np.arange(len(nodes)), size)
    place = np.arange(len(to)) - np.repeat(first, size)
    ok = fits[line]
    edges[to[ok], (have[line] + place)[ok]] = of[ok]
    full = np.flatnonzero(~fits)
    for i in range(0, len(full), BATCH):
        some = full[i:i + BATCH]
        most = int(size[some].max())
        cand = np.full((len(some), degree + most), len(x), np.int64)
        old = edges[nodes[some]]
        cand[:, :degree] = np.where(old >= 0, old, len(x))
        for r, s in enumerate(some):
            cand[r, degree:degree + size[s]] = of[first[s]:first[s] + size[s]]
        pts = np.concatenate((x, np.full((1, x.shape[1]), np.inf, x.dtype)))[cand]
        gap = pts - x[nodes[some]][:, None, :]
        dist = np.einsum("ijk,ijk->ij", gap, gap)
        by = np.argsort(dist, axis=1, kind="stable")
        edges[nodes[some]] = robust_prune(x, np.take_along_axis(cand, by, 1), np.take_along_axis(dist, by, 1), degree, alpha)


def both_ways(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, ends): for each node the ends of its edges and of those that lead to it, from ends[first[v]] to ends[first[v + 1]]."""
    n = len(edges)
    row, col = np.nonzero(edges >= 0)
    to = edges[row, col]
    flat = np.unique(np.concatenate((row * n + to, to * n + row)))
    return np.searchsorted(flat, np.arange(n + 1) * n), flat % max(n, 1)


def range_search(x: np.ndarray, edges: np.ndarray, links: tuple[np.ndarray, np.ndarray], q: np.ndarray, entry: int, radius2: float,
                 beam: int, slack: float = 1.3):
    """(rows, nodes) within squared distance ``radius2`` of each row of q: a greedy search from the entry over ``edges``, then
    everything met within the radius (times ``slack``) is expanded over ``links`` (edges both ways) until nothing new turns up."""
    n = len(x)
    first, ends = links
    _, _, met, (at, here, d) = beam_search(x, edges, q, entry, beam, within=radius2 * slack)
    out = []
    while len(at):
        out.append((at[d <= radius2], here[d <= radius2]))
        size = first[here + 1] - first[here]
        at = np.repeat(at, size)
        near = ends[np.arange(len(at)) - np.repeat(np.cumsum(size) - size - first[here], size)]
        ok = ~met[at, near]
        flat = np.unique(at[ok] * (n + 1) + near[ok])
        at, here = flat // (n + 1), flat % (n + 1)
        met[at, here] = True
        d = _distances(x, q, at, here)
        ok = d <= radius2 * slack
        at, here, d = at[ok], here[ok], d[ok]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
