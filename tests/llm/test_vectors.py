from __future__ import annotations

import numpy as np
import pytest

from tempora.llm import ann, embedding_dedup
from tempora.llm.common import merge_labels
from tempora.llm.vamana import beam_search, build


def odd(dim):
    return [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0] * (dim + 1)]


def table(spark, x, extra=()):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_graph_finds_neighbours():
    x = np.random.default_rng(0).normal(size=(1500, 16)).astype(np.float32)
    edges, entry = build(x, 24, 48)
    assert ((edges >= 0).sum(axis=1) > 0).all()
    q = x[:200] + 0.05
    nodes, dist, _ = beam_search(x, edges, q, entry, 64)
    exact = np.argsort(((q[:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(exact, nodes)]) > 0.95
    assert (np.diff(dist, axis=1) >= 0).all()


def test_nearest_recall_and_contract(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 12))
    x[100:140] = x[100]  # copies
    extra = [(2000 + i, v, 0) for i, v in enumerate(odd(12))] + [(None, [1.0] * 12, 0), (5, x[5].tolist(), 0)]
    df = table(spark, x, extra)
    got = ann.nearest(df.selectExpr("*", "1 AS shard", "2 AS v"), df.where("vec_id % 100 = 0"), 10, shard_rows=300)
    rows = got.collect()
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {*range(0, 900, 100)}  # odd vectors ask nothing; 2000 is null, 2006 no multiple
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11)) and q not in [r.vec_id for r in found]
        assert all(abs(r.score - np.sqrt(((x[q] - x[r.vec_id]) ** 2).sum())) < 1e-12 for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
    assert [r.vec_id for r in by[100]] == list(range(101, 111))
    exact = ann.brute_force(df, [(q, x[q].tolist()) for q in by], 10)
    assert ann.recall(got, exact) >= 0.9
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    few = ann.nearest(df.where("vec_id < 4"), df.where("vec_id = 0")).collect()
    assert len(few) == 3


@pytest.mark.parametrize("shard", [4096, 120])
def test_near_dedup_matches_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CLUSTER", 100)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 16))
    x[200:300] = x[200] + rng.normal(size=(100, 16)) * 0.1  # a dense group
    x[300:330] = x[300]  # copies
    x[330:350] = x[350:370] * 3 + rng.normal(size=(20, 16)) * 0.05
    extra = [(2000 + i, v, 0) for i, v in enumerate(odd(16))] + [(None, [1.0] * 16, 0), (7, x[7].tolist(), 0)]
    df = table(spark, x, extra)
    rows = embedding_dedup.embedding_near_dedup(df.selectExpr("*", "1 AS n_links", "2 AS rep"), 0.9, shard).collect()
    y = np.concatenate((x, x[7:8]))
    ids = np.append(np.arange(500), 7)
    u = y / np.linalg.norm(y, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    label = merge_labels(np.arange(501), a, b)
    want = {(int(i), int(n), int(ids[c])) for i, n, c in zip(ids, near.sum(axis=1), label)}
    assert {(r.vec_id, r.n_links, r.component_id) for r in rows if r.vec_id is not None and r.vec_id < 1000} == want
    alone = [r for r in rows if r.vec_id is None or r.vec_id >= 2000]
    assert len(rows) == len(x) + len(extra) and len(alone) == 8
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in alone)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows if r.vec_id is not None)
    assert embedding_dedup.embedding_near_dedup(df.limit(0)).count() == 0


def test_audit_sees_small_groups_and_says_when_it_saw_none(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 16))
    x[:300] = x[0] + rng.normal(size=(300, 16)) * 0.01  # one group decides the links
    x[301:400:2] = x[300:400:2] * 2 + rng.normal(size=(50, 16)) * 0.01  # pairs
    points = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "rep long, n long, v array<double>")
    lost = spark.createDataFrame([(i, 299 if i < 300 else 0) for i in range(800)], "rep long, links long")
    assert embedding_dedup.audit(points, lost, 16, 0.99) < 0.9  # per link 0.999
    none = points.where("rep >= 400")
    assert embedding_dedup.audit(none, lost, 16, 0.99) is None
    rare = points.where("rep >= 398")  # one pair: drawn until met
    assert embedding_dedup.audit(rare, lost, 16, 0.99, sample=1) == 0.0
    rows = embedding_dedup.embedding_near_dedup(table(spark, x[400:460]), 0.99).collect()
    assert len(rows) == 60 and all(r.recall is None for r in rows)


def test_every_length_and_every_odd_row_is_answered(spark):
    rng = np.random.default_rng(6)
    rows = []
    for dim in range(1, 1041):  # more lengths than a thousand, a near pair each
        v = rng.normal(size=dim)
        rows += [(2 * dim, v.tolist(), 0), (2 * dim + 1, (v * 2).tolist(), 0)]
    rows += [(2, None, 0), (3, [0.0], 0), (None, [1.0], 0)]  # ids that also occur with a sound vector
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    linked = {r.vec_id: r for r in got if r.n_links}
    assert len(linked) >= 2 * 1040 - 2 and all(r.n_links == 1 and r.component_id == i - i % 2 and r.recall == 1.0 for i, r in linked.items())
    assert sorted(r.vec_id for r in got if not r.n_links and r.vec_id is not None)[-2:] == [2, 3]


@pytest.mark.parametrize("size", [1e20, 1e200, 1e-200, 1.0])
def test_nearest_of_large_and_small_values(spark, size):
    x = np.random.default_rng(8).normal(size=(60, 8)) * size
    df = table(spark, x)
    found = ann.nearest(df, df.where("vec_id % 20 = 0"), 5, shard_rows=25).collect()
    scaled = x / size
    for q in (0, 20, 40):
        d = np.sqrt(((scaled - scaled[q]) ** 2).sum(axis=1))
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [v for _, v, _ in mine] == [v for v in np.argsort(d, kind="stable") if v != q][:5]
        assert all(abs(s / size - d[v]) < 1e-9 for _, v, s in mine)


def test_a_repeated_id_gives_the_same_answer_in_any_order(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [5.0, 5.0], 0), (1, [1.0, 0.5], 0), (2, [3.0, 0.0], 0), (0, [0.5, 9.0], 0)]
    got = [ann.nearest(d, d.where("vec_id = 0"), 2).collect() for d in (spark.createDataFrame(r, "vec_id long, embedding array<double>, label int").coalesce(1)
                                                                        for r in (rows, rows[::-1]))]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1])) == [(0, 1, 1, np.hypot(0.5, 8.5)), (0, 2, 2, np.hypot(2.5, 9.0))]


def test_one_id_with_two_vectors_has_a_row_for_each(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (7, [0.01, 1.0]), (8, [-1.0, -1.0])]
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int"))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == [
        (5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False), (8, 0, 8, True)]
