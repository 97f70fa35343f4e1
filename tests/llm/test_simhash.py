from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from helpers import docs, prose

from tempora.llm.components import connected_components
from tempora.llm.simhash import fingerprint, keep_one_of_each, simhash_near_dedup, trie_links, walk


def brute_print(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "One", "one", "a b c", "É b É d e", "x\u00a0y z"]
    for _ in range(12):
        base = prose(rng, rng.randint(30, 400)).split()
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "zz"
            out.append("  ".join(copy).upper() if rng.random() < 0.5 else "\n".join(copy))
    return out


def test_fingerprint_matches_definition():
    for t in near_texts():
        assert fingerprint(None if t is None else t.encode(), 4) == brute_print(t)


def test_classes_match_brute_force(spark):
    texts = near_texts()
    df = docs(spark, texts)
    df = df.union(df.limit(3))  # repeated rows
    got = simhash_near_dedup(df.withColumn("fp", df.doc_id).withColumn("label", df.text)).collect()
    prints = [brute_print(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = classes(near, range(len(texts)))
    assert len(got) == len(texts) + 3
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


def test_trie_finds_every_pair_within_budget():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, int(rng.integers(0, 7)), replace=False))) for b in base for _ in range(8)]
    words = np.unique(np.array([*base, *flips], np.uint64))
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if int(words[i] ^ words[j]).bit_count() <= 4}
    got = set()
    for s in range(0, 64, 16):
        turned = (words << np.uint64(s)) | (words >> np.uint64(64 - s)) if s else words
        by = np.argsort(turned)
        for i, j in _walk_same(turned[by]):
            got |= {tuple(sorted((int(by[a]), int(by[b])))) for a, b in zip(i, j)}
    assert got == want


def _walk_same(words):
    return walk(words, words, 0, 0, 4, 16, leaf=4)


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    import tempora.llm.simhash as s

    monkeypatch.setattr(s, "TRIE_ROWS", 40)  # several top nodes, so pairs meet over prefixes
    rng = np.random.default_rng(9)
    base = rng.integers(-(2**62), 2**62, 60)
    words = np.unique([int(b) ^ (1 << int(rng.integers(0, 62))) ^ (1 << int(rng.integers(0, 62))) for b in base for _ in range(6)]).tolist()
    near = [(a, b) for a in words for b in words if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    df = spark.createDataFrame([(w,) for w in words], "fp long")
    got = [(min(r.u, r.v), max(r.u, r.v)) for r in trie_links(df, 4).collect()]
    assert classes(got, words) == classes(near, words)


@pytest.mark.parametrize("step", [4, 7])
def test_a_hot_prefix_is_many_shards(spark, monkeypatch, step):
    import tempora.llm.simhash as s

    monkeypatch.setattr(s, "TRIE_ROWS", 64)
    monkeypatch.setattr(s, "HOT", 96)
    monkeypatch.setattr(s, "STEP", step)
    rng = np.random.default_rng(12)
    # a third of all words near one, so that they share a prefix in most rotations; then ends of the range and lone words
    centre = -(2**63) + 12345
    hot = [centre ^ sum(1 << int(x) for x in rng.choice(63, int(rng.integers(1, 4)), replace=False)) for _ in range(900)]
    lone = rng.integers(-(2**63), 2**63 - 1, 1500).tolist()
    words = sorted({*hot, *lone, *(w ^ 0x8001 for w in lone[:300]), 0, -1, -(2**63), 2**63 - 1, 7, -8, centre})
    near = [(a, b) for i, a in enumerate(words) for b in words[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    df = spark.createDataFrame([(w,) for w in words], "fp long")
    sizes = s.trie_shards(df, 4).groupBy("r", "depth", "lo", "flip").count().collect()
    assert max(r["count"] for r in sizes) <= 96 and len({r.depth for r in sizes}) > 2
    got = [(min(r.u, r.v), max(r.u, r.v)) for r in trie_links(df, 4).collect()]
    assert classes(got, words) == classes(near, words)


def test_components_of_long_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 1), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_of_each(spark):
    texts = near_texts()
    df = docs(spark, texts)
    df = df.union(df.limit(4)).union(df.limit(2).selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    prints = [brute_print(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes(near, range(len(texts))).values()))
    assert simhash_near_dedup(df.limit(0)).count() == 0 and keep_one_of_each(df.limit(0)).count() == 0
