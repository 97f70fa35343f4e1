from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from oracle_check import compare

from tempora.llm import prefix_trie as pt
from tempora.llm.oracle import ORACLE
from tempora.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def rebuilt(rows):
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            told.setdefault(c, []).append((turn is not None, turn or 0, role or "", sha(f"{len(role or '')}:{role or ''}{text or ''}"), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in told.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return out


def plain(rows):
    """Every node by walking all prefixes of all conversations."""
    seqs = rebuilt(rows)
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for node, ids in members.items():
        below = [m for m in members if m[:len(node)] == node]
        children = sum(len(m) == len(node) + 1 for m in below)
        leaves = sum(not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in below) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(str(c) for c in sorted(ids) if len(seqs[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children, leaves, saved, sha(ends)))
    return sorted(out, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def conversations(seed, convs, words=2):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        rows += [(c, t, rng.choice(["user", "bot"][: 1 + t % 2]), "ab" * rng.randint(1, words)) for t in range(rng.randint(1, 7))]
    return rows


ODD = [
    (None, 1, "user", "nobody"), (-105, 0, "u", "x"), (-105, 1, None, None), (-100, 0, "u", "x"), (-100, None, "u", "first"), (-5, 3, "", ""),
    (7, None, None, None), (7, None, None, None), (7, 2, "u", "é\u0000\U0001f600"), (7, 2, "u", "é"), (7, 2, "a", "z"), (9_000_000_000_000_000_123, 1, "u", "x"),
    (1201, 0, "u", "only turn"), (1301, 0, "u", "only turn"), (31, 5_000_000_000, "a", "b" * 5000), (31, -4, "a", "b"), (30, 0, "ab", "c"), (33, 0, "a", "bc"),
]


@pytest.mark.parametrize("rows", [conversations(2, 250, 1), ODD + conversations(3, 40)])
def test_equals_all_prefixes(spark, rows):
    df = table(spark, rows).selectExpr("*", "1 AS depth", "'x' AS a", "2 AS rep", "3 AS token")
    assert result(pt.prefix_trie(df)) == plain(rows)


def test_one_conversation_beyond_a_block(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 16)
    long = [(200, t * 300, "u", str(t % 9)) for t in range(900)] + [(300, t * 300, "u", str(t % 9)) for t in range(700)]
    assert result(pt.prefix_trie(table(spark, long + conversations(5, 20)))) == plain(long + conversations(5, 20))


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(700) for t in range(3)] + conversations(6, 30)
    assert result(pt.prefix_trie(table(spark, rows))) == plain(rows)


def test_empty_table(spark):
    assert result(pt.prefix_trie(table(spark, [(None, 1, "u", "x")]))) == []


@pytest.mark.parametrize("rows", [conversations(7, 150), ODD])
def test_sql_says_the_same(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.execute(ORACLE["op13_prefix_trie"]).fetchall()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_prefix_trie(spark, sf)
    assert result(got) == plain(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    ok, why = compare(got.toPandas(), con.execute(ORACLE["op13_prefix_trie"]).fetchdf())
    assert ok, why
