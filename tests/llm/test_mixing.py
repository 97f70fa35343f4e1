from __future__ import annotations

import re

import pytest
from helpers import prose

import random

from tempora.llm import mixing


def fill(sizes, share=1.5, most=2.0):
    """Targets by the definition: share by weight, stop at the ceiling, reshare the excess."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left, w = total - sum(out.values()), sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] / w >= most * sizes[n]]
        if not over:
            out.update({n: left * weight[n] / w for n in open_})
            break
        out.update({n: most * sizes[n] for n in over})
        open_ -= set(over)
    return out


def table(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 60)), "en", rng.choice(["a", "b", "c", "é", "Z", None, "big", "big", "big"]), 0) for i in range(600)]
    rows += [(900, None, "en", "a", 0), (901, "", "en", "nought", 0), (None, "x y\u00a0z\t w", None, "a", None), (5, rows[5][1], "en", rows[5][3], 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows


@pytest.mark.parametrize("ranges", [2000, 7])
def test_targets_and_taken(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    df, rows = table(spark)
    weights = spark.createDataFrame([(i, 4.0 if i % 2 else 0.25) for i in range(300)], "id long, weight double")
    got = mixing.mix_sources(df.withColumn("size", df.doc_id), weights).collect()
    again = mixing.mix_sources(df.repartition(5), weights).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
    want = fill(sizes)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(want[source]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) <= max(r.size for r in mine)
        assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in mine)


def test_heavier_documents_are_preferred(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a" if i < 1000 else "b") for i in range(4000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([(i, 8.0) for i in range(1000, 4000, 2)], "id long, weight double")
    got = [r for r in mixing.mix_sources(df, weights).collect() if r.source == "b"]
    heavy, light = (sum(r.copies for r in got if r.doc_id % 2 == k) for k in (0, 1))
    assert heavy > light


def test_mixed_documents_repeat_rows(spark):
    df, rows = table(spark)
    out = mixing.mixed_documents(df.withColumn("copies", df.doc_id))
    assert out.columns == [*df.columns, "copies"]
    assert out.count() == sum(r.copies for r in mixing.mix_sources(df).collect())
    assert mixing.mix_sources(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("share", [1.0, 0.45])
def test_rows_without_an_id_are_decided_one_by_one(spark, share):
    rows = [(None, "w " * 100, "a", i) for i in range(70)] + [(None, None, "a", 70), (None, "", "a", 71)]
    rows += [(i, "w " * 100, "b", i) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _key long")
    got = mixing.mix_sources(df.repartition(7), share=share).collect()
    assert len(got) == len(rows)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 100
    again = mixing.mix_sources(df.coalesce(1), share=share).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key)
    mixed = mixing.mixed_documents(df, share=share)
    assert mixed.columns == df.columns and {r._key for r in mixed.collect()} <= set(range(72))
    assert mixed.count() == sum(r.copies for r in got)


def test_sql_counts_rows_without_an_id(spark):
    import duckdb
    from oracle_check import compare

    from tempora.llm.oracle import ORACLE

    rng = random.Random(4)
    texts = [None, "", "a b c", "d e", *(prose(rng, n) for n in (30, 60))]
    rows = [(i if i % 3 else None, rng.choice(texts), rng.choice(["a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    con.execute("CREATE TABLE labels AS SELECT i AS doc_id, i % 2 AS quality FROM range(100) t(i)")
    got = mixing.mix_sources(df, mixing.quality_weights(labels)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
    ok, why = compare(got.toPandas(), con.execute(ORACLE["op4_mix_sources"]).fetchdf())
    assert ok, why


def test_key_ranges_are_even_for_any_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    df = spark.createDataFrame([(i, "w", "a") for i in range(4000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([(i, (0.001, 0.003, 700.0)[i % 3]) for i in range(4000)], "id long, weight double")
    rows, _ = mixing.plan(df, weights)
    from pyspark.sql import functions as F

    by = F.array(*[F.struct(F.lit(2.0**g).alias("w"), F.lit(n).alias("n")) for g, n in ((-10, 1334), (-9, 1333), (9, 1333))])
    most = rows.groupBy(F.floor(mixing._place(F.col("_key"), by, F.lit(4000)) * 80)).count().agg(F.max("count")).first()[0]
    assert most < 150
