from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tempora.llm import langid
from tempora.llm.langid import Bounds, identify, is_held_out, keep_identified, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_label_source_and_id_do_not_enter_a_prediction(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs.where(is_held_out())
    changed = docs.where(~is_held_out()).unionByName(held.selectExpr("doc_id", "text", "'xx' AS lang", "'other' AS source", "0L AS n_chars"))
    assert sorted(map(tuple, identify(docs).collect())) == sorted(map(tuple, identify(changed).collect()))


def test_backoff_and_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 34 !!", "de"), (1003, "THE DOG", None), (1004, "hundkatze", None), (1005, "漢字", None), (None, "the", "en")]
    df = spark.createDataFrame([*rows, *odd, odd[3]], "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "0 AS held_out")
    got = identify(df).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0)
    assert by[1003][0] == "en" and by[1004][0] == "de" and by[None][0] == "en"
    assert by[1005] == ("de", pytest.approx(0.5))  # nothing known: a tie, first by code point
    kept = keep_identified(df, least=0.6)
    assert kept.columns == df.columns and {1000, 1001, 1002, 1005}.isdisjoint(r.doc_id for r in kept.collect())


def test_sample_is_bounded_and_empty_tables_work(spark):
    df = spark.createDataFrame([(i, f"w{chr(97 + i % 26)} x", "en") for i in range(200)], "doc_id long, text string, lang string")
    model = train(df, Bounds(docs=10))
    assert model.langs == ["en"]
    none = train(df.limit(0))
    assert none.predict(["text", None]) == [("und", 0.0)] * 2
    assert identify(df.limit(0)).count() == 0 and keep_identified(df.limit(0)).count() == 0


def brute_force(training, texts, longest=5):
    """The method with plain dicts: one table of counts per language for words and per n-gram length."""
    langs = sorted({lang for _, lang in training})
    tables = [{x: Counter() for x in langs} for _ in range(longest + 1)]
    for text, lang in training:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            tables[0][lang][word] += 1
            for n in range(1, longest + 1):
                marked = "^" + word + "$"
                tables[n][lang].update(g for g in (marked[i:i + n] for i in range(len(marked) - n + 1)) if g not in "^$")

    def log(table, key, lang):
        return math.log((table[lang][key] + 0.5) / (sum(table[lang].values()) + 0.5 * len(set().union(*table.values()))))

    def score(word, lang):
        for n in (0, *range(longest, 0, -1)):
            marked = "^" + word + "$"
            keys = [word] if n == 0 else [marked[i:i + n] for i in range(len(marked) - n + 1)]
            hits = [k for k in keys if any(k in t for t in tables[n].values())]
            if hits:
                return sum(log(tables[n], k, lang) for k in hits) / len(hits)
        return 0.0

    out = []
    for text in texts:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            out.append(("und", 0.0))
            continue
        mean = {x: sum(score(w, x) for w in words) / len(words) * min(len(words), 20) for x in langs}
        best = max(mean.values())
        out.append((mean, 1 / sum(math.exp(m - best) for m in mean.values())))
    return out


def invented(languages, documents, seed):
    """Documents of invented languages, each with letters and endings of its own taste."""
    rng = random.Random(seed)
    taste = {f"l{i:03d}": ([rng.choice("bdfgklmnprstvz") + rng.choice("aeiouy") for _ in range(12)], rng.choice("abcdefghij") + rng.choice("nrst"))
             for i in range(languages)}
    rows = []
    for i in range(documents):
        lang = rng.choice(list(taste))
        syllables, end = taste[lang]
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) + (end if rng.random() < 0.5 else "") for _ in range(rng.randint(1, 30))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_equals_plain_dicts(spark, monkeypatch):
    rows = invented(4, 120, 1)
    asked = [*(t for _, t, _ in invented(4, 60, 2)), None, "", "7", "qqq xqx", rows[0][1].upper(), "a", "漢 字", rows[1][1] * 3]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.repartition(3))
    want = brute_force([(t, x) for _, t, x in rows], asked)
    for cache, ahead in ((200_000, 1_000_000), (8, 40)):  # with a small memory the words come and go
        monkeypatch.setattr(langid, "CACHE", cache)
        monkeypatch.setattr(langid, "AHEAD", ahead)
        model._forget()
        for (lang, score), (mean, posterior) in zip(model.predict(asked), want):
            assert score == pytest.approx(posterior)
            assert lang == mean == "und" or mean[lang] == pytest.approx(max(mean.values()))


def test_many_labels(spark):
    rows = invented(150, 6000, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.where(~is_held_out()))
    assert len(model.langs) == len({x for _, _, x in rows}) == 150
    got = identify(df).where("held_out").collect()
    label = {i: x for i, _, x in rows}
    long = {i for i, t, _ in rows if len(t.split()) >= 10}
    right = [label[r.doc_id] == r.lang_pred for r in got if r.doc_id in long]
    assert len(right) > 500 and sum(right) / len(right) > 0.95 and len({r.lang_pred for r in got}) == 150
    assert train(df, Bounds(total=300)).langs == model.langs  # an even share of the sample, no label goes
