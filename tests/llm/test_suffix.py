from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import prose

from tempora.llm.suffix import common_prefixes, remove_repeats, suffix_array


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 300))
        data = rng.integers(0, int(rng.integers(1, 4)), n).astype(np.uint8)
        raw = data.tobytes()
        want = sorted(range(n), key=lambda i: raw[i:])
        sa = suffix_array(data)
        assert sa.tolist() == want
        got = common_prefixes(data, sa, np.unique(np.append(0, rng.integers(0, n, 4))), 12)
        for k in range(1, n):
            a, b = raw[want[k - 1]:], raw[want[k]:]
            assert got[k] == next((m for m in range(12) if m >= len(a) or m >= len(b) or a[m] != b[m]), 12)


@pytest.mark.parametrize("shard", [8192, 5])
def test_removal_matches_brute_force(spark, shard):
    rng = random.Random(3)
    passages = [prose(rng, 14) for _ in range(5)]
    texts = [None, "", "short", "x" * 300, "ab" * 150, "é" * 90 + "ü" * 90]
    texts += [prose(rng, rng.randint(0, 50)) + rng.choice(passages) + prose(rng, rng.randint(0, 30)) for _ in range(120)]
    texts += [texts[20], texts[21][:80], texts[22] + texts[23]]
    data = [(i if i != 9 else None, t, 1, "clash") for i, t in enumerate(texts)] + [(30, texts[30], 1, "clash")]
    df = spark.createDataFrame(data, "doc_id long, text string, h int, kept string")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, 20, shard).collect())
    want = sorted(((d[0] is None, d[0] or 0), *b) for d, b in zip(data, brute([d[1] for d in data], 20)))
    assert got == want


def test_unique_text_and_empty_table_stay(spark):
    df = spark.createDataFrame([(1, "nothing here repeats at all"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in remove_repeats(df, 20).collect()}
    assert got == {1: (0, b"nothing here repeats at all"), 2: (0, b"")}
    assert remove_repeats(df.limit(0), 20).count() == 0
