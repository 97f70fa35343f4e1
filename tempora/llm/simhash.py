"""SimHash near-duplicates: fingerprints and a binary-trie self-join.

Steps, each a Spark stage:

1. one pass over whole texts gives a 64-bit fingerprint per document;
2. equal fingerprints collapse to one row (copies never become pairs);
3. the distinct fingerprints are joined with themselves by walking binary
   tries: node pairs descend together, differing bits add up, and a pair is
   dropped once it exceeds the budget. The top of the walk is the shuffle
   key (a pair of prefixes), the rest runs inside the tasks. Where a pair of
   prefixes holds many words Spark goes on walking it, a few bits a round,
   until every pair is small;
4. each task returns a spanning forest of its links, not all pairs, and the
   forests are joined by distributed connected components.

To prune early the walk is made once per rotation of the word: with the 64
bits cut in ``budget`` blocks, two words within the budget have a block with
at most one differing bit, so the trie that starts with that block is walked
with one error allowed in it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import group_arrow, map_arrow, merge_labels, pin
from tempora.llm.components import connected_components

SEED = 42
TRIE_ROWS = 16384  # distinct fingerprints below one top node, on average
HOT = 4 * TRIE_ROWS  # distinct fingerprints of a pair of top nodes that is not split further
STEP = 4  # bits by which a larger pair is split at a time
CHUNK = 1 << 18  # node pairs walked, and word pairs compared, at a time


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of a text's word shingles (A-Z lower-cased, repeats counted), as an unsigned integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        part = np.unpackbits(hashes[i:i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += part.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def text_hash():
    return F.xxhash64(F.col("text").cast("string"))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed 64-bit integer, one row per input row."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash"))
    return map_arrow(narrow, run, "doc_id long, text_hash long, fp long")


def _split(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the children of the nodes [lo, hi) at this depth part."""
    bit = np.uint64(1 << (63 - depth))
    keep = np.uint64(((1 << depth) - 1) << (64 - depth))
    return np.clip(np.searchsorted(words, (words[lo] & keep) | bit), lo, hi)


def _expand(alo, ahi, blo, bhi):
    """All index pairs below the given node pairs."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    which = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return alo[which] + k // nb[which], blo[which] + k % nb[which]


def walk(a: np.ndarray, b: np.ndarray, depth: int, apart: int, budget: int, block: int, leaf: int = 64):
    """Yield index pairs (i, j) with a[i], b[j] within ``budget`` differing bits.

    a and b are sorted distinct words that share their first ``depth`` bits but
    for ``apart``; within the first ``block`` bits one error is allowed. If
    they are the same array only i < j is given.
    """
    same = a is b
    if not len(a) or not len(b):
        return
    one = np.array([0])
    stack = [(depth, one, np.array([len(a)]), one, np.array([len(b)]), np.array([apart]))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > CHUNK:
            half = len(alo) // 2
            stack += [(d, *(x[:half] for x in (alo, ahi, blo, bhi, err))), (d, *(x[half:] for x in (alo, ahi, blo, bhi, err)))]
            continue
        small = ((ahi - alo) * (bhi - blo) <= leaf) | (d == 64)
        if small.any():
            ends = [x[small] for x in (alo, ahi, blo, bhi)]
            for k in range(0, len(ends[0]), CHUNK // leaf):
                i, j = _expand(*(x[k:k + CHUNK // leaf] for x in ends))
                if same:
                    i, j = i[i < j], j[i < j]
                near = np.bitwise_count(a[i] ^ b[j]) <= budget
                if near.any():
                    yield i[near], j[near]
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        am, bm = _split(a, alo, ahi, d), _split(b, blo, bhi, d)
        own = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        kids = [(alo, am, blo, bm, err), (am, ahi, bm, bhi, err), (alo, am, bm, bhi, err + 1)]
        kids.append(tuple(x[~own] for x in (am, ahi, blo, bm, err + 1)))
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*kids))
        live = (ahi > alo) & (bhi > blo) & (err <= (1 if d < block else budget))
        if live.any():
            stack.append((d + 1, *(x[live] for x in (alo, ahi, blo, bhi, err))))


def _prefix(depth: int) -> F.Column:
    return F.expr(f"shiftrightunsigned(w, {64 - depth})") if depth else F.lit(0).cast("long")


def _flips(depth: int) -> F.Column:
    """0 and every single bit of a prefix."""
    return F.explode(F.expr("array(0L)" if not depth else
                            f"concat(array(0L), transform(sequence(0, {depth - 1}), i -> shiftleft(1L, i)))"))


def _hot_pairs(rolled: DataFrame, depth: int) -> DataFrame:
    """(r, a, b): the node pairs at ``depth`` with at most one differing bit and more than HOT words."""
    cells = pin(rolled.groupBy("r", _prefix(depth).alias("a")).agg(F.count("*").alias("n")))
    sides = cells.withColumn("q", _flips(depth)).withColumn("b", F.col("a").bitwiseXOR(F.col("q")))
    other = cells.select("r", F.col("a").alias("b"), F.col("n").alias("nb"))
    both = sides.where("a <= b").join(other, ["r", "b"])
    return pin(both.where(F.when(F.col("q") == 0, F.col("n")).otherwise(F.col("n") + F.col("nb")) > HOT).select("r", "a", "b"))


def _split_pairs(rolled: DataFrame, pairs: DataFrame, depth: int, step: int, errors: int) -> DataFrame:
    """(r, a, b, n): the pairs of nodes ``step`` bits below the given pairs that differ in at most ``errors`` bits, n words each."""
    cells = pairs.select("r", F.col("a").alias("p")).union(pairs.select("r", F.col("b").alias("p"))).distinct()
    kids = rolled.withColumn("p", _prefix(depth)).join(cells, ["r", "p"], "left_semi").groupBy(
        "r", "p", _prefix(depth + step).alias("k")).agg(F.count("*").alias("n"))
    kids = pin(kids)
    left = kids.select("r", F.col("p").alias("a"), F.col("k").alias("ka"), F.col("n").alias("na"))
    right = kids.select("r", F.col("p").alias("b"), F.col("k").alias("kb"), F.col("n").alias("nb"))
    below = pairs.select("r", "a", "b").join(left, ["r", "a"]).join(right, ["r", "b"]).where(
        (F.col("a") != F.col("b")) | (F.col("ka") <= F.col("kb"))).where(F.bit_count(F.col("ka").bitwiseXOR(F.col("kb"))) <= errors)
    return pin(below.select("r", F.col("ka").alias("a"), F.col("kb").alias("b"),
                            F.when(F.col("ka") == F.col("kb"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n")))


def _members(rolled: DataFrame, pairs: DataFrame, depth: int) -> DataFrame:
    """The words of both nodes of every pair."""
    ends = pairs.select("r", "a", "b", F.col("a").alias("p")).union(pairs.where("a <> b").select("r", "a", "b", F.col("b").alias("p")))
    return rolled.withColumn("p", _prefix(depth)).join(ends, ["r", "p"]).select(
        "r", F.lit(depth).alias("depth"), F.col("a").alias("lo"), F.col("a").bitwiseXOR(F.col("b")).alias("flip"), "p", "w")


def trie_shards(words: DataFrame, budget: int) -> DataFrame:
    """(r, depth, lo, flip, p, w): the words of every node pair that a task walks.

    ``r`` is the rotation of the words ``w``, ``lo`` and ``lo ^ flip`` are the
    pair's prefixes of ``depth`` bits, ``p`` is the word's own. No pair has more
    than HOT words: larger ones are replaced by the pairs below them that can
    still hold links, a few bits a round, so a hot prefix is many shards.
    """
    blocks, block = budget, 64 // budget
    n = max(1, words.count())
    depth = max(0, min(block, math.ceil(math.log2(n / TRIE_ROWS))))
    rolled = words.select("fp", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("r"))
    rolled = rolled.withColumn("s", F.col("r") * block).select("r", F.expr(
        "CASE WHEN s = 0 THEN fp ELSE shiftleft(fp, s) | shiftrightunsigned(fp, 64 - s) END").alias("w"))
    sides = rolled.withColumn("p", _prefix(depth)).withColumn("q", _flips(depth)).select(
        "r", F.lit(depth).alias("depth"), F.least("p", F.col("p").bitwiseXOR(F.col("q"))).alias("lo"), F.col("q").alias("flip"), "p", "w")
    hot = _hot_pairs(rolled, depth)
    if hot.isEmpty():
        return sides
    shards = sides.join(hot.select("r", F.col("a").alias("lo"), F.col("a").bitwiseXOR(F.col("b")).alias("flip")),
                        ["r", "lo", "flip"], "left_anti").select("r", "depth", "lo", "flip", "p", "w")
    while not hot.isEmpty():
        step = min(STEP, (block if depth < block else 64) - depth)
        below = _split_pairs(rolled, hot, depth, step, 1 if depth + step <= block else budget)
        depth += step
        done = F.lit(depth == 64) | (F.col("n") <= HOT)
        shards = shards.union(_members(rolled, below.where(done), depth))
        hot = below.where(~done)
    return shards


def trie_links(words: DataFrame, budget: int) -> DataFrame:
    """(u, v): a spanning forest of the links between the distinct 64-bit words of column ``fp``.

    Two words are linked at ``budget`` or fewer differing bits. Every linked
    pair is connected by the edges returned; edges only join linked words.
    """
    if budget <= 0 or budget >= 16:
        raise ValueError("the bit budget must be from 1 to 15")
    block = 64 // budget

    def pairs(key, rows):
        r, depth, lo, flip = (x.as_py() for x in key)
        w = rows.column("w").to_numpy().view(np.uint64)
        if flip:
            low = rows.column("p").to_numpy() == lo
            if low.all() or not low.any():
                return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
            a, b = np.sort(w[low]), np.sort(w[~low])
            both = np.concatenate((a, b))
        else:
            a = b = both = np.sort(w)
        label, shift = np.arange(len(both)), len(a) if flip else 0
        for i, j in walk(a, b, depth, (flip & (2**64 - 1)).bit_count(), budget, block):
            label = merge_labels(label, i, j + shift)
        far = np.flatnonzero(label != np.arange(len(both)))
        s = r * block
        back = both if s == 0 else (both >> np.uint64(s)) | (both << np.uint64(64 - s))
        back = back.view(np.int64)
        return pa.table({"u": pa.array(back[far]), "v": pa.array(back[label[far]])})

    return group_arrow(trie_shards(words, budget), ["r", "depth", "lo", "flip"], pairs, "u long, v long").distinct()


def simhash_near_dedup(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """Near-duplicate classes of documents by SimHash.

    In: ``doc_id`` and ``text`` (other columns are ignored). Out: one row per
    input row with ``doc_id``, ``fp`` (signed 64-bit fingerprint),
    ``fingerprint`` (16 hex digits) and ``component_id`` (smallest doc_id
    reachable over links of ``budget`` or fewer differing bits).

    Texts with fewer words than a shingle hash as a whole; null and empty ones
    have fingerprint 0 and link like any other. A null doc_id takes part but
    never names a class (a class of null ids only has a null component_id).
    Repeated rows stay repeated. An empty table gives an empty result.
    """
    prints = pin(fingerprints(docs, shingle))
    words = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    parts = connected_components(trie_links(words.select("fp"), budget))
    marked = words.join(parts, words.fp == parts.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("label"))
    least = marked.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = marked.join(least, "label").select(F.col("fp").alias("word"), "label", "component_id")
    return prints.join(named, prints.fp == named.word).select(
        "doc_id", "text_hash", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "label")


def keep_one_of_each(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """docs, all columns, one row of each near-duplicate class: the smallest doc_id's (a null one only if there is no other).

    Rows are told apart by id and text; rows that repeat both count as copies,
    of which the first by the other columns stays.
    """
    found = simhash_near_dedup(docs.select("doc_id", "text"), shingle, budget)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    stay = found.groupBy("label").agg(first.alias("first"))

    def key(doc_id, text):
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text.cast("string"))

    stay = stay.select(key(F.col("first.doc_id"), F.col("first.text_hash")).alias("__stay"))
    rows = docs.withColumn("__key", key(F.col("doc_id").cast("long"), text_hash())).join(stay, F.col("__key") == F.col("__stay"), "left_semi")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("__key").orderBy(*(rest or [F.lit(0)]))
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__key", "__n")
