"""Exact removal of long repeated byte strings with suffix arrays.

A string of ``length`` bytes is removed wherever it starts in more than one
place. Equal strings meet in one shard through their anchor: of every window
of ``length`` bytes the gram with the smallest hash, leftmost of equals. The
choice depends on the window's bytes alone, so equal windows have equal
anchors at equal offsets. Neighbouring windows with one anchor form a
segment; segments are what is shuffled, as hashes first:

1. one pass gives (anchor, segment hash, place); anchors seen once are unique
   text and go;
2. an anchor with one kind of segment is repeated as a whole; only anchors
   with several kinds need their bytes, each kind once;
3. the kinds are dealt to shards by anchor; a shard builds its suffix array
   (Larsson-Sadakane refinement), the common prefixes (Kasai) and marks the
   windows that share ``length`` bytes with a neighbour;
4. an anchor with very many kinds is split over several shards; these send
   sorted runs of their distinct windows to merge tasks by value, which find
   windows of different shards by binary search;
5. marks go back to the documents, which drop the covered bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import group_arrow, map_arrow, pin, store

CHUNK = 1 << 16  # window starts hashed at a time
SHARD_SEGMENTS = 8192  # kinds of segments in a shard, on average; an anchor with more is split


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit words (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_size(length: int) -> int:
    """Bytes of an anchor: a power of two of at most a quarter of the length and 32."""
    return min(32, 1 << max(0, (length // 4).bit_length() - 1))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    h, step = BYTES[data], 1
    while step < size:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 ^ (step << 33) | 1) + h[step:]
        step *= 2
    return _mix(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def segments(data: np.ndarray, valid: np.ndarray, length: int):
    """Yield (starts, ends, anchor hashes) of the segments of the windows of ``data`` that ``valid`` allows."""
    size = gram_size(length)
    low = np.uint64((1 << 20) - 1)
    for first in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[first:first + CHUNK + length - 1]
        ok = valid[first:first + len(part) - length + 1]
        if not ok.any():
            continue
        h = _gram_hashes(part, size)
        place = np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min((h & ~low) | place, length - size + 1) & low).astype(np.int64)
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (at[1:] != at[:-1])
        edge = new.copy()
        edge[1:] |= ok[:-1] & ~ok[1:]
        edges = np.append(np.flatnonzero(edge), len(ok))
        is_start = np.flatnonzero(new[edges[:-1]])
        s, e = edges[is_start], edges[is_start + 1]
        yield first + s, first + e - 1 + length, h[at[s]]


def _valid_windows(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the documents, which positions start a window inside one document)."""
    starts = np.concatenate(([0], np.cumsum(sizes)))
    change = np.zeros(starts[-1] + 1, np.int32)  # +1 where a document's windows begin, -1 behind the last
    long = sizes >= length
    np.add.at(change, starts[:-1][long], 1)
    np.add.at(change, (starts[1:] - length + 1)[long], -1)
    return starts, np.cumsum(change[:-1], dtype=np.int32) > 0


def _parts(batches, most: int = 1 << 22):
    """Batches cut into parts of at most 4 MB of text (column 1) or one row, so that work arrays stay small."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for k, size in enumerate(sizes.tolist()):
            if total + size > most and k > start:
                yield b.slice(start, k - start)
                start, total = k, 0
            total += size
        if b.num_rows > start:
            yield b.slice(start)


def _binary(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def document_segments(docs: DataFrame, length: int) -> DataFrame:
    """(h, sk, doc_id, th, place): anchor hash, segment hash, document, start << 16 | bytes, for all windows of all texts."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in _parts(batches):
            texts = _binary(b.column(1))
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            starts, valid = _valid_windows(sizes, length)
            blob = b"".join(texts)
            for s, e, h in segments(np.frombuffer(blob, np.uint8), valid, length):
                sk = np.fromiter((digest(blob[x:y]) for x, y in zip(s.tolist(), e.tolist())), np.uint64, len(s))
                doc = np.searchsorted(starts, s, "right") - 1
                place = (s - starts[doc]) << 16 | (e - s)
                doc = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(sk.view(np.int64)), b.column(0).take(doc),
                                                  b.column(2).take(doc), pa.array(place)], names=["h", "sk", "doc_id", "th", "place"])

    return map_arrow(_keyed(docs), run, "h long, sk long, doc_id long, th long, place long")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, th): rows are told apart by id and hash of the text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("th"))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order: by seven bytes first, then each unsorted group by the ranks twice as far on."""
    n = len(data)
    symbols = np.concatenate((data.astype(np.uint64) + np.uint64(1), np.zeros(6, np.uint64)))  # the end sorts before a zero byte
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | symbols[k:k + n]
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def regroup(at: np.ndarray, order: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rank suffixes ``order`` at places ``at`` by the last place of their group; return the places still unsorted."""
        last = np.append(keys[1:] != keys[:-1], True)
        ends = np.flatnonzero(last)
        sizes = np.diff(np.append(-1, ends))
        rank[order] = np.repeat(at[ends], sizes)
        return at[np.repeat(sizes > 1, sizes)]

    open_, reach = regroup(np.arange(n), sa, key[sa]), 7
    while len(open_) and reach < n:
        s = sa[open_]
        ahead = np.where(s + reach < n, rank[np.minimum(s + reach, n - 1)] + 1, 0)
        keys = (rank[s] << 32) | ahead
        o = np.argsort(keys, kind="stable")
        sa[open_] = s[o]
        open_ = regroup(open_, s[o], keys[o])
        reach *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Bytes (``most`` at most) that each suffix in order shares with the one before, after Kasai.

    The text is cut at ``starts``; the pieces are walked side by side, each
    from left to right, and what a suffix shares is one byte less than its
    left neighbour shared, and more if the bytes go on alike.
    """
    n = len(data)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int32)
    ends = np.append(starts[1:], n)
    shared = np.zeros(len(starts), np.int64)
    i, live = starts.copy(), np.arange(len(starts))
    while len(live):
        j = before[i[live]]
        shared[live] = np.where(j < 0, 0, np.maximum(shared[live] - 1, 0))
        grow = live[(j >= 0) & (shared[live] < most)]
        while len(grow):
            a, b = i[grow] + shared[grow], before[i[grow]] + shared[grow]
            alike = (a < n) & (b < n)
            alike[alike] = data[a[alike]] == data[b[alike]]
            grow = grow[alike]
            shared[grow] += 1
            grow = grow[shared[grow] < most]
        out[i[live]] = shared[live]
        i[live] += 1
        live = live[i[live] < ends[live]]
    return out[sa]


def shard_marks(texts: list[bytes], counts: np.ndarray, length: int):
    """(marked, order, group, starts): which windows of the segments are repeated.

    ``marked`` is per byte of the joined segments, ``order`` lists the windows'
    starts in suffix order and ``group`` numbers equal ones alike. Segments
    counted more than once are repeated as they are.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, valid = _valid_windows(sizes, length)
    sa = suffix_array(data)
    lcp = common_prefixes(data, sa, starts[:-1], length)
    at = np.flatnonzero(valid[sa])
    # neighbours at[i], at[i + 1] share the least of the prefixes from at[i] + 1 to at[i + 1]
    same = np.minimum.reduceat(lcp[:at[-1] + 1], at[:-1] + 1) if len(at) > 1 else np.zeros(0, np.int32)
    alike = same >= length
    order = sa[at]
    repeated = np.zeros(len(at), bool)
    repeated[1:] |= alike
    repeated[:-1] |= alike
    marked = np.zeros(len(data), bool)
    marked[order[repeated]] = True
    marked |= np.repeat(counts > 1, sizes) & valid
    return marked, order, np.concatenate(([0], np.cumsum(~alike))) if len(at) else np.zeros(0, np.int64), starts


MARKS = "h long, sk long, marks binary, run int, hashes binary, owners binary"


def _shard(length: int):
    names = [x.split()[0] for x in MARKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def run(key, rows):
        runs = key[1].as_py()
        h, sk, n = (rows.column(c).to_numpy() for c in ("h", "sk", "n"))
        _, once = np.unique(np.stack((h, sk)), axis=1, return_index=True)  # a repeated row brings a segment twice
        h, sk, n = h[once], sk[once], n[once]
        texts = rows.column("bytes").take(pa.array(once)).to_pylist()
        marked, order, group, starts = shard_marks(texts, n, length)
        out = []
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            windows = np.flatnonzero(marked[a:b])
            if len(windows):
                out.append((h[i], sk[i], windows.astype(np.int32).tobytes(), None, None, None))
        if runs > 1 and len(order):  # one anchor over several shards: a sorted run of the windows, cut by value
            blob = b"".join(texts)
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            digests = np.fromiter((xxhash.xxh3_64_intdigest(blob[x:x + length]) for x in order[first].tolist()), np.uint64, len(first))
            digests = digests[group]
            by = np.argsort(digests, kind="stable")
            digests, where = digests[by], order[by]
            seg = np.searchsorted(starts, where, "right") - 1
            owners = np.stack((sk[seg], where - starts[seg]))
            cuts = np.searchsorted(digests, (np.arange(1, runs, dtype=np.uint64) * np.uint64(2**64 // runs)))
            for r, (a, b) in enumerate(zip(np.append(0, cuts), np.append(cuts, len(digests)))):
                if b > a:
                    out.append((h[0], None, None, r, digests[a:b].tobytes(), np.ascontiguousarray(owners[:, a:b]).tobytes()))
        return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(zip(names, types))})

    return run


def _merge(key, rows):
    """Windows of one value range that several shards of an anchor hold: every run is searched for the others' values."""
    runs = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
    owners = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rows.column("owners").to_pylist()]
    every = np.sort(np.concatenate([np.unique(r) for r in runs]))
    found: dict[int, list[np.ndarray]] = {}
    for r, o in zip(runs, owners):
        several = np.searchsorted(every, r, "right") - np.searchsorted(every, r, "left") > 1
        sk, at = o[0, several], o[1, several]
        by = np.argsort(sk, kind="stable")
        sk, at = sk[by], at[by]
        cut = np.flatnonzero(np.append(True, sk[1:] != sk[:-1])) if len(sk) else np.zeros(0, np.int64)
        for a, b in zip(cut, np.append(cut[1:], len(sk))):
            found.setdefault(int(sk[a]), []).append(at[a:b])
    h = rows.column("h")[0].as_py()
    return pa.table({"h": pa.array([h] * len(found), pa.int64()), "sk": pa.array(list(found), pa.int64()),
                     "marks": pa.array([np.concatenate(v).astype(np.int32).tobytes() for v in found.values()], pa.binary())})


def repeated_windows(docs: DataFrame, length: int, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(doc_id, th, place, marks): segments with repeated windows; marks are window starts in the segment, null for all."""
    found = document_segments(docs, length)
    # stored, so that the join below is between plain shuffles and the rows of a very common anchor can be split
    anchors = found.groupBy("h").agg(F.count("*").alias("n"), F.min("sk").alias("lo"), F.max("sk").alias("hi")).where("n > 1")
    anchors = store(anchors.select(F.col("h").alias("a"), (F.col("lo") != F.col("hi")).alias("mixed")), "anchors")
    cand = store(found.join(anchors, F.col("h") == F.col("a")).select("h", "sk", "doc_id", "th", "place", "mixed"), "segments")
    whole = cand.where("NOT mixed").select("doc_id", "th", "place", F.lit(None).cast("binary").alias("marks"))
    kinds = cand.where("mixed").groupBy("h", "sk").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "place")).alias("at"))
    kinds = store(kinds, "kinds")
    total = kinds.count()
    if not total:
        return whole
    shards = total // shard_segments + 1
    large = kinds.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("kinds")).where(f"kinds > {shard_segments}")
    dealt = kinds.join(large, F.col("h") == F.col("g"), "left").withColumn(
        "runs", F.coalesce(F.floor(F.col("kinds") / shard_segments) + 1, F.lit(1)).cast("int"))
    dealt = dealt.select(F.col("at.doc_id").alias("d"), F.col("at.th").alias("t"), F.struct(
        "h", "sk", "n", "at.place", F.when(F.col("runs") > 1, F.col("h")).otherwise(F.pmod("h", F.lit(shards))).alias("shard"), "runs",
        F.when(F.col("runs") > 1, F.pmod(F.xxhash64("sk"), F.col("runs"))).otherwise(0).cast("int").alias("salt")).alias("s"))
    wanted = dealt.groupBy("d", "t").agg(F.collect_list("s").alias("wanted"))
    rows = _keyed(docs)
    rows = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.d) & (rows.th == wanted.t)).select("text", "wanted")

    def cut(batches):
        fields = ("h", "sk", "n", "shard", "runs", "salt")
        for b in batches:
            texts, wanted = _binary(b.column(0)), b.column(1)
            flat, ends = wanted.flatten(), wanted.offsets.to_numpy()
            place = flat.field("place").to_numpy()
            start, size = place >> 16, place & 0xFFFF
            base = ends[0]
            cuts = [t[x:x + y] for k, t in enumerate(texts) for x, y in zip(
                start[ends[k] - base:ends[k + 1] - base].tolist(), size[ends[k] - base:ends[k + 1] - base].tolist())]
            yield pa.RecordBatch.from_arrays([*(flat.field(f) for f in fields), pa.array(cuts, pa.binary())], names=[*fields, "bytes"])

    pieces = map_arrow(rows, cut, "h long, sk long, n long, shard long, runs int, salt int, bytes binary")
    made = pin(group_arrow(pieces, ["shard", "runs", "salt"], _shard(length), MARKS))
    merged = group_arrow(made.where("run IS NOT NULL"), ["h", "run"], _merge, "h long, sk long, marks binary")
    marks = made.where("run IS NULL").select("h", "sk", "marks").unionByName(merged)
    marks = marks.select(F.col("h").alias("a"), F.col("sk").alias("b"), "marks")
    part = cand.where("mixed").join(marks, (F.col("h") == F.col("a")) & (F.col("sk") == F.col("b"))).select("doc_id", "th", "place", "marks")
    return whole.unionByName(part)


def remove_repeats(docs: DataFrame, length: int = 200, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left) for every row.

    In: doc_id and text, other columns are ignored. Every byte covered by a
    string of ``length`` bytes that starts anywhere else too goes, whatever
    the document; strings are judged on the input and never cross documents.
    Null texts are empty; texts shorter than ``length`` stay whole. Repeated
    rows are copies of each other and lose all windows. A null doc_id is an
    id like any other; an empty table gives no rows.
    """
    if length < 4:
        raise ValueError("length must be 4 or more")
    found = repeated_windows(docs, length, shard_segments).groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(
        F.collect_list(F.struct("place", "marks")).alias("found"))
    rows = _keyed(docs)
    rows = rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.th == found.t), "left").select("doc_id", "text", "found")

    def run(batches):
        for b in _parts(batches):
            out = []
            for text, found in zip(_binary(b.column(1)), b.column(2)):
                cover = np.zeros(len(text) + 1, np.int32)
                if found.is_valid:
                    place = found.values.field("place").to_numpy()
                    start, windows = place >> 16, (place & 0xFFFF) - length + 1
                    for s, w, marks in zip(start.tolist(), windows.tolist(), found.values.field("marks").to_pylist()):
                        if marks is None:
                            cover[s] += 1
                            cover[s + w - 1 + length] -= 1
                        else:
                            at = s + np.unique(np.frombuffer(marks, np.int32))
                            np.add.at(cover, at, 1)
                            np.add.at(cover, at + length, -1)
                gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) if out else [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_arrow(rows, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
