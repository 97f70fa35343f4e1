"""Language identification by words with back-off to character n-grams.

A word known from training adds its log frequency per language; an unseen
word falls back to the longest n-grams (5 down to 1 characters, word ends
marked) of which training knows any. The model is fitted on a bounded sample
of labelled documents (see ``Bounds``) and keeps every language, word and
n-gram of it; Spark counts them. Only what a language has seen is stored, by
64-bit hash, so the size follows the sample and not languages times words.
Predictions cover every whole text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow

LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
CACHE = 200_000  # words whose evidence a worker remembers
ENTRIES = 4_000_000  # and the numbers kept for them
AHEAD = 1_000_000  # characters of texts whose new words are looked up together


@dataclass(frozen=True)
class Bounds:
    """Limits of the training sample, the only ones."""

    docs: int = 4000  # labelled documents per language, smallest hash of the id first
    total: int = 100_000  # and in all: beyond 25 languages each has an even share (at least one document)
    longest: int = 5  # characters of an n-gram


@dataclass(frozen=True)
class Table:
    """Counts of words or of n-grams of one length, as log frequencies.

    ``keys`` are sorted hashes; key k has entries ptr[k] to ptr[k + 1]: a
    language and what its count adds to the language's floor ``base``.
    """

    keys: np.ndarray
    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    base: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, cols: np.ndarray, counts: np.ndarray, languages: int) -> Table:
        """Add-half log frequencies from one row per key and language."""
        by = np.lexsort((cols, keys))
        keys, cols, counts = keys[by], cols[by], counts[by]
        distinct, first = np.unique(keys, return_index=True)
        whole = np.bincount(cols, weights=counts, minlength=languages)
        base = np.log(0.5 / (whole + 0.5 * max(1, len(distinct))))
        return Table(distinct, np.append(first, len(keys)), cols.astype(np.int32), np.log(2.0 * counts + 1.0), base)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def _hashes(strings) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64)


def _grams(word: str, size: int) -> list[str]:
    """N-grams of a word with its ends marked; a mark alone is none."""
    marked = f"^{word}$" if size > 1 else word
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start[i], start[i] + 1, ... (size[i] of them) of every i, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Model:
    """tables[0] holds words, tables[n] n-grams; a worker remembers the evidence of the words it met."""

    def __init__(self, langs: list[str], tables: list[Table]):
        self.langs, self.tables = langs, tables
        self.bases = np.stack([*(t.base for t in tables), np.zeros(len(langs))])  # last: nothing is known
        self._forget()

    def __reduce__(self):
        return Model, (self.langs, self.tables)

    def _forget(self):
        self.seen: dict[str, int] = {}
        self.level = np.zeros(CACHE, np.int8)
        self.ptr = np.zeros(CACHE + 1, np.int64)
        self.cols, self.vals = np.zeros(1024, np.int32), np.zeros(1024)

    def _evidence(self, words: list[str]):
        """(level of each word, and by word: owner, language, value): its own entries, or the mean of its longest known n-grams'."""
        level = np.full(len(words), len(self.tables), np.int8)
        rest, found = np.arange(len(words)), []
        for n in (0, *range(len(self.tables) - 1, 0, -1)):
            if not len(rest):
                break
            parts = [[words[i]] if n == 0 else _grams(words[i], n) for i in rest]
            owner = np.repeat(rest, [len(p) for p in parts])
            table = self.tables[n]
            row = table.find(_hashes(x for p in parts for x in p))
            owner, row = owner[row >= 0], row[row >= 0]
            hits = np.bincount(owner, minlength=len(words))
            size = table.ptr[row + 1] - table.ptr[row]
            at = _spread(table.ptr[row], size)
            place = np.repeat(owner, size) * len(self.langs) + table.cols[at]
            place, back = np.unique(place, return_inverse=True)
            who = place // len(self.langs)
            found.append((who, place % len(self.langs), np.bincount(back, weights=table.vals[at], minlength=len(place)) / hits[who]))
            level[hits > 0] = n
            rest = rest[hits[rest] == 0]
        owner, cols, vals = (np.concatenate(c) for c in zip(*found))
        by = np.argsort(owner, kind="stable")
        return level, owner[by], cols[by], vals[by]

    def learn(self, words: list[str]) -> None:
        """Remember the evidence of words not met before (distinct, half of CACHE at most)."""
        new = [w for w in words if w not in self.seen]
        if not new:
            return
        if len(self.seen) + len(new) > CACHE or self.ptr[len(self.seen)] > ENTRIES:
            self._forget()
            new = words
        first = len(self.seen)
        level, owner, cols, vals = self._evidence(new)
        start, end = int(self.ptr[first]), int(self.ptr[first]) + len(cols)
        if end > len(self.cols):
            room = max(end, 2 * len(self.cols)) - start
            self.cols, self.vals = (np.concatenate((a[:start], np.zeros(room, a.dtype))) for a in (self.cols, self.vals))
        self.cols[start:end], self.vals[start:end] = cols, vals
        self.level[first:first + len(new)] = level
        self.ptr[first + 1:first + len(new) + 1] = start + np.cumsum(np.bincount(owner, minlength=len(new)))
        self.seen.update(zip(new, range(first, first + len(new))))

    def _sum(self, words: list[str], n: np.ndarray) -> np.ndarray:
        """Summed scores per language of words met n times."""
        self.learn(words)
        at = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        size = self.ptr[at + 1] - self.ptr[at]
        entry = _spread(self.ptr[at], size)
        floor = np.bincount(self.level[at], weights=n, minlength=len(self.bases)) @ self.bases
        return floor + np.bincount(self.cols[entry], weights=self.vals[entry] * np.repeat(n, size), minlength=len(self.langs))

    def _answer(self, counts: Counter | None) -> tuple[str, float]:
        if not counts:
            return UNDETERMINED, 0.0
        words, n = list(counts), np.fromiter(counts.values(), float, len(counts))
        step = CACHE // 2
        total = sum(self._sum(words[i:i + step], n[i:i + step]) for i in range(0, len(words), step))
        mean = total / n.sum() * min(n.sum(), 20.0)
        best = int(mean.argmax())
        return self.langs[best], float(1 / np.exp(mean - mean[best]).sum())

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text: score is the posterior with the text's evidence counted as 20 words at most."""
        out: list[tuple[str, float]] = []
        while len(out) < len(texts):
            counted, chars = [], 0
            while len(out) + len(counted) < len(texts) and chars < AHEAD:
                text = texts[len(out) + len(counted)]
                counted.append(Counter(LETTERS.findall(text.lower())) if text and self.langs else None)
                chars += len(text or "")
            words = list(dict.fromkeys(w for c in counted if c for w in c))
            if len(words) <= CACHE // 2:
                self.learn(words)
            out += map(self._answer, counted)
        return out


def _sample(docs: DataFrame, bounds: Bounds) -> tuple[list[str], DataFrame]:
    """Every language, and (code, text) of at most ``bounds.docs`` documents of each, chosen by hash of the id.

    Only ids and labels are looked at to find each language's cut. Rows that
    repeat an id come along. Broadcast is one row per language.
    """
    keyed = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select(
        F.xxhash64("doc_id").alias("h"), F.col("lang").cast("string"), F.col("text").cast("string"))
    labels = keyed.select("lang").distinct().count()
    most = max(1, min(bounds.docs, bounds.total // max(1, labels)))
    order = Window.partitionBy("lang").orderBy("h")
    first = keyed.select("lang", "h").distinct().withColumn("n", F.row_number().over(order)).where(f"n <= {most}")
    cuts = sorted((r.lang, r.cut) for r in first.groupBy("lang").agg(F.max("h").alias("cut")).collect())
    table = docs.sparkSession.createDataFrame([(i, lang, cut) for i, (lang, cut) in enumerate(cuts)], "code int, name string, cut long")
    chosen = keyed.join(F.broadcast(table), (F.col("lang") == F.col("name")) & (F.col("h") <= F.col("cut")))
    return [lang for lang, _ in cuts], chosen.select("code", "text")


def _batch(rows: list[tuple], **types) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def train(docs: DataFrame, bounds: Bounds = Bounds()) -> Model:
    """Fit a model on the text and lang of ``docs`` (doc_id only picks the sample).

    Rows with a null among the three are left out. No labelled rows give a
    model that answers `und` to everything. Words are summed over the sample
    before their n-grams are counted, so common words cost as much as rare ones.
    """

    def count_words(batches):
        for b in batches:
            found: dict[int, Counter] = defaultdict(Counter)
            for code, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found[code].update(LETTERS.findall(text.lower()))
            yield _batch([(x, w, n) for x, c in found.items() for w, n in c.items()], code=pa.int32(), word=pa.string(), n=pa.int64())

    longest = bounds.longest

    def count_grams(batches):
        for b in batches:
            found: dict[tuple, int] = defaultdict(int)
            for code, word, n in zip(*(c.to_pylist() for c in b.columns)):
                found[code, 0, word] += n
                for size in range(1, longest + 1):
                    for gram in _grams(word, size):
                        found[code, size, gram] += n
            keys = _hashes(g for _, _, g in found).view(np.int64)
            yield _batch([(c, s, k, n) for ((c, s, _), n), k in zip(found.items(), keys.tolist())],
                         code=pa.int32(), size=pa.int32(), key=pa.int64(), n=pa.int64())

    langs, chosen = _sample(docs, bounds)
    words = map_arrow(chosen, count_words, "code int, word string, n long").groupBy("code", "word").agg(F.sum("n").alias("n"))
    grams = map_arrow(words, count_grams, "code int, size int, key long, n long").groupBy("code", "size", "key").agg(F.sum("n").alias("n"))
    rows = grams.toArrow()  # bounded by the sample
    code, size, key, n = (rows.column(c).to_numpy() for c in ("code", "size", "key", "n"))
    tables = [Table.of(key[size == s].view(np.uint64), code[size == s], n[size == s], len(langs)) for s in range(longest + 1)]
    return Model(langs, tables)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from the whole text.

    Null texts and texts without a letter are `und` with score 0. Equal
    scores go to the first language by code point. Other columns are ignored;
    repeated rows are answered one by one. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        model = shared.value
        for b in batches:
            got = model.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, lang_pred string, score double")


def is_held_out():
    """Every fourth document by hash of its id is kept out of training; a null id is not, but never trains either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Train on the documents that are not held out, predict all: doc_id, held_out, lang_pred, score."""
    model = train(docs.where(~is_held_out()), bounds)
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.0, bounds: Bounds = Bounds()) -> DataFrame:
    """docs, all columns, without the rows whose language cannot be told: `und`, or a score below ``least``.

    A low score alone says little about a text of a word or two, so none is
    asked for by default. Null texts go with the `und` ones; repeated rows stay
    or go together, null ids and labels and other columns do not matter. An
    empty table gives no rows.
    """
    model = train(docs.select("doc_id", "lang", "text").where(~is_held_out()), bounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        model = shared.value
        for b in batches:
            got = model.predict(b.column(at).to_pylist())
            yield b.filter(pa.array([g[0] != UNDETERMINED and g[1] >= least for g in got], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
