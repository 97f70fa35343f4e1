"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled to a transducer: the normaliser's rewrite (character
map, extra spaces, dummy prefix, space mark: see ``normaliser``), one arc per
piece and, for characters that no piece has, byte arcs. Composed with an input
it is a lattice of pieces; the encoding is its shortest path in the tropical
semiring.

* Unigram models: an arc weighs minus its piece's score.
* BPE models: the order of merges decides, not a sum of scores. Which
  encodings merging can give is a regular property: every two neighbouring
  pieces must be what merging makes of their joined string. So a state is the
  last piece taken, and an arc weighs 0 if the pair may stand together and
  infinity if not; exactly one path is finite. The pair table is compiled as
  pairs are met (the model's pieces bound it).

Pieces never cross from other characters into a space mark, so the lattice of
a text is a chain of lattices of its words; a word's path is found once per
worker.
"""

from __future__ import annotations

import re
import struct
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow
from tempora.llm.normaliser import MARK, Normaliser, character_map

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN, USER, BYTE = 2, 4, 6  # fixed values: kinds of pieces in the file
CACHE = 250_000  # words whose paths a worker remembers at least
INFINITE = float("inf")


def _fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    i = 0

    def number():
        nonlocal i
        out = shift = 0
        while True:
            byte = data[i]
            i += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while i < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[i:i + size]
            i += size


class Remembered:
    """The latest answers by key: between CACHE and twice as many; what is asked for again stays."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, key: str, make) -> bytes:
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key) or make(key)
            if len(key) <= 64:
                if len(self.new) >= CACHE:
                    self.old, self.new = self.new, {}
                self.new[key] = got
        return got


class Transducer:
    """A compiled model: encode() and decode()."""

    def __init__(self, data: bytes):
        self.data = data
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, 1)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.bpe = trainer.get(3, 1) == 2
        if trainer.get(3, 1) not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        if any(kind == USER for _, _, kind in pieces) or trainer.get(24, 0):
            raise ValueError("models with user-defined pieces or the mark as a suffix are not supported")
        self.prefix, self.squeeze = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.normalize = Normaliser(character_map(normalizer.get(2, b"")), self.prefix, self.squeeze, bool(normalizer.get(5, 1)))
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
        self.score = {p: s for p, s, kind in pieces if kind == 1}
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.worst = min(self.score.values(), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.surface = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind == 1
                        else " ⁇ ".encode() if kind == UNKNOWN else b"" for p, _, kind in pieces]
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.words = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")) if not crossing else re.compile(r"(?s).+")
        self.pairs: dict[str, dict[str, bool]] = {}  # state -> piece -> may it follow
        self.paths, self.units = Remembered(), Remembered()
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.arcs = self._reachable() if self.bpe else set(self.ids)
        self.trie = {p[:k]: False for p in self.arcs for k in range(1, len(p))}  # prefix -> is it a piece
        self.trie.update(dict.fromkeys(self.arcs, True))

    def _reachable(self) -> set[str]:
        """Pieces that merging their own characters makes, and how their last symbols came about.

        ``left`` and ``right`` list what stands at a piece's edges while it is
        merged; None where a merge scores above one of its parts, so that
        merges do not come in order of score (such pairs are merged in full).
        """
        self.left, self.right = {}, {}
        out = set()
        for p in sorted(self.ids, key=len):
            last: list[str] = []
            if len(p) == 1:
                self.left[p] = self.right[p] = [p]
            elif self.merged(p, last) == [p]:
                a, b = last
                ordered = all(len(x) == 1 or self.score[x] > self.score[p] for x in (a, b))
                for side, x in ((self.left, a), (self.right, b)):
                    under = side.get(x) if len(x) > 1 else [x]
                    side[p] = [*under, p] if ordered and under and self.left.get(a, a) and self.right.get(b, b) else None
            else:
                continue
            out.add(p)
        return out

    def __reduce__(self):
        return Transducer, (self.data,)

    def merged(self, text: str, last: list[str] | None = None) -> list[str]:
        """What merging makes of a short string: best score first, leftmost of equals. last gets the parts of the final merge."""
        out = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(out, out[1:])) if a + b in self.score), default=None)
            if best is None:
                return out
            i = -best[1]
            if last is not None:
                last[:] = out[i:i + 2]
            out[i:i + 2] = [out[i] + out[i + 1]]

    def may_follow(self, a: str, b: str) -> bool:
        """Weight of the arc from state a over piece b: finite if merging leaves the pair as it is.

        The pair falls if, at some moment, the symbol at the end of a and the
        one at the start of b make a piece that scores above the merges that
        would take either of them next.
        """
        xs, ys = self.right.get(a, [a]), self.left.get(b, [b])
        if xs is None or ys is None:
            return self.merged(a + b) == [a, b]
        i = j = 0
        score = self.score
        while True:
            over = score.get(xs[i] + ys[j])
            na = score[xs[i + 1]] if i + 1 < len(xs) else -INFINITE
            nb = score[ys[j + 1]] if j + 1 < len(ys) else -INFINITE
            if over is not None:
                if over > na and over > nb:
                    return False
                if over == na or over == nb:  # the leftmost of equals goes first
                    return self.merged(a + b) == [a, b]
            if na == nb == -INFINITE:
                return True
            if na >= nb:
                i += 1
            else:
                j += 1

    def shortest_path(self, word: str) -> list[str]:
        """Pieces of the lattice's shortest path (single characters without a piece stand for their bytes)."""
        n, trie = len(word), self.trie.get
        back = [""] * (n + 1)  # the last arc of the best path to each place
        if self.bpe:
            for j in range(n):  # longer arcs into a place come first, and the first that fits is the only one
                before = back[j]
                if j and not before:
                    before = back[j] = word[j - 1]
                after = self.pairs.get(before)
                if after is None:
                    after = self.pairs[before] = {}
                for i in range(j + 1, n + 1):
                    piece = word[j:i]
                    known = trie(piece)
                    if known is None:
                        break
                    if known and not back[i]:
                        fits = after.get(piece)
                        if fits is None:
                            fits = after[piece] = not before or self.may_follow(before, piece)
                        if fits:
                            back[i] = piece
            back[n] = back[n] or word[-1:]
        else:
            best = [0.0] + [-INFINITE] * n  # of equal paths the one whose last piece is longest
            for j in range(n):
                for i in range(j + 1, n + 1):
                    piece = word[j:i]
                    known = trie(piece)
                    if known is None:
                        break
                    if known and best[j] + self.score[piece] > best[i]:
                        best[i], back[i] = best[j] + self.score[piece], piece
                if not trie(word[j]) and best[j] + self.worst > best[j + 1]:
                    best[j + 1], back[j + 1] = best[j] + self.worst, word[j]
        out = []
        while n:
            out.append(back[n])
            n -= len(back[n])
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        out = array("i")
        for p in self.shortest_path(unit):
            if p in self.ids:
                out.append(self.ids[p])
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out.tobytes()  # remembered by the hundred thousand: half the memory of an array

    def _word(self, word: str) -> bytes:
        """A word's ids, packed: no piece spans two neighbouring characters that no piece has side by side, so it falls into units there."""
        joined = self.joined
        cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in joined]
        if not cuts:
            return self.units.find(word, self._unit)
        ends = [0, *cuts, len(word)]
        return b"".join([self.units.find(word[i:k], self._unit) for i, k in zip(ends, ends[1:])])

    def encode(self, text: str | None) -> array:
        """Piece ids; none for a null or empty text."""
        out = array("i")
        if not text:
            return out
        extend, find, paths, make = out.frombytes, self.paths.find, self.paths, self._word
        for word in self.words.findall(self.normalize(text)):
            extend(paths.new.get(word) or find(word, make))
        if not self.bytes:  # neighbouring unknown characters are one unknown piece
            out = array("i", [x for k, x in enumerate(out) if x != self.unknown or not k or out[k - 1] != x])
        return out

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if (self.prefix or self.squeeze) and text.startswith(" ") else text


def load(path: str = MODEL) -> Transducer:
    with open(path, "rb") as f:
        return Transducer(f.read())


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip for every row; whole texts.

    In: doc_id and text, other columns are ignored. ``round_trip`` tells
    whether decoding gives the text back (a text that has the space mark
    itself comes back with spaces). Null and empty texts have no tokens and
    round_trip true; repeated rows are encoded one by one; an empty table
    gives no rows. The model file is read on the driver and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        model = shared.value
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                flat, ends, same = array("i"), array("i", [0]), []
                for text in part.column(1).to_pylist():
                    ids = model.encode(text)
                    same.append(model.decode(ids) == (text or ""))
                    flat.extend(ids)
                    ends.append(len(flat))
                ends, flat = pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32())
                ids = pa.ListArray.from_arrays(ends, flat)
                yield pa.RecordBatch.from_arrays([part.column(0), ids.value_lengths().cast(pa.int64()), ids, pa.array(same, pa.bool_())],
                                                 names=["doc_id", "n_tokens", "ids", "round_trip"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
