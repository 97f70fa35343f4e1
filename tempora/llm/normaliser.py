"""A SentencePiece model's normaliser, compiled to a sequential transducer.

The rules (a character map: strings and what they become) are applied from the
left, the longest first. Their trie is the machine's states; an arc reads one
character. Where a state has no arc for the next character, its failure arc
writes what the longest rule on the way here gives (or, without one, the first
character) and leads to the state that reading the rest again ends in, worked
out once for every state. So a text is read once, from left to right, with a
number of steps in proportion to its length and that of the rules.

A second machine of two states (after a space or not) drops extra spaces and
writes the others as space marks; the dummy prefix is its first output.
"""

from __future__ import annotations

import re

import numpy as np

MARK = "▁"
FRONTIER = 4096  # trie nodes looked at together


def character_map(blob: bytes) -> dict[str, str]:
    """Rules of a compiled map: the size of a double-array trie, the trie's units, zero-ended outputs that its values point into."""
    if len(blob) < 4:
        return {}
    size = int.from_bytes(blob[:4], "little")
    if size % 4 or size + 4 > len(blob):
        raise ValueError("the character map is cut short")
    units, outputs = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]
    # A unit's parts.
    label, has_leaf = units & 0x800000FF, units >> 8 & 1
    offset, value = units >> 10 << ((units & 1 << 9) >> 6), units & 0x7FFFFFFF
    octets = np.arange(1, 256)
    rules: dict[str, str] = {}
    level = [(np.array([int(offset[0])]), [b""])] if len(units) else []
    while level:
        base, keys = level.pop()
        at = base[:, None] ^ octets
        ok = at < len(units)
        ok[ok] = label[at[ok]] == np.broadcast_to(octets, at.shape)[ok]
        row, col = np.nonzero(ok)
        nodes = at[row, col]
        names = [keys[r] + bytes([c + 1]) for r, c in zip(row, col)]
        below = offset[nodes] ^ nodes
        for k in np.flatnonzero(has_leaf[nodes]):
            start = int(value[below[k]])
            rules[names[k].decode()] = outputs[start:outputs.index(b"\0", start)].decode()
        level += [(below[k:k + FRONTIER], names[k:k + FRONTIER]) for k in range(0, len(names), FRONTIER)]
    return rules


class Normaliser:
    """The compiled rewrite: call it with a text."""

    def __init__(self, rules: dict[str, str], prefix: bool, squeeze: bool, escape: bool = True):
        self.prefix, self.squeeze, self.space = prefix, squeeze, MARK if escape else " "
        self.arcs: list[dict[str, int]] = [{}]
        found: list[str | None] = [None]  # what the rule that ends in a state gives
        names = [""]
        for rule in sorted(rules):
            state = 0
            for c in rule:
                to = self.arcs[state].get(c)
                if to is None:
                    to = self.arcs[state][c] = len(self.arcs)
                    self.arcs.append({})
                    found.append(None)
                    names.append(names[state] + c)
                state = to
            if rule:
                found[state] = rules[rule]
        self.fail: list[tuple[tuple[str, ...], int]] = [((), 0)] * len(names)
        for state in sorted(range(1, len(names)), key=lambda s: len(names[s])):  # the rest is shorter, so its states are done
            name, at, done, out = names[state], 0, 1, names[state][0]
            for k, c in enumerate(name):
                at = self.arcs[at][c]
                if found[at] is not None:
                    done, out = k + 1, found[at]
            written, end = self._read(name[done:], 0)
            self.fail[state] = ((out, *written), end)
        # characters that lead nowhere from the start state are copied in runs
        self.enters = re.compile("[" + "".join(map(re.escape, sorted(self.arcs[0]))) + "]") if self.arcs[0] else None

    def _read(self, text: str, state: int) -> tuple[list[str], int]:
        """(outputs, last state) of reading a text from a state."""
        out: list[str] = []
        for c in text:
            while True:
                to = self.arcs[state].get(c)
                if to is not None:
                    state = to
                elif state:
                    written, state = self.fail[state]
                    out += written
                    continue
                else:
                    out.append(c)
                break
        return out, state

    def rewritten(self, text: str) -> list[tuple[str, bool]]:
        """What the rules make of a text, in order: (run of copied characters, False) or (one output, True)."""
        if self.enters is None:
            return [(text, False)]
        out: list[tuple[str, bool]] = []
        at, n = 0, len(text)
        while at < n:
            m = self.enters.search(text, at)
            here = m.start() if m else n
            if here > at:
                out.append((text[at:here], False))
            at, state = here, 0
            while at < n:
                to = self.arcs[state].get(text[at])
                if to is not None:
                    state, at = to, at + 1
                elif state:
                    written, state = self.fail[state]
                    out += [(w, True) for w in written]
                else:
                    break
            while state:  # the end of the text
                written, state = self.fail[state]
                out += [(w, True) for w in written]
        return out

    def __call__(self, text: str) -> str:
        if not text:
            return ""
        parts = self.rewritten(text)
        if self.squeeze:
            after, kept = True, []
            for part, ruled in parts:
                if after:
                    part = part.lstrip(" ")
                if part:
                    part = part if ruled else re.sub(" +", " ", part)
                    after = part[-1] == " "
                    kept.append(part)
            text = "".join(kept).replace(" ", self.space)
            while text.endswith(self.space):
                text = text[:-len(self.space)]
            return self.space + text if self.prefix and text else text
        text = "".join([part for part, _ in parts]).replace(" ", self.space)
        return self.space + text if self.prefix else text
