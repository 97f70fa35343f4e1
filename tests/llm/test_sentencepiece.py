from __future__ import annotations

import os
import random
import struct

import pytest
import sentencepiece
from helpers import docs

from tempora.llm.normaliser import Normaliser, character_map
from tempora.llm.sentencepiece_fst import MODEL, Transducer, _fields, encode_documents, load

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no tokenizer files here")


@pytest.fixture(scope="module")
def model():
    return load()


def samples(model):
    rng = random.Random(4)
    pieces = [p.replace("▁", " ") for p in model.ids]
    short = [p for p in pieces if len(p) < 4]
    out = ["", " ", "a", "\n", "the\n\nthe", "漢字 😀 ▁x", "\0", "e\u0301", "x" * 3000] + [" " * n for n in range(40)] + ["a" + " " * n + "the" for n in range(20)]
    out += ["".join(rng.choice("  abcdehinorst.,\n\té漢0<>-") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    out += ["".join(rng.choice(some) for _ in range(9)) for some in (pieces, short) for _ in range(1500)]
    return out


def test_bpe_paths_equal_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in samples(model):
        ids = model.encode(text).tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == library.decode(ids)


def _message(number, data):
    out = bytes([number << 3 | 2])
    n = len(data)
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n]) + data


def unigram(bytes_too):
    """A small unigram model file, made by hand."""
    rng = random.Random(8)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if bytes_too:
        pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    names = {"▁"} | set("abcdefgh") | {("▁" if rng.random() < 0.3 else "") + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(400)}
    pieces += [(p, -rng.uniform(2, 12), 1) for p in sorted(names)]
    data = b"".join(_message(1, _message(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + bytes([k])) for p, s, k in pieces)
    trainer = b"\x18\x01" + (b"\x98\x02\x01" if bytes_too else b"")
    return data + _message(2, trainer) + _message(3, _message(1, b"identity") + b"\x18\x01\x20\x01\x28\x01")


@pytest.mark.parametrize("bytes_too", [True, False])
def test_unigram_paths_equal_the_library(bytes_too):
    data = unigram(bytes_too)
    model, library = Transducer(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(6)
    weight = lambda ids: sum(library.get_score(i) for i in ids)
    for _ in range(800):
        text = "".join(rng.choice("abcdefgh  " + ("xé" if rng.random() < 0.3 else "")) for _ in range(rng.randint(0, 30)))
        got, want = model.encode(text).tolist(), library.encode(text)
        if got != want:  # only paths of equal weight may differ ("aa" + "a" and "a" + "aa")
            assert weight(got) == pytest.approx(weight(want), abs=1e-3) and library.decode(got) == library.decode(want), text


def _normaliser(rule, squeeze=True, prefix=True):
    """The library's normaliser for a named rule, and its specification."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
    return library, dict(_fields(library.serialized_model_proto()))[3]


def _mapped_texts(rules, rng, n):
    """Texts full of rules, parts of rules, spaces of many kinds and characters that combine."""
    keys = sorted(rules) or ["a"]
    others = ["", " ", "  ", "a", "e", "the ", "\u0301", "漢", "▁", "\u3000", "\u200b", "\uac00", "\u1100", "\u1161", "\ufdfa", "\ufb01", "①", "\t", "\n", "\0x"]
    for _ in range(n):
        some = [rng.choice(keys), rng.choice(keys)[:1], rng.choice(keys)[:2], rng.choice(others), rng.choice(others), rng.choice(others)]
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 9)))
        if "\0" not in text:
            yield text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_the_normaliser_equals_the_library(rule):
    rules = character_map(dict(_fields(_normaliser(rule)[1])).get(2, b""))
    assert (len(rules) > 200_000) == (rule != "identity")
    rng = random.Random(2)
    machine = Normaliser(rules, True, True)
    for squeeze, prefix in [(True, True), (True, False), (False, True), (False, False)]:
        library, _ = _normaliser(rule, squeeze, prefix)
        machine.squeeze, machine.prefix = squeeze, prefix
        for text in _mapped_texts(rules, rng, 1500):
            assert machine(text) == library.normalize(text), text


def test_rules_that_overlap_are_read_once():
    """Longest from the left, read again where a longer rule fails, against a plain loop."""
    rules = {"aab": "X", "a": "y", "abab": "Z ", "ba": "", "bbbbc": "  w"}
    machine, rng = Normaliser(rules, False, False), random.Random(3)
    for _ in range(3000):
        text, want, at = "".join(rng.choice("aabbc ") for _ in range(rng.randint(0, 14))), "", 0
        while at < len(text):
            rule = max((r for r in rules if text.startswith(r, at)), key=len, default=None)
            want, at = want + (text[at] if rule is None else rules[rule]), at + len(rule or "-")
        assert machine(text) == want.replace(" ", "▁")
    assert machine("aa" * 200_000) == "y" * 400_000  # linear


def test_a_map_that_is_cut_short_is_refused():
    blob = dict(_fields(_normaliser("nfkc")[1]))[2]
    assert character_map(b"") == {}
    with pytest.raises(ValueError):
        character_map(blob[:1000])


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_models_with_a_character_map_equal_the_library(kind):
    with open(MODEL, "rb") as f:
        data = f.read() if kind == "bpe" else unigram(True)
    _, spec = _normaliser("nmt_nfkc")
    data += _message(3, spec)  # a later field of the message is merged over the earlier
    merged = dict(_fields(data))[3]
    assert merged == spec
    model, library = Transducer(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng, letters = random.Random(5), kind == "unigram"
    weight = lambda ids: sum(library.get_score(i) for i in ids)
    for text in _mapped_texts(character_map(dict(_fields(spec))[2]), rng, 2500):
        text = "".join(chr(ord(c) + 0xFEE0) if "a" <= c <= "h" and rng.random() < 0.5 else c for c in text + "bad cafe" * letters)
        got, want = model.encode(text).tolist(), library.encode(text)
        if got != want:
            assert letters and weight(got) == pytest.approx(weight(want), abs=1e-3), text
        assert model.decode(want) == library.decode(want), text


def test_documents(spark, model):
    texts = [None, "", "plain words", "two  spaces\n", "漢字 and ▁", "word " * 5000]
    df = docs(spark, texts).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    got = encode_documents(df.union(df.limit(2))).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert r.ids == model.encode(texts[r.doc_id]).tolist() and r.n_tokens == len(r.ids)
        assert r.round_trip == ("▁" not in (texts[r.doc_id] or ""))
    assert encode_documents(df.limit(0)).count() == 0
