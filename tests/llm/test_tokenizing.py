"""Cached ids against the library's on whole texts."""

import cProfile
import pstats
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veriforge.llm.tokenizing import library_encoder, slices

PARTS = ["word", "Word", "ÀÉ", "ß", "naïve", "é", "H̱", "don't", "'s", "'ll", ",", ".", "...", "|", " | ", "%%%", "12", "3", "²", "中文", "\U0001f600", " ", "  ", "   ", "\n", "\n\n", "\r\n", "\t", "\xa0", " ", "\x1c", "\x85", "\x00", "<|endoftext|>", "A", "z", "İ", "Σ"]


def made(n: int, seed: int) -> list:
    r = random.Random(seed)
    plain = [p for p in PARTS if not p.isspace() and " " not in p and "\x1c" not in p and "\x85" not in p]
    texts = [None, "", " ", "\n", " a", "a ", "\na", "a\n", "a\nb", "́a", "a\ń", "|", "a|b"]
    for _ in range(n):
        texts.append("".join(r.choice(PARTS) for _ in range(r.randrange(12))))
        texts.append(r.choice(["", " ", "\n"]) + "".join(r.choice(plain) + r.choice(["", "", " ", "\n"]) for _ in range(r.randrange(12))) + "x")
    return texts


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_the_librarys(name, spaced):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    enc = library_encoder(public_tokenizers.path(name), spaced)
    enc.entries = 60  # the generations turn
    texts = made(3000, 1)
    found = [b for lo in range(0, len(texts), 500) for b in enc.batch(pa.array(texts[lo : lo + 500], pa.string()))]
    for text, got in zip(texts, found, strict=True):
        assert np.frombuffer(got, "<u2").tolist() == t.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_no_python_for_each_segment(name, spaced):
    r = random.Random(2)
    texts = [" ".join("".join(r.choices("aeioustnrh", k=8)) + r.choice(["", "", ",", "."]) for _ in range(200)) for _ in range(100)]
    t = Tokenizer.from_file(public_tokenizers.path(name))
    enc, calls = library_encoder(public_tokenizers.path(name), spaced), cProfile.Profile()
    found = calls.runcall(enc.batch, pa.array(texts))
    assert [np.frombuffer(b, "<u2").tolist() for b in found] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert pstats.Stats(calls).total_calls < 5_000  # of 20,000 segments


@pytest.mark.parametrize("spaced", [True, False])
def test_cache_is_bounded(spaced):
    enc = library_encoder(public_tokenizers.path("byte_bpe_50k.json" if spaced else "word_bpe_49k.json"), spaced, entries=200)
    for i in range(12):
        texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}" for k in range(20)) + " often" for j in range(10)]
        enc.batch(pa.array([*texts, " ", None, "long" * 20_000 + chr(97 + i)]))
        assert len(enc.keys) <= 700 and enc.keys.nbytes < 250_000
    assert " often" in enc.keys.to_pylist() or "often" in enc.keys.to_pylist()
    assert enc.batch(pa.array([], pa.string())) == [] and enc.batch(pa.array(["", None, " " * (not spaced)])) == [b""] * 3


def test_slices_cover_all_rows_once():
    texts = pa.array(["aaaa", None, "", "bb" * 50, "c", None])
    assert [i for lo, hi in slices(texts, 5) for i in range(lo, hi)] == list(range(6))
    assert list(slices(pa.array([], pa.string()))) == []
