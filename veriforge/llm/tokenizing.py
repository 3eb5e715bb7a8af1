"""Exact whole-text token ids, with the work shared between equal words.

A word-level cache needs cut points at which the tokenizer itself always cuts:

* byte-level BPE (the pattern " ?letters| ?digits| ?others|spaces"): a space that stands before a character other than
  white space always opens a new piece, whatever stands before it.  Text is cut there, and before single line feeds between
  characters other than white space.
* word BPE with white space dropped: no piece holds white space, and neither NFC nor lower-casing looks across it.
* both: a run of letters ends a piece where an ASCII character other than a letter follows (NFC composes nothing there).

Texts are cut, segments numbered, split into letters and what follows, and looked up by Arrow; ids lie in one array, from which
NumPy puts those of whole texts together, so no Python object is made for a segment.  Ids always come from the library itself;
only what the cache lacks is encoded, a slice at a time.  The cache is bounded, so memory does not grow with the input.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shared import KEPT

#: How many pieces a worker's cache holds that were met since it was last cleared out; up to twice as many in all, of about 40 bytes each.
CACHE_ENTRIES = 450_000

#: Longer pieces (in bytes) are forgotten when the cache is cleared out, which is also done at twice as many bytes for each entry.
CACHE_BYTES = 64

#: White space other than a space or a line feed, of Unicode or of Python's str methods.
RARE_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ASCII_RARE = RARE_SPACE[:8]
#: Stands between segments while Arrow cuts a text that holds no rare space.
_CUT = "\x1c"
_BEFORE_WORD = re.compile(r" (?=\S)")
_SPACES = re.compile(f"[\n {RARE_SPACE.translate(dict.fromkeys(range(0x1C, 0x20)))}]+")
#: A line feed or none, letters of ASCII and Latin-1, and what follows from an ASCII character other than a letter on.
_PARTS = r"(?s)\A(?P<feed>\n?)(?P<head> ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<tail>(?:[\x21-\x40\x5b-\x60\x7b-\x7e].*)?)\z"


def space_segments(text: str) -> list[str]:
    """Pieces of text between the spaces that stand before a character other than white space; those spaces are left out."""
    if "  " in text or " \n" in text or text[-1:] == " " or any(c in text for c in (_ASCII_RARE if text.isascii() else RARE_SPACE)):
        return _BEFORE_WORD.split(text)
    return text.split(" ")


def words(text: str) -> list[str]:
    """Runs without Unicode white space; str.split also cuts at the four information separators."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def gathered(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ids that begin there and are of that size, one after another."""
    at = np.repeat(begin - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    return ids[at]


class CachedEncoder:
    """Little-endian ids of whole texts as bytes, width bytes an id.  spaced: byte-level BPE, where segments are cut before
    spaces and line feeds and begin with them; else word BPE.  encode gives the ids of all texts of an array, one text after
    another, and how many each has.

    Once over `entries` pieces were met since the cache was last cleared out, all others go, so frequent pieces stay.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], spaced: bool, width: int, entries: int = CACHE_ENTRIES):
        self.encode, self.spaced, self.width, self.entries = encode, spaced, width, entries
        self.keys, self.ids = pa.array([], pa.string()), np.zeros(0, f"<u{width}")
        self.begin, self.size, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        border = "  | \n|\n |\n\n|[ \n]\\z|" if spaced else ""
        self.uneven = f"{border}[{RARE_SPACE}]"

    def _clear_out(self) -> None:
        heavy = self.keys.nbytes + self.ids.nbytes > 2 * CACHE_BYTES * self.entries
        if not heavy and np.count_nonzero(self.met) <= self.entries:
            return
        stay = np.flatnonzero(self.met & (pc.binary_length(self.keys).to_numpy() <= CACHE_BYTES))
        self.keys, self.ids = self.keys.take(pa.array(stay)), gathered(self.ids, self.begin[stay], self.size[stay])
        self.size = self.size[stay]
        self.begin, self.met = np.cumsum(self.size) - self.size, np.zeros(len(stay), bool)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece, all of them distinct, lies in the cache; what it lacks is encoded first."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.keys), -1).to_numpy().astype(np.int64)
        lacking = at < 0
        if lacking.any():
            new = pieces.filter(pa.array(lacking))
            ids, size = self.encode(new)
            at[lacking] = len(self.keys) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, new])
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
            self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
            self.met = np.concatenate([self.met, np.zeros(len(new), bool)])
        self.met[at] = True
        return at

    def _segments(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after another, and how many each has: those of a line feed, of the letters after it and of what
        follows these apart, as there are far fewer of each."""
        feed, head, tail = pc.extract_regex(segments, _PARTS).flatten()
        if not self.spaced:
            head = pc.utf8_lower(head)
        pieces = pa.concat_arrays([pc.fill_null(feed, ""), pc.coalesce(head, segments), pc.fill_null(tail, "")]).dictionary_encode()
        at = self._places(pieces.dictionary)[pieces.indices.to_numpy().reshape(3, -1).T]
        size = self.size[at]
        return gathered(self.ids, self.begin[at].ravel(), size.ravel()), size.sum(1)

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: empty)."""
        self._clear_out()
        texts = pc.fill_null(texts, "")
        uneven = pc.match_substring_regex(texts, self.uneven)
        if not (n := pc.sum(uneven).as_py()):
            return self._columns(texts)
        others = iter(self._rows(texts.filter(uneven).to_pylist()))
        evens = iter(self._columns(texts.filter(pc.invert(uneven))) if n < len(texts) else ())
        return [next(others if u else evens) for u in uneven.to_pylist()]

    def _columns(self, texts: pa.Array) -> list[bytes]:
        """Texts with no white space but single spaces and line feeds (spaced), or but those (otherwise)."""
        if not len(texts):
            return []
        if self.spaced:
            lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", f"{_CUT} "), "\n", f"{_CUT}\n"), _CUT)
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        return self._joined(lists.values, lists.offsets.to_numpy())

    def _rows(self, texts: list[str]) -> list[bytes]:
        """Any texts."""
        flat, ends = [], [0]
        for t in texts:
            if self.spaced:
                first, *more = space_segments(t)
                flat.append(first)
                flat += [f" {x}" for x in more]
            else:
                flat += words(t)
            ends.append(len(flat))
        return self._joined(pa.array(flat, pa.string()), np.array(ends))

    def _joined(self, flat: pa.Array, ends: np.ndarray) -> list[bytes]:
        """Ids of texts from those of their segments; ends: where each text's segments begin, and the end of the last one's."""
        numbered = flat.dictionary_encode()
        ids, size = self._segments(numbered.dictionary)
        index = numbered.indices.to_numpy()
        each = size[index]
        raw = gathered(ids, (np.cumsum(size) - size)[index], each).tobytes()
        cut = (np.concatenate([[0], np.cumsum(each)])[ends] * self.width).tolist()
        return [raw[b:e] for b, e in zip(cut, cut[1:], strict=False)]


def library_encoder(vocabulary: str, spaced: bool, entries: int = CACHE_ENTRIES) -> CachedEncoder:
    """The tokenizers library on the JSON file vocabulary, without special tokens, as unsigned 16-bit ids.

    Many segments go through the library as one text, which costs half of one call each.  Their borders show in the ids: of
    segments after a space, the first token alone begins with a space; between others stands a token that none of them holds.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    t.encode_special_tokens = True
    if t.get_vocab_size() > 65_536:
        raise ValueError("16-bit ids can't hold this vocabulary")

    def ids(text: str) -> np.ndarray:
        return np.array(t.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")

    between = "\n" if spaced else " | "
    opens, borders = np.zeros(65_536, bool), np.zeros(65_536, bool)
    (border,) = ids(between).tolist()
    borders[border] = True
    if spaced:
        space = t.encode(" ", add_special_tokens=False).tokens[0]
        opens[[i for token, i in t.get_vocab().items() if token.startswith(space)]] = True
    edge = f"\n {RARE_SPACE}" + "|" * (not spaced)
    #: One space, then no other space or line feed; no line feed or space (spaced) or bar, nor white space at either end.
    led = r"\A [^ \n]+\z" if spaced else None
    unled = f"\\A[^{edge}](?:[^ \n{'' if spaced else '|'}]*[^{edge}])?\\z"

    def joint(some: pa.Array, opening: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(some), 1024):
            part = some[i : i + 1024].to_pylist()
            found = ids("".join(part) if opening else between.join(["", *part]))
            at = np.flatnonzero((opens if opening else borders)[found])
            if len(at) != len(part) or at[0]:
                raise AssertionError("segments can't be told apart")
            size = np.diff(at, append=len(found))
            yield (found, size) if opening else (np.delete(found, at), size - 1)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ways = [pc.match_substring_regex(texts, unled).to_numpy(zero_copy_only=False)]
        ways.insert(0, pc.match_substring_regex(texts, led).to_numpy(zero_copy_only=False) if led else np.zeros(len(texts), bool))
        ways.append(~(ways[0] | ways[1]))
        some, others, alone = (texts.filter(pa.array(w)) for w in ways)
        done = [*joint(some, True), *joint(others, False), *((x := ids(s), np.array([len(x)])) for s in alone.to_pylist())]
        order = np.concatenate([np.flatnonzero(w) for w in ways])
        found, sizes = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        begin, size = np.empty((2, len(texts)), np.int64)
        begin[order], size[order] = np.cumsum(sizes) - sizes, sizes
        return gathered(found, begin, size), size

    return CachedEncoder(encode, spaced, width=2, entries=entries)


def worker_encoder(vocabulary: str, spaced: bool, entries: int = CACHE_ENTRIES) -> CachedEncoder:
    """The encoder that this worker keeps from task to task, until another operator or vocabulary takes its place."""
    if (key := (vocabulary, spaced, entries)) not in KEPT:
        KEPT.clear()
        KEPT[key] = library_encoder(vocabulary, spaced, entries)
    return KEPT[key]


def slices(texts: pa.Array, size: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about size bytes: memory follows neither the batch nor the longest texts' number."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(upto):
        before = int(upto[begin - 1]) if begin else 0
        end = min(len(upto), int(np.searchsorted(upto, before + size)) + 1)
        yield begin, end
        begin = end
