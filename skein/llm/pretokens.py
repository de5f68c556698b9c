"""Pre-tokens of texts, split a block at a time; each distinct one is encoded once by the tokenizers library.

A tokenizer of this kind encodes each pre-token by itself, so a text's ids are
the ids of its pre-tokens in a row, and a pre-token need only be encoded once.
Splitting is done on whole blocks of text with array operations; the model of the
tokenizers library encodes all new pre-tokens of a block at once, and every
``Encoder`` holds the ids of its first texts against the library's own.
"""

from __future__ import annotations

import json
import os
from functools import cache

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Distinct pre-tokens that an Encoder keeps before it starts anew.
KEPT = 400_000
#: Pre-tokens that the library is given as one sequence of words.
TOGETHER = 4096
#: Bytes of texts whose ids are held against the library's, for each worker.
CHECKED = 1 << 16


@cache
def char_classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    import regex

    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0
    every = points.tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """The code points of UTF-8 bytes."""
    if not (data & 0x80).any():
        return data.astype(np.uint32)
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")


def utf8_lengths(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def _contractions(points: np.ndarray, free: np.ndarray, edge: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Places of apostrophes that begin a contraction, and the letters after each.

    free: where an apostrophe begins a pre-token. edge: where a text begins;
    its last entry stands for the end of the block.
    """
    at = np.flatnonzero((points == 39) & free)
    n = len(points)
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    edge = np.concatenate([edge, np.ones(3, bool)])
    one, two = padded[at + 1], padded[at + 2]
    inside = ~edge[at + 1]
    single = inside & np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), "<u4"))
    double = inside & ~edge[at + 2] & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
    assert not len(at) or at[-1] < n
    return [(at[single], 1), (at[double], 2)]


def split_byte_level(points: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where pre-tokens of the byte-level pattern begin; they cover the block.

    edge: where a text (or a part next to a special string) begins.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kinds = char_classes()[points]
    starts = edge[:n].copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    word = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~edge[1:n]) + 1
    starts[word - 1] = True  # the last white space before a word stands alone
    starts[word[points[word - 1] == 32]] = False  # or, if it is a blank, goes with the word
    for at, letters in _contractions(points, starts, edge):
        _cut_contractions(starts, at, letters, kinds, edge)
    return starts


def _cut_contractions(starts: np.ndarray, at: np.ndarray, letters: int, kinds: np.ndarray, edge: np.ndarray) -> None:
    starts[at + 1] = False
    after = at + 1 + letters
    after = after[after < len(starts)]
    after = after[(kinds[after] == LETTER) & ~edge[after]]
    starts[after] = True


def split_words(points: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """As split_byte_level, for the pattern of letters, single numbers and other runs.

    Runs of white space are pre-tokens here too; they have no ids.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kinds = char_classes()[points]
    starts = edge[:n].copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    starts |= kinds == NUMBER
    for at, letters in _contractions(points, starts, edge):
        _cut_contractions(starts, at, letters, kinds, edge)
    return starts


@cache
@cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabularies: printable Latin-1 as itself, others from U+0100 on."""
    hidden = iter(range(0x100, 0x200))
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(b) if b in printable else chr(next(hidden)) for b in range(256)}


@cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Encoder:
    """Ids of texts by a tokenizer file, each distinct pre-token encoded once while it is kept."""

    def __init__(self, path: str):
        self.library = library(path)
        # pre-tokens are split and normalised already, so only the library's model is asked for them
        self.model = type(self.library)(self.library.model)
        spec = json.loads(self.library.to_str())
        self.words = spec["normalizer"] is not None
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.checked = 0
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text of a block, without added ids."""
        ids, out = self._encode_words(data, offsets) if self.words else self._encode_bytes(data, offsets)
        self._check(data, offsets, ids, out)
        return ids, out

    def _encode_bytes(self, data, offsets):
        pretokens, edges = byte_level_pretokens(data, offsets, list(self.special))
        return self._gather(pretokens, edges)

    def _encode_words(self, data, offsets):
        points = code_points(data)
        raw = data.tobytes()
        odd = [x for x in self.special if x in raw]
        if len(points) and (odd or points.max() >= 0x300 or (points == 0x130).any()):
            return self._encode_odd_words(raw, offsets, odd)
        at = np.concatenate([[0], np.cumsum(utf8_lengths(points))])
        return self._gather(*word_pretokens(points, np.searchsorted(at, offsets)))

    def _encode_odd_words(self, raw, offsets, odd):
        """Texts beyond Latin letters are normalised, those with special strings encoded, by the library."""
        texts, own = [], {}
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            text = raw[a:b].decode("utf-8", "replace")
            if any(x in raw[a:b] for x in odd):
                own[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
                text = ""
            elif text and (max(text) >= "̀" or "İ" in text):
                text = self.library.normalizer.normalize_str(text)
            texts.append(text)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        ids, out = self._gather(*word_pretokens(points, np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)))
        if not own:
            return ids, out
        parts = [own.get(i, ids[out[i] : out[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts).astype(np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)

    def _gather(self, pretokens: pa.Array, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """pretokens of a block in order; edges: the first pre-token of each text, and their number."""
        coded = pretokens.dictionary_encode()
        at = self._places(coded.dictionary)
        place = at[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.starts[place] - (ends - sizes), sizes) + np.arange(total)
        return self.ids[source], np.concatenate([[0], ends])[edges]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        if len(self.known) > KEPT:
            self._clear()
        names = distinct.to_pylist()
        known = self.known
        out = np.fromiter((known.get(x, -1) for x in names), np.int64, len(names))
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = self._add([names[i] for i in new])
        return out

    def _add(self, names: list[bytes]) -> np.ndarray:
        ends = np.cumsum(np.fromiter(map(len, names), np.int64, len(names))).tolist()
        letters = b"".join(names).decode("latin-1").translate(byte_letters())
        words = [letters[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        # special strings have ids of their own, white space between words has none
        own = {i: self.special.get(x) for i, x in enumerate(names) if (not x.strip(b" ") if self.words else x in self.special)}
        plain = np.ones(len(names), bool)
        plain[list(own)] = False
        if own:
            words = [words[i] for i in np.flatnonzero(plain).tolist()]
        rows = [words[a : a + TOGETHER] for a in range(0, len(words), TOGETHER)]
        found = self.model.encode_batch(rows, is_pretokenized=True, add_special_tokens=False)
        sizes, starts = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        sizes[plain] = np.concatenate([np.zeros(0, np.int64), *(np.bincount(np.array(x.word_ids, np.int64), minlength=len(row)) for x, row in zip(found, rows, strict=True))])
        starts[plain] = np.cumsum(sizes[plain]) - sizes[plain]
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in found)])
        for i, special in own.items():
            if special is not None:
                starts[i], sizes[i], ids = len(ids), 1, np.append(ids, np.uint32(special))
        first = len(self.known)
        for name in names:
            self.known[name] = len(self.known)
        last = len(self.known)
        self.ids = _grown(self.ids, self.used + len(ids))
        self.starts, self.sizes = _grown(self.starts, last), _grown(self.sizes, last)
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[first:last] = self.used + starts
        self.sizes[first:last] = sizes
        self.used += len(ids)
        return np.arange(first, last)

    def _check(self, data, offsets, ids, out) -> None:
        """The library's word on a worker's first texts: that they are split as it splits them."""
        for i in range(len(offsets) - 1):
            size = int(offsets[i + 1] - offsets[i])
            if self.checked + size > CHECKED:
                return
            self.checked += size
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            if (got := ids[out[i] : out[i + 1]].tolist()) != (said := self.library.encode(text, add_special_tokens=False).ids):
                raise ValueError(f"ids of {text!r} are {got}, the library has {said}")


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def _binary(data: bytes | np.ndarray, starts: np.ndarray, end: int) -> pa.Array:
    offsets = np.append(starts, end).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def byte_level_pretokens(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of a block's texts, and the number of those before each text.

    A special string is a pre-token of its own; the text on either side of it
    is split as a text by itself.
    """
    data = np.ascontiguousarray(data)
    points = code_points(data)
    at = np.concatenate([[0], np.cumsum(utf8_lengths(points))])
    if at[-1] != len(data):
        raise ValueError("text is not valid UTF-8")
    n = len(points)
    edge = np.zeros(n + 1, bool)
    texts = np.searchsorted(at, offsets)
    edge[texts] = True
    raw, whole = data.tobytes(), []
    bounds = set(offsets.tolist())
    for mark in special:
        i = raw.find(mark)
        while i >= 0:
            if not any(b in bounds for b in range(i + 1, i + len(mark))):
                whole.append(np.searchsorted(at, [i, i + len(mark)]))
                i = raw.find(mark, i + len(mark))
            else:
                i = raw.find(mark, i + 1)
    for a, b in whole:
        edge[[a, b]] = True
    starts = split_byte_level(points, edge)
    for a, b in whole:
        starts[a + 1 : b] = False
    first = np.flatnonzero(starts)
    return _binary(data, at[first], len(data)), np.searchsorted(first, texts)


def word_pretokens(points: np.ndarray, texts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """As byte_level_pretokens, for normalised or plain Latin text given as code points."""
    n = len(points)
    points = _lowered()[points] if n else points
    edge = np.zeros(n + 1, bool)
    edge[texts] = True
    first = np.flatnonzero(split_words(points, edge))
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
    at = np.concatenate([[0], np.cumsum(utf8_lengths(points))])
    return _binary(data, at[first], len(data)), np.searchsorted(first, texts)


@cache
def _lowered() -> np.ndarray:
    """Lower case of each code point whose lower case is one code point; white space as a blank."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x300):
        if len(low := chr(i).lower()) == 1:
            out[i] = ord(low)
    out[char_classes() == SPACE] = 32
    return out


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)
