"""Word shingles as 64-bit hashes, computed for a whole slice of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text that arrays of several bytes a byte are made for at once.
PIECE = 4 << 20

_U = np.uint64
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_RADIX = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A random 64-bit number for each byte.
_LETTER = mix(np.arange(1, 257, dtype=_U) * _RADIX)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offsets of the texts."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def pieces(raw: np.ndarray, ends: np.ndarray, size: int = PIECE) -> np.ndarray:
    """Offsets that cut the bytes into pieces of about `size` at blanks or text starts, so that a
    very long text is never worked on at once; only a longer word stays whole."""
    if len(raw) <= size:
        return np.array([0, len(raw)], np.int64)
    out, blank = [0], _BLANK[raw]
    while len(raw) - out[-1] > size:
        at = out[-1] + size
        ahead = int(blank[at:].argmax()) if blank[at:].any() else len(raw) - at
        text = int(ends[np.searchsorted(ends, at)])
        out.append(min(at + ahead, text))
    return np.array([*out, len(raw)] if out[-1] < len(raw) else out, np.int64)


def word_spans(
    raw: np.ndarray, ends: np.ndarray, blank: np.ndarray = _BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins, its length in bytes and its hash, with A-Z lower-cased. `blank` marks the
    bytes outside of words; the ASCII blanks must be among them."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    cuts = pieces(raw, ends)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = raw[a:b]
        inside = ~blank[part]
        edge = np.zeros(len(part), bool)
        edge[ends[(ends >= a) & (ends < b)] - a] = True  # a text starts a word of its own
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:]
        begins = np.flatnonzero(start)
        if not len(begins):
            continue
        terms = _LETTER[_FOLD[part]]
        terms *= powers(_RADIX, len(part))
        terms[~inside] = 0
        words = np.add.reduceat(terms, begins) * powers(_INVERSE, len(part))[begins]
        del terms
        lengths = np.add.reduceat(inside, begins, dtype=np.int64)
        found.append((begins + a, lengths, mix(words ^ (lengths.astype(_U) * _U(0xD6E8FEB86659FD93)))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def shingle_sets(texts: pa.LargeStringArray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts one after another, and their offsets.

    A-Z lower-cased; words are runs without ASCII blanks; fewer than `size` words are one shingle,
    none is the empty set. A word's hash adds up a random number for each byte times a power
    for its place; a shingle's hash mixes the word hashes with a factor for each place.
    """
    raw, ends = text_bytes(texts)
    n = len(ends) - 1
    begins, _, words = word_spans(raw, ends)
    if not len(begins):
        return np.zeros(0, _U), np.zeros(n + 1, np.int64)

    doc = np.searchsorted(ends, begins, side="right") - 1
    count = np.bincount(doc, minlength=n)
    factor = mix(np.arange(1, size + 1, dtype=_U) * _INVERSE) | _U(1)
    total = np.zeros(len(words), _U)
    for k in range(min(size, len(words))):
        total[: len(words) - k] += words[k:] * factor[k]
    first = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(len(words)) - first[doc]
    hashes = mix(total)
    keep = place <= (count - size)[doc]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):  # the whole sequence, told from longer ones by its number of words
        for d in short:
            a, b = first[d], first[d + 1]
            hashes[a] = mix(((words[a:b] * factor[: b - a]).sum(dtype=_U) + _U(b - a)).reshape(1))[0]
        keep[first[short]] = True
    hashes, doc = hashes[keep], doc[keep]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(n + 1))
