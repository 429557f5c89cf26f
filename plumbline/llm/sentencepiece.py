"""SentencePiece encoding and decoding: the best-scored path through the pieces of a Unigram
vocabulary, found over a double-array trie, with byte fallback and whitespace markers."""

from __future__ import annotations

import struct
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import slices, small_batches, strings, with_text

#: Piece types of a model file, and the marker that stands for a blank (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MARKER = "▁"
#: Bytes of text that are searched at once.
PIECE = 1 << 20
#: How far an unknown character's score lies below the worst piece (fixed value).
UNKNOWN_PENALTY = 10.0

SPACE, NEWLINE = 0x20, 0x0A


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a serialised message: numbers, floats and byte strings."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        elif tag & 7 == 2:
            size, at = number(at)
            value, at = raw[at : at + size], at + size
        else:
            size = 4 if tag & 7 == 5 else 8
            value, at = struct.unpack("<f" if size == 4 else "<d", raw[at : at + size])[0], at + size
        yield tag >> 3, value


@dataclass(frozen=True)
class Pieces:
    """The vocabulary: text (with blanks for markers), score and type of each id."""

    text: list[bytes]
    score: list[float]
    kind: list[int]

    @classmethod
    def load(cls, path: str) -> Pieces:
        with open(path, "rb") as file:
            raw = file.read()
        text, score, kind = [], [], []
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                text.append(piece.get(1, b"").decode().replace(MARKER, " ").encode())
                score.append(float(piece.get(2, 0.0)))
                kind.append(piece.get(3, NORMAL))
        return cls(text, score, kind)


class DoubleArray:
    """A trie in two arrays: from node s the byte c leads to base[s] + c + 1 if check says so.
    value[s] is the id of the piece that ends at s, or -1."""

    def __init__(self, keys: Iterable[tuple[bytes, int]]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in keys:
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = value
        base, check, value = {0: 0}, {0: 0}, {0: ends[0]}
        used = bytearray(8 * len(children) + 4096)
        used[0] = 1
        free = dense = 1  # the first free place; where the search for larger families goes on
        todo = deque([(0, 0)])
        while todo:
            node, place = todo.popleft()
            codes = sorted(children[node])
            if not codes:
                continue
            while used[free]:
                free += 1
            at = max(1, free - codes[0] - 1)
            if len(codes) > 1 or used[at + codes[0] + 1]:
                at = dense
                while any(used[at + c + 1] for c in codes):
                    at += 1
                dense = at
            base[place] = at
            for c in codes:
                child, to = children[node][c], at + c + 1
                used[to], check[to], value[to] = 1, place, ends[child]
                todo.append((child, to))
            if at + 1024 > len(used):
                used.extend(bytes(len(used)))
        size = len(used)
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        for array, filled in ((self.base, base), (self.check, check), (self.value, value)):
            array[np.fromiter(filled, np.int64)] = np.fromiter(filled.values(), np.int32)

    def walk(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next node of each node, -1 where there is none."""
        to = self.base[node] + code + 1
        return np.where((self.check[to] == node) & (to > 0), to, -1)


class Encoder:
    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        regular = [i for i, k in enumerate(pieces.kind) if k in (NORMAL, USER_DEFINED) and pieces.text[i]]
        normal = [pieces.score[i] for i in regular if pieces.kind[i] == NORMAL]
        worst, best = min(normal, default=0.0), max(normal, default=0.0)
        self.score = np.array(
            [
                len(t.decode()) * best - 0.1 if k == USER_DEFINED else s
                for t, s, k in zip(pieces.text, pieces.score, pieces.kind, strict=True)
            ]
        )
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.unknown = pieces.kind.index(UNKNOWN)
        byte_ids = [i for i, k in enumerate(pieces.kind) if k == BYTE]
        self.byte_ids = np.array(byte_ids, np.int32) if len(byte_ids) == 256 else None
        self.trie = DoubleArray((pieces.text[i], i) for i in regular)
        self.depth = max((len(pieces.text[i]) for i in regular), default=0)
        # A piece with a blank after something else would cross the cuts of _units.
        self.cut_words = not any(b" " in pieces.text[i].lstrip(b" ") for i in regular)
        self.cut_lines = not any(b"\n" in pieces.text[i] for i in regular)
        decoded = list(pieces.text)
        for value, i in enumerate(byte_ids):
            decoded[i] = bytes([value])
        for i, kind in enumerate(pieces.kind):
            if kind in (CONTROL, UNKNOWN):
                decoded[i] = b" \xe2\x81\x87 " if kind == UNKNOWN else b""
        self.decoded = decoded

    def _units(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Offsets that no piece crosses: text starts, blanks after something else, line ends."""
        cut = np.zeros(len(raw) + 1, bool)
        cut[starts[starts < len(raw)]] = True
        if self.cut_words:
            blank = raw == SPACE
            cut[1:-1] |= blank[1:] & ~blank[:-1]
        if self.cut_lines:
            line = raw == NEWLINE
            cut[:-1] |= line
            cut[1:] |= line
        cut[-1] = False
        return np.flatnonzero(cut)

    def encode(self, texts: pa.StringArray) -> pa.ListArray:
        """The ids of each text. A text is cut into units that no piece crosses, each different
        unit is searched once, and the paths are put together again."""
        blank, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        marked = pc.replace_substring(texts, MARKER, " ")
        marked = pc.if_else(
            pc.equal(marked, nothing), nothing, pc.binary_join_element_wise(blank, marked, nothing)
        )
        ends = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + len(marked) + 1]
        raw = np.frombuffer(marked.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        if not len(raw):
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.int32()))
        units = self._units(raw, ends[:-1])
        bounds = np.append(units, len(raw))
        ids, sizes = [], []
        group = units // PIECE  # a very long text is searched part by part
        for k in np.unique(group):
            few = np.flatnonzero(group == k)
            part = bounds[few[0] : few[-1] + 2]
            found, count = self._search(raw[part[0] : part[-1]], (part - part[0]).astype(np.int32))
            ids.append(found)
            sizes.append(count)
        before = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        offsets = before[np.searchsorted(units, ends)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))

    def _search(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after another, and how many each has."""
        array = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(raw.tobytes()))
        coded = array.dictionary_encode()
        which = coded.indices.to_numpy()
        ids, starts = self._paths(coded.dictionary)
        sizes = np.diff(starts)[which]
        stops = np.cumsum(sizes)
        return ids[np.arange(stops[-1]) + np.repeat(starts[which] - (stops - sizes), sizes)], sizes

    def _paths(self, units: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best paths through all units, and where each unit's ids start."""
        bounds = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1].astype(np.int64)
        raw = np.frombuffer(units.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        n = len(raw)
        first = np.repeat(bounds[:-1], np.diff(bounds)).astype(np.int32)  # of the unit of each byte
        left = (np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)).astype(np.int32)  # to its end
        head = (raw & 0xC0) != 0x80
        width = np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))

        # All pieces from all positions, one byte deeper at a time.
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.flatnonzero(head)
        node = np.zeros(len(at), np.int32)
        known = np.zeros(n, bool)
        for depth in range(1, self.depth + 1):
            inside = left[at] >= depth
            at, node = at[inside], node[inside]
            node = self.trie.walk(node, raw[at + depth - 1].astype(np.int32))
            alive = node >= 0
            at, node = at[alive], node[alive]
            if not len(at):
                break
            piece = self.trie.value[node]
            ending = piece >= 0
            found.append((at[ending].astype(np.int32), piece[ending]))
            known[at[ending & (width[at] == depth)]] = True
        strange = np.flatnonzero(head & ~known).astype(np.int32)
        while len(found) < 4:
            found.append((np.zeros(0, np.int32), np.zeros(0, np.int32)))
        for size in range(1, 5):
            here = strange[width[strange] == size]
            start, piece = found[size - 1]
            found[size - 1] = (np.append(start, here), np.append(piece, np.full(len(here), -1, np.int32)))

        # Edges by the distance of their end from the start of their unit, longer ones first: of
        # equal scores the one that starts first stays.
        start = np.concatenate([s for s, _ in reversed(found)])
        piece = np.concatenate([p for _, p in reversed(found)])
        size = np.concatenate([np.full(len(s), d, np.int32) for d, (s, _) in reversed(list(enumerate(found, 1)))])
        end = start + size
        far = end - first[start]
        far = far.astype(np.uint16) if far.max() < 1 << 16 else far
        order = np.argsort(far, kind="stable")
        start, piece, size, end, far = (x[order] for x in (start, piece, size, end, far))
        del order, found
        score = np.where(piece >= 0, self.score[piece], self.unknown_score)
        # Ends lie one after the last byte of their edge, so each unit has slots of its own.
        best = np.full(n, -np.inf)
        back = np.full(n, -1, np.int32)
        group = np.flatnonzero((np.diff(far.astype(np.int64), prepend=-1) != 0) | (np.diff(size, prepend=-1) != 0))
        for a, b in zip(group, np.append(group[1:], len(start)), strict=True):
            s, e = start[a:b], end[a:b] - 1
            total = score[a:b] + np.where(s > first[s], best[s - 1], 0.0)
            better = total > best[e]
            e = e[better]
            best[e] = total[better]
            back[e] = np.arange(a, b)[better]
        taken = np.zeros(n, bool)
        here = bounds[1:][np.diff(bounds) > 0] - 1
        while len(here):
            taken[here] = True
            s = start[back[here]]
            here = s[s > first[s]] - 1
        path = back[np.flatnonzero(taken)]
        chosen, begin, length = piece[path], start[path], size[path]
        unit = np.searchsorted(bounds, begin, side="right") - 1
        if self.byte_ids is None:
            ids, each = np.where(chosen >= 0, chosen, self.unknown), np.ones(len(path), np.int64)
        else:
            each = np.where(chosen >= 0, 1, length)
            stops = np.cumsum(each)
            within = np.arange(stops[-1]) - np.repeat(stops - each, each)
            ids = np.repeat(chosen, each)
            unknown = ids < 0
            ids[unknown] = self.byte_ids[raw[(np.repeat(begin, each) + within)[unknown]]]
        counts = np.bincount(unit, weights=each, minlength=len(bounds) - 1).astype(np.int64)
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: Iterable[int]) -> str:
        """Markers become blanks, byte pieces bytes, and the marker before the first word goes.
        Bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.decoded.__getitem__, ids))
        return raw.decode(errors="replace").removeprefix(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(Pieces.load(path))


def _encode(path: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        low, high = (int(coder.byte_ids[0]), int(coder.byte_ids[-1])) if coder.byte_ids is not None else (1, 0)
        for batch in slices(with_text(batches, text), "text"):
            texts = strings(batch.column("text"))
            ids = coder.encode(texts)
            flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
            decoded = [coder.decode(flat[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            fallback = np.concatenate([[0], np.cumsum((flat >= low) & (flat <= high))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array((fallback[offsets[1:]] - fallback[offsets[:-1]]).astype(np.int64)),
                    ids,
                    pa.array(decoded, pa.string()),
                ],
                ["row", "n_tokens", "n_bytes", "ids", "decoded"],
            )

    return run


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """One row per row of `docs`: struct `row`, `ids`, `n_tokens`, `n_bytes` (tokens that are single
    bytes of characters no piece holds) and `decoded` (the text the ids stand for).

    `path` is the model file, which every worker opens. The model's pieces and scores are taken
    as they are; the text is not normalised otherwise than by the marker before the first word
    (models with an identity rule). So `decoded` is the text itself, but for literal markers,
    which become blanks. Scores add up in double precision; of equally good paths the one with the
    longer last piece wins, from the end on. A null or empty text has no ids.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))
    more = "n_tokens long, n_bytes long, ids array<int>, decoded string"
    schema = StructType([rows.schema["row"], *StructType.fromDDL(more)])
    return rows.mapInArrow(_encode(path, text), schema)
