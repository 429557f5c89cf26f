"""Token counts of whole texts with a byte-level BPE vocabulary. Huge texts are encoded in
overlapping chunks that are spliced where both encodings provably agree with that of the whole."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import slices, small_batches, strings

#: Bytes of a chunk of a huge text, and by how much it reaches into the next one at first.
CHUNK = 32 << 10
OVERLAP = 1 << 10
LIMIT = 1024

#: The pre-tokenizer's pattern of byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A place where the pattern always starts anew: a blank after something else.
_EDGE = re.compile(rb"(?<=[!-~])[ \n]")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 letters
    stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file, for the faster of the installed encoders. Ids are the
    merge ranks, so both encode alike; special strings inside a text are one token, as there."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in piece): rank
        for piece, rank in spec["model"]["vocab"].items()
        if piece not in special
    }
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(coder: tiktoken.Encoding, text: str) -> list[int]:
    return coder.encode(text, allowed_special="all")


def _offsets(coder: tiktoken.Encoding, raw: bytes, start: int, end: int) -> tuple[list[int], np.ndarray]:
    """Tokens of raw[start:end] and the offset in `raw` at which each starts."""
    ids = encode(coder, raw[start:end].decode())
    sizes = [len(coder.decode_single_token_bytes(i)) for i in ids]
    return ids, start + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]) if ids else np.array([], np.int64)


def _char_start(raw: bytes, at: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(raw))


def _splice_at(raw: bytes, left: np.ndarray, right: np.ndarray, start: int, end: int) -> int | None:
    """The last offset in raw[start:end] at which a token of both encodings starts and the pattern
    always starts anew. A blank after a visible ASCII character ends every match before it and
    belongs to no special string, so tokens left of it depend on nothing to its right, and tokens
    right of it on nothing to its left."""
    common = np.intersect1d(left, right, assume_unique=True)
    edges = [start + m.start() for m in _EDGE.finditer(raw[start:end])]
    proven = np.intersect1d(common, edges)
    return int(proven[-1]) if len(proven) else None


def encode_spliced(
    coder: tiktoken.Encoding, text: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> list[int]:
    """The tokens of the whole text, made from overlapping chunks.

    If no proven boundary lies in an overlap (a long run without blanks), the left chunk is
    widened, twice as far each time, over the next chunks and in the end over the whole text.
    """
    raw = text.encode()
    if len(raw) <= chunk + overlap:
        return encode(coder, text)
    starts = [_char_start(raw, at) for at in range(0, len(raw), chunk)]
    span = lambda start, size: (start, _char_start(raw, min(len(raw), start + size)))
    out: list[int] = []
    begin, end = span(0, chunk + overlap)
    ids, at = _offsets(coder, raw, begin, end)
    for start in starts[1:]:
        reach, wide = _char_start(raw, min(len(raw), start + chunk + overlap)), overlap
        if reach <= end:  # a widened chunk has gone over this one
            continue
        next_ids, next_at = _offsets(coder, raw, start, reach)
        cut = _splice_at(raw, at, next_at, start, end)
        while cut is None and end < reach:
            wide *= 2
            end = _char_start(raw, min(reach, max(end, start) + wide))
            ids, at = _offsets(coder, raw, begin, end)
            cut = _splice_at(raw, at, next_at, start, end)
        if cut is None:
            continue
        out += ids[: int(np.searchsorted(at, cut))]
        first = int(np.searchsorted(next_at, cut))
        begin, end, ids, at = cut, reach, next_ids[first:], next_at[first:]
    return out + ids


RESULTS = ("n_bytes", "n_tokens", "over_limit")
WHOLE = "__text__"


def _count(path: str, keep: list[str], limit: int, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in slices(batches, WHOLE):
            texts = strings(batch.column(WHOLE))
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            counts = np.array(
                [
                    len(encode(coder, t) if n <= chunk + overlap else encode_spliced(coder, t, chunk, overlap))
                    for t, n in zip(texts.to_pylist(), sizes, strict=True)
                ],
                dtype=np.int64,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts),
                    pa.array(counts > limit),
                ],
                [*keep, *RESULTS],
            )

    return run


def count_tokens(
    docs: DataFrame,
    path: str,
    keep: list[str],
    text: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The columns `keep` of every row, `n_bytes` (UTF-8), `n_tokens` and `over_limit`. A kept column of
    one of these names has `_` after it.

    `path` is the vocabulary file, which every worker opens (the package that holds it is
    installed there). No begin, end or padding tokens; a special string inside a text is one
    token. A null or empty text has none. Rows are independent of each other: no shuffle.
    """
    small_batches(docs.sparkSession)
    names = [f"{c}_" if c in RESULTS else c for c in keep]
    kept = docs.select(*(F.col(c).alias(name) for c, name in zip(keep, names, strict=True)))
    rows = docs.select(*(F.col(c).alias(name) for c, name in zip(keep, names, strict=True)), F.col(text).alias(WHOLE))
    schema = StructType([*kept.schema, *StructType.fromDDL("n_bytes long, n_tokens long, over_limit boolean")])
    return rows.mapInArrow(_count(path, names, limit, chunk, overlap), schema)
