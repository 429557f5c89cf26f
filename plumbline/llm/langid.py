"""Language identification with string kernels: blended-spectrum n-gram presence kernels, Nyström
landmarks and one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import slices, small_batches, strings, with_text
from plumbline.llm.shingles import PIECE, text_bytes

#: Columns for the hashed n-grams of 1, 2 and 3 bytes: one block for each size.
BLOCKS = (256, 2048, 8192)
WIDTH = sum(BLOCKS)
#: Bounds of the training sample: documents and landmarks of a language, documents in all.
TRAIN, LANDMARKS, TRAIN_ALL = 600, 32, 6000
RIDGE = 1e-3
#: The kernel is a power of the cosine of each block, summed over the blocks.
POWER = 2
ROWS = 256
UNDETERMINED = "und"

#: ASCII letters in lower case, all other ASCII a blank, other bytes as they are.
_FOLD = np.array(
    [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint32
)


def presence(texts: pa.LargeStringArray) -> np.ndarray:
    """One row of zeros and ones for each text: which n-grams it holds, anywhere in it."""
    raw, ends = text_bytes(texts)
    out = np.zeros((len(ends) - 1, WIDTH), np.uint8)
    for a in range(0, len(raw), PIECE):  # parts overlap by what an n-gram reaches ahead
        b = min(len(raw), a + PIECE + len(BLOCKS) - 1)
        _mark(out, raw[a:b], np.clip(ends, a, b) - a)
    return out


def _mark(out: np.ndarray, raw: np.ndarray, ends: np.ndarray) -> None:
    letters = _FOLD[raw]
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(raw))
    code, base = np.zeros(len(raw), np.uint32), 0
    for size, width in enumerate(BLOCKS, 1):
        inside = left >= size
        code = code[: len(raw) - size + 1] * np.uint32(257) + letters[size - 1 :] if len(raw) >= size else code[:0]
        at = code if size == 1 else (code * np.uint32(2654435761)) >> np.uint32(32 - (width.bit_length() - 1))
        inside = inside[: len(at)]
        out[row[: len(at)][inside], base + at[inside].astype(np.int64)] = 1
        base += width


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over the blocks of the powers of the cosine of two presence rows, by matrix products."""
    out, base = np.zeros((len(x), len(y)), np.float32), 0
    for width in BLOCKS:
        a, b = (m[:, base : base + width].astype(np.float32) for m in (x, y))
        norms = np.sqrt(np.outer(a.sum(axis=1), b.sum(axis=1)))
        out += (a @ b.T / np.maximum(norms, 1)) ** POWER
        base += width
    return out / len(BLOCKS)


@dataclass(frozen=True)
class Model:
    """Presence rows of the landmarks, and the weight of each landmark for each language."""

    landmarks: np.ndarray
    weights: np.ndarray
    names: list[str]

    def outputs(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [kernel(x[i : i + ROWS], self.landmarks) @ self.weights for i in range(0, len(x), ROWS)]
        ) if len(x) else np.zeros((0, len(self.names)), np.float32)


def fit(x: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Rows come in a random order; the first ones of each language are its landmarks."""
    names = sorted(set(langs))
    which = np.array([names.index(name) for name in langs], np.int64)
    marks = np.concatenate([np.flatnonzero(which == k)[:landmarks] for k in range(len(names))] or [[]]).astype(int)
    if not len(marks):
        return Model(np.zeros((0, WIDTH), np.uint8), np.zeros((0, 0), np.float32), [])
    values, vectors = np.linalg.eigh(kernel(x[marks], x[marks]).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    z = np.concatenate([kernel(x[i : i + ROWS], x[marks]) for i in range(0, len(x), ROWS)]) @ root
    target = np.where(which[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = 1 / np.bincount(which, minlength=len(names))[which]  # every language counts alike
    left = z.T @ (z * share[:, None]) + ridge * np.eye(z.shape[1])
    beta = np.linalg.solve(left, z.T @ (target * share[:, None]))
    return Model(x[marks], (root @ beta).astype(np.float32), names)


def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 != 1


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        bits = np.packbits(presence(strings(batch.column("text"))), axis=1)
        rows = pa.array([r.tobytes() for r in bits], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), rows], ["lang", "place", "bits"])


def train(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang") -> Model:
    """Learn from a sample of the rows in `usable` that have a text and a language: of each language the TRAIN
    different texts with the least hashes, but TRAIN_ALL in all (and never less than two of a language).

    Copies of a text count once, so a language of few texts held by many rows is learned from all of
    them, and no text held by very many rows fills the sample. Hashes are shuffled, not texts; only the
    presence bits of the chosen texts reach the driver."""
    rows = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(F.lit(10), F.col(text)).alias("place"), F.col(text).alias("text")
    )
    places = rows.select("lang", "place").distinct()
    n_langs = rows.select("lang").distinct().count()
    quota = min(TRAIN, max(2, TRAIN_ALL // max(1, n_langs)))
    first = Window.partitionBy("lang").orderBy("place")
    chosen = places.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= quota).drop("rank")
    sample = rows.join(F.broadcast(chosen), ["lang", "place"])  # about TRAIN_ALL rows of two values
    packed = sample.select("lang", "place", "text").mapInArrow(_packed, "lang string, place long, bits binary")
    found = sorted(
        (r["place"], r["lang"], bytes(r["bits"])) for r in packed.dropDuplicates(["lang", "place"]).collect()
    )
    x = np.array([np.unpackbits(np.frombuffer(bits, np.uint8), count=WIDTH) for _, _, bits in found], np.uint8)
    return fit(x.reshape(-1, WIDTH), [name for _, name, _ in found])


def _predict(model, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in slices(with_text(batches, text), "text"):
            texts = strings(batch.column("text"))
            outputs = known.outputs(presence(texts)) if known.names else np.zeros((len(texts), 1))
            letters = [any(map(str.isalpha, t)) for t in texts.to_pylist()]
            best = outputs.argmax(axis=1)
            score = np.clip((outputs[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(np.float64)
            sure = np.array(letters, bool) & bool(known.names)
            names = [known.names[k] if ok else UNDETERMINED for k, ok in zip(best, sure, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(np.where(sure, score, 0.0))],
                ["row", "lang_pred", "score"],
            )

    return run


def identify_languages(
    docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per row of `docs`: struct `row`, `lang_pred` and `score`.

    Languages are learned from the rows in `usable` (see `train`); every whole text is scored, by
    its text alone. The model is broadcast; its size is fixed by the number of landmarks. A
    null text, or one without letters, is `und` with score 0, as is all if nothing was learned.
    Of equal outputs the first language by name wins.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(train(docs, usable, text, lang))
    rows = docs.select(F.struct("*").alias("row"))
    schema = StructType([rows.schema["row"], *StructType.fromDDL("lang_pred string, score double")])
    return rows.mapInArrow(_predict(model, text), schema)
