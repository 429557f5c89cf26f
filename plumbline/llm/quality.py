"""Quality classifier by attention-based multiple-instance learning: every passage of a text is
encoded, gated attention weighs the passages, and the weighted sum is scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import slices, small_batches, strings, with_text
from plumbline.llm.shingles import _BLANK, _LETTER, PIECE, pieces, text_bytes

PASSAGE = 64
#: Bound of the training sample: documents of each label.
TRAIN = 1500
#: Passages of a document to learn from.
TRAIN_PASSAGES = 256
HIDDEN, GATE, ROUNDS, RATE, DECAY = 24, 12, 300, 0.02, 1e-4
THRESHOLD = 0.3
SEED = 7

#: Classes of bytes whose shares in a passage are features: letters, digits, blanks, line ends, bytes
#: beyond ASCII, control characters, and each ASCII sign by itself.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_classes() -> tuple[np.ndarray, int]:
    of = np.full(256, 6, np.int64)
    of[97:123], of[65:91], of[48:58], of[128:] = 0, 1, 2, 5
    of[[32, 9]], of[[10, 13]] = 3, 4
    for k, sign in enumerate(_SIGNS):
        of[ord(sign)] = 7 + k
    return of, 7 + len(_SIGNS)


_CLASS, CLASSES = _byte_classes()
FEATURES = CLASSES + 7


def passages(texts: pa.LargeStringArray, words_each: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (rows) of all texts, and where each text's passages start. A
    passage is `words_each` words with what follows them; a text without words is one passage.
    Very long texts are cut at blanks every few MB and worked on part by part."""
    raw, ends = text_bytes(texts)
    parts = [np.array([0]), *(_parts(raw[a:b]) + a for a, b in zip(ends[:-1], ends[1:], strict=True))]
    cuts = np.concatenate(parts)  # each text ends one or more parts
    found, offsets = [], [0]
    group = np.cumsum(np.diff(cuts)) // PIECE
    for k in np.unique(group):
        few = np.flatnonzero(group == k)
        bounds = np.append(cuts[few], cuts[few[-1] + 1])
        x, starts = _passages(raw[bounds[0] : bounds[-1]], bounds - bounds[0], words_each)
        found.append(x)
        offsets += (starts[1:] + offsets[-1]).tolist()
    last = np.cumsum([len(p) for p in parts[1:]], dtype=np.int64)  # parts up to each text
    at = np.array(offsets, np.int64)[np.concatenate([[0], last]).astype(np.int64)]
    return np.concatenate(found) if found else np.zeros((0, FEATURES)), at


def _parts(raw: np.ndarray) -> np.ndarray:
    return pieces(raw, np.array([0, len(raw)]))[1:]


def _passages(raw: np.ndarray, ends: np.ndarray, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(ends) - 1
    blank = _BLANK[raw]
    start = ~blank
    start[1:] &= blank[:-1]
    heads = ends[:-1][np.diff(ends) > 0]
    start[heads] |= ~blank[heads]
    begins = np.flatnonzero(start)
    doc_of_word = np.searchsorted(ends, begins, side="right") - 1
    count = np.bincount(doc_of_word, minlength=n)
    each = np.maximum(1, -(-count // words_each))
    offsets = np.concatenate([[0], np.cumsum(each)])
    total = int(offsets[-1])
    place = np.arange(len(begins)) - np.concatenate([[0], np.cumsum(count)])[doc_of_word]
    passage = offsets[doc_of_word] + place // words_each
    # A byte belongs to the passage of the last word that has begun in its text, or to the first.
    words_before = np.cumsum(start)
    first_word = np.concatenate([[0], np.cumsum(count)])
    doc_of_byte = np.repeat(np.arange(n), np.diff(ends))
    nth = np.maximum(words_before - 1 - first_word[doc_of_byte], 0)
    of_byte = offsets[doc_of_byte] + np.minimum(nth // words_each, each[doc_of_byte] - 1)

    out = np.zeros((total, FEATURES))
    tally = np.bincount(of_byte * CLASSES + _CLASS[raw], minlength=total * CLASSES).reshape(total, CLASSES)
    size = np.maximum(tally.sum(axis=1), 1)
    out[:, :CLASSES] = np.sqrt(tally / size[:, None])
    if len(begins):
        words = np.maximum(np.bincount(passage, minlength=total), 1)
        length = np.add.reduceat(~blank, begins, dtype=np.int64)
        value = np.add.reduceat(np.where(blank, np.uint64(0), _LETTER[raw]), begins)
        mean = np.bincount(passage, weights=length, minlength=total) / words
        square = np.bincount(passage, weights=length.astype(float) ** 2, minlength=total) / words
        order = np.lexsort((value, passage))
        new = np.ones(len(order), bool)
        new[1:] = (value[order][1:] != value[order][:-1]) | (passage[order][1:] != passage[order][:-1])
        again = np.zeros(len(begins))
        again[1:] = (value[1:] == value[:-1]) & (passage[1:] == passage[:-1])
        upper = (raw[begins] >= 65) & (raw[begins] <= 90)
        tail = np.append(begins[1:], len(raw)) - 1
        sign = _CLASS[raw[np.minimum(begins + length - 1, tail)]] >= 7
        columns = (
            np.log1p(mean),
            np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
            np.bincount(passage[order], weights=new, minlength=total) / words,
            np.bincount(passage, weights=again, minlength=total) / words,
            np.bincount(passage, weights=upper, minlength=total) / words,
            np.bincount(passage, weights=sign, minlength=total) / words,
            np.log1p(np.bincount(passage, minlength=total)) / np.log1p(words_each),
        )
        out[:, CLASSES:] = np.stack(columns, axis=1)
    return out, offsets


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """encode: passage to hidden; tanh and gate: the two halves of the attention; attend: their
    product to one weight; score: hidden to the result."""

    mean: np.ndarray
    scale: np.ndarray
    part: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict]:
        p, starts, sizes = self.part, offsets[:-1], np.diff(offsets)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        hidden = np.tanh(x @ p["encode"] + p["encode0"])
        left, gate = np.tanh(hidden @ p["tanh"]), _sigmoid(hidden @ p["gate"])
        weight = (left * gate) @ p["attend"]
        weight = np.exp(weight - np.repeat(np.maximum.reduceat(weight, starts), sizes))
        weight /= np.repeat(np.add.reduceat(weight, starts), sizes)
        bag = np.add.reduceat(weight[:, None] * hidden, starts)
        return _sigmoid(bag @ p["score"] + p["score0"]), {
            "x": x, "hidden": hidden, "left": left, "gate": gate, "weight": weight, "bag": bag
        }

    def scores(self, texts: pa.LargeStringArray) -> np.ndarray:
        x, offsets = passages(texts)
        return self.forward(x, offsets)[0] if len(texts) else np.zeros(0)


def fit(x: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> Model:
    """Adam on the whole sample. The documents of both labels weigh alike."""
    rng = np.random.default_rng(SEED)
    shape = {"encode": (FEATURES, HIDDEN), "tanh": (HIDDEN, GATE), "gate": (HIDDEN, GATE)}
    part = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in shape.items()}
    part |= {"attend": rng.normal(0, GATE**-0.5, GATE), "score": rng.normal(0, HIDDEN**-0.5, HIDDEN)}
    part |= {"encode0": np.zeros(HIDDEN), "score0": np.zeros(1)}
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = x.std(axis=0) + 0.05 if len(x) else np.ones(FEATURES)
    model = Model(mean, scale, part)
    classes = np.bincount(label.astype(int), minlength=2)
    if classes.min() == 0:  # nothing to tell apart: the score is the share of label 1, or a half
        part["score"][:] = 0
        part["score0"][:] = 0 if classes.max() == 0 else 4 if classes[1] else -4
        return model
    share = (0.5 / classes)[label.astype(int)]
    sizes, starts = np.diff(offsets), offsets[:-1]
    first = {k: np.zeros_like(v) for k, v in part.items()}
    second = {k: np.zeros_like(v) for k, v in part.items()}
    for step in range(1, ROUNDS + 1):
        score, s = model.forward(x, offsets)
        error = (score - label) * share
        grad = {"score": s["bag"].T @ error, "score0": np.array([error.sum()])}
        d_bag = np.repeat(error[:, None] * part["score"], sizes, axis=0)
        along = (d_bag * s["hidden"]).sum(axis=1)
        mean_along = np.repeat(np.add.reduceat(s["weight"] * along, starts), sizes)
        d_weight = s["weight"] * (along - mean_along)
        grad["attend"] = (s["left"] * s["gate"]).T @ d_weight
        d_both = d_weight[:, None] * part["attend"]
        d_left = d_both * s["gate"] * (1 - s["left"] ** 2)
        d_gate = d_both * s["left"] * s["gate"] * (1 - s["gate"])
        grad["tanh"], grad["gate"] = s["hidden"].T @ d_left, s["hidden"].T @ d_gate
        d_hidden = s["weight"][:, None] * d_bag + d_left @ part["tanh"].T + d_gate @ part["gate"].T
        d_in = d_hidden * (1 - s["hidden"] ** 2)
        grad["encode"], grad["encode0"] = s["x"].T @ d_in, d_in.sum(axis=0)
        for k, g in grad.items():
            g = g + DECAY * part[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            part[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 != 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x, offsets = passages(strings(batch.column("text")))
        x = x.astype(np.float32)
        bags = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            some = np.linspace(a, b - 1, min(b - a, TRAIN_PASSAGES)).astype(np.int64)
            bags.append(x[some].tobytes())
        columns = [batch.column("place"), batch.column("label"), batch.column("text_hash"), pa.array(bags, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "label", "text_hash", "bag"])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """Learn from at most TRAIN labelled documents of each label, chosen by a hash of their id among
    those that are not held out, and from at most TRAIN_PASSAGES passages of each, evenly spread. Rows with
    one id and one text count once; an id held by many texts does not go beyond the bound. The chosen
    ids, at most a few thousand, are broadcast; only the passages' features reach the driver. A document with
    several labels has their mean."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learnable(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .withColumn("place", F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30)) / (1 << 30))
    )
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    share = [min(1.0, TRAIN / counts[k]) if k in counts else 0.0 for k in (0, 1)]
    chosen = known.where(F.col("place") < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = rows.join(F.broadcast(chosen), "id").select("place", "label", F.xxhash64("text").alias("text_hash"), "text")
    schema = "place double, label int, text_hash long, bag binary"
    different = sample.mapInArrow(_features, schema).dropDuplicates(["place", "label", "text_hash"])
    first = Window.partitionBy("label").orderBy("place", "text_hash")
    bounded = different.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TRAIN)
    found = sorted((r["place"], r["label"], bytes(r["bag"])) for r in bounded.select("place", "label", "bag").collect())
    bags = [np.frombuffer(bag, np.float32).reshape(-1, FEATURES) for _, _, bag in found]
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES))
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    return fit(x, offsets, np.array([y for _, y, _ in found], np.float64))


def _score(model, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(with_text(batches, text), "text"):
            scores = model.value.scores(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores)], ["row", "score"])

    return run


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """One row per row of `docs`: struct `row` and `score` (0 to 1, higher: label 1 is likelier).

    Every passage of every whole text is encoded; labels, ids, languages and sources are no input. A
    null or empty text, or one of blanks only, is one passage without words. The model is a few
    thousand numbers, whatever the input.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"))
    schema = StructType([rows.schema["row"], *StructType.fromDDL("score double")])
    return rows.mapInArrow(_score(sent, text), schema)
