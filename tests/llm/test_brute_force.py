"""Digests, kernels and the attention network against plain loops that share no code with them."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import fingerprint, langid, quality


def some_texts(seed, n=12):
    rng = random.Random(seed)
    words = ["the", "und", "Été", "a", "MONEY!!", "x|y", "ñandú", "12", "…", "of", "der", "les", "wörter"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 150))) + rng.choice(["", "\n", " \t x"]) for _ in range(n)] + ["", "a", "ab", "abc"]


def arrow(texts):
    return pa.array(texts, pa.large_string())


# Fingerprints


def plain_digest(raw):
    counts = [0] * 256
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        mixed = (a * 40503 + b * 30011 + c * 10427) % 65536
        mixed ^= mixed >> 7
        counts[(mixed * 40503 % 65536) >> 8] += 1
    q1, q2, q3 = (sorted(counts)[k] for k in (63, 127, 191))
    codes = [(n > q1) + (n > q2) + (n > q3) for n in counts]
    out = [min(255, round(8 * math.log2(len(raw) + 1))), 0]
    if q3:
        out[1] = int(15 * q1 / q3) * 16 + int(15 * q2 / q3)
    for k in range(0, 256, 4):
        out.append(sum(codes[k + j] * 4**j for j in range(4)))
    return "".join(f"{byte:02x}" for byte in out), codes


def plain_likeness(a, b):
    (x, codes), (y, others) = plain_digest(a), plain_digest(b)
    total = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(p - q)] for p, q in zip(codes, others, strict=True))
    size = [int(d[:2], 16) for d in (x, y)]
    ratios = [(int(d[2], 16), int(d[3], 16)) for d in (x, y)]
    total += max(0, abs(size[0] - size[1]) - 1) + sum(abs(p - q) for p, q in zip(*ratios, strict=True))
    return 1 - min(total, 300) / 300


@pytest.mark.parametrize("seed", range(4))
def test_digest_and_difference(seed):
    texts = [t.encode() for t in some_texts(seed)] + [b"", b"\x00" * 9]
    for text in texts:
        assert fingerprint.fingerprint(text) == plain_digest(text)[0]
    for a in texts:
        for b in texts[:5]:
            found = fingerprint.likeness(fingerprint.fingerprint(a), fingerprint.fingerprint(b))
            assert found == pytest.approx(plain_likeness(a, b), abs=1e-12)


# Languages


def plain_grams(text):
    """The n-grams a text holds, by size, as the columns they are dealt to."""
    letters = []
    for b in text.encode():
        letters.append(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32)
    out = []
    for size, width in ((1, 256), (2, 2048), (3, 8192)):
        held = set()
        for i in range(len(letters) - size + 1):
            code = 0
            for letter in letters[i : i + size]:
                code = (code * 257 + letter) % 2**32
            held.add(code if size == 1 else (code * 2654435761 % 2**32) * width >> 32)
        out.append(held)
    return out


def plain_kernel(a, b):
    return sum(len(x & y) ** 2 / max(1, len(x) * len(y)) for x, y in zip(a, b, strict=True)) / 3


def test_presence_and_kernel():
    texts = some_texts(1)
    grams = [plain_grams(t) for t in texts]
    x = langid.presence(arrow(texts))
    base = np.cumsum([0, *langid.BLOCKS])
    for row, held in zip(x, grams, strict=True):
        for k in range(3):
            assert set(np.flatnonzero(row[base[k] : base[k + 1]]).tolist()) == held[k]
    found = langid.kernel(x, x)
    expected = [[plain_kernel(a, b) for b in grams] for a in grams]
    assert np.allclose(found, expected, atol=1e-5)


def test_ridge_regression_on_landmarks():
    """The outputs are those of the weights that solve the regression in the span of the landmarks."""
    rng = random.Random(3)
    words = {"en": "the and of this", "de": "der und die nicht", "fr": "les des une où"}
    names = rng.choices(list(words), k=40)
    texts = [" ".join(rng.choices(words[n].split() + ["a1", "b2", "zz", "qq"], k=9)) for n in names]
    grams = [plain_grams(t) for t in texts]
    model = langid.fit(langid.presence(arrow(texts)), names, landmarks=4)
    langs = sorted(words)
    marks = [k for lang in langs for k in [i for i, n in enumerate(names) if n == lang][:4]]
    k_nm = np.array([[plain_kernel(a, grams[m]) for m in marks] for a in grams])
    k_mm = k_nm[marks]
    share = np.array([1 / names.count(n) for n in names])
    target = np.array([[1.0 if n == lang else -1.0 for lang in langs] for n in names])
    alpha = np.linalg.lstsq(
        k_nm.T @ (k_nm * share[:, None]) + langid.RIDGE * k_mm, k_nm.T @ (target * share[:, None]), rcond=None
    )[0]
    assert model.names == langs
    assert np.allclose(model.outputs(langid.presence(arrow(texts))), k_nm @ alpha, atol=2e-3)


# Quality


def plain_passages(text, words_each=64):
    """Word features of every passage, by plain counting."""
    words = text.split()
    return [words[i : i + words_each] for i in range(0, len(words), words_each)] or [[]]


def test_passages_by_plain_counting():
    rng = random.Random(2)
    words = ["the", "The", "MONEY!!", "a", "bc", "x,", "end.", "loooooong"]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 63, 64, 65, 300)]
    x, offsets = quality.passages(arrow(texts))
    assert np.diff(offsets).tolist() == [len(plain_passages(t)) for t in texts]
    rows = [p for t in texts for p in plain_passages(t)]
    for row, part in zip(x, rows, strict=True):
        n = max(1, len(part))
        mean = sum(map(len, part)) / n
        spread = math.sqrt(max(0, sum(len(w) ** 2 for w in part) / n - mean**2))
        expected = [
            math.log1p(mean), math.log1p(spread), len(set(part)) / n,
            sum(a == b for a, b in zip(part, part[1:], strict=False)) / n,
            sum(w[0].isupper() for w in part) / n,
        ]
        assert np.allclose(row[quality.CLASSES : quality.CLASSES + 5], expected, atol=1e-6)
        assert row[quality.CLASSES + 6] == pytest.approx(math.log1p(len(part)) / math.log1p(64))


def plain_scores(model, x, offsets):
    """Gated attention, passage by passage."""
    p = {k: v.tolist() for k, v in model.part.items()}
    dot = lambda v, m, j: sum(a * row[j] for a, row in zip(v, m, strict=True))
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        hidden, weight = [], []
        for row in x[a:b]:
            row = [min(8, max(-8, (v - m) / s)) for v, m, s in zip(row, model.mean, model.scale, strict=True)]
            h = [math.tanh(dot(row, p["encode"], j) + p["encode0"][j]) for j in range(len(p["encode0"]))]
            width = len(p["attend"])
            both = [math.tanh(dot(h, p["tanh"], j)) / (1 + math.exp(-dot(h, p["gate"], j))) for j in range(width)]
            hidden.append(h)
            weight.append(math.exp(sum(u * v for u, v in zip(both, p["attend"], strict=True))))
        bag = [sum(w * h[j] for w, h in zip(weight, hidden, strict=True)) / sum(weight) for j in range(len(hidden[0]))]
        out.append(1 / (1 + math.exp(-(sum(u * v for u, v in zip(bag, p["score"], strict=True)) + p["score0"][0]))))
    return out


def sample(seed):
    rng = np.random.default_rng(seed)
    offsets = np.array([0, 3, 4, 9, 15])
    return rng.normal(size=(15, quality.FEATURES)), offsets, np.array([0.0, 1, 1, 0])


def test_attention_by_plain_loops():
    x, offsets, label = sample(0)
    model = quality.fit(x, offsets, label)
    found, _ = model.forward(x, offsets)
    assert np.allclose(found, plain_scores(model, x, offsets), atol=1e-9)


def test_first_step_goes_against_the_gradient(monkeypatch):
    """The first step of the optimiser has the sign of the gradient of the plain loss, taken by differences."""
    x, offsets, label = sample(1)
    monkeypatch.setattr(quality, "ROUNDS", 0)
    model = quality.fit(x, offsets, label)
    start = {k: v.copy() for k, v in model.part.items()}
    monkeypatch.setattr(quality, "ROUNDS", 1)
    step = quality.fit(x, offsets, label).part
    share = [0.5 / label.tolist().count(y) for y in label]

    def loss():
        scores = plain_scores(model, x, offsets)
        data = -sum(s * math.log(p if y else 1 - p) for s, p, y in zip(share, scores, label, strict=True))
        return data + quality.DECAY / 2 * sum(float((v**2).sum()) for v in model.part.values())

    rng = random.Random(0)
    compared = 0
    for name, value in start.items():
        places = list(np.ndindex(value.shape))
        for place in rng.sample(places, min(4, len(places))):
            ends = []
            for h in (1e-5, -1e-5):
                model.part[name] = value.copy()
                model.part[name][place] += h
                ends.append(loss())
            model.part[name] = value
            gradient = (ends[0] - ends[1]) / 2e-5
            if abs(gradient) > 1e-5:
                moved = step[name][place] - value[place]
                assert moved == pytest.approx(-math.copysign(quality.RATE, gradient), rel=1e-2), (name, place)
                compared += 1
    assert compared > 12
