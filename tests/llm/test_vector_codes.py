"""Product codes against plain k-means in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from plumbline.llm import vector_codes as V


def by_hand(rows, parts, entries, rounds, scale=256):
    """(id, vector, label) rows: code, error and label error of each, and the digest of the codebooks."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(scale * x) for x in v], label, v) for i, v, label in kept]
    size = len(kept[0][1]) // parts if kept else 0
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _, _ in kept]
    first = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: (kept[k][0], kept[k][3]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            near = [min((sum((a - b) ** 2 for a, b in zip(row[p], c, strict=True)), e) for e, c in enumerate(books[p])) for p in range(parts)]
            out.append(near)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                held = [cut[k][p] for k in range(len(cut)) if found[k][p][1] == e]
                if held:
                    books[p][e] = [sum(column) // len(held) for column in zip(*held, strict=True)]
    found = assign()
    errors = {}
    for (_, _, label, _), near in zip(kept, found, strict=True):
        errors[label] = errors.get(label, 0) + sum(d for d, _ in near)
    out = [
        (i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), errors[label])
        for (i, _, label, _), near in zip(kept, found, strict=True)
    ]
    whole = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(whole.encode()).hexdigest()


def vectors(seed, n, width, kind):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for k in range(n):
        centre = rng.choice(centres)
        if kind == "near":
            v = [c + rng.gauss(0, 0.1) for c in centre]
        elif kind == "grid":
            v = [rng.randint(-2, 2) / 256 for _ in range(width)]  # ties everywhere
        else:
            v = [c * rng.choice([0.001, 1, 900]) for c in centre]
        rows.append((k * 3 - 40, v, rng.choice([None, 0, 1, 2])))
    return rows


def codes(spark, rows, parts, entries, rounds, kind="array<double>"):
    data = [(i, v, label, 1, "x") for i, v, label in rows]
    table = spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int, code int, row string").repartition(3)
    found, books = V.compress(table, parts=parts, entries=entries, rounds=rounds)
    coded = found.select("row.vec_id", "row.label", V.hex_code().alias("code"), "error")
    out = V.summed_over(coded, "label", "error", "label_error").select("vec_id", "code", "error", "label_error")
    return [tuple(r) for r in out.collect()], books


@pytest.mark.parametrize("kind", ["near", "grid", "wide"])
@pytest.mark.parametrize("parts,entries,rounds", [(16, 64, 2), (4, 9, 5), (1, 3, 0)])
def test_codes(spark, kind, parts, entries, rounds):
    rows = vectors(parts, 300, 32, kind)
    rows += [(500, None, 1), (501, [None] + [0.5] * 31, 1), (502, [float("nan")] * 32, 2), (503, [float("inf")] + [0.0] * 31, 2)]
    rows += [(-10**6, [-math.inf] * 32, 0), (None, [0.25] * 32, None), rows[0], rows[0], (rows[5][0], [0.1] * 32, 9), (504, [], 0)]
    rows += [(10**6 + k, rows[7][1], 7) for k in range(400)]  # a hot vector and label
    got, books = codes(spark, rows, parts, entries, rounds)
    expected, digest = by_hand(rows, parts, entries, rounds)
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert books.sha256() == digest


def test_floats_are_scaled_exactly(spark):
    rows = [(k, np.float32(v).tolist(), 0) for k, v, _ in vectors(3, 80, 16, "near")]
    got, books = codes(spark, rows, 16, 64, 2, "array<float>")
    expected, digest = by_hand(rows, 16, 64, 2)
    assert sorted(got) == sorted(expected) and books.sha256() == digest


def test_odd_tables(spark):
    assert codes(spark, [], 16, 64, 2) == ([], None)
    assert codes(spark, [(1, None, 1), (2, [math.nan] * 16, 1)], 16, 64, 2) == ([], None)
    one, books = codes(spark, [(1, [0.5] * 16, None)], 16, 64, 2)
    assert one == [(1, "00" * 16, 0, 0)] and books.entries.shape == (16, 1, 1)
    # another width goes, ids may all be missing, huge numbers count as the largest
    assert codes(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], 16, 64, 2)[0] == [(1, "00" * 16, 0, 0)]
    assert sorted(codes(spark, [(None, [k / 2] * 16, 1) for k in range(3)], 16, 64, 2)[0], key=str) == [
        (None, "00" * 16, 0, 0), (None, "01" * 16, 0, 0), (None, "02" * 16, 0, 0)
    ]
    huge = codes(spark, [(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1)], 16, 64, 2)[1]
    assert huge.entries.max() == V.LARGEST == -huge.entries.min()
    with pytest.raises(ValueError, match="can't be cut"):
        codes(spark, [(1, [0.5] * 10, 1)], 16, 64, 2)


@pytest.mark.parametrize("seed", range(5))
def test_balls_agree_with_all_distances(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-20, 20, (30, 2))
    entries[7] = entries[3]
    points = rng.integers(-25, 25, (2000, 2))
    before = rng.integers(0, 30, 2000)
    far = np.zeros(30, np.int64)
    np.maximum.at(far, before, ((points - entries[before]) ** 2).sum(1))
    nearest, distance = V._Balls(entries, far).assign(points, before)
    wanted, least = V._nearest(points, entries)
    assert (nearest == wanted).all() and (distance == least).all()


def test_stable_core_and_rings_skip_work(monkeypatch):
    """Points near their entry are never compared with others, and rings leave far entries out."""
    rng = np.random.default_rng(1)
    entries = np.array([[k * 1000, 0] for k in range(20)])
    before = np.repeat(np.arange(20), 50)
    points = entries[before] + rng.integers(-100, 100, (1000, 2))
    points[0] = [600, 0]
    seen = []
    plain = V._Balls._ring
    monkeypatch.setattr(V._Balls, "_ring", lambda self, p, at, e, c, *rest: (seen.append((len(at), len(c))), plain(self, p, at, e, c, *rest))[1])
    reach = np.full(20, 2 * 100**2)
    reach[0] = 600**2
    nearest, _ = V._Balls(entries, reach).assign(points, before)
    assert nearest[0] == 1 and (nearest[1:] == before[1:]).all()
    assert seen == [(1, 1)]
