"""Hard negatives against plain integer products."""
from __future__ import annotations

import math
import random

import numpy as np
import pytest

from growthloom.llm import negatives

ROWS = "vec_id long, embedding array<float>, label int, score string, rank string, v int"


def brute(rows, every=50):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in e], label) for i, e, label in rows
          if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    first = {}
    for i, v, label in ok:
        if i % every == 0:
            first[i] = min(first.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in first.items():
        s = sorted(((-sum(x * y for x, y in zip(v, w)), i, own) for i, w, own in ok if i != a and len(w) == len(v)))
        for ps, p, _ in [x for x in s if x[2] == label][:5]:
            window = [(n, ns) for ns, n, own in s if own != label and 50 * -ps <= 100 * -ns <= 95 * -ps][:3]
            out += [(a, p, k, n, -ps, -ns) for k, (n, ns) in enumerate(window, 1)]
    return sorted(out)


def mined(frame, rows, **options):
    got = negatives.mine(frame([(i, e, label, "x", "y", 1) for i, e, label in rows], ROWS), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("shape", [(5, 7), (3, 40), (64, 4096)])
def test_scores_equal_plain_products(shape):
    rng = np.random.default_rng(1)
    d, most = shape
    a, c = rng.integers(-most, most + 1, (9, d)).astype(np.int32), rng.integers(-most, most + 1, (300, d)).astype(np.int32)
    c[0], c[1], c[2] = 0, -most, most
    assert (negatives.scores(a, negatives.planes(c)) == c.astype(np.int64) @ a.T.astype(np.int64)).all()
    assert (negatives.scores(np.abs(a), negatives.planes(np.abs(c[:4] * 0))) == 0).all()


def test_scores_beyond_32_bits():
    a, c = np.full((2, 9), 1 << 23, dtype=np.int32), np.array([[-(1 << 23)] * 9, [(1 << 23) - 1] * 9], dtype=np.int32)
    assert (negatives.scores(a, negatives.planes(c)) == c.astype(np.int64) @ a.T.astype(np.int64)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_against_brute_force(frame, seed, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(negatives, "ROWS", 16)
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.2) + 0.1 for _ in range(10)] for _ in range(4)]
    rows = []
    for i in range(-60, 240):
        v = [x + rng.gauss(0, 0.1) for x in rng.choice(base)]
        rows.append((i, v, 0 if rng.random() < 0.4 else rng.randrange(4)))
    rows += [(500, list(rows[3][1]), 0), (501, list(rows[3][1]), 1), (502, list(rows[3][1]), 1)]  # ties
    rows += [(600, None, 1), (601, [0.1] * 10, None), (602, [0.1] * 9 + [float("nan")], 1), (603, [0.1] * 9 + [float("inf")], 1), (604, [0.1] * 9 + [None], 1)]
    rows += [(650, [0.3] * 4, 2), (651, [0.3] * 4, 2), (652, [0.2] * 4, 1), (700, [], 1), (750, [0.0] * 10, 3), (None, [0.1] * 10, 1)]
    rows += [(100, [0.15] * 10, 1), (101, list(rows[161][1]), 1)]  # ids that repeat
    rng.shuffle(rows)
    got = mined(frame, rows)
    assert got == brute(rows) and len(got) > 20


def test_few_rows(frame):
    assert mined(frame, []) == []
    assert mined(frame, [(0, [0.5, 0.5], 1)]) == []
    assert mined(frame, [(0, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.4, 0.4], 2)]) == [(0, 1, 1, 2, 32768, 26112)]
    assert mined(frame, [(0, [1e30, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.4, 0.4], 2)]) == []
