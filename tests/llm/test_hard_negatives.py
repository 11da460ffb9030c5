import math
import random

import numpy as np
import pytest

from eventmart.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, r string, cell string, anchor string"


def brute(rows, positives=5, negatives=10):
    """All products, in whole numbers of any size."""
    kept = []
    for vec_id, label, vec in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vec]
        if sum(x * x for x in whole) < 2**62:
            kept.append((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, whole))
    out = []
    for a, (anchor, label, vec) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, v)), i is None, i or 0, k, l) for k, (i, l, v) in enumerate(kept) if k != a]
        scored.sort()
        for score, none, positive, *_ in [s for s in scored if s[4] == label][:positives]:
            fit = [s for s in scored if s[4] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            for rank, (s, no_id, negative, *_) in enumerate(fit[:negatives], 1):
                out.append((anchor, None if none else positive, rank, None if no_id else negative, -score, -s))
    return sorted(map(repr, out))


def mined(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)
    found = H.hard_negatives(frame, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in found.collect())


def clustered(n, width, seed, label=lambda k: k % 4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    points = centres[rng.integers(0, 8, n)] + 0.15 * rng.normal(size=(n, width))
    points *= rng.uniform(0.2, 2.0, size=(n, 1)) / np.linalg.norm(points, axis=1)[:, None]
    return [(k * 5, label(k), [float(x) for x in p]) for k, p in enumerate(points)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "TREE_ROWS", 64)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 4)
    monkeypatch.setattr(H, "PIVOTS", 12)
    rows = clustered(400, 6, 1)
    # Ties, copies of one vector in a third of all rows, repeated rows, and rows that take no part.
    rows += [(2_000 + k, k % 3, rows[0][2]) for k in range(200)] + rows[:20] + [rows[20]] * 5
    rows += [(3_100, None, rows[1][2]), (3_200, 1, None), (3_300, 1, [1.0, None]), (3_400, 1, [float("nan")] * 6), (3_500, 2, [math.inf])]
    rows += [(None, 1, rows[2][2]), (None, 2, rows[0][2]), (3_600, 1, []), (3_700, 3, [1.0]), (3_800, 2, [0.0] * 9), (3_900, 1, [3e38])]
    random.Random(2).shuffle(rows)
    expected = brute(rows)
    assert mined(spark, rows) == expected and len(expected) > 500


def test_products_beyond_doubles(spark):
    """Norms whose products no double holds exactly."""
    rows = [(k, label, [x * 2.0**20 for x in vec]) for k, label, vec in clustered(120, 5, 3)]
    assert mined(spark, rows) == brute(rows) != []


@pytest.mark.parametrize("positives,negatives", [(1, 1), (3, 50)])
def test_other_counts(spark, positives, negatives):
    rows = clustered(150, 4, 4)
    assert mined(spark, rows, positives=positives, negatives=negatives) == brute(rows, positives, negatives)


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, 1, [1.0])]) == []
    assert mined(spark, [(1, 1, [1.0]), (3, 2, [0.5])]) == []  # no anchor
    rows = [(100, 1, [1.0, 0.0]), (101, 1, [0.9, 0.1]), (102, 2, [0.5, 0.5]), (103, 2, [-1.0, 0.0]), (200, 3, [0.0, 0.0])]
    assert mined(spark, rows) == brute(rows) != []


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(5)
    points = np.array([v for _, _, v in clustered(600, 7, 6)])
    norm = float(np.linalg.norm(points, axis=1).max())
    lifted = H.augmented(points, norm)
    order, nodes = H.build(lifted)
    assert sorted(order) == list(range(600)) and len(nodes) > 8
    anchors = rng.normal(size=(9, 7))
    low, high = H.bounds(anchors, lifted[[n[0] for n in nodes]], np.array([n[3] for n in nodes]), norm)
    product = anchors @ points.T
    leaves = []
    for k, (_, first, last, _, begin, end) in enumerate(nodes):
        inside = product[:, order[first:last]]
        assert (low[:, k][:, None] <= inside).all() and (inside <= high[:, k][:, None]).all()
        if end > begin:
            assert [nodes[c][1] for c in range(begin, end)] + [last] == [first] + [nodes[c][2] for c in range(begin, end)]
        else:
            leaves += range(first, last)
    assert sorted(leaves) == list(range(600))


def test_descent_skips_what_bounds_exclude(monkeypatch):
    points = np.floor(256 * np.array([v for _, _, v in clustered(2_000, 6, 7)]))
    norm = float(np.linalg.norm(points, axis=1).max())
    order, nodes = H.build(H.augmented(points, norm))
    place = np.argsort(order)
    table = np.array([(place[c], *rest) for c, *rest in nodes], H.NODES)
    head = np.array([np.arange(2_000), np.arange(2_000), np.zeros(2_000), np.ones(2_000)], np.int64)
    verified = []
    unique = np.unique
    monkeypatch.setattr(H.np, "unique", lambda *a, **k: verified.append(1) or unique(*a, **k))
    one, wide = np.zeros(1, np.int64), np.array([2**62])
    H.descend(head, points[order], table, norm, points[order][:1], one, one, one, -wide, wide, -wide, True, 5)
    assert len(verified) < sum(n[4] == n[5] for n in nodes) / 3
