"""Hard negatives against all products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annalist.llm import negatives

SCHEMA = "id long, label int, vector array<int>"


def brute(rows, is_anchor, positives=5, most=10, low=30, high=90):
    items = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None:
            items[i] = min(items.get(i, (label, v)), (label, v))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in filter(is_anchor, items):
        label, v = items[a]
        scored = sorted((-score(v, w), i, other) for i, (other, w) in items.items() if i != a)
        for p, i, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(n, j) for n, j, other in scored if other != label and low * -p <= 100 * -n <= high * -p][:most]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **kw):
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, **kw)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed", range(4))
def test_all_products(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 50)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    r = random.Random(seed)
    centres = [[r.randint(-90, 90) for _ in range(12)] for _ in range(3)]
    rows = []
    for i in range(300):
        c = r.choice(centres)
        rows.append((i, r.randrange(3) if seed else r.choice([0, 0, 0, 1]), [x + r.randint(-40, 40) for x in c]))
    rows += [(1000 + i, *rows[0][1:]) for i in range(20)] + [(2000 + i, 2, rows[0][2]) for i in range(20)]  # ties
    rows += [rows[3], (5, 0, rows[9][2]), (None, 1, [1] * 12), (3001, None, [1] * 12), (3002, 1, None)]
    rows += [(3010, 0, []), (3011, 1, []), (3020, 1, [5, 5]), (3021, 2, [0] * 12), (3030, 0, [-1] * 12), (3031, 0, [-7] * 3)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=100) == brute(rows, lambda i: i % 10 == 0, 2, 3, 50, 100)


def test_edges(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1])]) == [] and mined(spark, [(10, 1, [1]), (20, 2, [1])]) == []
    rows = [(10, 1, [4]), (11, 1, [5]), (12, 2, [2]), (13, 2, [-2]), (14, 2, [5])]
    assert mined(spark, rows) == [(10, 11, 1, 12, 20, 8)]
    big = (1 << 23) - 1
    rows = [(10, 1, [big] * 40), (11, 1, [-big - 0] * 20 + [big] * 20), (12, 1, [big] * 40), (13, 2, [big // 2] * 40)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_quantised(spark):
    rows = [(1, [0.5, -0.001, 1.0]), (2, [0.5, None]), (3, [float("nan")]), (4, [float("inf")]), (5, None), (6, [])]
    found = dict(spark.createDataFrame(rows, "i int, v array<float>").select("i", negatives.quantised(F.col("v"))).collect())
    assert found == {1: [128, -1, 256], 2: None, 3: None, 4: None, 5: None, 6: []}
    with pytest.raises(Exception, match="more than 23 bits"):
        spark.createDataFrame([([1e9],)], "v array<double>").select(negatives.quantised(F.col("v"))).collect()


def test_candidates_go_before_the_last_plane():
    r = np.random.default_rng(1)
    anchors, rows = r.integers(-60, 60, (4, 32)), r.integers(-60, 60, (32, 500))
    planes = np.stack([np.packbits((rows >> k & 1).astype(np.uint8), axis=1) for k in range(8)])
    left = []
    original = negatives._still
    negatives._still = lambda low, high, bands, most: left.append(len(low)) or original(low, high, bands, most)
    try:
        bands = np.full((4, 1, 2), (-(1 << 62), 1 << 62))
        found = {i: (at, s) for i, _, at, s in negatives.best(anchors, planes, np.ones((4, 500), bool), bands, 5)}
    finally:
        negatives._still = original
    assert left[0] == 500 and max(left[-4:]) < 50
    for i in range(4):
        exact = anchors[i] @ rows
        top = np.argsort(-exact)[:5]
        assert set(top) <= set(found[i][0]) and (exact[found[i][0]] == found[i][1]).all()
