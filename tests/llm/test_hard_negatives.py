"""Hard negatives against a plain loop: ties, copies, hot labels, odd rows, several groups and blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, block string"


def plain(rows, every=50, positives=5, negatives=3, low=50, high=95):
    one = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        item = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        one[i] = min(one.get(i, item), item)
    out = set()
    for a, (label, v) in one.items():
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in one.items() if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in score if x[2] == label)[:positives]:
            fits = sorted(x for x in score if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)}
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, label, "clash") for i, v, label in rows], SCHEMA)
    every = kw.get("every", 50)
    kw.pop("every", None)
    out = H.hard_negatives(H.integer_vectors(df), F.col("vec_id") % every == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, every, **kw)
    return got


def rows_of(n, dim, seed, spread=1.0, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    v = (centre[label] + spread * rng.normal(size=(n, dim))) / math.sqrt(dim)
    return [(k, [float(x) for x in v[k].astype(np.float32)], int(label[k])) for k in range(n)]


@pytest.mark.parametrize("groups", [1 << 20, 200])
def test_is_that_of_a_plain_loop(spark, monkeypatch, groups):
    monkeypatch.setattr(H, "GROUP_NUMBERS", groups)
    monkeypatch.setattr(H, "BLOCK_NUMBERS", 20 * groups)
    assert check(spark, rows_of(1500, 16, 3), every=20)


def test_ties_copies_and_a_hot_vector(spark):
    rng = random.Random(2)
    few = [[rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(4)] for _ in range(12)]
    rows = [(k, few[0] if k % 3 == 0 else rng.choice(few), rng.choice([0, 0, 0, 1, 2])) for k in range(700)]
    assert check(spark, rows, every=10)
    assert check(spark, rows, every=7, positives=2, negatives=4, low=10, high=100)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(120, 3, 5, labels=2)
    rows += [(1000, None, 1), (1050, [nan, 0.0, 0.0], 0), (1100, [0.1, inf, 0.0], 0), (1150, [0.1, None, 0.0], 0), (1200, [0.3, 0.2, 0.1], None), (None, [0.1, 0.1, 0.1], 1)]
    rows += [(1250, [], 0), (1251, [], 0), (1300, [0.0, 0.0, 0.0], 0), (1350, [1.0, 2.0], 0), (1351, [1.0, 2.0], 0), (1352, [0.9, 1.6], 1), rows[50], (50, [9.0, 9.0, 9.0], 7)]
    got = check(spark, rows)
    assert any(a == 1350 for a, *_ in got)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x)) for x in rng.uniform(1e5, 3e5, 8)], k % 2) for k in range(60)]
    check(spark, rows, every=10, low=1, high=100)


def test_empty_tables_and_lone_anchors(spark):
    assert not check(spark, [])
    assert not check(spark, [(1, [1.0], 0)])
    assert not check(spark, [(50, [1.0], 0)])
    assert not check(spark, [(50, [1.0], 0), (51, [1.0], 1)])


def test_walks_end_before_the_list(monkeypatch):
    rows = rows_of(4000, 8, 9, spread=0.15)
    v = np.array([[math.floor(256 * x) for x in r[1]] for r in rows], dtype=np.int64)
    label, ids, shown = np.array([r[2] for r in rows]), np.arange(4000), [0]
    real = H.products
    monkeypatch.setattr(H, "products", lambda a, b: (shown.__setitem__(0, shown[0] + len(a) * len(b)), real(a, b))[1])
    own = np.arange(0, 4000, 50)
    far = np.full(len(own), np.iinfo(np.int64).max)
    best = H.Best(5, np.arange(len(own)), -far, far, ids, lambda r, j: (label[own[r]][:, None] == label[j]) & (own[r][:, None] != j))
    H.walk(v[own], v, H.centroids(v[own].astype(float), 8), best)
    assert len(best.id) == 5 * len(own) and shown[0] < 0.6 * len(own) * 4000
