"""Hard negatives against brute force with whole Python numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselode.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, `key` long"


def expected(rows, positives=5, negatives=5, every=10, low=80):
    known = set()
    for i, e, label, *_ in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        known.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in e)))
    out = set()
    for a, label, v in known:
        if a % every:
            continue
        scored = sorted(
            (-max(-hn.LONG, min(hn.LONG, sum(x * y for x, y in zip(v, w)))), i, other) for i, other, w in known if i != a
        )
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(n, j) for n, j, other in scored if other != label and low * -p <= 100 * -n <= 100 * -p]
            out |= {(a, i, k + 1, j, -p, -n) for k, (n, j) in enumerate(fits[:negatives])}
    return out


def mined(spark, rows, every=10, **more):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in hn.mine(df, F.col("vec_id") % every == 0, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


def _cloud(n, width=6, labels=4, seed=3):
    random.seed(seed)
    spots = [[random.gauss(0, 1) for _ in range(width)] for _ in range(7)]
    return [(i, [x + random.gauss(0, 0.3) for x in spots[i % 7]], (i * i) % labels) for i in range(n)]


def test_equals_brute_force(spark):
    rows = _cloud(600)
    assert mined(spark, rows) == expected(rows)


def test_one_very_common_vector_ties_and_repeated_rows(spark):
    rows = _cloud(200) + [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], i % 3) for i in range(300)]
    rows += [(2000 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(40)] + rows[:60]
    assert mined(spark, rows) == expected(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _cloud(80) + [
        (None, [1.0] * 6, 1), (100, None, 1), (110, [1.0] * 6, None), (120, [1.0, None, 1.0], 1), (130, [nan] * 6, 1),
        (140, [inf, 0.0], 2), (150, [], 2), (160, [0.0] * 6, 2), (170, [0.0] * 6, 1), (180, [0.5, 0.5], 0), (190, [0.5, 0.5], 1),
        (200, [0.004] * 6, 0), (210, [-1.0] * 6, 0), (0, [0.1] * 6, 3), (0, [0.2] * 6, 3), (221, [1.0] * 9, 2),
    ]
    assert mined(spark, rows) == expected(rows)


@pytest.mark.parametrize("factor", [1e5, 1e8])
def test_scores_beyond_doubles_and_longs(spark, factor):
    rows = [(i, [x * factor for x in e], label) for i, e, label in _cloud(120)]
    assert mined(spark, rows) == expected(rows)


def test_blocks_and_windows_of_other_sizes(spark, monkeypatch):
    rows = _cloud(1500, seed=5)
    monkeypatch.setattr(hn, "BLOCK_NUMBERS", 6)
    found = mined(spark, rows, every=2, positives=2, negatives=3, low=60)
    assert found == expected(rows, 2, 3, every=2, low=60)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == set() and mined(spark, [(1, [1.0], 1)]) == set()


def test_a_walk_stops_before_the_end_of_the_list():
    """Members of a narrow cluster need not score what lies elsewhere."""
    rng = np.random.default_rng(1)
    spots = rng.normal(size=(20, 8)) * 100
    vectors = np.concatenate([s + rng.normal(size=(200, 8)) * 5 for s in spots]).astype(np.int64)
    members = vectors[:20]
    cluster = hn.Cluster(hn._unit(members.mean(axis=0)[None])[0], np.arange(20), np.zeros(20, np.int64), members)
    none = np.zeros(20, np.int64)
    walk = hn.Walk(cluster, np.arange(20), none - hn.LONG, none + hn.LONG, none, True, 6)
    walk.along(np.zeros(4000, np.int64), vectors, hn._lengths(vectors), np.arange(4000)[:, None])
    row, score, ids = walk.result()
    exact = members @ vectors.T
    for i in range(20):
        want = sorted((-s, j) for j, s in enumerate(exact[i].tolist()))[:6]
        assert list(zip((-score[row == i]).tolist(), ids[row == i, 0].tolist())) == want
    assert walk.n_scored < 0.3 * exact.size
