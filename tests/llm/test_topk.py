import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from townlens.llm import topk


def brute(rows, k=5, every=50, exact=False):
    good = [(i, [int(np.floor(256 * (x if exact else float(np.float32(x))))) for x in v]) for i, v in rows if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in good if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "few"])
def test_against_brute_force(spark, kind):
    rng = random.Random(kind)
    n = {"random": 900, "ties": 700, "few": 3}[kind]
    value = (lambda: rng.choice([0.5, -0.25])) if kind == "ties" else (lambda: rng.gauss(0, 1))
    rows = [(i * 10, [value() for _ in range(8)]) for i in range(n)]
    rows += [(100_050, None), (100_051, [1.0, None] + [0.0] * 6), (100_100, [float("nan")] * 8), (100_150, [float("inf")] * 8), (100_200, [1.0, 2.0]), (100_201, [3.0, -1.0]), (100_250, []), (100_251, []), (None, [0.0] * 8), (100_300, [1e18] * 8), (100_301, [1e18] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string").repartition(7)
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == brute(rows)


def test_pruning_skips_blocks():
    rng = np.random.default_rng(0)
    blocks = [(np.arange(b * 64, b * 64 + 64), rng.integers(0, 5, (64, 16)).astype(float) + 100 * (b == 7)) for b in range(30)]
    found, scores, visits = topk.search_cell(np.array([10_000]), np.ones((1, 16)), blocks, 5)
    assert visits == 1 and (found // 64 == 7).all() and (np.diff(scores[0]) <= 0).all()


def test_blocks_that_bounds_exclude_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "CHUNK", 8)
    monkeypatch.setattr(topk, "BOUND_BLOCKS", 7)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(1200):  # ids in order of topic, as crawls are
        topic = np.eye(12)[i // 100]
        rows.append((i, (topic + 0.02 * rng.normal(size=12)).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got, met = topk.search(df, F.col("vec_id") % 50 == 0)
    want = sorted((q, r, i, s) for q, r, i, s in brute([(i, v) for i, v in rows], exact=True))
    assert sorted(tuple(r) for r in got.collect()) == want
    blocks, visits = 1200 / 16, met.agg(F.sum("visits")).first()[0]
    assert visits < 0.35 * blocks * 24, visits / (blocks * 24)


def test_repeated_ids_and_query_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [2.0, 1.0]), (7, [2.0, 1.0]), (7, [0.5, 3.0]), (9, [1.0, 1.0])]
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=3).collect()]
    one = [(0, 1, 7, 131072), (0, 2, 7, 131072), (0, 3, 9, 65536)]
    assert sorted(got) == sorted([*one, *one, (50, 1, 7, 196608), (50, 2, 7, 65536), (50, 3, 7, 65536)])


def test_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0
