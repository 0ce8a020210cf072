import math
import random

import numpy as np
import pytest

from quarry.llm import topk as T


def brute(rows, k=20):
    kept = []
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for i in {i for i, _ in kept if i % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for o, q in kept if o == i for j, c in kept if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def frame(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(df, **kw).collect())


def vectors(n, seed, spread):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    return [(i, [c + rnd.gauss(0, spread) for c in rnd.choice(centres)], 3) for i in range(n)]


@pytest.mark.parametrize("spread", [0.01, 1.0])  # bounds rule out nearly all, or little
def test_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", 150)
    monkeypatch.setattr(T, "QUERY_BLOCK", 7)
    monkeypatch.setattr(T, "FIRST", 25)
    rows = vectors(500, 1, spread) + [(600 + i, [0.5] * 12, 0) for i in range(40)]  # ties
    assert frame(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = vectors(8, 2, 1.0) + [
        (20, None, 1), (40, [1.0, None], 1), (60, [float("nan")] * 12, 1), (80, [float("inf")] * 12, 1), (None, [1.0] * 12, 1),
        (100, [1.0, 2.0], 1), (100, [0.5, 9.0], 1), (120, [], 1), (140, [1e4] * 12, 1),
    ]
    assert frame(spark, rows) == brute(rows)
    assert frame(spark, rows[:1]) == []
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    assert T.top_k(df.limit(0)).collect() == []


def test_repeated_ids_take_part_each(spark):
    rows = vectors(60, 3, 0.5)
    rows += [(i, v, 4) for i, v, _ in vectors(60, 4, 0.5) if i % 3 == 0] + rows[:30]
    assert frame(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.uniform(-4e6, 4e6) for _ in range(12)], 0) for i in range(300)]
    assert frame(spark, rows) == brute(rows)


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_queries_travel_only_where_bounds_allow(spark, monkeypatch, spread):
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(T, "MOST_CELLS", 9)  # cells of several blocks
    monkeypatch.setattr(T, "QUERY_BLOCK", 5)  # a block meets its queries in several parts
    sent, places = [], []
    whole = T.sent_out

    def counted(home, bounds, parts, places_only):
        rows = whole(home, bounds, parts, places_only)
        if places_only:
            places.append((int(bounds.blocks.sum()), home.count()))
        else:
            sent.append(rows.count())
        return rows

    monkeypatch.setattr(T, "sent_out", counted)
    rows = vectors(600, 11, spread)
    assert frame(spark, rows, k=5) == brute(rows, 5)
    (blocks, queries), letters = places[0], sent[0]
    assert queries == 30 and blocks >= 15
    if spread < 0.1:  # clusters far apart: most blocks are never visited
        assert letters < 0.6 * queries * (blocks - 1)
    else:
        assert letters <= queries * (blocks - 1)


@pytest.mark.parametrize("far", [1e5, 1e6, 1e7])
def test_outlier_pivot_leaves_no_answer_out(spark, monkeypatch, far):
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", 100)
    rows = vectors(600, 9, 0.05) + [(9001, [far * x for x in vectors(1, 5, 1.0)[0][1]], 0)]
    assert frame(spark, rows) == brute(rows)
