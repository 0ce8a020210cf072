import math
import random

import numpy as np
import pytest

from quarry.llm import whitening as H

SCHEMA = "vec_id long, embedding array<float>, n long, component int, z double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, components=8):
    keep = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in keep), default=0)
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v + [0.0] * (width - len(v))] for _, v in keep]
    n = len(x)
    s = [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[n * a - b for a, b in zip(r, s, strict=True)] for r in x], object)
    v = np.array([[int(c) / (n**3) for c in line] for line in centred.T.dot(centred)])
    return [i for i, _ in keep], n, [int(sum(c * c for c in r)) for r in centred], centred.astype(float) / n, v


def check(spark, rows, tolerance=1e-6):
    got = H.whiten(frame(spark, rows)).collect()
    ids, n, deviation, centred, v = brute(rows)
    k = min(8, len(v))
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert sorted((r.vec_id, int(r.deviation_exact)) for r in got if r.component == 1) == sorted(zip(ids, deviation, strict=True))
    assert all(r.deviation == (int(r.deviation_exact) if int(r.deviation_exact) < 1 << 63 else None) for r in got)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-6
    explained = {r.component: r.explained for r in got}
    assert [explained[c + 1] for c in range(k)] == pytest.approx(list(e[:k] / np.trace(v)), rel=1e-6)
    # whitened values up to the sign of each component, as a multiset by id
    for c in range(k):
        want = sorted(zip(ids, np.abs(centred @ q[:, c] / math.sqrt(e[c])).tolist(), strict=True))
        have = sorted((r.vec_id, abs(r.whitened)) for r in got if r.component == c + 1)
        assert [i for i, _ in have] == [i for i, _ in want]
        assert [w for _, w in have] == pytest.approx([w for _, w in want], abs=tolerance)


def vectors(n, seed, width=12):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0.1 * j, 0.02 + 0.05 * j) for j in range(width)]) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 100)
    rows = vectors(700, 1)
    check(spark, rows + rows[:40])  # repeated rows are rows like others
    check(spark, vectors(50, 2, width=3))


def test_rows_that_take_no_part_and_short_vectors(spark):
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [1.0, 2.0])]
    check(spark, vectors(60, 3) + odd + [(905, [])])


def test_large_entries_stay_exact(spark):
    rows = vectors(80, 4) + [(500, [3e9] * 12), (501, [-2e9] + [0.5] * 11)]
    got = H.whiten(frame(spark, rows)).collect()
    ids, n, deviation, _, _ = brute(rows)
    assert sorted((r.vec_id, int(r.deviation_exact)) for r in got if r.component == 1) == sorted(zip(ids, deviation, strict=True))
    assert any(r.deviation is None for r in got)
    assert got[0].identity_error < 1e-4  # small components beside ones 10^20 times larger


def test_tables_without_variance(spark):
    assert H.whiten(frame(spark, [(1, None)])).collect() == []
    assert H.whiten(frame(spark, vectors(3, 5)).limit(0)).collect() == []
    assert H.whiten(frame(spark, [(1, [])])).collect() == []
    got = H.whiten(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in got] == [(0.0, 0.0, 0.0, 0)] * 4
    line = H.whiten(frame(spark, [(i, [0.5 * i, 1.0]) for i in range(4)])).collect()
    assert sorted((r.vec_id, abs(round(r.whitened, 6))) for r in line if r.component == 1) == [(0, 1.341641), (1, 0.447214), (2, 0.447214), (3, 1.341641)]
    assert {r.whitened for r in line if r.component == 2} == {0.0}


@pytest.mark.parametrize("top", [1, 1 << 10, 1 << 30, 1 << 50])
def test_bit_planes_give_exact_products(top):
    rnd = random.Random(top)
    x = np.array([[rnd.randrange(-top, top + 1) for _ in range(5)] for _ in range(131)], np.int64)
    want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j], strict=True)) for j in range(5)] for i in range(5)]
    assert H.cross_products(x).tolist() == want
    assert [sum(v << (H.LIMB * i) for i, v in enumerate(H._limbs(s))) for line in want for s in line] == [s for line in want for s in line]
