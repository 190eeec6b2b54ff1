import math
import random

import numpy as np
import pytest

from tallyfold.llm import whitening as wh


def brute(rows, k=4):
    """n, deviations by row, whitened up to sign, explained, by numpy's own solver."""
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in good]
    distinct = sorted({tuple(v) for _, v in x})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[j] for v in distinct) for j in range(d)]
    a = np.array(distinct, np.float64) - np.array(sums) / n
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, v in x:
        w = (np.array(v) - np.array(sums) / n) @ u[:, :k] / np.sqrt(e[:k])
        out[i] = (sum((n * q - s) ** 2 for q, s in zip(v, sums)), w)
    return n, out, e[:k] / e.sum()


def spiked(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) * np.array(spread + [0.01] * (d - len(spread)))
    return (base @ np.linalg.qr(rng.standard_normal((d, d)))[0]).astype(np.float32)


def check(spark, rows, k=4, columns="vec_id long, embedding array<float>", **how):
    df = spark.createDataFrame([(i, v, "y", 3) for i, v in rows], columns + ", x string, n int").repartition(3)
    got = wh.whiten(df, k=k, **how).collect()
    n, want, explained = brute(rows, k)
    assert len(got) == len([i for i, _ in rows if i in want]) * min(k, len(explained))
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, r)
        assert (r.n, r.deviation) == (n, want[r.vec_id][0]) and r.identity_error <= 1e-8
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    for c, rs in by.items():
        sign = max((want[i][1][c - 1] * r.whitened for i, r in rs.items()), key=abs)
        assert all(abs(r.whitened - math.copysign(1, sign) * want[i][1][c - 1]) < 1e-6 for i, r in rs.items())


def test_power_passes_are_enough_for_a_clear_spectrum(spark):
    rows = [(k, v.tolist()) for k, v in enumerate(spiked(1, 400, 48, [9.0, 6.0, 4.0, 2.5]))]
    check(spark, rows, passes=8)
    df = wh.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    model = wh.fit(df, passes=8)
    assert not model.expanded and 1 < model.passes <= 8
    assert wh.fit(df, passes=1).expanded


def test_a_flat_spectrum_is_expanded(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((500, 40))
    rows = [(k, (x / np.linalg.norm(x)).astype(np.float32).tolist()) for k, x in enumerate(v)]
    rows += [(1000 + k, rows[7][1]) for k in range(300)]  # copies do not weigh in the fit
    check(spark, rows)
    model = wh.fit(wh.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert model.expanded and model.passes <= wh.PASSES + 1 and model.n == len({tuple(map(lambda c: math.floor(256 * c), r[1])) for r in rows})
    assert np.abs(model.components.T @ model.components - np.eye(4)).max() < 1e-13


def test_unusable_rows_and_few_dimensions(spark):
    rows = [(k, [float(k), float(k * k % 7), -1.0]) for k in range(20)]
    rows += [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 0.0, 0.0]), (55, [-0.001, -0.0, 0.0]), (None, [5.0, 1.0, 2.0]), (3, rows[3][1]), (3, rows[4][1])]
    df = spark.createDataFrame(rows + [(60, [1.0, 2.0])], "vec_id long, embedding array<float>").repartition(4)
    got = wh.whiten(df).collect()
    kept = [r for r in rows if r[0] not in (50, 51, 52, 53, 54)]
    assert sorted({str(r.vec_id) for r in got}) == sorted({str(i) for i, _ in kept}) and len(got) == len(kept) * 3
    n, want, explained = brute([(k, v) for k, (_, v) in enumerate(kept)])
    assert sorted({r.deviation for r in got}) == sorted({d for d, _ in want.values()}) and got[0].n == n
    assert [r.explained for r in sorted(got, key=lambda r: r.component)][:: len(kept)] == pytest.approx(list(explained[:3]), rel=1e-9)


def test_no_variance_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]):
        assert wh.whiten(spark.createDataFrame(rows, kind)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(9)], kind)
    assert {r.component for r in wh.whiten(line).collect()} == {1}


def test_deviations_are_exact_or_null():
    x = np.array([[3, -5], [1 << 20, 7]], np.int64)
    n, sums = 1 << 12, np.array([11, -(1 << 40)])
    want = [sum((n * v - s) ** 2 for v, s in zip(r, sums.tolist())) for r in x.tolist()]
    assert wh._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
    pick = random.Random(1)
    y = np.array([[pick.randrange(-900, 900) for _ in range(64)] for _ in range(50)], np.int64)
    s = np.array([pick.randrange(-10**7, 10**7) for _ in range(64)])
    assert wh._deviations(y, 50_000, s) == [sum((50_000 * v - t) ** 2 for v, t in zip(r, s.tolist())) for r in y.tolist()]
