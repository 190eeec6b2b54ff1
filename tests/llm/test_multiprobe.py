import itertools

import numpy as np
import pytest

from tallyfold.llm import multiprobe as mp


def exact(rows, k, step=20):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % step == 0:
            scored = sorted((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    v = (centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, 8))) * rng.uniform(0.2, 2, (n, 1))
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "vec_id long, embedding array<float>, rank int, bucket string").repartition(3)


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def overlap(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_small_tables_are_hashed_and_cases_defined(spark):
    rows = vectors(150) + [(1000 + k, vectors(1)[0][1]) for k in range(60)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (2100, [1.0] * 3), (None, [1.0] * 8)]
    docs = frame(spark, rows)
    search = mp.NeighbourSearch(docs, k=5)
    assert search.hashing.m > 0
    got, want = answers(search.neighbours(docs)), exact(rows, 5, step=1)
    assert got.keys() == want.keys()
    distinct = [q for q in want if q < 1000]  # the others repeat one query sixty times
    assert overlap({q: got[q] for q in distinct}, {q: want[q] for q in distinct}) >= 0.9
    few = frame(spark, rows[:4])
    same(answers(mp.NeighbourSearch(few).neighbours(few.where("vec_id % 20 = 0"))), exact(rows[:4], 20))
    assert mp.NeighbourSearch(docs.limit(0)).neighbours(docs).collect() == []


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(mp, "PART", 300)
    rows = vectors(4000, 1) + [(4000 + k, vectors(1, 1)[0][1]) for k in range(700)]
    docs = frame(spark, rows)
    search = mp.NeighbourSearch(docs, k=10)
    assert search.hashing.m > 0
    got, want = answers(search.neighbours(docs.where("vec_id % 20 = 0"))), exact(rows, 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    by_id = {i: np.array(v) for i, v in rows}
    for q, hits in got.items():
        assert all(s == pytest.approx(float(by_id[q] @ by_id[i]), rel=1e-12) for i, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))


def test_queries_that_find_too_little_are_compared_with_all(spark, monkeypatch):
    rows = vectors(2500, 2)
    docs = frame(spark, rows)
    search = mp.NeighbourSearch(docs, k=10)
    search.hashing.width /= 50  # nearly every vector alone
    same(answers(search.neighbours(docs.where("vec_id % 500 = 0"))), {q: v for q, v in exact(rows, 10).items() if q % 500 == 0})


def test_probing_order_has_every_set_once_by_cost():
    for m in (1, 2, 3):
        order = mp.probing_order(m, 10**6)
        assert len(order) == len(set(order)) == 3**m
        assert order[0] == () and order[1] == (0,)
        valid = {s for r in range(2 * m + 1) for s in itertools.combinations(range(2 * m), r) if len({min(j, 2 * m - 1 - j) for j in s}) == len(s)}
        assert set(order) == valid


@pytest.mark.parametrize("n", [10**7, 10**8])
def test_fit_reaches_the_recall_for_large_tables(n):
    sample = np.random.default_rng(4).normal(size=(2000, 64))
    sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
    hashing = mp.fit(sample, n, 1.0)
    asked = np.random.default_rng(9).choice(len(sample), 200, replace=False)
    gain = sample[asked] @ sample.T
    gain[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-gain, mp.K, axis=1)[:, : mp.K]
    held, probes = hashing.buckets(sample)[best], hashing.probes(sample[asked])
    hit = np.zeros(best.shape, bool)
    for t in range(hashing.tables):
        hit |= (probes[:, t, None, :] == held[:, :, t, None]).any(axis=2)
    assert hit.mean() >= 0.93


def test_fit_ends_with_one_bucket():
    sample = np.random.default_rng(4).normal(size=(500, 8))
    hashing = mp.fit(sample, 10**6, float(np.sqrt((sample**2).sum(axis=1)).max()), recall=1.01)  # out of reach
    assert hashing.m == 0 and len(np.unique(hashing.buckets(sample))) == 1
    assert (hashing.probes(sample) == hashing.buckets(sample)[0, 0]).all()
