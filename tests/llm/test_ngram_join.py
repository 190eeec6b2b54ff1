import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import ngram_join as nj


def corpus(seed, n_base=40, copies=(0, 1, 3, 12), words=120):
    pick = random.Random(seed)
    stock = " ".join(f"s{k}" for k in range(40))
    rows = []
    for _ in range(n_base):
        base = [f"v{pick.randrange(4000)}" for _ in range(pick.randrange(6, words))]
        if pick.random() < 0.5:
            base += stock.split()
        rows.append(" ".join(base))
        for _ in range(pick.choice(copies)):
            edited = base[:]
            for _ in range(pick.randrange(0, 6)):
                edited[pick.randrange(len(edited))] = f"e{pick.randrange(10**6)}"
            rows.append(" ".join(edited))
    rows += [None, "", "one two", "one two", "a b c d", rows[0]]
    return list(enumerate(rows)) + [(None, rows[1])]


def brute(rows, threshold=0.8):
    """Class, links and linked texts of each row, from all pairs."""
    sets = {}
    for k, t in rows:
        w = (t or "").split()
        s = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
        sets[k] = s
    ids = [k for k, _ in rows if k is not None]
    near = {k: {j for j in ids if j != k and sets[k] and sets[j] and len(sets[k] & sets[j]) >= threshold * len(sets[k] | sets[j])} for k in ids}
    label = {k: k for k in ids}
    changed = True
    while changed:
        changed = False
        for k in ids:
            least = min([label[k], *(label[j] for j in near[k])])
            changed |= least != label[k]
            label[k] = least
    out = {(k, label[k], len(near[k]), len({sets[j] for j in near[k]} - {sets[k]})) for k in ids}
    return out | {(None, None, 0, 0)} if None in sets else out


@pytest.mark.parametrize("how", [{}, {"leaf": 3, "block": 4}, {"leaf": 2, "block": 3, "alike": 2.0}])
def test_equals_all_pairs(spark, how):
    rows = corpus(3)
    docs = spark.createDataFrame([(a, b, "x", 0) for a, b in rows], "doc_id long, text string, node string, size int").repartition(3)
    got = nj.similar_texts(docs, **how).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nj.similar_texts(empty).collect() == []
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y"), (3, None)], "doc_id long, text string")
    assert sorted(map(tuple, nj.similar_texts(docs).collect())) == [(1, 1, 1, 0), (1, 1, 1, 0), (2, 2, 0, 0), (3, 3, 0, 0)]
    assert sorted(map(tuple, nj.one_of_each_class(docs).collect()), key=str) == [(1, "a b c d e f"), (2, "x y"), (3, None)]


@pytest.mark.parametrize("how", [{}, {"leaf": 3, "block": 4}])
def test_one_of_each_class_stays(spark, how):
    rows = [r for r in corpus(9, 15) if r[0] is not None]
    kept = {r.doc_id for r in nj.one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()}
    assert kept == {c for k, c, *_ in brute(rows)}


def test_united_groups_have_the_classes_of_all_pairs(spark):
    """One candidate group of several classes: a chain, a large class, single texts, whatever blocks they fall in."""
    chain = [" ".join(f"c{k}" for k in range(3 * s, 3 * s + 60)) for s in range(12)]
    base = [f"d{k}" for k in range(80)]
    large = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in (0, 1, 2, 77, 78, 79)] * 2
    rows = list(enumerate([*chain, *large, "single one of six words here", "another single of six words here"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = nj.ChosenPathJoin(block=3)
    members = join._sketched(docs)
    sets = members.groupBy("set_id", "n").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("weight"))
    first = {r.set_id: r.first_id for r in sets.collect()}
    groups = sets.selectExpr("set_id", "0L AS root")  # every text in one group
    links = [(first[r.set_id], first[r.root]) for r in join._united(docs, sets, groups).collect()]
    label = {k: k for k in first.values()}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert {(k, label[k]) for k in label} == {(k, c) for k, c, *_ in brute(rows) if k in label}


def test_runs_follow_from_recall():
    assert nj.missed(0.8, 1) == pytest.approx(0.75 * 0.2 + 0.25 * 0.04)
    assert nj.runs_needed(0.8, 1, 0.9999) == 6 or nj.missed(0.8, 1) ** 6 <= 1e-4
    assert nj.runs_needed(0.8, 3, 0.999) > nj.runs_needed(0.8, 1, 0.999)


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_recall_holds_over_shared_coordinates(depth):
    """Runs that draw from one set of coordinates, with the cut: misses at the threshold, by simulation at a lower recall."""
    recall, rng = 0.99, np.random.default_rng(depth)
    runs, least, gone = nj.runs_needed(0.8, depth, recall), nj.least_equal(0.8, recall), 0
    pairs = 4000
    same = rng.random((pairs, nj.COORDINATES)) < 0.8
    for k in range(pairs):
        b = np.where(same[k], 0, 1).astype(np.uint32)
        s = np.stack([np.zeros(nj.COORDINATES, np.uint32), b])
        roots = rng.integers(-(2**62), 2**62, runs)
        at = [set(nj.children(*_twice(roots, s[[i] * runs], depth))[1].tolist()) for i in (0, 1)]
        gone += same[k].sum() < least or not at[0] & at[1]
    assert gone <= (1 - recall) * pairs + 4 * (0.01 * pairs) ** 0.5
    assert nj.least_equal(0.8, 0.9999) / nj.COORDINATES < 0.8 - 4.5 * 0.05


def test_pairs_at_the_threshold_share_a_path():
    rng = np.random.default_rng(4)
    runs = nj.runs_needed(0.8, 2, 0.999)
    hit = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, 900).astype(np.uint64)
        a, b = np.unique(both[:850]), np.unique(both[50:])  # 800 of 900
        s = np.stack([nj.sketch(a), nj.sketch(b)])
        roots = np.arange(runs, dtype=np.int64)
        at = [set(nj.children(*_twice(roots, s[[k] * runs], 2))[1].tolist()) for k in (0, 1)]
        hit += bool(at[0] & at[1])
    assert hit >= 295


def _twice(nodes, sketches, depth):
    for _ in range(depth - 1):
        row, child = nj.children(nodes, sketches, 0.8)
        nodes, sketches = child, sketches[row]
    return nodes, sketches, 0.8


def test_reused_ids_are_decided_by_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = a.replace("a30 ", "x30 ")  # linked to a
    rows = [(1, a), (2, near), (2, b), (3, a), (3, c), (3, c), (4, "d1 d2"), (4, "e1 e2"), (5, a), (6, ""), (6, None), (6, ""), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string").repartition(3)
    got = nj.one_of_each_class(docs).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = [(1, a), (2, b), (3, c), (4, "d1 d2"), (4, "e1 e2"), (6, ""), (6, None), (None, a), (None, a)]
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(want, key=key)
    twice = spark.createDataFrame([(7, a), (7, near), (7, b), (8, near)], "doc_id long, text string")  # two texts of one class under one id
    got = [(r.doc_id, r.text) for r in nj.one_of_each_class(twice).collect()]
    assert len(got) == 2 and (7, b) in got and {i for i, _ in got} == {7}
