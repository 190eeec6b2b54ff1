from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from tallyfold.llm import pfair_mix as pm


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_every_prefix_is_less_than_a_block_off(weights):
    order = pm.period(weights)
    q, done = sum(weights), Counter()
    for t, s in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[k] * q - w * t) < q for k, w in enumerate(weights))


def slowly(rows, weights, default, size):
    """Slots of all blocks, one slot after the other, without using that they repeat."""
    names = sorted(rows, key=lambda s: (s is None, s or ""))
    left = {s: -(-rows[s] // size) for s in names}
    slots, start, used = {}, 0, Counter()
    for rank in (True, False):
        while live := [s for s in names if (weights.get(s, default) > 0) == rank and left[s]]:
            w = {s: int(weights.get(s, default)) if rank else default for s in live}
            q, t, own = sum(w.values()), 0, Counter()
            while all(left[s] for s in live):
                ready = [(-(-(own[s] + 1) * q // w[s]), live.index(s), s) for s in live if own[s] * q // w[s] <= t]
                s = min(ready)[2]
                slots[s, used[s]] = start + t
                own[s] += 1
                used[s] += 1
                left[s] -= 1
                t += 1
            start += t
    return slots


CASES = [{"a": 100, "b": 37, None: 12, "z": 9}, {"a": 5}, {"b": 1, "c": 700, "d": 64}]


@pytest.mark.parametrize("rows", CASES)
def test_rows_are_placed_as_slot_by_slot(spark, rows):
    weights = {"a": 3, "b": 5, "c": 1, "z": 0}
    docs = [(None if n == 0 else 1000 * k + n, s, "x") for k, (s, m) in enumerate(rows.items()) for n in range(m)]
    docs = spark.createDataFrame(docs + docs[:1], "doc_id long, source string, slot string").repartition(3)
    rows = dict(Counter(r.source for r in docs.collect()))
    got = pm.mix(docs, weights, default_weight=2, block_rows=4, chunk_rows=16).collect()
    assert sorted(r.position for r in got) == list(range(sum(rows.values())))
    want = slowly(rows, weights, 2, 4)
    assert {(r.source, r.block): r.slot for r in got} == want
    assert all(r.release <= r.slot < r.deadline for r in got)
    by_position = [r.slot for r in sorted(got, key=lambda r: r.position)]
    assert by_position == sorted(by_position)
    ordered = pm.in_order(pm.mix(docs, weights, default_weight=2, block_rows=4, chunk_rows=16), len(got), 20).collect()
    assert [r.position for r in ordered] == list(range(len(got)))


def test_empty_table_and_too_many_sources(spark):
    assert pm.mix(spark.createDataFrame([], "doc_id long, source string"), {}).collect() == []
    with pytest.raises(ValueError):
        pm.mix(spark.createDataFrame([(k, str(k)) for k in range(9)], "doc_id long, source string"), {}, max_sources=5)


def test_tables_are_ordered_by_one_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pm, "SEGMENT", 100)
    rows = [(None if k % 3 == 0 else 7 if k % 5 == 0 else k, "ab"[k % 2] if k % 11 else None, f"t{k}", k, "x") for k in range(900)]
    spark.createDataFrame(rows + rows[:5], "doc_id long, source string, text string, position int, block string").repartition(4).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    got = pm.mixed_in_order(docs, {"a": 3, "b": 5}, default_weight=1, block_rows=4, chunk_rows=64, rows_per_task=200)
    assert sum("Exchange REPARTITION" in line or "hashpartitioning" in line for line in got._jdf.queryExecution().executedPlan().toString().splitlines()) <= 1
    found = got.collect()
    assert [r.position for r in found] == list(range(905))
    assert sorted(str(r.text) for r in found) == sorted(r[2] for r in rows + rows[:5])
    want = pm.mix(docs, {"a": 3, "b": 5}, default_weight=1, block_rows=4, chunk_rows=64).orderBy("position").collect()
    assert [(r.doc_id, r.source) for r in want] == [(r.doc_id, r.source) for r in found]
    again = pm.mixed_in_order(spark.createDataFrame(found[:50]), {"a": 1}, block_rows=4).collect()
    assert [r.position for r in again] == list(range(50))
    spark.createDataFrame([], docs.schema).write.parquet(f"{tmp_path}/empty")
    assert pm.mixed_in_order(spark.read.parquet(f"{tmp_path}/empty"), {}).collect() == []


def test_rows_that_share_an_id_or_have_none_are_dealt_out(spark, tmp_path):
    spark.range(8000).selectExpr("if(id % 2 = 0, null, 5L) AS doc_id", "'s' AS source", "if(id % 2 = 0, 'same', 't' || id) AS text").repartition(2).write.parquet(f"{tmp_path}/t")
    keyed = pm._keyed(spark.read.parquet(f"{tmp_path}/t"), "source", "doc_id", 17)
    largest = keyed.groupBy(keyed["__hash"]).count().agg({"count": "max"}).first()[0]
    assert largest <= 2
