"""Stages of calls with recorded replies, and the checks of answers."""

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import calls

REPLY = "struct<text:string, error:string, usage:map<string,bigint>, seconds:double>"


class Counting(calls.RecordedClient):
    """One per partition: numbers its calls in the reply."""

    def __init__(self):
        self.n = 0

    def ask(self, request, attempt):
        self.n += 1
        return calls.Reply('{"n": %d, "id": %s}' % (self.n, request["id"]), {"tokens": self.n}, 1.0)


def test_attempts_and_answers(spark):
    right, fenced = '{"pages": [{"rows": [{"a": "x, ]"}]}]}', 'Sure:\n```json\n{"pages": [{"rows": [{"a": 1},]},]}\n```'
    usage = {"tokens": 5}
    rows = [
        (1, "a", [(right, None, usage, 0.5)]), (2, "b", [("no", None, usage, 1.0), (fenced, None, usage, 2.0)]), (3, "c", [(None, "gone", usage, 1.0)] * 3 + [(right, None, usage, 1.0)]), (4, "d", []),
        (5, "e", None), (None, "f", [('{"pages": []}', None, None, None), (right, None, usage, 0.0)]), (6, "g", [("[1]", None, usage, 0.0), (None, None, None, 0.0), ('{"pages": [{"rows": 1}]}', None, usage, 0.0)]),
    ]
    df = spark.createDataFrame(rows, f"id int, status string, replies array<{REPLY}>").repartition(3)
    got = calls.call_stage(df.withColumnRenamed("status", "other"), "pages", ["id"], calls.RecordedClient, calls.page_shape(1))
    by = {}
    for r in sorted(got.collect(), key=lambda r: r.attempt):
        by.setdefault(r.id, []).append(r)
    assert {k: [r.status for r in v] for k, v in by.items()} == {
        1: ["parsed"], 2: ["invalid_json", "repaired"], 3: ["call_failed"] * 3, 4: ["no_reply"] * 3, 5: ["no_reply"] * 3, None: ["invalid_schema", "parsed"], 6: ["invalid_json", "invalid_json", "invalid_schema"],
    }
    assert by[2][1].payload == '{"pages":[{"rows":[{"a":1}]}]}' and by[2][0].raw_response == "no" and by[3][0].error == "gone"
    assert {r.id for r in calls.accepted(got).collect()} == {1, 2, None}
    sums = {r.id: (r.attempts, r.status, r.usage, r.seconds) for r in calls.request_summary(got, ["id"]).collect()}
    assert sums[2] == (2, "repaired", {"tokens": 10}, 3.0) and sums[3] == (3, "call_failed", {"tokens": 15}, 3.0) and sums[4] == (3, "no_reply", None, 0.0)
    assert calls.call_stage(df.limit(0), "pages", ["id"], calls.RecordedClient, calls.page_shape(1)).collect() == []
    with pytest.raises(ValueError, match="attempt"):
        calls.call_stage(df, "pages", ["id"], calls.RecordedClient, calls.page_shape(1), 0)


def test_a_client_serves_a_partition(spark):
    got = calls.call_stage(spark.range(10).repartition(2), "s", ["id"], Counting, lambda payload: None)
    numbers = [int(n) for n, in got.select(F.get_json_object("payload", "$.n")).collect()]
    assert len(numbers) == 10 and sorted(numbers).count(1) == 2


def test_shapes():
    pages = calls.page_shape(2)
    assert pages({"pages": [{"rows": []}, {"rows": [{}]}]}) is None and calls.page_shape(rows=False)({"pages": [{}]}) is None
    assert all(pages(p) for p in ({}, {"pages": {}}, {"pages": [{"rows": []}]}, {"pages": [1, {"rows": []}]}, {"pages": [{}, {"rows": []}]}, {"pages": [{"rows": [1]}, {"rows": []}]}))
    ok = {"current": {"cash": {"candidate_id": "c"}, "shareholders_funds": None}, "previous": {"cash": {"reason": "none shown"}}}
    assert calls.decision_shape({"financial_period_summaries": ok}) is None
    bad = [None, {"current": {}}, {"current": {}, "previous": []}, *({"current": {"cash": c}, "previous": {}} for c in (None, [], {}, {"reason": " "}, {"candidate_id": 3}))]
    assert all(calls.decision_shape({"financial_period_summaries": b}) for b in bad)
