"""Replay of saved extractions, and the substring index against a scan."""

import json

from pyspark.sql import functions as F

from tallyfold.operators import replay, substring


def saved(page, rows, candidates=()):
    pages = [{"page": page, "statement_type": "income_statement", "statement_scope": "Group", "unit": "GBP", "rows": rows}]
    return json.dumps({"raw_extraction": {"candidates": list(candidates), "detail": {"pages": pages}}})


def test_only_lost_payloads_are_replayed(spark):
    row = {"metric": "turnover", "source_label": "Turnover", "current_display": "120", "previous_display": "(7)", "confidence": 0.5}
    rows = [
        ("lost", saved(" 3 ", [row])), ("number", saved(3, [row])), ("has", saved("3", [row], ["x"])), ("word", saved("iv", [row])), ("empty", saved("3", [])), ("undecided", saved("4", [row])),
        ("failed", saved("4", [row])), ("bad", "{"), ("null", None),
    ]
    df = spark.createDataFrame([(k, p, "old") for k, p in rows], "case_id string, payload string, metrics string")
    ok = {"financial_period_summaries": {"current": {"turnover": {"candidate_id": "p-0-r-0"}, "cash": {"candidate_id": None, "reason": "none"}}, "previous": {"turnover": {"candidate_id": "p-0-r-0"}}}}
    none = {"financial_period_summaries": {"current": {}, "previous": {}}}
    reply = lambda t: [(t, None, None, 0.0)]
    replies = spark.createDataFrame([("lost", reply("Here: " + json.dumps(ok))), ("undecided", reply(json.dumps(none))), ("failed", reply("no"))], "case_id string, replies array<struct<text:string, error:string, usage:map<string,bigint>, seconds:double>>")
    got = {r.case_id: r for r in replay.replayed(df, lambda c: replay.decided_by_calls(c, "case_id", replies), "case_id").collect()}
    assert {k: r.outcome for k, r in got.items()} == {"lost": "replayed", "number": "kept", "has": "kept", "word": "kept", "empty": "kept", "undecided": "replayed", "failed": "replayed", "bad": "kept", "null": "kept"}
    assert [(c.period, c.metric, c.candidate_id, c.value_pence) for c in got["lost"].replayed] == [("current", "turnover", "p-0-r-0", 12000), ("previous", "turnover", "p-0-r-0", -700)]
    assert got["undecided"].replayed == [] == got["failed"].replayed and got["number"].replayed is None and all(r.metrics == "old" for r in got.values())


def test_the_index_finds_what_a_scan_finds(spark, tmp_path):
    texts = ["The Going Concern", "going", "a concern", "", None, "xx", "GOING CONCERN, and going", "ÄÖÜ ß going", "abcabcabd", "goin g concern"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, "THE going concern again"), (None, "going concern")], "id long, text string").repartition(3)
    index = substring.SubstringIndex(spark, f"{tmp_path}/index", "id", 4).build(docs, "text")
    for q in ("going concern", "Going", "g c", "go", "", "äöü", "abd", "bca", "zzz", "going concerns", "the going concern again", "abcabd"):
        want = docs.where(F.contains(F.lower("text"), F.lit(q.lower())) & F.col("id").isNotNull())
        found = index.search(docs, q, "text").where("id is not null")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())), q
    assert {r.id for r in index.candidates("going concern").collect()} == {0, 6} and index.candidates("go") is None and index.candidates("zzz").count() == 0
    assert index.share_read("going concern") == 2 / 10 and index.share_read("go") == 1.0 and index.share_read("zzz") == 0
    plan = index.candidates("abd")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_the_index_holds_a_list_per_piece_and_segment(spark, tmp_path):
    docs = spark.range(300).selectExpr("concat('k', id % 250) AS id", "concat('going concern ', id, CASE WHEN id % 7 = 0 THEN ' *' ELSE '' END) AS text").repartition(2)
    whole = substring.SubstringIndex(spark, f"{tmp_path}/whole", "id", 3).build(docs, "text")
    n = spark.read.parquet(f"{tmp_path}/whole/pieces").where("piece is not null").groupBy("piece", "segment").count()
    assert n.where("count > 1").isEmpty() and n.agg(F.max("segment")).first()[0] is not None
    assert spark.read.parquet(f"{tmp_path}/whole/pieces").count() < 2 * 300  # not a row per piece and text
    small = substring.SubstringIndex(spark, f"{tmp_path}/small", "id", 3, entries=100, texts=5).build(docs, "text")
    assert spark.read.parquet(f"{tmp_path}/small/pieces").select("segment").distinct().count() >= 60
    for q in ("concern 1", "rn 29", "4 *", "n 77 *", "cern 250", "zzz"):
        want = sorted(map(tuple, docs.where(F.contains("text", F.lit(q))).collect()))
        assert [sorted(map(tuple, index.search(docs, q, "text").collect())) for index in (whole, small)] == [want, want], q
    none = substring.SubstringIndex(spark, f"{tmp_path}/none", "id").build(docs.where("id is null"), "text")
    assert none.search(docs, "going", "text").count() == 0 and none.share_read("going") == 0


def test_a_replayed_payload_is_read_once(spark):
    row = {"metric": "turnover", "source_label": "Turnover", "current_display": "120", "previous_display": "(7)", "confidence": 0.5}
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def payload(number):
        read.add(1)
        return saved("3" if number % 2 else 3, [row])

    df = spark.range(40).select(F.col("id").alias("case_id"), payload("id").alias("payload"))
    ok = json.dumps({"financial_period_summaries": {"current": {"turnover": {"candidate_id": "p-0-r-0"}}, "previous": {}}})
    replies = spark.createDataFrame([(k, [(ok, None, None, 0.0)]) for k in range(40)], "case_id long, replies array<struct<text:string, error:string, usage:map<string,bigint>, seconds:double>>")
    got = replay.replayed(df, lambda c: replay.decided_by_calls(c, "case_id", replies), "case_id").collect()
    assert {r.case_id: [c.value_pence for c in r.replayed or []] for r in got} == {k: [12000] * (k % 2) for k in range(40)}
    assert got[0].__fields__ == ["case_id", "payload", "outcome", "replayed"] and read.value == 40
