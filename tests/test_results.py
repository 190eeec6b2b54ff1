"""Cases of what stages of model calls leave in the tables."""

import json

from pyspark.sql import functions as F

from tallyfold.operators import evidence, profiles, results


def payloads(spark, *rows):
    return spark.createDataFrame([(i, "1", "D", p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(rows)], "run_id bigint, company_number string, document_id string, payload string")


def metric(name, period="current", known=True, confidence=0.5, **more):
    return {"metric_name": name, "period_type": period, "validation": {"unit_known": known}, "confidence": confidence, **more}


def test_unreadable_payloads_give_a_run_only(spark):
    rows = payloads(spark, None, "", "x", "[1]", {"metrics": []}, {"metrics": None, "status": "partial", "usage": {"a": 1}, "raw_extraction": {"pages": []}})
    runs = {r.run_id: r for r in results.run_rows(rows).collect()}
    assert [runs[i].status for i in range(6)] == ["unreadable"] * 4 + ["complete", "partial"]
    assert (runs[5].usage_payload, runs[5].raw_extraction_payload, runs[5].rationalisation_payload, runs[0].cost_method) == ('{"a":1}', '{"pages":[]}', "{}", "estimated")
    assert results.metric_rows(rows).count() == 0 and results.run_rows(rows.limit(0)).count() == 0


def test_known_units_then_confidence_then_the_first(spark):
    found = results.metric_rows(payloads(spark, {"metrics": [
        metric("cash", known=False, confidence=0.9, source_page=1), metric("cash", confidence=None, source_page=2), metric("cash", confidence=0.1, source_page=3), metric("cash", confidence=0.1, source_page=4),
        metric("cash", "previous", known=None, source_page=5), None, metric("turnover", source_page=6),
    ]}))
    assert sorted((r.metric_name, r.period_type, r.source_page) for r in found.collect()) == [("cash", "current", 3), ("cash", "previous", 5), ("turnover", "current", 6)]


def period(spark, *metrics):
    return results.period_rows(results.metric_rows(payloads(spark, {"metrics": list(metrics)}))).first()


def test_currency_year_and_amounts(spark):
    r = period(spark, metric("cash", value_pence=12350, financial_year=2020), metric("turnover", reported_value="7.0", currency_code="GBP", financial_year=2020), metric("employees", value_count=4, currency_code="USD"))
    assert (r.cash_reported_value, r.cash, r.turnover_reported_value, r.turnover, r.employees, r.financial_year) == ("123.5", None, "7.0", None, 4, 2020)
    assert (r.currency_code, r.currency_validation_status, json.loads(r.raw_payload)["metrics"]) == ("GBP", "valid", ["cash", "employees", "turnover"])
    r = period(spark, metric("cash", value_pence=12300, financial_year=2020), metric("turnover", reported_value="-7", currency_code="USD", financial_year=2021))
    assert (r.cash, r.turnover, r.currency_code, r.currency_validation_status, r.financial_year) == (123, -7, None, "mixed", None)
    r = period(spark, metric("cash", value_pence=12300, currency_code="USD"), metric("turnover", reported_value="5", currency_code=""))
    assert (r.cash_reported_value, r.turnover, r.currency_code, r.currency_validation_status) == (None, 5, None, "unknown")
    assert period(spark, metric("creditors", value_pence=1)) is None


def test_amounts_as_text(spark):
    values = [0, 5, 10, 100, 12350, -1230, 10000, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "p bigint").select(results.amount_text(F.col("p"))).collect()]
    assert got == ["0", "0.05", "0.1", "1", "123.5", "-12.3", "100", None]


def test_markup_periods_stay_and_the_last_run_counts(spark):
    fresh = results.period_rows(results.metric_rows(payloads(spark, {"metrics": [metric("cash", reported_value="1")]}, {"metrics": [metric("cash", reported_value="2"), metric("cash", "previous", reported_value="3")]})))
    kept = spark.createDataFrame([("1", "D", "previous", 9, "xhtml"), ("2", None, "current", 8, "vlm")], "company_number string, document_id string, period_type string, cash bigint, data_source string")
    got = {(r.company_number, r.period_type): (r.cash, r.data_source) for r in results.stored_periods(kept, fresh).collect()}
    assert got == {("1", "previous"): (9, "xhtml"), ("1", "current"): (2, "vlm"), ("2", "current"): (8, "vlm")}
    again = results.stored_periods(results.stored_periods(kept, fresh), fresh)
    assert {(r.company_number, r.period_type): (r.cash, r.data_source) for r in again.collect()} == got


def test_locator_without_a_page_and_pages_without_a_locator(spark):
    pages = spark.createDataFrame([(1, 3, "group", "cash_flow"), (1, None, None, None), (2, 3, "x", "notes")], "d int, page int, statement_scope string, statement_type string")
    located = spark.createDataFrame([(1, None, 0, "company", "balance_sheet"), (1, 3, 1, "unknown", None)], "d int, page int, position int, statement_scope string, statement_type string")
    got = sorted((r.d, r.page or 0, r.statement_scope, r.statement_type) for r in results.with_located(pages, located, ["d"]).collect())
    assert got == [(1, 0, "unknown", "other"), (1, 3, "consolidated_group", "cash_flow"), (2, 3, "unknown", "other")]


def test_answers_and_pages_of_reviewers(spark):
    rows = spark.createDataFrame([("a", "q", "1", 5, 0), ("a", "q", "2", 5, 1), ("a", "q", "3", None, 2), ("a", None, "4", 9, 3)], "case_id string, name string, value string, updated_ms bigint, position int")
    assert [tuple(r) for r in results.latest_answers(rows, ["case_id"]).collect()] == [("a", "q", "2")]
    told = spark.createDataFrame([("2,1, 2",), (" , ",), ("0,1",), ("1,x",), ("",), (None,)], "v string")
    assert [r[0] for r in told.select(results.statement_pages(F.col("v"))).collect()] == [[1, 2], None, None, None, None, None]
    traces = spark.createDataFrame([("a", "1", "D", "h", "s", "t", "r", "d")], "case_id string, company_number string, document_id string, pdf_sha256 string, split string, trace_id string, reviewer string, reviewed_at string")
    r = results.reviewed_cases(traces, results.latest_answers(rows, ["case_id"])).first()
    assert len(r.missing) == 15 and r.errors == [] and r.case_json is None


def test_results_of_the_last_file_and_failures_without_one(spark):
    saved = spark.createDataFrame([("a", 1, "f1", "x"), ("a", 1, "f2", "y"), ("b", 2, "f3", "z"), (None, 1, "f4", "w")], "case_id string, attempt int, file string, payload string")
    outcomes = spark.createDataFrame([("a", "p", "late", None, 1.0), ("b", "p", None, {"tokens": 3}, None), (None, "p", None, None, None)], "case_id string, pdf_path string, error string, usage map<string,bigint>, elapsed_seconds double")
    got = {r.case_id: r for r in results.saved_results(saved, outcomes, {}).collect()}
    assert set(got) == {"a", "b"} and got["a"].payload == "y" and got["b"].synthesised
    made = json.loads(got["b"].payload)
    assert made["metrics"] == [] and made["usage"] == {"tokens": 3} and made["models"] == {"locator": None, "vision": None, "rationalisation": None} and made["elapsed_seconds"] is None


def test_a_question_needs_a_filing(spark):
    rows = spark.createDataFrame([("n", "1", "s", "body"), ("n", "1", "s", None)], "company_name string, sic_code_primary string, sic_label string, text string")
    got = [r.question for r in profiles.whole_question(rows).collect()]
    assert got[0].endswith("## filed_report\nbody") and got[1] is None


def test_grades_of_answers(spark):
    whole = "model string, context string, answer struct<" + ", ".join(f"{f}: struct<value: string>" for f in results.SCORED) + ">, issues array<string>, expected struct<" + ", ".join(f"{f}: string" for f in results.SCORED) + ">, prompt_tokens bigint, completion_tokens bigint, elapsed_seconds double"
    said, none = tuple(("a",) for _ in results.SCORED), tuple(None for _ in results.SCORED)
    wanted = ("a", "b", *none[2:])
    cases = [(said, []), (said, ["customer_type: no quote"]), (said, ["sic_agreement: value not allowed"]), (said, ["business_description: missing"]), (said, ["not JSON"]), (None, []), (said, None)]
    rows = results.graded(spark.createDataFrame([("m", "c", a, i, wanted, 1, None, 0.25) for a, i in cases], whole))
    assert [r.grade for r in rows.select("grade").collect()] == ["scored", "partial", "partial", "rejected", "rejected", "rejected", "scored"]
    r = results.combination_report(rows).first()
    assert (r.cases, r.rejections, r.partial_rejections, r.quote_pass_rate, r.unclear_rate, r.prompt_tokens, r.completion_tokens, r.elapsed_seconds) == (7, 5, 2, 0.2857, 0.0, 7, None, 1.8)
    fields = {r.field: (r.scored, r.accuracy) for r in results.combination_fields(rows).collect()}
    assert fields["demand_model"] == (7, 0.5714) and fields["customer_type"] == (7, 0.0) and fields["sic_agreement"] == (0, None)
    assert results.combination_report(rows.limit(0)).count() == 0


def test_reviewed_cases_are_put_together_without_a_join(spark):
    traces = spark.createDataFrame([("a", "1", "D", "h", "s", t, "r", "d") for t in ("t", "u")] + [("b", "1", "D", "h", "s", "v", "r", "d")], "case_id string, company_number string, document_id string, pdf_sha256 string, split string, trace_id string, reviewer string, reviewed_at string")
    names = [f"gold_{p}_{m}" for p in results.PERIODS for m in evidence.CANONICAL]
    answers = spark.createDataFrame([("a", n, "MISSING") for n in names] + [("a", "gold_statement_pages", "2, 1"), ("a", "other", "x"), ("c", names[0], "5 | 1 | GBP"), (None, names[0], "MISSING")], "case_id string, name string, value string")
    found = results.reviewed_cases(traces, answers)
    rows = sorted((r.case_id, len(r.missing), len(r.errors), r.case_json and json.loads(r.case_json)["metadata"]["review_trace_id"]) for r in found.collect())
    assert rows == [("a", 0, 0, "t"), ("a", 0, 0, "u"), ("b", 15, 0, None)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_traces_hold_their_answers(spark):
    given = "name string, value string, updated_ms bigint"
    names = [f"gold_{p}_{m}" for p in results.PERIODS for m in evidence.CANONICAL]
    full = [("gold_statement_pages", "9", 1), ("gold_statement_pages", "2, 1", 2), *[(n, "MISSING", None) for n in names], ("gold_current_cash", "(1,234) | 4 | £'000", 1), ("gold_current_cash", "5", 1), ("gold_current_cash", "6", 0), (None, "x", 9), ("other", "x", 9)]
    right = [*full, ("gold_current_cash", "(1,234) | 4 | £'000", 1), ("gold_previous_employees", " - | 7 | ", 1)]
    wrong = [*full, ("gold_current_turnover", "1 | 0 | GBP", 1), ("gold_previous_turnover", "x | 1 | GBP", 1), ("gold_previous_cash", "1 | 1 | ?", 1), ("gold_previous_net_assets", None, 1)]
    traces = spark.createDataFrame([(i, "1", "D", "h", "s", "t", "r", "d", a) for i, a in (("a", right), ("b", wrong), ("c", full[3:]), ("d", []), ("e", None), ("a", wrong), (None, right))], f"case_id string, company_number string, document_id string, pdf_sha256 string, split string, trace_id string, reviewer string, reviewed_at string, answers array<struct<{given.replace(' ', ':')}>>".replace(",:", ", "))
    found = results.reviewed_traces(traces.withColumn("answers", results.latest_of(F.col("answers"))))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Join", "Aggregate", "Window", "Generate", "Repartition"))
    rows = [(r.case_id, len(r.missing), len(r.errors), r.case_json and json.loads(r.case_json)) for r in found.collect()]
    assert [(i, m, e, c is not None) for i, m, e, c in rows] == [("a", 0, 0, True), ("b", 0, 5, False), ("c", 2, 0, False), ("d", 15, 0, False), ("e", 15, 0, False), ("a", 0, 5, False), (None, 0, 0, True)]
    assert found.collect()[1].errors == [
        "gold_current_turnover: page is no positive number", "gold_current_cash: expected three parts", "gold_previous_turnover: value is no number", "gold_previous_cash: unit is not known", "gold_previous_net_assets: page is no positive number",
    ]
    expected = rows[0][3]["expected"]
    assert expected["statement_pages"] == [1, 2] and expected["financial_period_summaries"]["current"]["turnover"] == {"state": "missing"} | dict.fromkeys(("displayed_value", "unit", "source_page", "value_count", "reported_value", "value_pence", "evidence_kind"))
    cash, people = expected["financial_period_summaries"]["current"]["cash"], expected["financial_period_summaries"]["previous"]["employees"]
    assert (cash["state"], cash["unit"], cash["source_page"], cash["value_pence"], cash["reported_value"]) == ("present", "GBP_THOUSANDS", 4, -123_400_000, -1_234_000)
    assert (people["unit"], people["value_count"], people["evidence_kind"], people["value_pence"]) == ("COUNT", 0, "dash_zero", None)
    old = results.reviewed_cases(traces.where("case_id = 'b'").drop("answers"), results.latest_answers(traces.where("case_id = 'b'").select("case_id", F.posexplode("answers").alias("position", "x")).select("case_id", "position", "x.*"), ["case_id"])).first()
    assert (old.missing, old.errors, old.case_json) == tuple(found.collect()[1])[1:]
