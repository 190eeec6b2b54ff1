"""Triage, histories, conversion, upserts, facts, narrative, evidence and the service on small cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators import evidence, facts, fx, ingestion, narrative, sampling, scoring, timeseries, triage, upsert, websites
from tallyfold.plans.service import LeadService
from tallyfold.sources import files, responses


def table(spark, name, rows):
    """Rows as dicts in a stored table's schema."""
    kind = schemas.schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind) for r in rows], kind)


def period(id_, company, document="d1", role="current", year=2024, end=date(2024, 3, 31), **more):
    return {"id": id_, "company_number": company, "document_id": document, "period_type": role, "financial_year": year, "period_end_on": end} | more


def test_triage(spark):
    companies = [("1", "Alpha Holdings", "active", "47910"), ("2", "Beta Ltd", "active", "64209"), ("3", "Gamma", "dissolved", "1"), ("4", "Delta", "active", "82990"), ("5", "Eps", "active", None), ("6", "Zeta Holdco", "active", "1"), ("7", "Copy A", "active", "1"), ("8", "Copy B", "active", "1"), ("9", "Nil", "active", "1")]
    c = table(spark, "companies", [dict(zip(("company_number", "company_name", "company_status", "sic_code_primary"), r)) for r in companies])
    p = table(spark, "periods", [
        period(1, "1", turnover=500, employees=0.0), period(2, "2", turnover=5), period(4, "4", turnover=6_000_000, employees=2.0, gross_profit=1_000_000),
        period(3, "4", year=2023, turnover=1, employees=0.0), period(6, "6", turnover=50_000, employees=3.0, gross_profit=60_000), period(7, "7", turnover=77_000, employees=4.0),
        period(8, "8", turnover=77_000, employees=0.0), period(9, "9", employees=0.0), period(10, "9", role="previous", turnover=5),
    ])
    got = {r.company_number: r for r in triage.triage(c, p).collect()}
    assert {k: r.trading_status for k, r in got.items()} == {"1": "holding", "2": "holding", "3": "non_trading", "4": "trading", "5": "unknown", "6": "unknown", "7": "trading", "8": "holding", "9": "dormant"}
    assert (got["4"].revenue_per_employee, got["4"].revenue_per_employee_flagged, got["4"].gross_margin_pct, got["4"].sic_is_catch_all) == (3_000_000, True, 16.67, True)
    assert got["6"].gross_margin_pct is None and got["8"].duplicate_of == "7" and got["7"].duplicate_of is None and got["1"].turnover_without_employees
    long = upsert.to_signals(triage.triage(c, p), "company_number", triage.SIGNALS)
    wide = {r.company_number: r for r in upsert.from_signals(long, "company_number", ["gross_margin_pct"], ["sic_is_catch_all"], ["trading_status"]).collect()}
    assert (wide["4"].gross_margin_pct, wide["4"].sic_is_catch_all, wide["4"].trading_status) == (16.67, 1, "trading")
    assert {r.trading_status: r.n for r in triage.status_counts(triage.triage(c, p)).collect()}["holding"] == 3


def test_duplicates_prefer_operating_companies(spark):
    rows = spark.createDataFrame([("1", "Big Holdings", 20_000, "a"), ("2", "Works", 20_000, "a"), ("3", "Other", 20_000, "b"), ("4", "X", 5_000, "a"), ("5", "Y", 5_000, "a")], "k string, name string, t int, p string")
    assert {r.k: r.duplicate_of for r in triage.duplicates(rows, "k", "t", "p", "name").collect()} == {"1": "2"}


def test_signals_upsert(spark):
    none = schemas.ensure_schema(spark.createDataFrame([], "company_number string"), "company_signals")
    first = spark.createDataFrame([("1", 5, "a", True)], "company_number string, n int, s string, f boolean")
    at = lambda d: F.lit(datetime(2024, 1, d))
    one = upsert.upsert_signals(none, upsert.to_signals(first, "company_number", ["n", "s", "f"]), "company_number", at(1))
    again = upsert.upsert_signals(one, upsert.to_signals(first, "company_number", ["n", "s", "f"]), "company_number", at(2))
    assert sorted((r.signal_key, r.created_at.day, r.updated_at.day) for r in again.collect()) == [("f", 1, 2), ("n", 1, 2), ("s", 1, 2)]
    changed = spark.createDataFrame([("1", 2.5, None, False)], "company_number string, n double, s string, f boolean")
    got = {r.signal_key: (r.signal_int, r.signal_real, r.signal_bool) for r in upsert.upsert_signals(one, upsert.to_signals(changed, "company_number", ["n", "s", "f"]), "company_number", at(3)).collect()}
    assert got == {"n": (None, 2.5, None), "f": (None, None, False)}


def test_upsert_rules(spark):
    have = spark.createDataFrame([(1, "a", "xhtml", "old"), (2, "b", "vlm", "old"), (None, "n", "vlm", "old")], "k int, v string, src string, made string")
    new = spark.createDataFrame([(1, "A", "vlm", "new"), (2, "B", "vlm", "new"), (3, "C", "vlm", "new"), (None, "N", "vlm", "new")], "k int, v string, src string, made string")
    got = upsert.upsert(have, new, ["k"], keep=["made"], only_if=F.col("e.src") == "vlm")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a", "xhtml", "old"), (2, "B", "vlm", "old"), (3, "C", "vlm", "new"), (None, "N", "vlm", "old")], key=str)
    added = upsert.insert_new(have, new, ["k"])
    assert sorted((str(r.k), r.v) for r in added.collect()) == [("1", "a"), ("2", "b"), ("3", "C"), ("None", "n")]
    assert upsert.insert_new(added, new, ["k"]).count() == 4  # a null key is found again, as any other
    two = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, v string")
    assert sorted(r.v for r in upsert.insert_new(two, spark.createDataFrame([(1, None, "z"), (None, 2, "w"), (None, None, "u")], "a int, b int, v string"), ["a", "b"]).collect()) == ["w", "x", "y"]


def test_conversion(spark):
    empty = schemas.ensure_schema(spark.createDataFrame([], "series string"), "fx_rates")
    day = spark.createDataFrame([(date(2024, 1, 5), Decimal(2), "p1"), (date(2023, 12, 1), Decimal(4), "p0")], "rate_date date, rate decimal(20,8), payload string")
    rates = fx.import_rates(empty, day, "USD", "XUDLGBD", "http://bank")
    assert fx.import_rates(rates, day, "USD", "XUDLGBD", "http://bank").count() == 2
    rows = [
        period(1, "1", end=date(2024, 1, 8), currency_code="USD", turnover=15_073_418), period(2, "1", end=date(2024, 1, 16), currency_code="USD", turnover=1),
        period(3, "1", end=None, currency_code="USD", turnover=1), period(4, "1", end=None, currency_code="GBP", turnover=7, cash=None), period(5, "1", end=date(2024, 1, 5), currency_code="EUR", turnover=1),
        period(6, "1", end=date(2024, 1, 15), currency_code="USD", turnover=3),
    ]
    p = table(spark, "periods", [r | {"currency_validation_status": "valid"} for r in rows] + [period(7, "1", currency_code="GBP")])
    got = {r.summary_id: (r.status, r.reason, r.turnover_pence) for r in fx.convert(p, rates).collect()}
    assert got == {1: ("converted", None, 753_670_900), 2: ("pending", "missing_rate", None), 3: ("pending", "missing_period_end", None), 4: ("converted", None, 700), 5: ("pending", "missing_rate", None), 6: ("converted", None, 150)}


def test_rates_file(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿DATE,XUDLGBD\n05 Jan 2024,2\n06 Jan 2024,n/a\n07 Jan 2024,-1\nbad,3\n08 Jan 2024,\"1,000.5\"\n", encoding="utf-8")
    got = sorted((r.rate_date, r.rate) for r in files.exchange_rates(spark, str(tmp_path), "XUDLGBD").collect())
    assert got == [(date(2024, 1, 5), Decimal("2.00000000")), (date(2024, 1, 8), Decimal("1000.50000000"))]


def test_overlap(spark):
    p = table(spark, "periods", [
        period(1, "1", "old", "current", turnover=100, employees=5.0), period(2, "1", "new", "previous", turnover=110, employees=5.0), period(3, "1", "new", "current", 2025, date(2025, 3, 31), turnover=1),
        period(4, "2", "old", "current", turnover=9), period(5, "2", "new", "previous", turnover=9, cash=3), period(6, "2", "old2", "current", turnover=7), period(7, "3", "x", "previous", turnover=1), period(8, "3", "x", "current", turnover=1),
    ])
    got = {r.id: (r.comparative_overlap_status, r.comparative_overlap_payload) for r in timeseries.with_overlap(p).collect()}
    assert got[2] == ("mismatch", '{"turnover":{"previous_period_reading":110,"adjacent_filing_reading":100}}')
    assert got[5] == ("match", None) and all(got[k] == (None, None) for k in (1, 3, 4, 6, 7, 8))


def test_filing_history(spark):
    rows = [("AA", "2024-01-01", "2023-03-31", None, 0), ("AAMD", "2024-02-01", "2023-03-31", None, 1), ("AA", "2023-01-01", None, "2022-03-31", 2), ("AA01", "2023-05-01", "2021-03-31", None, 3), ("AA", "2018-01-01", "2017-03-31", None, 4), ("AA", "2022-01-01", "2021-03-31", None, 5), ("AA", "2022-01-01", "2021-03-31", None, 6), ("AA", "2022-01-01", None, None, 7)]
    f = spark.createDataFrame(rows, "type string, date string, made_up_date string, action_date string, position int").withColumns({c: F.to_date(c) for c in ("date", "made_up_date", "action_date")}).withColumn("company_number", F.lit("1"))
    got = [(str(r.period_end), r.position) for r in timeseries.accounts_history(f, F.to_date(F.lit("2024-06-30")), 5, 4).orderBy("rank").collect()]
    assert got == [("2023-03-31", 1), ("2022-03-31", 2), ("2021-03-31", 5)]


TAGGED = """<html><ix:header><ix:hidden>secret principal activity</ix:hidden></ix:header>
<xbrli:context id="c1"><xbrli:period><xbrli:startDate>2023-04-01</xbrli:startDate><xbrli:endDate>2024-03-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="c2"><xbrli:period><xbrli:endDate>2023-03-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="c3"><xbrli:entity><xbrli:segment>x</xbrli:segment></xbrli:entity><xbrli:period><xbrli:instant>2024-03-31</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:unit id="u"><xbrli:measure>iso4217:GBP</xbrli:measure></xbrli:unit>
<ix:nonFraction name="core:TurnoverRevenue" contextRef="c1" unitRef="u" scale="3">1,250</ix:nonFraction>
<ix:nonFraction name="ns5:Turnover" contextRef="c2" unitRef="u">900</ix:nonFraction><ix:nonFraction name="x:Revenue" contextRef="c2" unitRef="u">901</ix:nonFraction>
<ix:nonFraction name="core:ProfitLoss" contextRef="c1" sign="-" unitRef="u">5</ix:nonFraction><ix:nonFraction name="core:ProfitLoss" contextRef="c3">77</ix:nonFraction>
<ix:nonFraction name="core:AverageNumberEmployeesDuringPeriod" contextRef="c1" scale="-2">2.5</ix:nonFraction>
<ix:nonFraction name="core:CashBankOnHand" contextRef="c1">-</ix:nonFraction>
<p>Principal activity. The company sells shoes. Turnover rose by a third. Going concern. All is well.</p></html>"""


def test_tagged_facts(spark):
    docs = spark.createDataFrame([("d", "1", TAGGED), ("e", "2", None)], "document_id string, company_number string, xhtml string")
    rows = facts.tag_rows(docs, "document_id", "xhtml")
    got = {(r.period_type, r.metric): r.value for r in facts.resolved(rows, "document_id").collect()}
    assert got == {("current", "turnover"): 1_250_000.0, ("current", "profit_after_tax"): -5.0, ("current", "employees"): 2.5, ("current", "cash"): 0.0}
    periods = {r.period_type: r for r in ingestion.periods_of(docs).collect()}
    assert (periods["current"].financial_year, periods["current"].period_end_on, periods["current"].currency_code, periods["current"].turnover) == (2024, date(2024, 3, 31), "GBP", 1_250_000.0)
    assert periods["previous"].financial_year == 2023 and periods["previous"].turnover is None
    assert facts.derived(facts.year_views(rows, "document_id"), "document_id").first().net_margin_pct == pytest.approx(-5 / 1_250_000)
    sections, statements = ingestion.narrative_of(docs)
    found = {r.section_key: r.text for r in sections.collect()}
    assert found == {"principal_activity": "Principal activity. The company sells shoes. Turnover rose by a third.", "going_concern": "Going concern. All is well."}
    assert [r.text for r in statements.collect()] == ["Turnover rose by a third."]


def test_sections_prefer_the_company(spark):
    pages = ["Principal risks and uncertainties are many and described at length here. Future developments are none.", "Independent auditor's report. We have audited. Principal risks of the audit were considered at much greater length than above, indeed. Strategic report follows. Business review: fine."]
    got = {r.section_key: r for r in narrative.sections(spark.createDataFrame([(1, pages), (2, [])], "id int, pages array<string>"), "id", "pages").collect()}
    assert got["principal_risks"].text.startswith("Principal risks and uncertainties are many") and not got["principal_risks"].is_auditor_text
    assert got["business_review"].is_auditor_text is False and got["strategic_report"].is_auditor_text is True  # what precedes the heading counts
    long = "going concern " + "x" * 9000
    assert narrative.sections(spark.createDataFrame([(1, [long])], "id int, pages array<string>"), "id", "pages").first().text == ("going concern " + "x" * 9000)[:6000]
    quality = narrative.text_quality(spark.createDataFrame([(1, ["ab", "", "c"]), (2, [])], "id int, pages array<string>"), "id", "pages").orderBy("id").collect()
    assert [tuple(r)[1:] for r in quality] == [(3, 2, 3, 1.5), (0, 0, 0, 0.0)]


ROW = "struct<metric:string, source_label:string, current_display:string, previous_display:string, confidence:double>"


def candidates(spark, rows, key="d"):
    """(page, statement, scope, unit, metric, label, current, previous, confidence) rows of one document."""
    by_page = {}
    for page, statement, scope, unit, *row in rows:
        by_page.setdefault((page, statement, scope, unit), []).append(tuple(row))
    pages = [(p, s, c, u, r) for (p, s, c, u), r in by_page.items()]
    docs = spark.createDataFrame([(key, pages)], f"document_id string, pages array<struct<page:int, statement_type:string, statement_scope:string, unit:string, rows:array<{ROW}>>>")
    return evidence.exploded(docs)


def test_evidence_policy(spark):
    rows = candidates(spark, [
        (1, "income_statement", "Group", "GBP", "turnover", "Turnover", "100", "90", 0.9), (1, "income_statement", "Group", "GBP", "profit_before_tax", "Profit before tax", "20", "15", 0.9),
        (2, "balance_sheet", "Group", "GBP", "shareholders_funds", "Shareholders' funds", "50", None, 0.8), (3, "other", "Group", "GBP", "turnover", "Turnover note", "99", "91", 0.99),
        (4, "income_statement", "Company", "GBP", "net_earned_premiums", "Earned premiums, net of reinsurance", "70", "60", 0.7), (4, "income_statement", "Company", "GBP", "claims_incurred_net_reinsurance", "Claims incurred, net of reinsurance", "(30)", "-", 0.6),
        (5, "other", "Group", "GBP", "tax", "Tax", "1", None, 0.5),
    ])
    found = evidence.with_equivalents(rows, ["document_id"])
    derived = {(r.metric, r.tier): (r.current_display, r.previous_display, r.confidence) for r in found.where("derived_from is not null").collect()}
    assert derived == {("operating_result", 3): ("20", "15", 0.9), ("net_assets", 2): ("50", None, 0.8), ("gross_profit", 2): ("40", "60", 0.6)}
    best = {r.metric: r.current_display for r in evidence.strongest(found.where(F.col("tier") < 5), ["document_id"]).where(F.col("metric").isin(evidence.CANONICAL)).collect()}
    assert best == {"turnover": "100", "operating_result": "20", "net_assets": "50", "gross_profit": "40"}
    decisions = spark.createDataFrame([("d", "current", "turnover", "p-0-r-0"), ("d", "previous", "turnover", "p-0-r-0"), ("d", "previous", "net_assets", "p-1-r-0:net_assets")], "document_id string, period string, metric string, candidate_id string")
    chosen = {(r.period, r.metric): (r.reported_value, r.currency_code, r.value_pence) for r in evidence.selected(found, decisions, ["document_id"]).collect()}
    assert chosen == {("current", "turnover"): (Decimal("100.000000"), "GBP", 10_000), ("previous", "turnover"): (Decimal("90.000000"), "GBP", 9_000)}


def test_validation_and_repairs(spark):
    rows = candidates(spark, [
        (1, "income_statement", "Group", "GBP", "turnover", "", "2024", None, 0.9), (1, "income_statement", "Group", "EUR", "cash", "Cash", "5", None, 0.9), (1, "income_statement", "Group", "GBP", "turnover", "Turnover", "5", "4", 0.9),
        (1, "income_statement", "Group", "GBP", "profit_after_tax", "Profit before tax", None, None, 0.9), (2, "balance_sheet", "Group", "UNKNOWN", "employees", "Staff", "12", None, 0.9),
    ])
    ok, bad = evidence.validated(rows)
    assert sorted(r.candidate_id for r in ok.collect()) == ["p-0-r-2", "p-1-r-0"] or sorted(r.source_label for r in ok.collect()) == ["Staff", "Turnover"]
    issues = {r.source_label: [i.code for i in r.issues] for r in bad.collect()}
    assert issues == {"": ["missing_source_label", "year_used_as_value"], "Cash": ["unknown_money_unit", "metric_statement_conflict"], "Profit before tax": ["missing_period_values", "metric_label_conflict"]}
    assert {r.code: r.n for r in evidence.issue_report(bad).collect()}["missing_source_label"] == 1
    wrong = candidates(spark, [(1, "income_statement", "Group", "GBP", "current_assets", "Current", "1", None, 1.0), (1, "income_statement", "Group", "GBP", "net_assets", "Net", "1", None, 1.0)])
    assert {r.statement_type for r in evidence.corrected_statement(wrong, ["document_id", "page"]).collect()} == {"balance_sheet"}
    mixed = candidates(spark, [(p, "balance_sheet", "Group", u, "cash", "Cash", "1", None, 1.0) for p, u in enumerate(["GBP", "GBP", "USD_THOUSANDS"])])
    assert sorted(r.unit for r in evidence.in_majority_currency(mixed).collect()) == ["GBP", "GBP", "GBP_THOUSANDS"]
    merged, conflicts = evidence.with_recovered(ok, candidates(spark, [(1, "income_statement", "Group", "GBP", "turnover", "TURNOVER", "6", "4", 0.9), (1, "income_statement", "Group", "GBP", "tax", "Tax", "1", None, 0.9)]), ["document_id"])
    assert merged.count() == 3 and conflicts.count() == 1


def test_labels_and_head_counts(spark):
    labels = spark.createDataFrame([("operating_result", "group operating loss", True), ("operating_result", "operating profit before exceptional items", False), ("operating_result", "other operating income", False), ("profit_after_tax", "profit before tax", False), ("turnover", "x", True)], "m string, l string, want boolean")
    assert all(r.got == r.want for r in labels.withColumn("got", evidence.canonical_label_fits(F.col("m"), F.col("l"))).collect())
    scopes = spark.createDataFrame([("Group accounts", "consolidated_group"), ("parent-company", "company"), ("Company", "company"), (None, "unknown"), ("x", "unknown")], "s string, want string")
    assert all(r.got == r.want for r in scopes.withColumn("got", evidence.statement_scope(F.col("s"))).collect())
    kind = "k int, metric string, evidence_text string, period_scope string, current_display string, previous_display string, current_evidence_kind string, previous_evidence_kind string, current_value_count int, previous_value_count int"
    zero = ("narrative_zero", "narrative_zero", 0, 0)
    rows = spark.createDataFrame([
        (1, "employees", "The company has no employees.", "both", None, None, *zero), (2, "employees", "It had no employees other than directors.", "both", None, None, *zero),
        (3, "employees", "It had no employees in both periods.", "both", None, None, *zero), (4, "employees", None, None, "–", "x", "dash_zero", "numeric", 0, 3), (5, "employees", "Staff are few.", "current", None, None, "narrative_zero", None, 0, None),
    ], kind)
    fixed = evidence.with_narrative_scope(rows).withColumn("codes", evidence.narrative_zero_issues())
    got = {r.k: (r.period_scope, r.previous_value_count, r.codes) for r in fixed.collect()}
    assert got[1] == ("current", None, []) and got[3] == ("both", 0, [])
    assert got[2][2] == ["ambiguous_narrative_zero_evidence"] * 2 and got[4][2] == ["invalid_numeric_employee_evidence"] and got[5][2] == ["invalid_narrative_zero_evidence"]
    pages = spark.createDataFrame([(1, "The company employed no persons."), (2, "no employees other than directors; had no employees except two"), (3, None)], "page int, text string")
    assert [r.page for r in evidence.no_employee_pages(pages).collect()] == [1]
    sided = spark.createDataFrame([("cash", "2024", "2023", "5", None), ("cash", "2024", None, "5", None), ("employees", "a", "b", "5", None), ("tax", "a", "b", None, "1")], "metric string, current_column string, previous_column string, current_display string, previous_display string")
    assert [r.x for r in sided.select(evidence.one_sided_row().alias("x")).collect()] == ["previous", None, None, "current"]


def test_recovery_and_selection(spark):
    rows = candidates(spark, [
        (1, "income_statement", "Group", "GBP", "turnover", "Turnover", "1", None, 1.0), (2, "balance_sheet", "Group", "GBP", "current_assets", "Current assets", "1", None, 1.0),
        (3, "balance_sheet", "Group", "GBP", "shareholders_funds", "Total equity", "1", "2", 1.0), (3, "balance_sheet", "Group", "GBP", "cash", "Cash", "1", None, 1.0), (4, "cash_flow", "Group", "GBP", "tax", "Tax", "1", None, 1.0),
    ])
    located = spark.createDataFrame([("d", p, t, c) for p, t, c in [(1, "income_statement", 0.9), (2, "balance_sheet", 0.9), (3, "balance_sheet", 0.9), (4, "cash_flow", 0.9), (5, "income_statement", 0.5)]], "document_id string, page int, statement_type string, confidence double")
    got = {r.page: r.triggers for r in evidence.recovery_pages(rows, located, ["document_id"]).collect()}
    assert got == {1: ["income_statement_partial_core_family"], 2: ["balance_sheet_missing_net_assets", "balance_sheet_current_assets_without_cash"], 4: ["cash_flow_missing_cash_row"]}
    assert [r.page for r in evidence.recovery_pages(rows, located, ["document_id"], most=1).collect()] == [2]
    pages = located.withColumns({"page_count": F.lit(4), "contains_employee_count": F.lit(False)}).unionByName(spark.createDataFrame([("d", 4, "other", 1.0, 4, False)], "document_id string, page int, statement_type string, confidence double, page_count int, contains_employee_count boolean"))
    assert [r.page for r in evidence.employee_pages(pages, ["document_id"]).collect()] == [4] and evidence.primary_pages(pages).count() == 4
    found = evidence.with_equivalents(rows, ["document_id"])
    decisions = spark.createDataFrame([("d", "current", "net_assets", "p-2-r-0"), ("d", "current", "turnover", "p-0-r-0")], "document_id string, period string, metric string, candidate_id string")
    fixed = {r.metric: (r.candidate_id, r.canonicalised_from) for r in evidence.resolved_choices(decisions, found, ["document_id"]).collect()}
    assert fixed == {"net_assets": ("p-2-r-0:net_assets", "p-2-r-0"), "turnover": ("p-0-r-0", None)}
    ok, bad = evidence.validated(found.drop("role", "tier", "derived_from"))
    status = {(r.period, r.metric): r.status for r in evidence.selection_diagnostics(rows, ok, bad, decisions, ["document_id"]).collect()}
    assert len(status) == 14 and status["current", "net_assets"] == "selected" and status["previous", "net_assets"] == "unselected_despite_usable_candidate" and status["previous", "turnover"] == "no_usable_candidate" and status["current", "gross_profit"] == "no_candidate_extracted"


def test_scope_and_pages(spark):
    rows = spark.createDataFrame([("a", "Group", 1), ("a", "Company", 1), ("b", "Group", 4), ("b", "Company", 3), ("c", "Group", 3), ("c", "Unknown", 1)], "m string, scope string, tier int")
    assert sorted((r.m, r.scope) for r in evidence.preferred_scope(rows, ["m"]).collect()) == [("a", "Group"), ("b", "Company"), ("c", "Group"), ("c", "Unknown")]
    pages = spark.createDataFrame([("d", 1, 5), ("d", 5, 5)], "k string, p int, n int")
    assert sorted(r.p for r in evidence.with_neighbours(pages, ["k"], "p", "n").collect()) == [1, 2, 4, 5]
    calls = spark.createDataFrame([("d", 1, ["x"], 1), ("d", 1, ["y"], 2), ("d", 2, [], 1)], "k string, page int, rows array<string>, call_seq int")
    assert evidence.longest_call(calls, ["k"]).where("page = 1").first().rows == ["y"]
    need = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3)], "k string, page int")
    assert {r.page: r.reason for r in evidence.missing_and_empty(calls, need, ["k"]).collect()} == {2: "empty", 3: "missing"}


def test_scoring(spark):
    value = "struct<code:string, amount:decimal(38,6)>"
    D = Decimal
    gold = spark.createDataFrame([("c", "current", "turnover", ("GBP", D(5))), ("c", "current", "cash", ("GBP", D(1))), ("c", "previous", "cash", ("GBP", D(2))), ("c", "previous", "turnover", None), ("c", "current", "employees", None)], f"case_id string, period string, metric string, value {value}")
    found = spark.createDataFrame([("c", "current", "turnover", ("GBP", D(5))), ("c", "current", "cash", ("USD", D(1))), ("c", "previous", "turnover", ("GBP", D(3)))], f"case_id string, period string, metric string, value {value}")
    r = scoring.cell_summary(scoring.cells(gold, found), ["case_id"]).first()
    assert (r.exact, r.true_positives, r.false_positives, r.false_negatives, r.recall, r.precision) == (2, 1, 1, 2, pytest.approx(1 / 3), 0.5)
    o = spark.createDataFrame([([1, 2], [2, 3, 4])], "a array<int>, b array<int>").select(scoring.page_overlap(F.col("a"), F.col("b")).alias("o")).first().o
    assert (o.precision, o.recall, o.f1) == (pytest.approx(1 / 3), 0.5, pytest.approx(0.4))
    runs = spark.createDataFrame([(12.0, 0.5, (1.0,))], "elapsed_seconds double, cost_usd double, pages_overlap struct<f1:double>")
    assert scoring.run_report(runs).first().documents_per_hour == pytest.approx(300.0)
    wide = spark.createDataFrame([(1, "a", "a", None, "x"), (2, "a", "b", "y", None)], "case_id int, expected_f string, found_f string, expected_g string, found_g string")
    assert {r.field: (r.n, r.accuracy) for r in scoring.field_accuracy(wide, ["f", "g"]).collect()} == {"f": (2, 0.5), "g": (1, 0.0)}
    answer = spark.createDataFrame([({"kind": ("b2b", "sells to firms"), "area": ("mars", "")}, "It sells to firms, mostly.")], "r map<string, struct<value:string, quote:string>>, t string")
    assert answer.select(scoring.quote_issues(F.col("r"), {"kind": ["b2b"], "area": ["uk"]}, F.col("t")).alias("i")).first().i == ["area: value not allowed"]


def test_websites(spark):
    site = "struct<title:string, meta_description:string, og_description:string, body_sample:string, nav_links:array<string>, ctas:array<string>, h1s:array<string>, final_url:string, has_checkout:boolean, has_store_locator:boolean, has_quote_form:boolean, has_booking:boolean, has_demo:boolean, has_finance:boolean>"
    rows = [("Acme Tools Ltd", "ok", ("Acme", None, None, "Buy now £5 shop", ["Contact"], None, ["h"], "https://www.acme.com/x", True, None, False, None, None, None), ("t", "tools", "acme.com", None, 9.5), ["r"], None), ("X", "failed", None, None, None, None)]
    df = spark.createDataFrame(rows, f"company_name string, status string, website {site}, chosen_result struct<title:string, snippet:string, hostname:string, target_url:string, score:double>, search_results array<string>, candidates array<string>")
    a, b = websites.investigations(df).orderBy("company_name").collect()
    assert (a.company_token_count, a.domain_token_match_count, a.title_token_match_count, a.site_match_confidence_score) == (2, 1, 2, 77.5)
    assert (a.ecommerce_keyword_count, a.price_mention_count, a.ecommerce_signal_score, a.contact_keyword_count, a.nav_link_count, a.has_store_locator) == (2, 1, 43.0, 1, 1, False)
    assert a.ppc_fit_score == 43.0 and (b.ppc_fit_score, b.site_match_confidence_score, b.body_word_count) == (0.0, 0.0, 0)


def service(spark):
    lead_rows = [("13406761", "Mesh Works", "62020", 82, "done", "tier-3 SIC; established 7.3yr"), ("22222222", "Wire Mesh", "47910", 88, "error", "a|b"), ("33333333", "Plain", "1", 76, "pending", None)]
    names = ("company_number", "company_name", "sic_1", "lead_score", "status", "score_reasons")
    t = {n: schemas.ensure_schema(spark.createDataFrame([], "x int"), n) for n in schemas.DDL}
    t["leads"] = table(spark, "leads", [dict(zip(names, r)) | {"account_category": "FULL"} for r in lead_rows])
    t["companies"] = table(spark, "companies", [{"company_number": n, "company_name": c, "sic_code_primary": "62020"} for n, c, *_ in lead_rows])
    t["periods"] = table(spark, "periods", [period(1, "13406761", turnover=1_250_000, profit_after_tax=5, gross_profit=500_000), period(2, "13406761", "d0", year=2023, turnover=1_000_000), period(3, "22222222", turnover=5, comparative_overlap_status="mismatch")])
    t["filings"] = table(spark, "filings", [{"transaction_id": k, "company_number": "13406761", "filing_date": date(2024, 1, int(k))} for k in "12"])
    t["documents"] = table(spark, "documents", [{"document_id": "d1", "company_number": "13406761", "ingest_seq": 1}, {"document_id": "d2", "company_number": "13406761", "ingest_seq": 2}])
    t["narrative_runs"] = table(spark, "narrative_runs", [{"id": 1, "company_number": "13406761"}, {"id": 2, "company_number": "13406761"}])
    t["narrative_sections"] = table(spark, "narrative_sections", [{"id": 1, "narrative_run_id": 2, "section_key": "strategic_report", "section_text": "We weave contextRef mesh"}, {"id": 2, "narrative_run_id": 1, "section_key": "going_concern", "section_text": "old"}])
    t["performance_statements"] = table(spark, "performance_statements", [{"id": 1, "narrative_run_id": 2, "page": 1, "statement_text": "Revenue grew."}])
    t["website_investigations"] = table(spark, "website_investigations", [{"id": 7, "company_number": "13406761", "source_label": "s", "business_model": "B2B", "final_url": "https://www.mesh.example/"}])
    t["website_signals"] = table(spark, "website_signals", [{"investigation_id": 7, "signal_key": "ppc_fit_score", "signal_real": 74.5}, {"investigation_id": 7, "signal_key": "has_demo", "signal_bool": True}])
    t["sic_groups"] = table(spark, "sic_groups", [{"sic_code": "62020", "sic_label": "IT", "sic_group": "Tech"}])
    t["company_signals"] = table(spark, "company_signals", [{"company_number": "22222222", "signal_key": "trading_status", "signal_text": "unknown"}, {"company_number": "33333333", "signal_key": "trading_status", "signal_text": "trading"}])
    return LeadService(t)


def test_service(spark):
    s = service(spark)
    numbers = lambda df: [r.company_number for r in df.collect()]
    assert numbers(s.search_leads("mesh", 70)) == ["22222222", "13406761"] and numbers(s.search_leads(limit=1)) == ["22222222"]
    assert numbers(s.unenriched(min_score=70)) == ["22222222", "33333333"] and numbers(s.errors()) == ["22222222"]
    snap = s.snapshot("13406761").first()
    assert snap.company.company_name == "Mesh Works" and snap.latest_filing.transaction_id == "2" and snap.latest_document.document_id == "d2"
    assert snap.financials["current"].turnover == 1_250_000 and snap.website_investigation.ppc_fit_score == 74.5
    assert s.snapshot("33333333").first().financials is None
    for ask in (s.snapshot, s.explain_score):
        with pytest.raises(LookupError):
            ask("0")
    why = s.explain_score("13406761").first()
    assert why.score_reasons == ["tier-3 SIC", "established 7.3yr"] and why.has_financials and why.has_website_investigation and why.financials.id == 1
    both = s.compare(["13406761", "22222222"])
    assert [(r.company_number, r.turnover) for r in both.collect()][0] == ("22222222", 5) and both.count() == 3 and s.compare(["13406761", "22222222"], latest_only=True).count() == 2
    assert numbers(s.search_sections("MESH")) == ["13406761"] and numbers(s.search_statements("revenue")) == ["13406761"] and numbers(s.website_leads(70, "b2b")) == ["13406761"]
    counts = {(r.measure, r.key): r.n for r in s.pipeline().collect()}
    assert counts["leads", None] == 3 and counts["leads by status", "done"] == 1 and counts["narrative_runs", None] == 2
    assert {r.years_of_history: r.companies for r in s.history_coverage().collect()} == {1: 1, 2: 1}
    history = s.financial_history(2).collect()
    assert [(r.financial_year, r.turnover_change_pct, r.gross_margin_pct, r.sic_label) for r in history] == [(2023, None, None, "IT"), (2024, 25.0, 40.0, "IT")]
    assert numbers(s.band_candidates(1_000_000, 2_000_000)) == ["13406761"] and numbers(s.overlap_review()) == ["22222222"]
    assert {(r.account_category, r.periods) for r in s.overlap_summary().collect()} == {("overall", 1), ("FULL", 1)}
    assert numbers(s.triage_review()) == ["22222222"]
    report = s.narrative_report().first()
    assert (report.sections, report.junk_sections, report.strategic_report, report.going_concern) == (1, 1, "We weave contextRef mesh", None)
    assert numbers(s.narrative_queue()) == [] and s.profile_context().first().sections == {"strategic_report": "We weave contextRef mesh"}
    assert set(s.questions()) >= {"search_leads", "snapshot", "pipeline"} and len(s.questions()) == 11


def test_responses(spark):
    a = spark.createDataFrame([("acme", '{"items":[{"title":" Acme Two ","company_number":"2","address_snippet":"a  b"},{"title":"ACME","company_number":"1"}]}'), ("bad", "x")], "query string, payload string")
    found = responses.search_results(a)
    assert [(r.company_number, r.address) for r in found.orderBy("position").collect()] == [("2", "a b"), ("1", None)]
    assert [r.company_number for r in responses.chosen_company(found).collect()] == ["1"]
    p = responses.profiles(spark.createDataFrame([("1", '{"company_name":"A","sic_codes":["62020","1"]}'), ("2", "bad")], "company_number string, payload string"))
    assert {r.company_number: (r.sic_codes, r.sic_code_primary) for r in p.collect()} == {"1": (["62020", "1"], "62020"), "2": ([], None)}
    m = responses.document_urls(spark.createDataFrame([("http://d/document/x9", '{"resources":{"application/pdf":{}}}')], "metadata_url string, payload string"), "http://d")
    assert tuple(m.first())[1:] == ("x9", None, "http://d/document/x9/content")
    html = '<tr><td class="nowrap">1 Jan 2024</td><td class="filing-type">AA</td><td><b>Full</b> accounts</td><td><a href="/company/1/filing-history/a/document?format=pdf&amp;download=0">x</a></td></tr><tr><td>2</td><td>CS01</td><td>c</td></tr>'
    r = responses.page_filings(spark.createDataFrame([("1", html)], "company_number string, html string")).collect()
    assert [(x.date_text, x.description, x.pdf_link) for x in r] == [("1 Jan 2024", "Full accounts", "/company/1/filing-history/a/document?format=pdf&download=0")]


def test_samples(spark):
    rows = spark.createDataFrame([(k, "ab"[k % 3 == 0], k % 2) for k in range(12)], "k int, g string, f int")
    assert [r.k for r in sampling.round_robin(rows, ["g"], "k", 3).collect()] == [1, 0, 2]
    assert sampling.seeded(rows, "k", 5, 1).collect() == sampling.seeded(rows.repartition(3), "k", 5, 1).collect()
    first = sampling.unseen_first(rows, "g", "f", "k", 4, 3).collect()
    assert {(r.g, r.f) for r in first} == {("a", 0), ("a", 1), ("b", 0), ("b", 1)}


def test_files(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"event":"a","n":1}\nbroken\n{"event":"b","n":2}\n')
    log = files.event_log(spark, str(tmp_path / "log.jsonl"), "event string, n int")
    assert [r.n for r in files.last_events(log, "n", 1).collect()] == [2] and log.count() == 2
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "one.json").write_text('{"id":"1","review":{"status":"verified"}}')
    (tmp_path / "c" / "two.json").write_text('{"id":"2","review":{"status":"draft"}}')
    (tmp_path / "c" / "manifest.json").write_text('{"id":"m","review":{"status":"verified"}}')
    cases = lambda **k: sorted(r.id for r in files.label_cases(spark, str(tmp_path / "c"), "id string, review struct<status:string>", **k).collect())
    assert cases() == ["1"] and cases(unreviewed=True) == ["1", "2"]
    entries = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, x string")
    report = spark.createDataFrame([("1", ""), ("2", "B")], "k string, x string")
    assert {r.k: r.x for r in files.merged_report(entries, report, "k", ["x"]).collect()} == {"1": "a", "2": "B"}
    files.store(entries.select(F.col("k").alias("sic_code"), F.col("x").alias("sic_label")), str(tmp_path), "sic_groups")
    assert files.load(spark, str(tmp_path), "sic_groups").where("sic_code = '1'").first().sic_label == "a"


def test_industries_and_profiles(spark):
    from tallyfold.operators import industries, leads, profiles

    groups = industries.industry_groups(spark)
    assert groups.count() == len(leads.TIER_1 + leads.TIER_2 + leads.TIER_3) and {r.sic_code for r in groups.collect()} == set(leads.TIER_1 + leads.TIER_2 + leads.TIER_3)
    c = table(spark, "companies", [{"company_number": "1", "profile_payload": '{"sic_codes":["1","2"]}'}, {"company_number": "2", "profile_payload": "bad"}, {"company_number": "3", "sic_codes": ["9"], "sic_code_primary": "9"}])
    assert {r.company_number: (r.sic_codes, r.sic_code_primary) for r in industries.with_codes(c).collect()} == {"1": (["1", "2"], "1"), "2": ([], None), "3": (["9"], "9")}
    p = table(spark, "periods", [period(1, "1"), period(2, "1", currency_source="tag"), period(3, "1", currency_code="USD")])
    assert {r.id: (r.currency_code, r.currency_source) for r in industries.with_currency_defaults(p).collect()} == {1: ("GBP", "legacy_default"), 2: (None, "tag"), 3: ("USD", None)}
    rows = [("1", "business_review", "We sell tools, to trade buyers.", False), ("1", "principal_risks", "audit words", True), ("1", "other", "x", False), ("2", "going_concern", "x", False)]
    own = profiles.own_words(spark.createDataFrame(rows, "company_number string, section_key string, text string, is_auditor_text boolean"), ["company_number"])
    contexts = own.withColumns({"company_name": F.lit("Acme"), "sic_code_primary": F.lit("1"), "sic_label": F.lit("Tools"), "financial_year": F.lit(2024)})
    assert "## business_review" in profiles.question(contexts).first().question
    entry = lambda v, q: f'{{"value":"{v}","confidence":0.9,"quote":"{q}","section":"business_review"}}'
    good = {f: entry(v[0], "sell tools to trade buyers") for f, v in profiles.FIELDS.items()}
    answer = lambda e: "{" + ",".join(f'"{k}":{v}' for k, v in e.items()) + ',"business_description":"d","sic_agreement":{"value":"agrees"}}'
    for body, outcome in ((answer(good), "profiled"), ("```json\n" + answer(good) + "\n```", "profiled"), (answer(good | {"customer_type": entry("b2b", "sells cars")}), "invalid_response"), ("none", "invalid_response")):
        got = profiles.outcomes(profiles.answered(contexts, spark.createDataFrame([("1", body)], "company_number string, response string")))
        assert got.first().outcome == outcome and profiles.profile_rows(got).count() == (5 if outcome == "profiled" else 0)


def test_visible_rows(spark):
    from tallyfold.operators import visible

    cell = lambda v, b="n": f'<div class="cr{b} fn1" style="x">{v}</div>'
    two = f'<div class="cln">Turnover</div>{cell("2024", "b")}{cell("2023")}{cell("1,000", "b")}{cell("(900)")}<div class="cln">Other</div>{cell("5")}'
    six = '<div class="cln">Gross profit</div>' + "".join(cell(v) for v in (1, 2, 3, 4, 5, 6)) + '<div class="clb">x</div>'
    odd = '<div class="cln">Operating profit</div>' + "".join(cell(v) for v in (1, 2, 3)) + '<div class="clb">x</div>'
    docs = spark.createDataFrame([("d", two + six + odd + "resulted in a 7% revenue increase in the second half of the year"), ("e", None)], "document_id string, xhtml string")
    got = {(r.document_id, r.period_type): (r.turnover, r.gross_profit, r.operating_result) for r in visible.visible_rows(docs, "document_id", "xhtml").collect()}
    assert got["d", "current"] == (1000.0, 3.0, None) and got["d", "previous"] == (-900.0, 6.0, None) and got["e", "current"] == (None, None, None)
    views = spark.createDataFrame([("d", "current", 5.0, None, 7.0)], "document_id string, period_type string, turnover double, gross_profit double, operating_result double")
    r = visible.with_visible(views, visible.visible_rows(docs, "document_id", "xhtml"), "document_id").first()
    assert (r.turnover, r.gross_profit, r.operating_result, r.uk_revenue) == (1000.0, 3.0, 7.0, None)
    assert [tuple(x) for x in visible.commentary(docs, "document_id", "xhtml").collect()] == [("d", "second_half_revenue_growth", "7%")]


def test_ranks_of_uneven_keys(spark, monkeypatch):
    """One key far from the rest, many equal ones, and nulls: ranks are those of a sort, and chunks stay near their size."""
    import random

    from tallyfold.operators import sampling

    monkeypatch.setattr(sampling, "CHUNK_ROWS", 100)
    keys = [*range(3000), 2**61, -(2**61), *[7] * 40, None]
    random.Random(1).shuffle(keys)
    rows = spark.createDataFrame([(k, "a" if j % 3 else None) for j, k in enumerate(keys)], "k long, s string").repartition(3)
    got = sampling.ranked(rows, ["s"], "k", "r", "n").collect()
    for s in ("a", None):
        mine = sorted((r for r in got if r.s == s), key=lambda r: r.r)
        assert [r.r for r in mine] == list(range(1, len(mine) + 1)) and {r.n for r in mine} == {len(mine)}
        assert [r.k for r in mine] == sorted([r.k for r in mine], key=lambda k: (k is not None, k or 0))
    cuts = sorted({k for k in keys if k is not None})[::90]
    sizes = rows.groupBy(sampling._chunk(F.col("k"), cuts).alias("c")).count().collect()
    assert max(r["count"] for r in sizes) <= 90 + 40 and [r["count"] for r in sizes if r.c == -1] == [1]
    assert {r.k: r.c for r in rows.select("k", sampling._chunk(F.col("k"), cuts).alias("c")).collect() if r.k is not None} == {k: sum(c < k for c in cuts) for k in keys if k is not None}


def test_home_currency_takes_no_part_in_the_lookup(spark):
    empty = schemas.ensure_schema(spark.createDataFrame([], "series string"), "fx_rates")
    rates = fx.import_rates(empty, spark.createDataFrame([(date(2024, 1, 31), Decimal(2), "p1")], "rate_date date, rate decimal(20,8), payload string"), "USD", "X", "http://bank")
    rows = [period(k, "1", end=date(2024, 2, 3), currency_code="GBP" if k % 10 else "USD", turnover=k) for k in range(50)] + [period(99, "1", end=None, currency_code=None, turnover=5)]
    p = table(spark, "periods", [r | {"currency_validation_status": "valid"} for r in rows])
    got = {r.summary_id: (r.status, r.reason, r.turnover_pence, str(r.rate_date)) for r in fx.convert(p, rates).collect()}
    assert all(got[k] == (("converted", None, 50 * k, "2024-01-31") if k % 10 == 0 else ("converted", None, 100 * k, "None")) for k in range(50))
    assert got[99] == ("pending", "missing_period_end", None, "None")


def test_only_changed_conversions_are_made_again(spark):
    empty = schemas.ensure_schema(spark.createDataFrame([], "series string"), "fx_rates")
    day = lambda rows: spark.createDataFrame(rows, "rate_date date, rate decimal(20,8), payload string")
    first = [(date(2024, 1, 5), Decimal(2), "p1"), (date(2024, 1, 28), Decimal(3), "p2"), (date(2024, 5, 1), Decimal(4), "p3")]
    rates = fx.import_rates(empty, day(first), "USD", "X", "u")
    ends = [date(2024, 1, 8), date(2024, 2, 2), date(2024, 2, 20), date(2024, 5, 3), None]
    rows = [period(k, "1", end=e, currency_code="USD", turnover=10 + k) for k, e in enumerate(ends)] + [period(10 + k, "1", end=e, currency_code="GBP", turnover=1) for k, e in enumerate(ends)] + [period(20, "1", end=ends[0], currency_code=None)]
    valid = lambda rows: table(spark, "periods", [r | {"currency_validation_status": "valid"} for r in rows])
    whole = lambda df: sorted(map(str, df.drop("basis", "recomputed").collect()))
    done = spark.createDataFrame(fx.convert_changed(valid(rows), rates).collect(), fx.convert_changed(valid(rows), rates).schema)
    assert whole(done) == whole(fx.convert(valid(rows), rates)) and done.where("recomputed").count() == 11
    again = fx.convert_changed(valid(rows), rates, done)
    assert whole(again) == whole(done) and again.where("recomputed").count() == 0
    more = fx.import_rates(rates, day([(date(2024, 1, 31), Decimal(5), "p4")]), "USD", "X", "u")  # reaches January and February
    rows[3] = rows[3] | {"turnover": 99}
    found = fx.convert_changed(valid(rows), more, done)
    assert whole(found) == whole(fx.convert(valid(rows), more)) and {r.summary_id for r in found.where("recomputed").collect()} == {0, 1, 2, 3}
    assert {r.summary_id for r in fx.convert_changed(valid(rows[1:]), more, done).collect()} == {r["id"] for r in rows[1:]}


def test_payloads_are_shredded(spark):
    import json

    body = {
        "company_number": "1", "source_mode": "public_api", "generated_at": "2024-01-01T00:00:00", "company_profile": {"company_name": "A", "sic_codes": ["9"]},
        "latest_accounts_filing": {"transaction_id": "t", "date": "2024-01-01", "type": "AA"}, "document_urls": {"metadata": "http://x/document/d7/", "xhtml": "u"},
        "financials": {"current": {"financial_year": 2024, "turnover": 5}, "previous": {"financial_year": 2023}},
    }
    got = ingestion.shredded(spark.createDataFrame([(json.dumps(body),), ("bad",), ("{}",)], "payload string"))
    assert {k: df.count() for k, df in got.items()} == {"companies": 1, "filings": 1, "documents": 1, "periods": 2}
    assert got["documents"].first().document_id == "d7" and got["companies"].first().sic_code_primary == "9"
    assert {(r.period_type, r.financial_year, r.turnover, r.data_source, r.document_id) for r in got["periods"].collect()} == {("current", 2024, 5, "xhtml", "d7"), ("previous", 2023, None, "xhtml", "d7")}


def test_review_answers(spark, tmp_path):
    rows = [("1,250 | 7 | £000", "turnover"), ("MISSING", "cash"), ("NARRATIVE_ZERO | 3 | count", "employees"), ("- | 3 | count", "employees"), ("5 | x | £", "cash"), ("5|1", "cash"), ("abc | 1 | £", "cash"), ("5 | 1 | bananas", "cash")]
    df = spark.createDataFrame(rows, "a string, m string").select("m", scoring.reviewed_metric(F.col("a"), F.col("m")).alias("r")).select("m", "r.*").collect()
    assert [(r.state, r.value_count, r.value_pence, r.evidence_kind, r.error) for r in df] == [
        ("present", None, 125_000_000, None, None), ("missing", None, None, None, None), ("present", 0, None, "narrative_zero", None), ("present", 0, None, "dash_zero", None),
        (None, None, None, None, "page is no positive number"), (None, None, None, None, "expected three parts"), (None, None, None, None, "value is no number"), (None, None, None, None, "unit is not known"),
    ]
    cells = spark.createDataFrame([("c", "current", "cash", "present", 5, None, None, 1), ("c", "current", "tax", "present", None, None, None, 1), ("c", "previous", "cash", "missing", 5, None, None, None), ("c", "previous", "tax", "?", None, None, None, None)], "case_id string, period string, metric string, state string, value_pence bigint, value_count bigint, reported_value decimal(38,6), source_page int")
    assert sorted(r.issue for r in scoring.case_issues(cells).collect()) == ["a missing cell has a value", "a present cell has no value", "state is not known"]
    value = "struct<code:string, amount:decimal(38,6)>"
    gold = spark.createDataFrame([("c", "current", "cash", ("GBP", Decimal(1)))], f"case_id string, period string, metric string, value {value}")
    scoring.comparison_report(scoring.cells(gold, gold.limit(0)), str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "errors")).first().outcome == "not_found"
    both = scoring.with_results(gold, spark.createDataFrame([], "case_id string, payload string, error string"))
    assert both.first().error == "no saved result"


def test_search_pages(spark):
    html = '<li><a href="/company/01" title="View company"> <b>Acme</b> Ltd </a><p class="meta crumbtrail">01 - Dissolved</p><p>1 Road</p></li><li><a href="/company/SC2" title="View company">Two</a><p class="meta crumbtrail">SC2</p></li>'
    got = responses.page_search(spark.createDataFrame([("q", html), ("none", "")], "query string, html string")).collect()
    assert [(r.company_name, r.company_number, r.company_status, r.address) for r in got] == [("Acme Ltd", "01", "Dissolved", "1 Road"), ("Two", "SC2", None, None)]
    modes = responses.source_mode(spark.createDataFrame([("1", "public_api"), ("1", "website"), ("2", "public_api")], "k string, source string"), "k")
    assert {r.k: r.mode for r in modes.collect()} == {"1": "website", "2": "public_api"}


def test_events_are_appended_and_cases_replaced_one_by_one(spark, tmp_path):
    from tallyfold.sources import files

    log = f"{tmp_path}/log"
    for k in (1, 2):
        files.append_events(spark.createDataFrame([(k, "done")], "n int, event string"), log)
    assert sorted(r.n for r in files.event_log(spark, log, "n int, event string").collect()) == [1, 2]
    cases = f"{tmp_path}/cases"
    files.store_cases(spark.createDataFrame([("a", 1), ("b", 1)], "case_id string, v int"), cases)
    files.store_cases(spark.createDataFrame([("b", 2)], "case_id string, v int"), cases)
    assert sorted((r.case_id, r.v) for r in spark.read.json(cases).collect()) == [("a", 1), ("b", 2)]


def test_provenance_keeps_the_rows_order(spark):
    from tallyfold.operators import context

    rows = spark.createDataFrame([(1, 1, 0, 5, "b", "other", "n"), (1, 0, 2, 4, "a", "income_statement", "p")], "d int, page_pos int, row_pos int, page int, source_label string, statement_type string, role string")
    found = context.provenance(rows, ["d"]).first()
    assert (found.source_pages, found.source_labels, found.source_statement_types, found.source_roles) == ([4, 5], ["a", "b"], ["income_statement", "other"], ["p", "n"])


def test_labels_are_made_once_a_row(spark):
    rows = spark.sql("select 1 document_id, 'a' candidate_id, 0 page_pos, 0 row_pos, 1 page, if(id < 9, 'operating_result', 'cash') metric, if(id < 9, 'income_statement', 'other') statement_type, 'x' statement_scope, 'GBP' unit, if(id < 9, 'Operating profit', 'Cash') source_label, '5' current_display, '4' previous_display, 0.5D confidence from range(1)")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(evidence.with_tier(rows)).count("[^a-z0-9]+") == 1
    assert "metric" in rows.columns and evidence.with_equivalents(rows, ["document_id"]).count() == 1
    accepted, rejected = evidence.validated(rows)
    assert accepted.columns == rows.columns and rejected.count() == 0


def test_year_views_read_the_rows_once(spark):
    fact = lambda n, c, v, p: (1, "fact", n, c, None, None, v, 0, False, None, p)
    ctx = lambda c, d, s=False: (1, "context", None, c, date(d, 12, 31), s, None, None, None, None, 0)
    given = [ctx("c", 2024), ctx("c2", 2024), ctx("p", 2023), ctx("o", 2022), ctx("s", 2024, True), fact("Turnover", "c", "5", 1), fact("Turnover", "c", "6", 2), fact("Revenue", "c2", "6", 3), fact("Turnover", "s", "9", 4),
             fact("CostSales", "c", "1", 5), fact("CostSales", "c2", "2", 6), fact("Debtors", "p", "-", 7), fact("Debtors", "o", "3", 8), fact("Other", "c", "3", 9)]
    rows = spark.createDataFrame(given, f"document_id int, {facts.ROWS}")
    views = facts.year_views(rows, "document_id")
    got = {(r.period_type, m, r[m]) for r in views.collect() for m in facts.SYNONYMS if r[m] is not None}
    assert got == {("current", "turnover", 6.0), ("previous", "debtors", 0.0)} == {(r.period_type, r.metric, r.value) for r in facts.resolved(rows, "document_id").collect()}
    assert {(r.period_type, r.financial_year, r.metric_date.year) for r in views.collect()} == {("current", 2024, 2024), ("previous", 2023, 2023)}
    assert views._jdf.queryExecution().sparkPlan().toString().count("Scan") == 1


def test_kept_conversions_rest_on_written_tables(spark):
    from tallyfold.plans import registry

    found = registry.QUERIES["conversions_kept"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [o_custkey" not in plan and "o_orderdate" not in plan  # orders are not grouped into periods anew
    rows = found.collect()
    assert rows and {r.recomputed for r in rows} == {False, True} and len({r.summary_id for r in rows}) == len(rows)


ODD = """<context id="a"><endDate>2024-12-31</endDate></context><context id="b"><instant>2024-06-30</instant></context><context id="o"><endDate>2023-12-31</endDate></context><context id="x"><endDate>2023-02-30</endDate></context>
<context id="s"><segment>x</segment><endDate>2024-12-31</endDate></context><unit id="u"><measure>iso4217:GBP</measure></unit><unit id="d"><measure>iso4217:USD</measure></unit><unit id="n"><measure>pure</measure></unit>
<nonFraction name="Turnover" contextRef="a" unitRef="u">5</nonFraction><nonFraction name="Turnover" contextRef="a" unitRef="n">6</nonFraction><nonFraction name="Turnover" contextRef="a" unitRef="n">x</nonFraction><nonFraction name="Revenue" contextRef="b" unitRef="u">7</nonFraction>
<nonFraction name="Debtors" contextRef="s" unitRef="u">9</nonFraction><nonFraction name="Creditors" contextRef="o" unitRef="u"><b>1</b>&#44;000</nonFraction><nonFraction name="Other" contextRef="o" unitRef="d">1</nonFraction><nonFraction name="Other" unitRef="d">1</nonFraction>"""


def test_periods_of_filings_are_one_pass_without_a_shuffle(spark):
    more = '<nonFraction name="Other" contextRef="s" unitRef="d">1</nonFraction>'
    docs = spark.createDataFrame([(1, "1", ODD), (2, None, ODD + more), (3, "3", "<html></html>"), (4, "4", None), (5, "5", TAGGED)], "document_id int, company_number string, xhtml string")
    found = ingestion.periods_of(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and not any(step in plan for step in ("Join", "Aggregate", "Window", "Repartition"))
    rows = {(r.document_id, r.period_type): r for r in found.collect()}
    assert {k: (r.company_number, str(r.metric_date), r.financial_year, str(r.period_end_on), r.currency_code) for k, r in rows.items()} == {
        (1, "current"): ("1", "2024-12-31", 2024, "2024-12-31", "GBP"), (1, "previous"): ("1", "2024-06-30", 2023, "2023-12-31", "USD"),
        (2, "current"): (None, "2024-12-31", 2024, "2024-12-31", None), (2, "previous"): (None, "2024-06-30", 2023, "2023-12-31", "USD"),
        (5, "current"): ("5", "2024-03-31", 2024, "2024-03-31", "GBP"), (5, "previous"): ("5", "2023-03-31", 2023, "2023-03-31", "GBP"),
    }
    assert (rows[1, "current"].turnover, rows[1, "previous"].turnover, rows[1, "current"].debtors, rows[1, "previous"].current_liabilities) == (6.0, 7.0, None, None)
    views = facts.year_views(facts.tag_rows(docs, "document_id", "xhtml"), "document_id")
    assert sorted(map(tuple, found.select(views.columns).collect())) == sorted(map(tuple, views.collect()))


def test_filings_with_the_same_key_are_read_each_by_itself(spark):
    docs = spark.createDataFrame([(1, "1", TAGGED), (1, "2", TAGGED.replace("2024-", "2020-").replace("2023-", "2019-")), (None, "3", TAGGED)], "document_id int, company_number string, xhtml string")
    got = sorted((r.company_number, r.period_type, r.financial_year) for r in ingestion.periods_of(docs).collect())
    assert got == [("1", "current", 2024), ("1", "previous", 2023), ("2", "current", 2020), ("2", "previous", 2019), ("3", "current", 2024), ("3", "previous", 2023)]
