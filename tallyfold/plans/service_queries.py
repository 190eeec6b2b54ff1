"""The query service's answers, and what keeps its tables: queues, triage, signals, conversion."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold import schemas
from tallyfold.operators import fx, leads, sampling, substring, timeseries, triage, upsert, websites
from tallyfold.plans import store
from tallyfold.plans.registry import query, table
from tallyfold.plans.service import LeadService
from tallyfold.sources import scratch

NEWEST_SQL = """newest AS (SELECT * FROM st_periods WHERE period_type = 'current' QUALIFY row_number() OVER (PARTITION BY company_number ORDER BY financial_year DESC NULLS LAST, id DESC) = 1)"""
SITES_SQL = """sites AS (SELECT i.*, s.ppc_fit_score, s.has_checkout, s.cta_count,
    nullif(regexp_replace(regexp_extract(lower(final_url), '^[a-z][a-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\\.', ''), '') AS final_domain
    FROM st_website_investigations i LEFT JOIN (SELECT investigation_id, max(signal_real) FILTER (signal_key = 'ppc_fit_score') AS ppc_fit_score,
        max(CAST(signal_bool AS BIGINT)) FILTER (signal_key = 'has_checkout') AS has_checkout, max(CAST(signal_int AS DOUBLE)) FILTER (signal_key = 'cta_count') AS cta_count
        FROM st_website_signals GROUP BY 1) s ON s.investigation_id = i.id)"""


def service(spark: SparkSession, sf_dir: str) -> LeadService:
    return LeadService(store.Store(spark, sf_dir))


@query(f"""WITH {store.sql('leads')} SELECT company_number, company_name, lead_score, status FROM st_leads
    WHERE lead_score >= 20 AND status IN ('pending', 'error') AND account_category IN ('BUILDING', 'MACHINERY') ORDER BY lead_score DESC, company_name, company_number LIMIT 100""")
def service_unenriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).unenriched(20, ["BUILDING", "MACHINERY"], limit=500).select("company_number", "company_name", "lead_score", "status")


@query(f"""WITH {store.sql('leads')} SELECT company_number, lead_score, processed_at FROM st_leads WHERE status = 'error' ORDER BY processed_at DESC NULLS LAST, lead_score DESC, company_number LIMIT 50""")
def service_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).errors(50).select("company_number", "lead_score", "processed_at")


@query(f"""
    WITH {store.sql('leads', 'companies', 'periods', 'filings', 'documents', 'website_investigations', 'website_signals')}, {SITES_SQL}
    SELECT c.company_number, c.company_name, l.lead_score,
        (SELECT transaction_id FROM st_filings f WHERE f.company_number = '8' ORDER BY filing_date DESC, transaction_id DESC LIMIT 1) AS transaction_id,
        (SELECT document_id FROM st_documents f WHERE f.company_number = '8' ORDER BY ingest_seq DESC LIMIT 1) AS document_id,
        (SELECT turnover FROM st_periods p WHERE p.company_number = '8' AND period_type = 'current' ORDER BY financial_year DESC, id DESC LIMIT 1) AS turnover,
        (SELECT financial_year FROM st_periods p WHERE p.company_number = '8' AND period_type = 'previous' ORDER BY financial_year DESC, id DESC LIMIT 1) AS previous_year,
        (SELECT final_domain FROM sites s WHERE s.company_number = '8' ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 1) AS final_domain
    FROM st_companies c LEFT JOIN st_leads l USING (company_number) WHERE c.company_number = '8'
""")
def service_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = service(spark, sf_dir).snapshot("8")
    return found.select(
        "company_number", "company.company_name", "lead.lead_score", "latest_filing.transaction_id", "latest_document.document_id", F.col("financials")["current"]["turnover"].alias("turnover"),
        F.col("financials")["previous"]["financial_year"].alias("previous_year"), "website_investigation.final_domain",
    )


@query(f"""
    WITH {store.sql('leads', 'periods', 'website_investigations', 'website_signals')}, {NEWEST_SQL}, {SITES_SQL},
    site AS (SELECT * FROM sites WHERE company_number = '12' ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 1)
    SELECT l.company_number, l.lead_score, 'tier-1 SIC/no charges/GB address' AS reasons, n.turnover, s.ppc_fit_score, n.id IS NOT NULL AS has_financials, s.id IS NOT NULL AS has_website_investigation
    FROM st_leads l LEFT JOIN newest n USING (company_number) LEFT JOIN site s USING (company_number) WHERE l.company_number = '12'
""")
def service_explain_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = service(spark, sf_dir).explain_score("12")
    return found.select(
        "company_number", "lead_score", F.array_join("score_reasons", "/").alias("reasons"), "financials.turnover", "website_investigation.ppc_fit_score", "has_financials", "has_website_investigation"
    )


@query(f"""
    WITH {store.sql('leads', 'companies', 'periods', 'sic_groups', 'website_investigations', 'website_signals')}, {NEWEST_SQL}, {SITES_SQL}
    SELECT l.company_number, coalesce(l.company_name, c.company_name) AS company_name, lead_score, status, sic_1, account_category, post_town, turnover, net_assets, employees, sic_label, sic_group,
        final_domain, ppc_fit_score, business_model
    FROM st_leads l LEFT JOIN st_companies c USING (company_number) LEFT JOIN newest n USING (company_number) LEFT JOIN st_sic_groups g ON g.sic_code = substr(sic_1, 1, 5)
        LEFT JOIN sites s USING (company_number)
    WHERE l.company_number IN ('1', '2', '3', '4', '5', '6', '7', '8')
""")
def service_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).compare([str(k) for k in range(1, 9)], latest_only=True)


@query(f"""
    WITH {store.sql('narrative_sections', 'narrative_runs', 'companies')}
    SELECT s.id, r.company_number, c.company_name, section_key, document_id FROM st_narrative_sections s JOIN st_narrative_runs r ON r.id = s.narrative_run_id LEFT JOIN st_companies c USING (company_number)
    WHERE contains(lower(section_key), 'an') OR contains(lower(section_title), 'an') OR contains(lower(section_text), 'an') ORDER BY r.company_number, section_key, s.id LIMIT 60
""")
def service_search_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).search_sections("AN", 60).select("id", "company_number", "company_name", "section_key", "document_id")


@query(f"""
    WITH {store.sql('performance_statements', 'narrative_runs', 'companies')}
    SELECT s.id, r.company_number, c.company_name, page FROM st_performance_statements s JOIN st_narrative_runs r ON r.id = s.narrative_run_id LEFT JOIN st_companies c USING (company_number)
    WHERE contains(lower(statement_text), 'the') ORDER BY r.company_number, page, s.id LIMIT 80
""")
def service_search_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).search_statements("The", 80).select("id", "company_number", "company_name", "page")


_QUESTIONS = ["Released Under", "the and", "src1", "zzzz"]


@query(f"WITH {store.sql('narrative_sections', 'performance_statements', 'narrative_runs')}" + " UNION ALL ".join(
    f""" SELECT * FROM (SELECT '{q}' AS question, 'sections' AS part, s.id, company_number FROM st_narrative_sections s JOIN st_narrative_runs r ON r.id = s.narrative_run_id
        WHERE contains(lower(section_key), '{q.lower()}') OR contains(lower(section_title), '{q.lower()}') OR contains(lower(section_text), '{q.lower()}') ORDER BY company_number, section_key, s.id LIMIT 40)
    UNION ALL SELECT * FROM (SELECT '{q}', 'statements', s.id, company_number FROM st_performance_statements s JOIN st_narrative_runs r ON r.id = s.narrative_run_id
        WHERE contains(lower(statement_text), '{q.lower()}') ORDER BY company_number, page, s.id LIMIT 40)""" for q in _QUESTIONS))
def service_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service's searches answered from indexes of all texts (forty rows a question, the service's own limit)."""
    tables = store.Store(spark, sf_dir)
    built = {name: substring.SubstringIndex(spark, scratch.folder(spark, name), "id").build(tables[name], column) for name, column in (("narrative_sections", "section_text"), ("performance_statements", "statement_text"))}
    asked = LeadService(tables, built)
    found = []
    for q in _QUESTIONS:
        for part, rows in (("sections", asked.search_sections(q, 40)), ("statements", asked.search_statements(q, 40))):
            found.append(rows.select(F.lit(q).alias("question"), F.lit(part).alias("part"), "id", "company_number"))
    return functools.reduce(DataFrame.unionAll, found)


_COUNTED = ["leads", "companies", "filings", "documents", "periods", "website_investigations", "narrative_runs", "narrative_sections", "performance_statements"]


@query(f"WITH {store.sql(*_COUNTED)} " + " UNION ALL ".join(f"SELECT '{t}' AS measure, NULL::VARCHAR AS key, count(*) AS n FROM st_{t}" for t in _COUNTED)
    + " UNION ALL SELECT 'leads by status', status, count(*) FROM st_leads WHERE status IS NOT NULL GROUP BY 2 UNION ALL SELECT 'leads by account_category', account_category, count(*) FROM st_leads WHERE account_category IS NOT NULL GROUP BY 2")
def service_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).pipeline()


@query(f"""WITH {store.sql('website_investigations', 'website_signals')}, {SITES_SQL} SELECT id, company_number, ppc_fit_score, has_checkout, cta_count, final_domain FROM sites
    WHERE coalesce(ppc_fit_score, 0) >= 40 AND lower(business_model) = 'retail' ORDER BY ppc_fit_score DESC NULLS LAST, company_number, id LIMIT 70""")
def service_website_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).website_leads(40.0, "RETAIL", 70).select("id", "company_number", "ppc_fit_score", "has_checkout", "cta_count", "final_domain")


@query(f"""WITH {store.sql('website_investigations', 'website_signals')}, {SITES_SQL} SELECT id, source_label, ppc_fit_score, cta_count FROM sites
    WHERE company_number = '21' AND source_label = 'b' ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 1""")
def service_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).website("21", "b").select("id", "source_label", "ppc_fit_score", "cta_count")


@query(f"""
    WITH {store.sql('periods', 'companies', 'leads', 'sic_groups')}, cur AS (SELECT * FROM st_periods WHERE period_type = 'current'),
    deep AS (SELECT company_number, count(DISTINCT financial_year) AS years_of_history FROM cur WHERE financial_year IS NOT NULL GROUP BY 1 HAVING count(DISTINCT financial_year) >= 4)
    SELECT cur.company_number, company_name, financial_year, years_of_history, sic_label, turnover,
        round((turnover - lag(turnover) OVER w) * 100.0 / nullif(abs(lag(turnover) OVER w), 0), 1) + 0.0 AS turnover_change_pct,
        round(100.0 * gross_profit / nullif(turnover, 0), 1) + 0.0 AS gross_margin_pct, round(100.0 * operating_result / nullif(turnover, 0), 1) + 0.0 AS operating_margin_pct
    FROM cur JOIN deep USING (company_number) LEFT JOIN (SELECT company_number, company_name FROM st_companies) c USING (company_number)
        LEFT JOIN (SELECT company_number, substr(sic_1, 1, 5) AS sic_code FROM st_leads) l USING (company_number) LEFT JOIN st_sic_groups g USING (sic_code)
    WINDOW w AS (PARTITION BY cur.company_number ORDER BY financial_year, id)
""")
def service_financial_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = service(spark, sf_dir).financial_history(4)
    return found.select("company_number", "company_name", "financial_year", "years_of_history", "sic_label", "turnover", "turnover_change_pct", "gross_margin_pct", "operating_margin_pct")


@query(f"""
    WITH {store.sql('periods', 'companies', 'leads', 'sic_groups')}
    SELECT p.company_number, c.company_name, account_category, sic_label, turnover, profit_after_tax FROM st_periods p LEFT JOIN st_companies c USING (company_number)
        LEFT JOIN st_leads l USING (company_number) LEFT JOIN st_sic_groups g ON g.sic_code = substr(l.sic_1, 1, 5)
    WHERE period_type = 'current' AND turnover BETWEEN 100000 AND 400000 AND profit_after_tax IS NOT NULL
""")
def service_band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).band_candidates(100_000, 400_000)


@query(f"""
    WITH {store.sql('periods', 'leads')} SELECT company_name, p.company_number, financial_year, CAST(period_end_on AS VARCHAR) AS period_end_on, comparative_overlap_payload
    FROM st_periods p LEFT JOIN st_leads l USING (company_number) WHERE comparative_overlap_status = 'mismatch'
""")
def service_overlap_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).overlap_review().withColumn("period_end_on", F.col("period_end_on").cast("string"))


@query(f"""
    WITH {store.sql('periods', 'leads')}, r AS (SELECT account_category, comparative_overlap_status FROM st_periods LEFT JOIN st_leads USING (company_number) WHERE comparative_overlap_status IS NOT NULL)
    SELECT 'overall' AS account_category, comparative_overlap_status, count(*) AS periods FROM r GROUP BY ALL
    UNION ALL SELECT coalesce(account_category, 'unknown'), comparative_overlap_status, count(*) FROM r GROUP BY ALL
""")
def service_overlap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).overlap_summary()


@query(f"""
    WITH {store.sql('periods', 'companies', 'sic_groups', 'company_signals')}, {NEWEST_SQL},
    sig AS (SELECT company_number, max(signal_text) FILTER (signal_key = 'trading_status') AS trading_status, max(CAST(signal_int AS DOUBLE)) FILTER (signal_key = 'revenue_per_employee') AS revenue_per_employee,
        max(CAST(signal_bool AS BIGINT)) FILTER (signal_key = 'sic_is_catch_all') AS sic_is_catch_all FROM st_company_signals GROUP BY 1)
    SELECT c.company_number, company_name, sic_label, trading_status, revenue_per_employee, sic_is_catch_all, turnover, employees
    FROM st_companies c JOIN sig USING (company_number) LEFT JOIN st_sic_groups g ON g.sic_code = sic_code_primary LEFT JOIN newest USING (company_number) WHERE trading_status <> 'trading'
""")
def service_triage_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).triage_review().select("company_number", "company_name", "sic_label", "trading_status", "revenue_per_employee", "sic_is_catch_all", "turnover", "employees")


@query(f"""
    WITH {store.sql('periods', 'companies', 'narrative_runs', 'narrative_sections')}, {NEWEST_SQL},
    runs AS (SELECT company_number, max(id) AS narrative_run_id FROM st_narrative_runs GROUP BY 1),
    wide AS (SELECT company_number, count(*) AS sections, count(*) FILTER (contains(section_text, 'contextRef') OR contains(section_text, 'xbrli') OR contains(section_text, 'bus:Director')) AS junk_sections,
        max(section_text) FILTER (section_key = 'strategic_report') AS strategic_report, max(section_text) FILTER (section_key = 'directors_report') AS directors_report
        FROM st_narrative_sections JOIN runs USING (narrative_run_id) GROUP BY 1)
    SELECT company_number, company_name, sections, junk_sections, md5(strategic_report) AS strategic, md5(directors_report) AS directors, turnover, employees
    FROM wide JOIN st_companies USING (company_number) LEFT JOIN newest USING (company_number)
""")
def service_narrative_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = service(spark, sf_dir).narrative_report()
    return found.select("company_number", "company_name", "sections", "junk_sections", F.md5("strategic_report").alias("strategic"), F.md5("directors_report").alias("directors"), "turnover", "employees")


@query(f"""
    WITH {store.sql('periods', 'leads', 'documents', 'narrative_runs')}
    SELECT d.company_number, d.document_id, xhtml_url, turnover FROM st_documents d JOIN st_periods p USING (company_number)
    WHERE period_type = 'current' AND turnover IS NOT NULL AND d.company_number IN (SELECT company_number FROM st_leads WHERE status = 'done')
        AND d.company_number NOT IN (SELECT company_number FROM st_narrative_runs)
    ORDER BY turnover DESC, d.company_number, d.document_id LIMIT 90
""")
def service_narrative_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service(spark, sf_dir).narrative_queue(90)


@query(f"""
    WITH {store.sql('periods', 'companies', 'sic_groups', 'narrative_runs', 'narrative_sections')}, {NEWEST_SQL}, runs AS (SELECT company_number, max(id) AS narrative_run_id FROM st_narrative_runs GROUP BY 1)
    SELECT c.company_number, narrative_run_id, company_name, sic_label, financial_year, turnover,
        CAST((SELECT count(*) FROM st_narrative_sections s WHERE s.narrative_run_id = r.narrative_run_id) AS INTEGER) AS n_sections,
        (SELECT md5(section_text) FROM st_narrative_sections s WHERE s.narrative_run_id = r.narrative_run_id AND section_key = 'directors_report') AS directors
    FROM runs r JOIN st_companies c USING (company_number) LEFT JOIN st_sic_groups ON sic_code = sic_code_primary LEFT JOIN newest USING (company_number)
""")
def service_profile_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = service(spark, sf_dir).profile_context()
    return found.select("company_number", "narrative_run_id", "company_name", "sic_label", "financial_year", "turnover", F.size("sections").alias("n_sections"), F.md5(F.col("sections")["directors_report"]).alias("directors"))


@query(f"""WITH {store.sql('leads')} SELECT company_number, lead_score FROM st_leads WHERE status = 'pending' AND account_category IN ('BUILDING') ORDER BY lead_score DESC, company_number LIMIT 40""")
def leads_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.pending(store.Store(spark, sf_dir)["leads"], ["BUILDING"], 40).select("company_number", "lead_score")


@query(f"""
    WITH {store.sql('leads')}, o AS (SELECT CAST(o_custkey AS VARCHAR) AS company_number, max_by(o_orderstatus, o_orderkey) AS status, max_by(o_orderpriority, o_orderkey) AS error_message FROM orders GROUP BY 1)
    SELECT l.company_number, coalesce(o.status, l.status) AS status, o.error_message FROM st_leads l LEFT JOIN o USING (company_number)
""")
def leads_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schemas.ensure_schema(store.Store(spark, sf_dir)["leads"].drop("score_reasons", "processed_at"), "leads")
    outcomes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("company_number"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"), F.lit(True).alias("xhtml_available"),
        F.col("o_orderdate").cast("date").alias("filing_date"), F.lit("AA").alias("filing_type"), F.col("o_orderpriority").alias("error_message"), F.lit(None).cast("timestamp").alias("processed_at"),
    )
    return leads.mark(rows, outcomes).select("company_number", "status", "error_message")


TRIAGE_SQL = f"""
    {store.sql('companies', 'periods')}, {NEWEST_SQL},
    keyed AS (SELECT p.company_number, company_name, turnover, coalesce(CAST(period_end_on AS VARCHAR), 'FY' || financial_year) AS pk FROM st_periods p JOIN st_companies USING (company_number)
        WHERE period_type = 'current' AND turnover > 10000),
    grp AS (SELECT turnover, pk, coalesce(min(company_number) FILTER (NOT regexp_matches(company_name, '(?i)\\b(HOLDINGS?|HOLDCO|TOPCO|BIDCO|MIDCO|NEWCO)\\b')), min(company_number)) AS duplicate_of
        FROM keyed GROUP BY ALL HAVING count(DISTINCT company_number) > 1),
    dup AS (SELECT company_number, duplicate_of FROM keyed JOIN grp USING (turnover, pk) WHERE company_number <> duplicate_of
        QUALIFY row_number() OVER (PARTITION BY company_number ORDER BY turnover DESC, pk DESC) = 1),
    base AS (SELECT c.*, n.turnover, n.employees, n.gross_profit, dup.duplicate_of, regexp_matches(company_name, '(?i)\\b(HOLDINGS?|HOLDCO)\\b') AS holding,
        coalesce(n.employees = 0, false) AS nobody, coalesce(n.turnover > 0, false) AS sells FROM st_companies c LEFT JOIN newest n USING (company_number) LEFT JOIN dup USING (company_number)),
    triaged AS (SELECT company_number, CASE WHEN company_status <> 'active' THEN 'non_trading' WHEN sic_code_primary IN ('64209', '70100') THEN 'holding' WHEN holding AND nobody THEN 'holding'
            WHEN duplicate_of IS NOT NULL AND nobody THEN 'holding' WHEN turnover IS NULL AND employees IS NULL THEN 'unknown' WHEN NOT sells AND nobody THEN 'dormant'
            WHEN sells AND nobody THEN 'unknown' WHEN holding THEN 'unknown' ELSE 'trading' END AS trading_status,
        holding AS name_suggests_holding, sic_code_primary IN ('82990') AS sic_is_catch_all,
        CASE WHEN turnover > 0 AND employees > 0 THEN CAST(trunc(turnover / employees) AS BIGINT) END AS revenue_per_employee,
        coalesce(CASE WHEN turnover > 0 AND employees > 0 THEN trunc(turnover / employees) END >= 2000000, false) AS revenue_per_employee_flagged,
        coalesce(turnover > 0 AND employees = 0, false) AS turnover_without_employees,
        CASE WHEN turnover > 0 AND gross_profit * 100.0 / turnover BETWEEN 0 AND 100 THEN round(CAST(gross_profit * 100.0 / turnover AS DOUBLE), 2) END AS gross_margin_pct, duplicate_of FROM base)
"""


@query(f"WITH {TRIAGE_SQL} SELECT * FROM triaged")
def triage_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = store.Store(spark, sf_dir)
    return triage.triage(s["companies"], s["periods"]).drop("trading_status_reason")


@query(f"""WITH {TRIAGE_SQL} SELECT trading_status, count(*) AS n, count(*) FILTER (name_suggests_holding) AS name_suggests_holding, count(*) FILTER (sic_is_catch_all) AS sic_is_catch_all,
    count(*) FILTER (revenue_per_employee_flagged) AS revenue_per_employee_flagged, count(*) FILTER (turnover_without_employees) AS turnover_without_employees FROM triaged GROUP BY 1""")
def triage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = store.Store(spark, sf_dir)
    return triage.status_counts(triage.triage(s["companies"], s["periods"]))


@query(f"""
    WITH {TRIAGE_SQL}, old AS (SELECT company_number, signal_key, coalesce(signal_text, CAST(signal_bool AS VARCHAR), CAST(signal_int AS VARCHAR)) AS v FROM ({store.TABLES['company_signals'].format(customer='customer')})),
    new AS (SELECT company_number, 'trading_status' AS signal_key, trading_status AS v FROM triaged UNION ALL SELECT company_number, 'sic_is_catch_all', CAST(sic_is_catch_all AS VARCHAR) FROM triaged
        UNION ALL SELECT company_number, 'revenue_per_employee', CAST(revenue_per_employee AS VARCHAR) FROM triaged)
    SELECT company_number, signal_key, CASE WHEN n.company_number IS NOT NULL THEN n.v ELSE o.v END AS v, o.company_number IS NULL AS is_new FROM old o FULL JOIN new n USING (company_number, signal_key)
    WHERE CASE WHEN n.company_number IS NOT NULL THEN n.v ELSE o.v END IS NOT NULL
""")
def signals_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage written over stored signals; one that has become empty goes, creation times stay."""
    s = store.Store(spark, sf_dir)
    old = s["company_signals"].withColumns({"signal_type": F.lit("x"), "source_scope": F.lit(None).cast("string"), "created_at": F.lit("2020-01-01").cast("timestamp"), "updated_at": F.lit("2020-01-01").cast("timestamp")})
    new = upsert.to_signals(triage.triage(s["companies"], s["periods"]), "company_number", ["trading_status", "sic_is_catch_all", "revenue_per_employee"])
    merged = upsert.upsert_signals(schemas.ensure_schema(old, "company_signals"), new, "company_number", F.lit("2024-01-01").cast("timestamp"))
    value = F.coalesce("signal_text", F.col("signal_bool").cast("string"), F.col("signal_int").cast("string"))
    return merged.select("company_number", "signal_key", value.alias("v"), (F.year("created_at") == 2024).alias("is_new"))


RATES = """SELECT CAST(ts AS DATE) AS d, event_id, CAST(value AS DECIMAL(20,8)) AS rate FROM {events} WHERE value > 0.01 AND event_id % 50 = 0"""


@query(f"""
    WITH {store.sql('periods')}, r AS ({RATES.format(events='events')}), best AS (SELECT d, sha256(CAST(event_id AS VARCHAR)) AS h, rate FROM r),
    rates AS (SELECT d AS rate_date, CAST(CAST(1 AS DECIMAL(28,18)) / rate AS DOUBLE) AS rate FROM best QUALIFY row_number() OVER (PARTITION BY d ORDER BY h) = 1),
    p AS (SELECT id, currency_code, CAST(period_end_on + INTERVAL 3650 DAY AS DATE) AS due, turnover FROM st_periods WHERE currency_validation_status = 'valid'),
    j AS (SELECT p.*, CASE WHEN rate_date >= due - INTERVAL 4000 DAY THEN rate_date END AS rate_date FROM p ASOF LEFT JOIN rates ON p.due >= rates.rate_date)
    SELECT id AS summary_id, CASE WHEN currency_code = 'GBP' OR rate_date IS NOT NULL THEN 'converted' ELSE 'pending' END AS status,
        CASE WHEN currency_code = 'GBP' OR rate_date IS NOT NULL THEN NULL WHEN due IS NULL THEN 'missing_period_end' ELSE 'missing_rate' END AS reason,
        CAST(CASE WHEN currency_code <> 'GBP' THEN rate_date END AS VARCHAR) AS rate_date, CASE WHEN currency_code = 'GBP' THEN turnover * 100 END AS own_pence
    FROM j
""")
def periods_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as daily dollar rates, put in once each; periods moved into the events' years."""
    rows = spark.sql(RATES, events=table(spark, sf_dir, "events")).select(F.col("d").alias("rate_date"), "rate", F.col("event_id").cast("string").alias("payload"))
    empty = spark.createDataFrame([], schemas.schema("fx_rates"))
    rates = fx.import_rates(fx.import_rates(empty, rows, "USD", "S1", "u"), rows, "USD", "S1", "u")
    periods = store.Store(spark, sf_dir)["periods"].withColumn("period_end_on", F.date_add("period_end_on", 3650))
    found = fx.convert(periods, rates, 4000).join(periods.select(F.col("id").alias("summary_id"), "currency_code"), "summary_id")
    return found.select("summary_id", "status", "reason", F.col("rate_date").cast("string").alias("rate_date"), F.when(F.col("currency_code") == "GBP", F.col("turnover_pence")).alias("own_pence"))


ORDER_RATES = """SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey AS k, CAST(o_custkey % 90 + 10 AS DECIMAL(20,8)) AS rate FROM {orders}"""


@query(f"""
    WITH {store.sql('periods')}, r AS ({ORDER_RATES.format(orders='orders')}), rates AS (SELECT d AS rate_date FROM r GROUP BY 1),
    p AS (SELECT id, currency_code, period_end_on AS due FROM st_periods WHERE currency_validation_status = 'valid'),
    j AS (SELECT p.*, CASE WHEN rate_date >= due - INTERVAL 10 DAY THEN rate_date END AS rate_date FROM p ASOF LEFT JOIN rates ON p.due >= rates.rate_date),
    new AS (SELECT DISTINCT year(d) * 12 + month(d) AS m FROM r WHERE k % 200 = 0 UNION SELECT year(d + INTERVAL 10 DAY) * 12 + month(d + INTERVAL 10 DAY) FROM r WHERE k % 200 = 0)
    SELECT id AS summary_id, CASE WHEN currency_code = 'GBP' OR rate_date IS NOT NULL THEN 'converted' ELSE 'pending' END AS status,
        CASE WHEN currency_code = 'GBP' OR rate_date IS NOT NULL THEN NULL WHEN due IS NULL THEN 'missing_period_end' ELSE 'missing_rate' END AS reason,
        CAST(CASE WHEN currency_code <> 'GBP' THEN rate_date END AS VARCHAR) AS rate_date,
        currency_code <> 'GBP' AND coalesce(year(due) * 12 + month(due) IN (SELECT m FROM new), false) AS recomputed
    FROM j
""")
def conversions_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions after a few more rates have come in: only periods of months that these reach are looked up again."""
    rows = spark.sql(ORDER_RATES, orders=table(spark, sf_dir, "orders")).select(F.col("d").alias("rate_date"), "rate", F.col("k").cast("string").alias("payload"), "k")
    before = scratch.written(fx.import_rates(spark.createDataFrame([], schemas.schema("fx_rates")), rows.where("k % 200 <> 0").drop("k"), "USD", "S1", "u"), "before")
    rates = scratch.written(fx.import_rates(before, rows.drop("k"), "USD", "S1", "u"), "rates")
    wanted = ["id", "period_end_on", "currency_code", "currency_validation_status", *fx.AMOUNTS]
    periods = scratch.written(store.Store(spark, sf_dir)["periods"].select(wanted), "periods")  # written tables are looked up in twice
    stored = scratch.written(fx.convert_changed(periods, before), "conversions")
    return fx.convert_changed(periods, rates, stored).select("summary_id", "status", "reason", F.col("rate_date").cast("string").alias("rate_date"), "recomputed")


@query(f"""
    WITH {store.sql('periods')}, p AS (SELECT * FROM st_periods WHERE period_type = 'previous'), c AS (SELECT * FROM st_periods WHERE period_type = 'current' AND period_end_on IS NOT NULL),
    pairs AS (SELECT p.id, p.turnover AS a, c.turnover AS b, p.cash AS ca, c.cash AS cb FROM p JOIN c ON p.company_number = c.company_number AND p.period_end_on = c.period_end_on AND p.document_id <> c.document_id
        QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY c.id) = 1)
    SELECT s.id, CASE WHEN pairs.id IS NULL THEN s.comparative_overlap_status WHEN coalesce(a <> b, false) OR ca <> cb THEN 'mismatch' ELSE 'match' END AS status FROM st_periods s LEFT JOIN pairs USING (id)
""")
def overlap_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = store.Store(spark, sf_dir)["periods"].withColumns({m: F.lit(None).cast("bigint") for m in ("gross_profit", "operating_result", "profit_after_tax", "net_assets", "employees")})
    return timeseries.with_overlap(periods).select("id", F.col("comparative_overlap_status").alias("status"))


@query(f"""
    WITH {store.sql('leads')}, s AS (SELECT company_number, account_category, status, md5('7:' || company_number) AS h FROM st_leads),
    r AS (SELECT *, row_number() OVER (PARTITION BY account_category, status ORDER BY h, company_number) AS rep FROM s),
    t AS (SELECT *, row_number() OVER (PARTITION BY account_category ORDER BY rep, h, company_number) AS round FROM r)
    SELECT company_number, account_category, CAST(round AS INTEGER) AS round FROM t ORDER BY round, account_category LIMIT 33
""")
def cases_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels to review: each category in turn, statuses not yet seen first (a sample is what it is)."""
    return sampling.unseen_first(store.Store(spark, sf_dir)["leads"], "account_category", "status", "company_number", 33, 7).select("company_number", "account_category", "round")


@query("SELECT CAST(c_custkey AS VARCHAR) AS company_number, NULL::INTEGER AS lead_score, c_name AS company_name, 'pending' AS status FROM customer")
def schema_ensured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of an older shape brought to the leads' schema, with a default for a column that it lacks."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_number"), F.col("c_name").alias("company_name"), F.lit(1).alias("gone"))
    return schemas.ensure_schema(old, "leads", {"status": "pending"}).select("company_number", "lead_score", "company_name", "status")


@query("""
    WITH b AS (SELECT page_id, url, lower(coalesce(html, '')) AS h, page_id % 2 = 0 AS has_checkout, page_id % 3 = 0 AS has_quote_form FROM pages),
    c AS (SELECT *, """ + ", ".join(
    "CAST(" + " + ".join(f"(length(h) - length(replace(h, '{w}', ''))) // {len(w)}" for w in words) + f" AS BIGINT) AS {topic}" for topic, words in websites.KEYWORDS.items()
) + """, CAST(len(regexp_extract_all(h, '[£$€][ \t]?[0-9]')) AS BIGINT) AS price FROM b),
    s AS (SELECT *, least(100.0::DOUBLE, CASE WHEN has_checkout THEN 35.0 ELSE 0 END + least(25.0::DOUBLE, ecommerce * 3.0) + least(20.0::DOUBLE, price * 2.0)) AS shop,
        least(100.0::DOUBLE, CASE WHEN has_quote_form THEN 30.0 ELSE 0 END + least(15.0::DOUBLE, contact * 2.0) + least(10.0::DOUBLE, service * 1.5)) AS lead_,
        least(100.0::DOUBLE, least(35.0::DOUBLE, service * 3.0) + least(25.0::DOUBLE, b2b * 4.0) + least(15.0::DOUBLE, trust * 3.0) + CASE WHEN has_quote_form THEN 10.0 ELSE 0 END) AS b2b_,
        least(100.0::DOUBLE, least(30.0::DOUBLE, location * 4.0) + least(20.0::DOUBLE, contact * 2.0)) AS local_ FROM c)
    SELECT page_id, round(shop, 2) AS ecommerce_signal_score, round(lead_, 2) AS lead_generation_signal_score, round(b2b_, 2) AS b2b_service_signal_score, round(local_, 2) AS local_presence_signal_score,
        round(least(100.0::DOUBLE, greatest(shop, lead_ * 0.9::DOUBLE + b2b_ * 0.35::DOUBLE, local_ * 0.7::DOUBLE + lead_ * 0.3::DOUBLE)), 2) AS ppc_fit_score FROM s
""")
def website_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five scores, with flags on some of the pages."""
    k = F.col("page_id")
    sites = table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("body"), (k % 2 == 0).alias("has_checkout"), (k % 3 == 0).alias("has_quote_form"))
    return websites.scored(sites, "body").select("page_id", "ecommerce_signal_score", "lead_generation_signal_score", "b2b_service_signal_score", "local_presence_signal_score", "ppc_fit_score")
