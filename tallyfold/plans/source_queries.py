"""Recorded answers and pages read as relations, display functions, scoring and profiles, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions import arithmetic, money, text
from tallyfold.operators import context, ingestion, leads, profiles, scoring, upsert
from tallyfold.plans.registry import query, table
from tallyfold.sources import files, responses


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _number(name: str = "c_custkey") -> F.Column:
    return F.col(name).cast("string")


@query("""
    SELECT c_name AS query, CAST(c_custkey AS VARCHAR) AS company_number, c_name AS company_name, '1 High St' AS address, CAST(1 AS INTEGER) AS position FROM customer WHERE c_custkey % 4 > 0
    UNION ALL SELECT c_name, CAST(c_custkey + 1 AS VARCHAR), c_name || ' X', NULL, 0 FROM customer WHERE c_custkey % 4 = 0
""")
def answers_chosen_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search answers, and the result that the name asks for, else the first."""
    item = lambda title, number, address: F.struct(title.alias("title"), number.alias("company_number"), F.lit("active").alias("company_status"), address.alias("address_snippet"))
    other = item(F.concat(F.lit(" "), "c_name", F.lit(" X ")), (F.col("c_custkey") + 1).cast("string"), F.lit("  "))
    own = item(F.when(F.col("c_custkey") % 4 > 0, F.upper("c_name")).otherwise("Z"), _number(), F.lit("1  High \n St"))
    answers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("query"), _json(items=F.array(other, own)).alias("payload"))
    found = responses.chosen_company(responses.search_results(answers))
    name = F.when(F.col("position") == 1, F.col("query")).otherwise(F.col("company_name"))
    return found.select("query", "company_number", name.alias("company_name"), "address", "position")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS company_number, CASE WHEN c_custkey % 10 > 0 THEN c_name END AS company_name, CAST(CASE WHEN c_custkey % 10 > 0 THEN 2 ELSE 0 END AS INTEGER) AS n_codes,
        CASE WHEN c_custkey % 10 > 0 THEN '62020' END AS sic_code_primary, CASE WHEN c_custkey % 10 > 0 THEN '2001-02-03' END AS born
    FROM customer
""")
def answers_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company profiles from JSON, one in ten of which is none."""
    good = _json(company_name=F.col("c_name"), company_number=_number(), date_of_creation=F.lit("2001-02-03"), sic_codes=F.array(F.lit("62020"), F.lit("47910")))
    answers = table(spark, sf_dir, "customer").select(_number().alias("company_number"), F.when(F.col("c_custkey") % 10 > 0, good).otherwise("no json").alias("payload"))
    found = responses.profiles(answers)
    return found.select("company_number", "company_name", F.size("sic_codes").alias("n_codes"), "sic_code_primary", F.col("date_of_creation").cast("string").alias("born"))


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS company_number, CAST(o_orderkey AS VARCHAR) AS transaction_id, strftime(o_orderdate, '%Y-%m-%d') AS date, 'D' || o_orderkey AS document_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 'http://b/document/D' || o_orderkey || '/content' END AS xhtml_url, 'http://b/document/D' || o_orderkey || '/content' AS pdf_url
    FROM orders WHERE o_orderstatus = 'F'
""")
def answers_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first filing of each list, and the documents that its metadata name."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    key = F.concat(F.lit("D"), _number("o_orderkey"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    filing = lambda name, d: F.struct(name.alias("transaction_id"), d.alias("date"), F.lit("AA").alias("type"), F.struct(F.concat(F.lit("http://b/document/"), key, F.lit("/")).alias("document_metadata")).alias("links"))
    answers = orders.select(F.concat_ws("-", "o_custkey", "o_orderkey").alias("company_number"), _json(items=F.array(filing(_number("o_orderkey"), day), filing(F.lit("old"), F.lit("1990-01-01")))).alias("payload"))
    first = responses.latest_filing(responses.filings(answers))
    size = F.struct(F.lit(1).alias("content_length"))
    kinds = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("application/pdf"), size, F.lit("application/xhtml+xml"), size)).otherwise(F.create_map(F.lit("application/pdf"), size))
    metadata = orders.select(F.concat(F.lit("http://b/document/"), key, F.lit("/")).alias("metadata_url"), _json(resources=kinds).alias("payload"))
    documents = responses.document_urls(metadata, "http://b")
    joined = first.join(documents, first["metadata_path"] == documents["metadata_url"])
    return joined.select(F.substring_index("company_number", "-", 1).alias("company_number"), "transaction_id", F.col("date").cast("string").alias("date"), "document_id", "xhtml_url", "pdf_url")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS company_number, c_name AS company_name, 'Active' AS company_status, '12 Mar 2024' AS date_text, '/c/' || c_custkey || '/d?format=pdf&x=1' AS pdf_link,
        CASE WHEN c_custkey % 2 = 0 THEN 'website' ELSE 'public_api' END AS mode
    FROM customer
""")
def answers_web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles and filings from web pages, and whether a company's parts came from there."""
    rows = table(spark, sf_dir, "customer")
    head = F.concat(F.lit('<h1 class="x">'), "c_name", F.lit('</h1><dd id="company-status"> Active </dd><dd id="company-type">Private</dd>'))
    row = lambda kind, link: F.concat(F.lit(f"<tr><td>12 Mar 2024</td><td>{kind}</td><td>Full</td>"), link, F.lit("</tr>"))
    link = F.concat(F.lit('<td><a href="/c/'), "c_custkey", F.lit('/d?format=pdf&amp;x=1">pdf</a></td>'))
    pages = rows.select(_number().alias("company_number"), F.concat(head, F.lit("<table>"), row("CS01", link), row("AA", link), row("AA", F.lit("<td></td>")), F.lit("</table>")).alias("html"))
    modes = rows.select(_number().alias("company_number"), F.explode(F.array(F.lit("api"), F.when(F.col("c_custkey") % 2 == 0, "website").otherwise("api"))).alias("source"))
    found = responses.page_profiles(pages).select("company_number", "company_name", "company_status").join(responses.page_filings(pages), "company_number").join(responses.source_mode(modes, "company_number"), "company_number")
    return found.select("company_number", "company_name", "company_status", "date_text", "pdf_link", "mode")


@query("""
    SELECT n_name AS query, 'A' || n_nationkey AS company_number, n_name AS company_name, CAST(0 AS INTEGER) AS position, 'Dissolved on 1 May' AS company_status, '1 Road' AS address FROM nation
    UNION ALL SELECT n_name, 'B' || n_nationkey, n_name || ' two', 1, NULL, NULL FROM nation
""")
def answers_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.concat(F.lit('<li><a class="l" href="/company/A'), "n_nationkey", F.lit('"> <b>'), "n_name", F.lit('</b></a><p class="meta crumbtrail">A - Dissolved on 1 May</p><p>1 Road</p></li>'))
    two = F.concat(F.lit('<li><a href="/company/B'), "n_nationkey", F.lit('">'), "n_name", F.lit(" two</a></li>"))
    pages = table(spark, sf_dir, "nation").select(F.col("n_name").alias("query"), F.concat(one, two).alias("html"))
    return responses.page_search(pages)


@query("""
    WITH f AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders), last AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT c_custkey, coalesce(nullif(CASE WHEN last.o_orderkey % 3 = 0 THEN '' ELSE last.o_orderpriority END, ''), c_mktsegment) AS segment FROM customer LEFT JOIN last ON o_custkey = c_custkey
""")
def report_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest assessment of each key laid over entries, where it has a value."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("segment"))
    entries = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return files.merged_report(entries, files.latest_by_key(orders, "c_custkey", "o_orderkey"), "c_custkey", ["segment"]).select("c_custkey", "segment")


@query("""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS company_number, 'D' || o_orderkey AS document_id, CAST(floor(o_totalprice) AS BIGINT) AS turnover, CAST(year(o_orderdate) AS INTEGER) AS financial_year FROM orders WHERE o_orderkey % 10 > 0
""")
def payloads_shredded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractor payloads as period rows; one in ten is no JSON."""
    year = F.struct(F.year("o_orderdate").alias("financial_year"), F.floor("o_totalprice").cast("bigint").alias("turnover"))
    good = _json(company_number=_number("o_custkey"), document_urls=F.struct(F.concat(F.lit("http://b/D"), "o_orderkey").alias("metadata")), financials=F.create_map(F.lit("current"), year))
    payloads = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 > 0, good).otherwise("[").alias("payload"))
    found = ingestion.shredded(payloads)["periods"]
    return found.select(F.substring("document_id", 2, 20).cast("bigint").alias("o_orderkey"), "company_number", "document_id", "turnover", "financial_year")


@query("""
    SELECT 'orders' AS step, CASE WHEN o_orderkey % 7 = 0 THEN 'error' WHEN o_orderstatus = 'P' THEN 'no_filing' WHEN o_orderkey % 2 = 0 THEN 'no_xhtml' ELSE 'done' END AS outcome, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'customers', 'pending', count(*) FROM customer
""")
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    filing, xhtml, error = F.when(F.col("o_orderstatus") != "P", 1), F.when(k % 2 == 1, "x"), F.when(k % 7 == 0, "e")
    steps = {"orders": table(spark, sf_dir, "orders").select(ingestion.outcome(filing, xhtml, error).alias("outcome")), "customers": table(spark, sf_dir, "customer").select(F.lit("pending").alias("outcome"))}
    return ingestion.outcome_counts(steps)


@query("""
    WITH y AS (SELECT o_custkey, CASE WHEN min(year(o_orderdate)) = max(year(o_orderdate)) THEN CAST(min(year(o_orderdate)) AS INTEGER) END AS agreed FROM orders GROUP BY 1)
    SELECT c_custkey AS o_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 1999 END, agreed) AS financial_year FROM customer LEFT JOIN y ON o_custkey = c_custkey
""")
def years_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, 1999).alias("financial_year"))
    years = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return ingestion.years_filled(rows, years, ["o_custkey"]).select("o_custkey", "financial_year")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus = 'O' """)
def new_filings_put_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings whose key is not stored yet; repeated ones once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    old, new = orders.where("o_orderkey % 3 = 0"), orders.where("o_orderstatus = 'O'")
    fetched = ingestion.to_fetch(new.withColumnRenamed("o_orderkey", "transaction_id"), old.withColumnRenamed("o_orderkey", "transaction_id"))
    again = fetched.unionAll(fetched).withColumnRenamed("transaction_id", "o_orderkey")
    return upsert.insert_new(old, again.select(old.columns), ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("""
    WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)
    SELECT k, CASE WHEN k % 3 = 0 THEN -v ELSE v END AS digits, 'GBP ' || format('{:,}', v) AS shown, round((v - k) * 100.0 / nullif(k, 0), 1) + 0.0 AS change_pct, CASE k % 4 WHEN 0 THEN NULL ELSE CAST(k AS INTEGER) END AS page,
        'total equity ' || k AS label, CASE k % 5 WHEN 0 THEN 'GBP' WHEN 1 THEN 'GBP_THOUSANDS' WHEN 2 THEN 'USD_MILLIONS' WHEN 3 THEN 'EUR_THOUSANDS' ELSE 'UNKNOWN' END AS unit,
        CASE k % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'USD_THOUSANDS' WHEN 2 THEN 'USD_MILLIONS' WHEN 3 THEN 'USD_THOUSANDS' ELSE 'UNKNOWN' END AS other_unit, 'd' || k AS document_id,
        'Profit rose 12.5, to ' || k || '!' AS quote, v - 2 AS fixed, CASE WHEN v - 2 < 0 THEN '(' || format('{:,}', 2 - v) || ')' ELSE format('{:,}', v - 2) END AS display, CASE WHEN k = 0 THEN '0,' ELSE '' END || '1,2' || CASE WHEN k > 2 THEN ',' || k ELSE '' END AS pages
    FROM o
""")
def display_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Displayed numbers, units, labels, pages and quotes, and back."""
    k, v = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")
    s = k.cast("string")
    shown = F.when(k % 3 == 0, F.concat(F.lit("( "), F.format_number(v, 0), F.lit(")"))).otherwise(F.concat(F.lit("£ "), F.format_number(v, 0)))
    units = F.element_at(F.array(*map(F.lit, ("£", "£'000", "$ m", "EUR thousand", "shares"))), (k % 5 + 1).cast("int"))
    page = F.element_at(F.array(F.lit("p. "), F.lit(""), F.lit("Page "), F.lit(" Document page ")), (k % 4 + 1).cast("int"))
    unit = money.unit(units)
    body = F.concat(F.lit('note: ```json {"v": '), (v - 2).cast("string"), F.lit(', "t": ",]",} ```'))
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), text.display_number(shown).alias("digits"), text.currency_text(v).alias("shown"), arithmetic.change_over_magnitude(v, k).alias("change_pct"), text.page_number(F.concat(page, s)).alias("page"),
        text.label_text(F.concat(F.lit("Total  equity: "), s, F.lit(" £"))).alias("label"), unit.alias("unit"), money.with_currency(unit, F.lit("USD")).alias("other_unit"),
        text.last_path_segment(F.concat(F.lit("http://x/d"), s, F.lit("/"))).alias("document_id"), text.quote_text(F.concat(F.lit("“Profit  rose 12.5, to "), s, F.lit("!”"))).alias("quote"),
        F.get_json_object(text.repair_json(body), "$.v").cast("bigint").alias("fixed"), money.display_text((v - 2).cast("decimal(38,6)")).alias("display"),
        F.array_join(text.page_list(F.concat(F.lit("2, 1,x,"), s, F.lit(",2"))), ",").alias("pages"),
    )


CELL_SQL = """
    c AS (SELECT o_orderkey AS k, o_orderpriority AS priority, CASE WHEN o_orderkey % 7 > 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS want,
        CASE WHEN o_orderkey % 6 > 0 THEN CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END END AS got FROM orders),
    s AS (SELECT *, CASE WHEN want IS NULL AND got IS NULL THEN 'correct_missing' WHEN want = got THEN 'correct' WHEN want IS NOT NULL AND got IS NOT NULL THEN 'wrong' WHEN want IS NOT NULL THEN 'not_found' ELSE 'unexpected' END AS outcome FROM c)
"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")
    orders = table(spark, sf_dir, "orders")
    cell = [k.alias("case_id"), F.lit("current").alias("period"), F.lit("turnover").alias("metric")]
    value = lambda pounds, pence: scoring.comparable(F.lit("GBP"), pounds.cast("decimal(38,6)"), pence, F.lit(None).cast("bigint"), F.lit("turnover")).alias("value")
    gold = orders.select(*cell, "o_orderpriority", value(F.when(k % 7 > 0, v), F.lit(None).cast("bigint")))
    found = orders.where("o_orderkey % 6 > 0").select(*cell, value(F.lit(None), (v + F.when(k % 5 == 0, 1).otherwise(0)) * 100))
    return scoring.cells(gold, found)


@query(f"WITH {CELL_SQL} SELECT k AS case_id, outcome FROM s")
def scored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected amounts against found ones, which are stated in pence."""
    return _cells(spark, sf_dir).select("case_id", "outcome")


@query(f"""
    WITH {CELL_SQL} SELECT priority, count(*) AS cells, count(*) FILTER (outcome IN ('correct', 'correct_missing')) AS exact, round(count(*) FILTER (outcome = 'correct') / nullif(count(*) FILTER (outcome IN ('correct', 'wrong', 'not_found')), 0), 6) AS recall,
        round(count(*) FILTER (outcome = 'correct') / nullif(count(*) FILTER (outcome IN ('correct', 'unexpected')), 0), 6) AS precision_ FROM s GROUP BY 1
""")
def scored_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.cell_summary(_cells(spark, sf_dir), ["o_orderpriority"])
    return found.select(F.col("o_orderpriority").alias("priority"), "cells", "exact", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision_"))


@query("""
    WITH r AS (SELECT o_orderkey % 50 + 1.0::DOUBLE AS sec, CASE WHEN o_orderkey % 3 = 0 THEN 0.01::DOUBLE ELSE CAST((o_orderkey % 10) * 0.001 + 5 * 0.002 AS DOUBLE) END AS cost, CASE WHEN o_orderkey % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS f1 FROM orders)
    SELECT count(*) AS documents, quantile_cont(sec, 0.5) AS median_seconds, quantile_cont(sec, 0.95) AS p95_seconds, round(count(*) / (sum(sec) / 3600.0), 6) AS documents_per_hour, round(sum(cost), 4) AS cost_usd, round(avg(f1), 6) AS mean_page_f1 FROM r
""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times, cost and page overlap of runs: costs are stated for some and priced by tokens for others."""
    k = F.col("o_orderkey")
    cost = scoring.call_cost(k % 10, F.lit(5), F.lit("0.001").cast("decimal(18,12)"), F.lit("0.002").cast("decimal(18,12)"), F.when(k % 3 == 0, 0.01))
    pages = scoring.page_overlap(F.array(F.lit(1), F.lit(2)), F.when(k % 2 == 0, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(2), F.lit(1))))
    runs = table(spark, sf_dir, "orders").select((k % 50 + 1.0).alias("elapsed_seconds"), cost["cost_usd"].alias("cost_usd"), pages.alias("pages_overlap"))
    found = scoring.run_report(runs)
    return found.withColumns({"documents_per_hour": F.round("documents_per_hour", 6), "cost_usd": F.round("cost_usd", 4), "mean_page_f1": F.round("mean_page_f1", 6)})


@query("""
    SELECT o_orderpriority AS stage, o_orderstatus AS model, count(*) AS attempts, count(*) FILTER (o_orderkey % 3 > 1) AS retries, count(*) FILTER (o_orderkey % 4 = 0) AS repaired, count(*) FILTER (o_orderkey % 5 = 0) AS failed,
        CAST(sum(o_orderkey % 3) AS BIGINT) AS attempt_tokens FROM orders GROUP BY ALL
""")
def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls per stage and model, with the sum of a usage map's numbers."""
    k = F.col("o_orderkey")
    calls = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("stage"), F.col("o_orderstatus").alias("model"), (k % 3).alias("attempt"), (k % 4 == 0).alias("repaired"), (k % 5 == 0).alias("failed"), F.lit(1.0).alias("elapsed_seconds"),
        F.create_map(F.lit("tokens"), k % 3).alias("usage"),
    )
    usage = scoring.usage_totals(calls, ["stage", "model"]).select("stage", "model", F.col("usage")["tokens"].alias("attempt_tokens"))
    return scoring.stage_summary(calls).drop("elapsed_seconds").join(usage, ["stage", "model"])


@query("""
    SELECT doc_id AS case_id, CASE doc_id % 6 WHEN 0 THEN 'state is not known' WHEN 1 THEN 'a missing cell has a value' WHEN 2 THEN 'a present cell has no value' ELSE 'a present cell has no page' END AS issue FROM documents WHERE doc_id % 6 < 4
""")
def label_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label cells that contradict themselves, and only these."""
    k = F.col("doc_id") % 6
    cells = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("case_id"), F.lit("current").alias("period"), F.lit("cash").alias("metric"), F.when(k == 0, "odd").when(k.isin(1, 5), "missing").otherwise("present").alias("state"),
        F.when(k.isin(1, 3, 4), 5).cast("bigint").alias("value_pence"), F.lit(None).cast("bigint").alias("value_count"), F.lit(None).cast("decimal(38,6)").alias("reported_value"), F.when(k == 4, 1).alias("source_page"),
    )
    return scoring.case_issues(cells).select("case_id", "issue")


@query("""
    SELECT doc_id AS case_id, CASE doc_id % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'present' END AS state, CASE doc_id % 6 WHEN 1 THEN doc_id * 100000 END AS value_pence,
        CASE doc_id % 6 WHEN 2 THEN 'expected three parts' WHEN 3 THEN 'page is no positive number' WHEN 4 THEN 'unit is not known' WHEN 5 THEN 'value is no number' END AS error FROM documents
""")
def reviewed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers' answers read as cells."""
    k = F.col("doc_id").cast("string")
    answer = F.element_at(F.array(F.lit(" missing "), F.concat(k, F.lit(" | 3 | £'000")), F.lit("1 | 2"), F.concat(k, F.lit(" | 0 | GBP")), F.concat(k, F.lit(" | 1 | sheep")), F.lit("x | 1 | GBP")), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"), scoring.reviewed_metric(answer, F.lit("turnover")).alias("r")).select("case_id", "r.state", "r.value_pence", "r.error")


PROFILED = """CASE doc_id % 5 WHEN 0 THEN 'no_narrative' WHEN 1 THEN 'invalid_response' WHEN 2 THEN 'invalid_response' ELSE 'profiled' END"""


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as companies: some without text, some whose quote or value does not hold, the rest in order."""
    k = F.col("doc_id") % 5
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("company_number"), F.lit(2020).alias("financial_year"), F.lit("Acme").alias("company_name"), F.lit("62020").alias("sic_code_primary"), F.lit("Software").alias("sic_label"))
    parts = rows.where(k > 0).select("company_number", F.explode(F.array(*[F.struct(F.lit(s).alias("section_key"), F.lit(t).alias("text"), F.lit(a).alias("is_auditor_text")) for s, t, a in (("business_review", "We sell software, to firms.", False), ("strategic_report", "In our opinion", True), ("other", "x", False))])).alias("p")).select("company_number", "p.*")
    contexts = profiles.question(rows.join(profiles.own_words(parts, ["company_number"]), "company_number", "left"))
    entry = lambda value, quote: F.struct(value.alias("value"), F.lit(0.5).alias("confidence"), quote.alias("quote"), F.lit("business_review").alias("section"))
    said = F.when(k == 1, "We sell sheep").otherwise('We  sell "software" to firms')
    fields = {f: entry(F.lit(v[0]), said) for f, v in profiles.FIELDS.items()} | {"customer_type": entry(F.when(k == 2, "aliens").otherwise("b2b"), said)}
    body = F.to_json(F.struct(*[c.alias(f) for f, c in fields.items()], F.lit("sells").alias("business_description"), F.struct(F.lit("agrees").alias("value"), F.lit("r").alias("reason")).alias("sic_agreement")))
    answers = rows.select("company_number", F.when(k == 3, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body).alias("response"))
    return profiles.outcomes(profiles.answered(contexts, answers))


@query(f"""
    SELECT doc_id, {PROFILED} AS outcome, CASE doc_id % 5 WHEN 1 THEN 5 WHEN 2 THEN 1 END AS n_issues, CASE WHEN doc_id % 5 > 0 THEN true ELSE false END AS shows_review FROM documents
""")
def profile_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came of each question that was put to a model."""
    rows = _answered(spark, sf_dir)
    told = F.when(F.col("outcome") == "invalid_response", F.size("issues"))
    shows = F.col("question").contains("## business_review\nWe sell software") & ~F.col("question").contains("In our opinion")
    return rows.select("doc_id", "outcome", told.alias("n_issues"), shows.alias("shows_review"))


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS company_number, f AS field, CASE f WHEN 'customer_type' THEN 'b2b' WHEN 'demand_model' THEN 'consumer_search' WHEN 'delivery_model' THEN 'product_physical' WHEN 'geography_served' THEN 'local' ELSE 'trading' END AS value
    FROM documents, (SELECT unnest(['demand_model', 'customer_type', 'delivery_model', 'geography_served', 'trading_status_confirmed']) AS f) WHERE doc_id % 5 > 2
""")
def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_rows(_answered(spark, sf_dir)).select("company_number", "field", "value")


@query("""SELECT field, count(*) AS n, round(avg(hit), 6) AS accuracy FROM (SELECT 'lang' AS field, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS hit FROM documents WHERE lang IS NOT NULL
    UNION ALL SELECT 'source', CASE WHEN source = 'src0' THEN 1.0 ELSE 0.0 END FROM documents WHERE source IS NOT NULL) GROUP BY 1""")
def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"), F.col("lang").alias("expected_lang"), F.lit("en").alias("found_lang"), F.col("source").alias("expected_source"), F.lit("src0").alias("found_source"))
    found = scoring.field_accuracy(rows, ["lang", "source"])
    return found.select("field", "n", F.round("accuracy", 6).alias("accuracy"))


@query("SELECT event_type AS event, max(event_id) AS event_id FROM events WHERE event_type IN ('click', 'error') GROUP BY 1")
def last_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyfold.streaming import monitor

    log = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("event"))
    return monitor.last_of_kind(log, "event_id", ["click", "error"]).select("event", "last.event_id")


@query("""
    WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS done, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1)
    SELECT hour, done, errors, done - lag(done) OVER (ORDER BY hour) AS done_delta, errors - lag(errors) OVER (ORDER BY hour) AS errors_delta FROM h
""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyfold.streaming import monitor

    hours = monitor.snapshot_change(monitor.hourly_snapshots(table(spark, sf_dir, "events")), "hour", ["done", "errors"])
    return hours.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "done", "errors", "done_delta", "errors_delta")


@query("SELECT min(c_custkey) AS c_custkey, c_mktsegment AS company_number, 40 AS lead_score FROM customer GROUP BY c_mktsegment")
def leads_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads put in once a number, the first one of each, if their score is high enough."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("company_number"), F.lit(40).alias("lead_score"))
    low = rows.withColumns({"company_number": F.lit("low"), "lead_score": F.lit(10)})
    return leads.load_leads(rows.limit(0), rows.unionAll(low), 30, F.col("c_custkey"))


@query("""
    SELECT o_orderkey AS document_id, CASE WHEN o_orderkey % 3 = 0 THEN 'sic_unavailable' WHEN (o_orderkey % 3 = 1) = (o_orderkey % 2 = 0) THEN 'agreement' ELSE 'document_evidence_overrides_sic' END AS alignment,
        CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_primary, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_rejected,
        CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN '65120,62020' ELSE '62020' END AS codes
    FROM orders
""")
def insurance_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether registered codes and visible rows tell of the same kind of company."""
    k = F.col("o_orderkey")
    codes = F.when(k % 3 == 1, F.array(F.lit(" 65120"), F.lit("62020 "), F.lit("65120"))).when(k % 3 == 2, F.array(F.lit("62020"), F.lit(" "))).otherwise(F.array(F.lit("")))
    orders = table(spark, sf_dir, "orders")
    contexts = context.normalised(orders.select(k.alias("document_id"), _number("o_custkey").alias("company_number"), codes.alias("sic_codes")))
    rows = orders.select(k.alias("document_id"), F.lit("c1").alias("candidate_id"), F.when(k % 2 == 0, "primary_insurance_income_statement").otherwise("primary_statement").alias("role"), F.lit("turnover").alias("metric"))
    refused = orders.where(k % 5 == 0).select(k.alias("document_id"), F.lit("c2").alias("candidate_id"), F.lit("net_earned_premiums").alias("metric"))
    found = context.insurance_alignment(contexts, rows, refused)
    return found.select("document_id", "alignment", F.size("primary_ids").alias("n_primary"), F.size("rejected_ids").alias("n_rejected"), F.array_join("sic_codes", ",").alias("codes"))


@query("""
    SELECT o_orderkey AS batch, CAST(p AS INTEGER) AS position, CAST(10 + p AS INTEGER) AS page, 'r' || p AS rows_ FROM orders, (SELECT unnest([0, 1]) AS p) WHERE o_orderkey % 4 > 0
""")
def pages_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the pages of the images that they came from; a batch in four has a result too few."""
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch"), F.explode(F.array(F.lit(0), F.lit(1))).alias("position")).withColumn("page", F.col("position") + 10)
    results = images.where("batch % 4 > 0 or position = 0").select("batch", "position", F.lit(99).alias("page"), F.concat(F.lit("r"), F.col("position")).alias("rows_"))
    return context.with_page_numbers(results, images).select("batch", "position", "page", "rows_")


@query("""
    SELECT doc_id, doc_id % 3 = 0 AND doc_id % 2 = 0 AS needs, CASE doc_id % 4 WHEN 0 THEN 'sic_agreement' WHEN 1 THEN 'demand_model' WHEN 2 THEN 'customer_type' END AS field,
        CASE WHEN doc_id % 2 = 0 THEN 'business_review,other' ELSE '' END AS cited, CASE WHEN doc_id % 2 = 0 THEN '00000' || (doc_id % 900 + 100) END AS company_number, CASE WHEN doc_id % 2 = 0 THEN 'doc' || doc_id END AS document_id
    FROM documents
""")
def label_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost page numbers, the fields that issues name, cited sections and ids from file names."""
    k = F.col("doc_id")
    page = F.struct(F.when(k % 3 == 0, " 7 ").otherwise("vii").alias("page"), F.lit(True).alias("is_text"), F.lit(2).alias("n_rows"))
    message = F.element_at(F.array(*map(F.lit, ("sic_agreement: value not allowed", "demand_model.quote does not appear", "customer_type is missing", "no answer"))), (k % 4 + 1).cast("int"))
    entry = lambda s: F.struct(F.lit(s).alias("section"))
    expected = F.when(k % 2 == 0, F.array(entry("business_review"), entry(None), entry("other"), entry("business_review")))
    name = F.concat(F.lit("/d/"), F.lit("00000"), (k % 900 + 100).cast("string"), F.when(k % 2 == 0, "-doc").otherwise("_doc"), k.cast("string"), F.lit(".pdf"))
    rows = table(spark, sf_dir, "documents").select(k, F.when(k % 2 == 1, 1).alias("n_candidates"), F.array(page).alias("pages"), message.alias("message"), expected.alias("expected"), name.alias("name"))
    ids = context.ids_of_file(F.col("name"))
    return rows.select(
        "doc_id", context.needs_page_numbers(rows).alias("needs"), context.error_field(F.col("message")).alias("field"), F.array_join(context.cited_sections(F.col("expected")), ",").alias("cited"),
        ids["company_number"].alias("company_number"), ids["document_id"].alias("document_id"),
    )
