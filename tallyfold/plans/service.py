"""The query service: read-only questions over the stored tables, each a lazy DataFrame."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import arithmetic, text
from tallyfold.operators import leads, timeseries, upsert, websites
from tallyfold.operators.narrative import SECTION_HEADINGS
from tallyfold.operators.substring import SubstringIndex

SCORES = ["ecommerce_signal_score", "lead_generation_signal_score", "b2b_service_signal_score", "local_presence_signal_score", "ppc_fit_score"]
NUMBERS = [
    "site_match_confidence_score", *SCORES, "search_results_count", "candidate_count", "chosen_result_score", "nav_link_count", "cta_count", "body_word_count",
    "price_mention_count", *[f"{t}_keyword_count" for t in websites.KEYWORDS],
]


class LeadService:
    """Questions over a mapping of table names to DataFrames.

    Industry groups are a small dimension of fixed size and are joined on the
    first five characters of a lead's code; Spark broadcasts them by their size.
    ``indexes`` are substring indexes of a table's texts, by the table's name, with
    its ``id``: searches then look into the texts that can hold the question only.
    """

    def __init__(self, tables: Mapping[str, DataFrame], indexes: Mapping[str, SubstringIndex] | None = None):
        self.t, self.indexes = tables, indexes or {}

    def _top(self, rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
        return rows.orderBy(*order).limit(arithmetic.bounded(limit))

    def investigations(self) -> DataFrame:
        """Website investigations with their signals as columns."""
        signals = upsert.from_signals(self.t["website_signals"], "investigation_id", NUMBERS, websites.FLAGS)
        i = self.t["website_investigations"]
        return i.join(signals, F.col("investigation_id") == F.col("id"), "left").drop("investigation_id").withColumn("final_domain", text.domain(F.col("final_url")))

    def search_leads(self, query: str | None = None, min_score: int | None = None, statuses: list[str] | None = None, limit: int = 20) -> DataFrame:
        found = leads.matching(self.t["leads"], query, min_score, statuses)
        return self._top(found, [F.desc("lead_score"), F.asc("company_name"), F.asc("company_number")], limit)

    def unenriched(self, min_score: int = 80, categories: list[str] | None = None, statuses: list[str] | None = None, limit: int = 20) -> DataFrame:
        found = leads.matching(self.t["leads"], None, min_score, statuses or ["pending", "error"], categories)
        return self._top(found, [F.desc("lead_score"), F.asc("company_name"), F.asc("company_number")], limit)

    def errors(self, limit: int = 20) -> DataFrame:
        return self._top(self.t["leads"].where("status = 'error'"), [F.desc_nulls_last("processed_at"), F.desc("lead_score"), F.asc("company_number")], limit)

    def snapshot(self, company_number: str) -> DataFrame:
        """One row with company, lead, latest filing and document, periods by role, and website; LookupError without it."""
        own = lambda name: self.t[name].where(F.col("company_number") == company_number)
        company = own("companies")
        if company.isEmpty():
            raise LookupError(f"company {company_number} is not stored")
        key, row = "company_number", lambda df: F.struct(*df.columns)
        filing = own("filings").groupBy(key).agg(F.max_by(row(self.t["filings"]), F.struct("filing_date", "transaction_id")).alias("latest_filing"))
        document = own("documents").groupBy(key).agg(F.max_by(row(self.t["documents"]), "ingest_seq").alias("latest_document"))
        periods = own("periods")
        if "fx_conversions" in self.t:
            periods = periods.join(self.t["fx_conversions"].withColumnRenamed("status", "conversion_status"), F.col("id") == F.col("summary_id"), "left")
        latest = timeseries.upsert_latest(periods, ["period_type"])
        finances = latest.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("period_type", row(periods)))).alias("financials"))
        website = self.website(company_number)
        site = website.select(key, F.struct(*website.columns).alias("website_investigation"))
        lead = own("leads").groupBy(key).agg(F.first(row(self.t["leads"])).alias("lead"))
        out = company.select(key, F.struct(*company.columns).alias("company"))
        for part in (lead, filing, document, finances, site):
            out = out.join(part, key, "left")
        return out

    def website(self, company_number: str, source_label: str | None = None) -> DataFrame:
        rows = self.investigations().where(F.col("company_number") == company_number)
        rows = rows.where(F.col("source_label") == source_label) if source_label else rows
        return rows.orderBy(F.desc_nulls_last("updated_at"), F.desc("id")).limit(1)

    def explain_score(self, company_number: str) -> DataFrame:
        """The lead with its reasons, newest current period, website, and what is there; LookupError without it."""
        lead = self.t["leads"].where(F.col("company_number") == company_number)
        if lead.isEmpty():
            raise LookupError(f"lead {company_number} is not stored")
        current = self.t["periods"].where((F.col("company_number") == company_number) & (F.col("period_type") == "current"))
        period = timeseries.latest_period(current).select("company_number", F.struct(*current.columns).alias("financials"))
        website = self.website(company_number)
        site = website.select("company_number", F.struct(*website.columns).alias("website_investigation"))
        out = lead.select("company_number", "company_name", "lead_score", text.score_reasons(F.col("score_reasons")).alias("score_reasons"), F.struct(*lead.columns).alias("lead")).join(period, "company_number", "left").join(site, "company_number", "left")
        return out.withColumns({"has_financials": F.col("financials").isNotNull(), "has_website_investigation": F.col("website_investigation").isNotNull()})

    def compare(self, numbers: list[str], latest_only: bool = False) -> DataFrame:
        """Leads side by side, of the first hundred numbers; several years or investigations give several rows unless ``latest_only``."""
        wanted = self.t["leads"].where(F.col("company_number").isin(numbers[:100]))
        current = self.t["periods"].where("period_type = 'current'")
        current = timeseries.latest_period(current) if latest_only else current
        sites = self.investigations().select("company_number", "final_domain", "ppc_fit_score", "business_model")
        names = self.t["companies"].select("company_number", F.col("company_name").alias("filed_name"))
        rows = wanted.join(names, "company_number", "left").join(current.select("company_number", "turnover", "net_assets", "employees"), "company_number", "left")
        rows = self._with_industry(rows).join(sites, "company_number", "left")
        rows = rows.withColumn("company_name", F.coalesce("company_name", "filed_name"))
        columns = ["company_number", "company_name", "lead_score", "status", "sic_1", "account_category", "post_town", "turnover", "net_assets", "employees", "sic_label", "sic_group", "final_domain", "ppc_fit_score", "business_model"]
        return rows.select(columns).orderBy(F.desc("lead_score"), "company_number")

    def _with_industry(self, rows: DataFrame) -> DataFrame:
        groups = self.t["sic_groups"].withColumnRenamed("sic_code", "__code")
        return rows.join(groups, F.substring("sic_1", 1, 5) == F.col("__code"), "left").drop("__code")

    def _text_search(self, table: str, columns: list[str], query: str, order: list[str], limit: int) -> DataFrame:
        runs = self.t["narrative_runs"].select(F.col("id").alias("narrative_run_id"), "company_number", "document_id")
        *names, body = columns
        holds = lambda cs: functools.reduce(operator.or_, [F.coalesce(F.contains(F.lower(F.col(c)), F.lit(query.lower())), F.lit(False)) for c in cs], F.lit(False))
        texts = self.t[table]
        can = self.indexes[table].candidates(query) if table in self.indexes else None
        if can is None:
            found = texts.where(holds(columns))
        else:
            found = texts.join(can, "id", "left_semi").where(holds([body]) & ~holds(names)).select(texts.columns)
            found = found.unionAll(texts.where(holds(names))) if names else found
        rows = found.join(runs, "narrative_run_id").join(self.t["companies"].select("company_number", "company_name"), "company_number", "left")
        return self._top(rows, [F.asc(c) for c in order], limit)

    def search_sections(self, query: str, limit: int = 20) -> DataFrame:
        return self._text_search("narrative_sections", ["section_key", "section_title", "section_text"], query, ["company_number", "section_key", "id"], limit)

    def search_statements(self, query: str, limit: int = 20) -> DataFrame:
        return self._text_search("performance_statements", ["statement_text"], query, ["company_number", "page", "id"], limit)

    def pipeline(self) -> DataFrame:
        """(measure, key, n): totals of the tables, and leads by status and category."""
        names = ["leads", "companies", "filings", "documents", "periods", "website_investigations", "narrative_runs", "narrative_sections", "performance_statements"]
        totals = leads.pipeline_summary({n: self.t[n] for n in names}).select("measure", F.lit(None).cast("string").alias("key"), "n")
        for key in ("status", "account_category"):
            totals = totals.unionByName(leads.counts_by(self.t["leads"], key).select(F.lit(f"leads by {key}").alias("measure"), F.col(key).alias("key"), "n"))
        return totals

    def website_leads(self, min_fit: float = 0.0, business_model: str | None = None, limit: int = 20) -> DataFrame:
        rows = self.investigations().where(F.coalesce("ppc_fit_score", F.lit(0.0)) >= min_fit)
        rows = rows.where(F.lower("business_model") == business_model.lower()) if business_model else rows
        return self._top(rows, [F.desc_nulls_last("ppc_fit_score"), F.asc("company_number"), F.asc("id")], limit)

    # the reports that stand on their own

    def history_coverage(self) -> DataFrame:
        return timeseries.history_coverage(self.t["periods"].where("period_type = 'current'"), "company_number", "financial_year")

    def financial_history(self, at_least: int = 1, company_number: str | None = None) -> DataFrame:
        """Current periods with growth and margins, of companies with enough years or of one company."""
        rows = self.t["periods"].where("period_type = 'current'")
        rows = rows.where(F.col("company_number") == company_number) if company_number else timeseries.with_history(rows, "company_number", "financial_year", at_least)
        rows = timeseries.growth(rows, "company_number", "financial_year", ["turnover", "net_assets"], F.col("id"))
        margins = {f"{n}_margin_pct": arithmetic.percent(F.col(c), F.col("turnover")) for n, c in (("gross", "gross_profit"), ("operating", "operating_result"))}
        rows = rows.withColumns(margins).join(self.t["companies"].select("company_number", "company_name"), "company_number", "left")
        industry = self._with_industry(self.t["leads"].select("company_number", "sic_1")).drop("sic_1")
        return rows.join(industry, "company_number", "left").orderBy("company_number", "financial_year")

    def band_candidates(self, least: int, most: int) -> DataFrame:
        rows = self.t["periods"].where((F.col("period_type") == "current") & F.col("turnover").between(least, most) & F.col("profit_after_tax").isNotNull())
        rows = rows.join(self.t["companies"].select("company_number", "company_name"), "company_number", "left").join(self.t["leads"].select("company_number", "account_category", "sic_1"), "company_number", "left")
        return self._with_industry(rows).select("company_number", "company_name", "account_category", "sic_label", "turnover", "profit_after_tax").orderBy(F.desc("turnover"), "company_number")

    def overlap_review(self) -> DataFrame:
        names = self.t["leads"].select("company_number", "company_name")
        rows = self.t["periods"].where("comparative_overlap_status = 'mismatch'").join(names, "company_number", "left")
        return rows.select("company_name", "company_number", "financial_year", "period_end_on", "comparative_overlap_payload").orderBy("company_number", "financial_year")

    def overlap_summary(self) -> DataFrame:
        rows = self.t["periods"].where("comparative_overlap_status is not null").join(self.t["leads"].select("company_number", "account_category"), "company_number", "left")
        part = rows.groupBy("account_category", "comparative_overlap_status").agg(F.count("*").alias("periods"))
        every = part.groupBy("comparative_overlap_status").agg(F.sum("periods").alias("periods")).withColumn("account_category", F.lit("overall"))
        return every.unionByName(part.withColumn("account_category", F.coalesce("account_category", F.lit("unknown")))).select("account_category", "comparative_overlap_status", "periods")

    def triage_review(self) -> DataFrame:
        """Companies that do not plainly trade, with their signals and newest figures."""
        signals = upsert.from_signals(
            self.t["company_signals"], "company_number", ["revenue_per_employee", "gross_margin_pct"], ["turnover_without_employees", "sic_is_catch_all"], ["trading_status", "trading_status_reason", "duplicate_of"]
        )
        current = timeseries.latest_period(self.t["periods"].where("period_type = 'current'")).select("company_number", "turnover", "employees")
        groups = self.t["sic_groups"].select(F.col("sic_code").alias("sic_code_primary"), "sic_label")
        rows = self.t["companies"].select("company_number", "company_name", "sic_code_primary").join(signals.where("trading_status <> 'trading'"), "company_number")
        return rows.join(groups, "sic_code_primary", "left").join(current, "company_number", "left").orderBy(F.desc_nulls_last("turnover"), "company_number")

    def narrative_report(self) -> DataFrame:
        """Each company's newest narrative, a column per section, with counts of sections and of those with tags in them."""
        runs = self.t["narrative_runs"].groupBy("company_number").agg(F.max("id").alias("narrative_run_id"))
        rows = self.t["narrative_sections"].join(runs, "narrative_run_id")
        body = F.col("section_text")
        junk = body.contains("bus:Director") | body.contains("contextRef") | body.contains("xbrli")
        keys = [k for k, _ in SECTION_HEADINGS[:9]]
        wide = rows.groupBy("company_number").agg(F.count("id").alias("sections"), F.count_if(junk).alias("junk_sections"), *[F.max(F.when(F.col("section_key") == k, body)).alias(k) for k in keys])
        current = timeseries.latest_period(self.t["periods"].where("period_type = 'current'")).select("company_number", "turnover", "employees")
        return wide.join(self.t["companies"].select("company_number", "company_name", "sic_code_primary"), "company_number").join(current, "company_number", "left").orderBy(F.desc_nulls_last("turnover"), "company_number")

    def narrative_queue(self, limit: int | None = None) -> DataFrame:
        """Documents with turnover and a finished lead but no narrative, largest turnover first."""
        current = self.t["periods"].where("period_type = 'current' and turnover is not null").select("company_number", "turnover")
        done = self.t["leads"].where("status = 'done'").select("company_number")
        rows = self.t["documents"].join(current, "company_number").join(done, "company_number", "left_semi")
        rows = rows.join(self.t["narrative_runs"].select("company_number"), "company_number", "left_anti")
        rows = rows.orderBy(F.desc("turnover"), "company_number", "document_id").select("company_number", "document_id", "xhtml_url", "turnover")
        return rows.limit(limit) if limit else rows

    def profile_context(self) -> DataFrame:
        """Each company's newest narrative as a map of sections, with its industry and newest year."""
        runs = self.t["narrative_runs"].groupBy("company_number").agg(F.max("id").alias("narrative_run_id"))
        parts = self.t["narrative_sections"].join(runs, "narrative_run_id").groupBy("company_number", "narrative_run_id").agg(F.map_from_entries(F.collect_list(F.struct("section_key", "section_text"))).alias("sections"))
        current = timeseries.latest_period(self.t["periods"].where("period_type = 'current'")).select("company_number", "financial_year", "turnover", "employees")
        groups = self.t["sic_groups"].select(F.col("sic_code").alias("sic_code_primary"), "sic_label")
        company = self.t["companies"].select("company_number", "company_name", "sic_code_primary")
        return parts.join(company, "company_number").join(groups, "sic_code_primary", "left").join(current, "company_number", "left")

    def questions(self) -> dict[str, object]:
        """The service's questions by name."""
        names = ["search_leads", "snapshot", "search_sections", "website", "pipeline", "unenriched", "explain_score", "compare", "search_statements", "errors", "website_leads"]
        return {n: getattr(self, n) for n in names}
