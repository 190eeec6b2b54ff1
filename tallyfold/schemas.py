"""Schemas of the stored tables, their keys, and additive evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

#: Columns of each table as DDL.
DDL: dict[str, str] = {
    "companies": "company_number string, company_name string, company_status string, company_type string, date_of_creation date, sic_codes array<string>, sic_code_primary string, source_mode string, profile_payload string, updated_at timestamp",
    "leads": "company_number string, company_name string, sic_1 string, incorporation_date date, last_accounts_date date, account_category string, post_town string, post_code string, lead_score int, score_reasons string, status string, xhtml_available boolean, filing_date date, filing_type string, error_message string, processed_at timestamp",
    "filings": "transaction_id string, company_number string, filing_date date, category string, type string, description string, action_date date, pages int, filing_payload string",
    "documents": "document_id string, transaction_id string, company_number string, metadata_url string, xhtml_url string, pdf_url string, metadata_payload string, ingest_seq bigint",
    "periods": "id bigint, company_number string, document_id string, period_type string, financial_year int, period_end_on date, currency_code string, currency_source string, currency_validation_status string, turnover bigint, gross_profit bigint, operating_result bigint, profit_after_tax bigint, cash bigint, net_assets bigint, employees double, data_source string, comparative_overlap_status string, comparative_overlap_payload string",
    "narrative_runs": "id bigint, company_number string, document_id string, created_at timestamp",
    "narrative_sections": "id bigint, narrative_run_id bigint, section_key string, section_title string, page int, section_text string",
    "performance_statements": "id bigint, narrative_run_id bigint, page int, statement_text string",
    "vision_metrics": "run_id bigint, company_number string, period_type string, metric string, reported_value decimal(38,6), currency_code string, unit string, confidence double, source_page int",
    "company_signals": "company_number string, signal_key string, signal_type string, signal_bool boolean, signal_int bigint, signal_real double, signal_text string, source_scope string, created_at timestamp, updated_at timestamp",
    "company_profiles": "company_number string, financial_year int, field string, value string, confidence double, quote string, section string, narrative_run_id bigint",
    "website_investigations": "id bigint, company_number string, source_label string, status string, sic_1 string, business_model string, final_url string, page_title string, updated_at timestamp",
    "website_signals": "investigation_id bigint, signal_key string, signal_type string, signal_bool boolean, signal_int bigint, signal_real double, signal_text string",
    "fx_rates": "source_currency string, target_currency string, rate_date date, series string, payload_hash string, rate decimal(38,20), source_url string",
    "fx_conversions": "summary_id bigint, status string, reason string, rate_date date, rate decimal(38,20), turnover_pence bigint, gross_profit_pence bigint, operating_result_pence bigint, profit_after_tax_pence bigint, cash_pence bigint, net_assets_pence bigint",
    "sic_groups": "sic_code string, sic_label string, sic_group string",
}

#: What identifies a row of each table; nulls are equal to each other here.
KEYS: dict[str, list[str]] = {
    "companies": ["company_number"],
    "leads": ["company_number"],
    "filings": ["transaction_id"],
    "documents": ["document_id"],
    "periods": ["company_number", "document_id", "period_type"],
    "vision_metrics": ["run_id", "period_type", "metric"],
    "company_signals": ["company_number", "signal_key"],
    "company_profiles": ["company_number", "financial_year", "field"],
    "website_investigations": ["company_number", "source_label"],
    "website_signals": ["investigation_id", "signal_key"],
    "fx_rates": ["source_currency", "target_currency", "rate_date", "series", "payload_hash"],
    "fx_conversions": ["summary_id"],
    "sic_groups": ["sic_code"],
}


def schema(table: str) -> StructType:
    return _parse_datatype_string(DDL[table])


def ensure_schema(df: DataFrame, table: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """The table's columns in order; missing ones hold their default or null, others go."""
    have, defaults = set(df.columns), defaults or {}
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema(table)]
    )
