"""From fetched payloads to tables: shredding, outcomes, and what a run of the queue did."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators import evidence, facts, narrative


def periods_of(documents: DataFrame, key: str = "document_id", markup: str = "xhtml") -> DataFrame:
    """Period rows from tagged documents (document_id, company_number, xhtml); each row is a document of its own."""
    views = facts.period_views(facts.tagged(documents.select(key, "company_number", markup), markup))
    return views.select(key, *[c for c in views.columns if c not in (key, "company_number")], "company_number", F.lit("xhtml").alias("data_source"))


def narrative_of(documents: DataFrame, key: str = "document_id", markup: str = "xhtml") -> tuple[DataFrame, DataFrame]:
    """(sections, statements) of tagged documents, each read as one page."""
    pages = documents.select(key, F.array(narrative.narrative_text(F.col(markup))).alias("pages"))
    return narrative.sections(pages, key, "pages"), narrative.performance_statements(pages, key, "pages")


def outcome(filing: Column, xhtml: Column, error: Column) -> Column:
    """What a company's enrichment came to."""
    return F.when(error.isNotNull(), "error").when(filing.isNull(), "no_filing").when(xhtml.isNull(), "no_xhtml").otherwise("done")


def best_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, period and metric the row with a known unit and the highest confidence; the first one wins ties."""
    from pyspark.sql import Window

    best = Window.partitionBy(*keys, "period_type", "metric").orderBy(F.desc((F.col("unit") != "UNKNOWN").cast("int")), F.desc_nulls_last("confidence"), "position")
    return rows.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def metric_periods(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and period with a column per canonical metric and the currency, if there is one for all."""
    best = best_metrics(rows, keys)
    group = [*keys, "period_type"]
    wide = best.groupBy(*group).agg(*[F.max(F.when(F.col("metric") == m, F.col("reported_value"))).alias(m) for m in evidence.CANONICAL])
    return wide.join(evidence.unanimous(best, group, "currency_code"), group, "left").withColumn("data_source", F.lit("vlm"))


def legacy_amount(value: Column) -> Column:
    """A whole number written without a point; anything else is null."""
    return F.when(value.rlike(r"^-?\d+$"), value.try_cast("bigint"))


def outcome_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """(step, outcome, n) of the steps of a run, each with a column ``outcome``."""
    rows = [df.groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(k).alias("step"), "outcome", "n") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def to_fetch(filings: DataFrame, stored: DataFrame) -> DataFrame:
    """Filings whose transaction is not stored yet."""
    known = stored.where("transaction_id is not null").select("transaction_id")
    return filings.join(known, "transaction_id", "left_anti")


def years_filled(rows: DataFrame, years: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a null year filled where all candidates of the key agree on one."""
    agreed = evidence.unanimous(years, keys, "year").withColumnRenamed("year", "__year")
    return rows.join(agreed, keys, "left").withColumn("financial_year", F.coalesce("financial_year", "__year")).drop("__year")


PAYLOAD = (
    "company_number string, source_mode string, generated_at string, "
    "company_profile struct<company_name:string, company_status:string, type:string, date_of_creation:string, sic_codes:array<string>>, "
    "latest_accounts_filing struct<transaction_id:string, date:string, category:string, type:string, description:string, action_date:string, pages:int>, "
    "document_urls struct<metadata:string, xhtml:string, pdf:string>, "
    "financials map<string, struct<financial_year:int, period_end_on:string, currency_code:string, turnover:bigint, gross_profit:bigint, operating_result:bigint, profit_after_tax:bigint, cash:bigint, net_assets:bigint, employees:double>>"
)


def shredded(payloads: DataFrame) -> dict[str, DataFrame]:
    """Rows of companies, filings, documents and periods from JSON payloads (column ``payload``), in the tables' schemas.

    Payloads that are no JSON, or without a company, give nothing.
    """
    from tallyfold import schemas
    from tallyfold.functions import text

    p = payloads.select(F.from_json("payload", PAYLOAD).alias("p"), "payload").where("p.company_number is not null")
    document = text.last_path_segment(F.col("p.document_urls.metadata"))
    profile = F.col("p.company_profile")
    companies = p.select(
        "p.company_number", profile["company_name"].alias("company_name"), profile["company_status"].alias("company_status"), profile["type"].alias("company_type"),
        F.to_date(profile["date_of_creation"]).alias("date_of_creation"), F.coalesce(profile["sic_codes"], F.array().cast("array<string>")).alias("sic_codes"),
        F.try_element_at(profile["sic_codes"], F.lit(1)).alias("sic_code_primary"), "p.source_mode", F.to_json(profile).alias("profile_payload"), F.try_to_timestamp("p.generated_at").alias("updated_at"),
    )
    f = F.col("p.latest_accounts_filing")
    filings = p.where(f["transaction_id"].isNotNull()).select(
        f["transaction_id"].alias("transaction_id"), "p.company_number", F.to_date(f["date"]).alias("filing_date"), f["category"].alias("category"), f["type"].alias("type"),
        f["description"].alias("description"), F.to_date(f["action_date"]).alias("action_date"), f["pages"].alias("pages"), F.to_json(f).alias("filing_payload"),
    )
    urls = F.col("p.document_urls")
    documents = p.where(document.isNotNull()).select(document.alias("document_id"), f["transaction_id"].alias("transaction_id"), "p.company_number", urls["metadata"].alias("metadata_url"), urls["xhtml"].alias("xhtml_url"), urls["pdf"].alias("pdf_url"))
    years = p.select("p.company_number", document.alias("document_id"), F.explode("p.financials").alias("period_type", "y"))
    periods = years.select("company_number", "document_id", "period_type", "y.*").withColumn("period_end_on", F.to_date("period_end_on"))
    found = {"companies": companies, "filings": filings, "documents": documents, "periods": periods}
    return {name: schemas.ensure_schema(df, name, {"data_source": "xhtml"} if name == "periods" else None) for name, df in found.items()}
