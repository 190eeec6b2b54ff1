"""Recorded answers of the register's interface and web pages, as relations.

Fetching is a job outside the engine; its results are stored as (key, payload)
rows with the JSON or HTML text, and every function here takes such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.functions import text

SEARCH = "items array<struct<title:string, company_number:string, company_status:string, address_snippet:string>>"
PROFILE = "company_name string, company_number string, company_status string, type string, date_of_creation string, sic_codes array<string>"
FILINGS = "items array<struct<transaction_id:string, date:string, category:string, type:string, description:string, description_values:struct<made_up_date:string>, action_date:string, pages:int, links:struct<document_metadata:string>>>"
METADATA = "id string, resources map<string, struct<content_length:bigint>>"


def search_results(answers: DataFrame, key: str = "query") -> DataFrame:
    """(key, position, company_name, company_number, company_status, address)."""
    items = answers.select(key, F.posexplode(F.from_json("payload", SEARCH)["items"]).alias("position", "i"))
    return items.select(
        key, "position", F.trim("i.title").alias("company_name"), F.trim("i.company_number").alias("company_number"), "i.company_status",
        F.nullif(text.collapse(F.col("i.address_snippet")), F.lit("")).alias("address"),
    )


def chosen_company(results: DataFrame, key: str = "query", number: str | None = None) -> DataFrame:
    """Per query the result with the wanted number, else with exactly the query's name, else the first."""
    wanted = F.col("company_number") == F.col(number) if number else F.lit(False)
    rank = F.when(wanted, 0).when(F.lower("company_name") == F.lower(F.col(key)), 1).otherwise(2)
    first = F.row_number().over(Window.partitionBy(key).orderBy(rank, "position"))
    return results.withColumn("__r", first).where("__r = 1").drop("__r")


def profiles(answers: DataFrame) -> DataFrame:
    """Companies with their industry codes, the first of which is primary; bad JSON gives no codes."""
    p = F.from_json("payload", PROFILE)
    rows = answers.withColumn("p", p)
    codes = F.coalesce("p.sic_codes", F.array().cast("array<string>"))
    return rows.select(
        F.coalesce("p.company_number", F.col("company_number")).alias("company_number"), "p.company_name", "p.company_status", F.col("p.type").alias("company_type"),
        F.to_date("p.date_of_creation").alias("date_of_creation"), codes.alias("sic_codes"), F.try_element_at(codes, F.lit(1)).alias("sic_code_primary"), F.col("payload").alias("profile_payload"),
    )


def filings(answers: DataFrame) -> DataFrame:
    """(company_number, position, transaction_id, date, type, made_up_date, action_date, metadata_path, ...)."""
    items = answers.select("company_number", F.posexplode(F.from_json("payload", FILINGS)["items"]).alias("position", "i"))
    return items.select(
        "company_number", "position", "i.transaction_id", F.to_date("i.date").alias("date"), "i.category", "i.type", "i.description",
        F.to_date("i.description_values.made_up_date").alias("made_up_date"), F.to_date("i.action_date").alias("action_date"), "i.pages", F.col("i.links.document_metadata").alias("metadata_path"),
    )


def latest_filing(rows: DataFrame) -> DataFrame:
    """The first filing of each company's list, whatever its type."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy("company_number").orderBy("position"))).where("__r = 1").drop("__r")


def document_urls(answers: DataFrame, base: str) -> DataFrame:
    """Metadata answers (metadata_url, payload) with the document's id and content URLs by kind."""
    m = answers.withColumn("m", F.from_json("payload", METADATA))
    name = F.coalesce("m.id", text.last_path_segment(F.col("metadata_url")))
    content = F.concat(F.lit(f"{base}/document/"), name, F.lit("/content"))
    has = lambda kind: F.when(F.coalesce(F.map_contains_key("m.resources", kind), F.lit(False)), content)
    return m.select("metadata_url", name.alias("document_id"), has("application/xhtml+xml").alias("xhtml_url"), has("application/pdf").alias("pdf_url"))


def page_profiles(pages: DataFrame) -> DataFrame:
    """Profile fields from a company's web page (company_number, html)."""
    cell = lambda mark: text.strip_tags(F.regexp_extract("html", rf'(?is){mark}>\s*(.*?)\s*</(?:dd|span)>', 1))
    return pages.select(
        "company_number", text.strip_tags(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("company_name"), cell('id="company-status"').alias("company_status"),
        cell('id="company-type"').alias("company_type"), cell('id="company-creation-date"').alias("date_of_creation"), cell('id="roa-address"').alias("address"),
    )


def page_filings(pages: DataFrame) -> DataFrame:
    """Annual accounts listed on a company's filing page: one row per table row of type AA."""
    rows = pages.select("company_number", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)(<tr>.*?</tr>)"), 1)).alias("position", "row"))
    cells = rows.withColumn("cells", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1), text.strip_tags))
    link = lambda kind: F.nullif(F.replace(F.regexp_extract("row", rf'href="([^"]*format={kind}[^"]*)"', 1), F.lit("&amp;"), F.lit("&")), F.lit(""))
    found = cells.select("company_number", "position", F.try_element_at("cells", F.lit(1)).alias("date_text"), F.try_element_at("cells", F.lit(2)).alias("type"), F.try_element_at("cells", F.lit(3)).alias("description"), link("pdf").alias("pdf_link"), link("xhtml").alias("xhtml_link"))
    return found.where("type = 'AA' and pdf_link is not null")


def page_search(pages: DataFrame, key: str = "query") -> DataFrame:
    """Companies listed on a search page (key, html): one row per link to a company."""
    items = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(r'(?is)(<a[^>]*href="/company/[A-Z0-9]+"[^>]*>.*?</a>.*?)(?=<a[^>]*href="/company/|\z)'), 1)).alias("position", "item"))
    meta = text.strip_tags(F.regexp_extract("item", r'(?is)<p class="meta crumbtrail">(.*?)</p>', 1))
    return items.select(
        key, "position", text.strip_tags(F.regexp_extract("item", r"(?is)^(.*?)</a>", 1)).alias("company_name"), F.regexp_extract("item", r'(?i)href="/company/([A-Z0-9]+)"', 1).alias("company_number"),
        F.nullif(F.trim(F.regexp_extract(meta, r"-\s*(.+)$", 1)), F.lit("")).alias("company_status"), F.nullif(text.strip_tags(F.regexp_extract("item", r"(?is)<p>(.*?)</p>", 1)), F.lit("")).alias("address"),
    )


def source_mode(results: DataFrame, key: str) -> DataFrame:
    """(key, mode): website where any of a key's parts came from a web page, else public_api."""
    return results.groupBy(key).agg(F.when(F.bool_or(F.col("source") == "website"), "website").otherwise("public_api").alias("mode"))
