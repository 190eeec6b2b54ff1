"""What is known about a company or a label beside the evidence: context, provenance, pages, citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators import evidence
from tallyfold.operators.profiles import FIELDS


def clean_codes(codes: Column) -> Column:
    """Industry codes trimmed, without blank ones and repeats, in order; null gives none."""
    trimmed = F.transform(F.coalesce(codes, F.array().cast("array<string>")), lambda c: F.trim(c))
    return F.array_distinct(F.filter(trimmed, lambda c: F.coalesce(c != "", F.lit(False))))


def normalised(companies: DataFrame) -> DataFrame:
    """Companies (company_number, sic_codes) as context: the trimmed number, null where blank, and clean codes."""
    return companies.withColumns({"company_number": F.nullif(F.trim("company_number"), F.lit("")), "sic_codes": clean_codes(F.col("sic_codes"))})


def insurance_alignment(contexts: DataFrame, candidates: DataFrame, rejected: DataFrame, key: str = "document_id") -> DataFrame:
    """Contexts (key, sic_codes) with whether codes and accepted rows (role, metric) tell of an insurer, and the ids behind it."""
    ids = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("candidate_id"))))
    primary, note = F.col("role") == "primary_insurance_income_statement", (F.col("role") == "exact_insurance_note") & F.col("metric").isin(evidence.CANONICAL)
    found = candidates.groupBy(key).agg(ids(primary).alias("primary_ids"), ids(note).alias("note_ids"))
    refused = rejected.groupBy(key).agg(ids(F.col("metric").isin(evidence.INSURANCE)).alias("rejected_ids"))
    rows = contexts.join(found, key, "left").join(refused, key, "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumns({c: F.coalesce(c, none) for c in ("primary_ids", "note_ids", "rejected_ids")})
    by_code = F.exists("sic_codes", lambda c: c.rlike(r"^65[0-9]{3}\b"))
    by_document = F.size("primary_ids") > 0
    alignment = F.when(F.size("sic_codes") == 0, "sic_unavailable").when(by_code == by_document, "agreement").otherwise("document_evidence_overrides_sic")
    return rows.withColumns({"sic_indicates_insurance": by_code, "document_indicates_insurance": by_document, "alignment": alignment})


def with_page_numbers(results: DataFrame, rendered: DataFrame, batch: str = "batch") -> DataFrame:
    """Model results (batch, position, ...) with the page of the image at their position (batch, position, page).

    A page that the model states is not used. Batches with more or fewer results
    than images are left out whole; ``unmatched_batches`` names them.
    """
    return results.drop("page").join(rendered, [batch, "position"]).join(unmatched_batches(results, rendered, batch), batch, "left_anti")


def unmatched_batches(results: DataFrame, rendered: DataFrame, batch: str = "batch") -> DataFrame:
    """(batch, n_results, n_images) where the two differ."""
    counts = lambda df, name: df.groupBy(batch).agg(F.count("*").alias(name))
    both = counts(results, "n_results").join(counts(rendered, "n_images"), batch, "full").fillna(0)
    return both.where("n_results <> n_images")


def needs_page_numbers(payloads: DataFrame) -> Column:
    """Whether a saved payload (n_candidates, pages of (page string, is_text, n_rows)) lost its rows since its pages are numbers written as text."""
    lost = F.exists("pages", lambda p: p["is_text"] & p["page"].rlike(r"^\s*[0-9]+\s*$") & (p["n_rows"] > 0))
    return (F.coalesce("n_candidates", F.lit(0)) == 0) & F.coalesce(lost, F.lit(False))


def error_field(message: Column) -> Column:
    """The field that an issue of an answer is about, or null where it names none."""
    head = F.regexp_extract(message, r"^([^ .:]*)", 1)
    return F.when(head.isin([*FIELDS, "sic_agreement", "business_description"]), head)


def cited_sections(expected: Column) -> Column:
    """The sections that expected values cite, in field order, each once; ``expected`` is an array of structs with ``section``."""
    sections = F.filter(F.transform(F.coalesce(expected, F.array().cast("array<struct<section:string>>")), lambda e: e["section"]), lambda s: F.coalesce(s != "", F.lit(False)))
    return F.array_distinct(sections)


def provenance(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pages, labels, statement types and roles of the rows behind a figure, in the rows' order (at most the few rows of one figure)."""
    fields = ["page", "source_label", "statement_type", "role"]
    told = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page_pos", "row_pos", *fields))).alias("r"))
    return told.select(*keys, *[F.col("r")[f].alias(f"source_{f.removeprefix('source_')}s") for f in fields])


def ids_of_file(path: Column) -> Column:
    """(company_number, document_id) of a file named 12345678-<document>.pdf; both null for other names."""
    name = F.substring_index(path, "/", -1)
    parts = [F.nullif(F.regexp_extract(name, r"^([0-9]{8})-([^.]+)\.pdf$", k), F.lit("")) for k in (1, 2)]
    return F.struct(parts[0].alias("company_number"), parts[1].alias("document_id"))
