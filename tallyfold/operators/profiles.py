"""Business profiles: what a model is asked, and what of its answer counts.

Model calls are a replaceable stage: ``answered`` joins recorded answers, and a
client can be put in its place with ``mapInPandas``. Everything here works on
answers as JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import text

# Sections that are read, in order, and the values of each field.
SECTIONS = ["turnover_note", "employee_note", "principal_activity", "business_review", "strategic_report", "directors_report", "principal_risks", "future_developments"]
FIELDS: dict[str, list[str]] = {
    "demand_model": ["consumer_search", "local_service", "b2b_relationship", "platform_intermediated", "wholesale_contract", "not_customer_facing", "unclear"],
    "customer_type": ["b2c", "b2b", "b2b2c", "public_sector", "mixed", "unclear"],
    "delivery_model": ["product_physical", "product_digital", "saas", "professional_service", "trade_service", "contracting", "distribution_resale", "rental_leasing", "property", "unclear"],
    "geography_served": ["local", "regional", "national_uk", "international", "unclear"],
    "trading_status_confirmed": ["trading", "investment_holding", "trading_group_parent", "dormant", "spv", "unclear"],
}
AGREEMENT = ["agrees", "disagrees", "unclear"]

_ENTRY = "struct<value:string, confidence:double, quote:string, section:string>"
ANSWER = ", ".join(f"{f} {_ENTRY}" for f in FIELDS) + ", business_description string, sic_agreement struct<value:string, reason:string>"


def own_words(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sections): a map of the sections that are read, without those of an auditor (section_key, text, is_auditor_text)."""
    rows = sections.where(F.col("section_key").isin(SECTIONS) & (F.coalesce("text", F.lit("")) != "") & ~F.coalesce("is_auditor_text", F.lit(False)))
    return rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("section_key", "text"))).alias("sections"))


def section_block(sections: Column) -> Column:
    """The sections as one text, in their order."""
    parts = [F.when(F.map_contains_key(sections, s), F.concat(F.lit(f"## {s}\n"), F.try_element_at(sections, F.lit(s)))) for s in SECTIONS]
    return F.concat_ws("\n\n", *parts)


def _asked() -> Column:
    """The part of a question that names the company and the values of each field."""
    head = F.concat_ws("\n", F.concat(F.lit("Company: "), F.col("company_name")), F.concat(F.lit("Registered activity: "), F.concat_ws(" ", "sic_code_primary", "sic_label")))
    options = "\n".join(f"{f}: {', '.join(v)}" for f, v in FIELDS.items())
    return F.concat_ws("\n\n", head, F.lit(options))


def question(contexts: DataFrame) -> DataFrame:
    """Contexts (company_name, sic_code_primary, sic_label, sections) with the text that is put to a model."""
    return contexts.withColumn("question", F.concat_ws("\n\n", _asked(), section_block(F.col("sections"))))


def whole_question(contexts: DataFrame, body: str = "text") -> DataFrame:
    """The same over a whole filing as one text in place of sections; null where there is no filing."""
    return contexts.withColumn("question", F.concat(_asked(), F.lit("\n\n## filed_report\n"), F.col(body)))


def answered(contexts: DataFrame, answers: DataFrame, key: str = "company_number") -> DataFrame:
    """Contexts with their recorded answer (key, response), read as JSON; a code fence around it is allowed."""
    fenced = F.regexp_extract("response", r"(?s)```(?:json)?\s*(.+?)\s*```", 1)
    body = F.when(fenced != "", fenced).otherwise(F.trim("response"))
    return contexts.join(answers, key, "left").withColumn("answer", F.from_json(body, ANSWER))


def answer_issues(whole_text: Column | None = None) -> Column:
    """What is wrong with ``answer``; none means that it counts. With a whole text, quotes may stand anywhere in it."""
    errors = [F.when(F.trim(F.coalesce("answer.business_description", F.lit(""))) == "", "business_description: missing")]
    for name, values in FIELDS.items():
        entry = F.col(f"answer.{name}")
        quote = F.coalesce(entry["quote"], F.lit(""))
        source = whole_text if whole_text is not None else F.try_element_at(F.col("sections"), entry["section"])
        held = F.contains(text.quote_text(source), text.quote_text(quote))
        errors.append(
            F.when(entry.isNull(), f"{name}: missing")
            .when(~F.coalesce(entry["value"].isin(values), F.lit(False)), f"{name}: value not allowed")
            .when(entry["value"] == "unclear", None)
            .when(quote == "", f"{name}: no quote")
            .when(source.isNull(), f"{name}: unknown section")
            .when(~held, f"{name}: quote not found")
        )
    errors.append(F.when(~F.coalesce(F.col("answer.sic_agreement.value").isin(AGREEMENT), F.lit(False)), "sic_agreement: value not allowed"))
    return F.array_compact(F.array(*errors))


def outcomes(rows: DataFrame) -> DataFrame:
    """Answered contexts with issues and the outcome: no_narrative, no_usable_sections, invalid_response or profiled."""
    checked = rows.withColumn("issues", F.when(F.col("answer").isNull(), F.array(F.lit("no answer"))).otherwise(answer_issues()))
    empty = F.size(F.coalesce(F.map_keys("sections"), F.array().cast("array<string>"))) == 0
    status = F.when(F.col("sections").isNull(), "no_narrative").when(empty, "no_usable_sections").when(F.size("issues") > 0, "invalid_response").otherwise("profiled")
    return checked.withColumn("outcome", status)


def profile_rows(checked: DataFrame) -> DataFrame:
    """Profiles as (company_number, financial_year, field, value, confidence, quote, section) of answers that count."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"answer.{f}").alias("e")) for f in FIELDS])
    rows = checked.where("outcome = 'profiled'").select("company_number", "financial_year", F.explode(entries).alias("x"))
    return rows.select("company_number", "financial_year", "x.field", "x.e.value", "x.e.confidence", "x.e.quote", "x.e.section")


def partial_credit(rows: DataFrame) -> DataFrame:
    """(model, context, field, n, accuracy): a rejected answer loses only the fields that its issues name."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"expected.{f}").alias("expected"), F.col(f"answer.{f}.value").alias("found")) for f in FIELDS])
    long = rows.select("model", "context", "issues", F.explode(entries).alias("x")).where("x.expected is not null")
    named = F.exists("issues", lambda i: i.startswith(F.col("x.field")))
    hit = F.coalesce((~named & (F.col("x.found") == F.col("x.expected"))).cast("double"), F.lit(0.0))
    return long.groupBy("model", "context", "x.field").agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))
