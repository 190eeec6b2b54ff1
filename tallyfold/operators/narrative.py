"""Narrative text of filings: hidden blocks, sections between headings, statements about performance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import text

# Headings of the sections, in order, as case-insensitive patterns.
SECTION_HEADINGS: list[tuple[str, str]] = [
    ("strategic_report", r"\bstrategic report\b"),
    ("directors_report", r"\bdirectors?[’']?\s+report\b"),
    ("principal_activity", r"\bprincipal activit(?:y|ies)\b"),
    ("business_review", r"\bbusiness review\b"),
    ("results_and_dividends", r"\bresults?\s+and\s+dividends?\b"),
    ("going_concern", r"\bgoing concern\b"),
    ("future_developments", r"\bfuture developments?\b"),
    ("principal_risks", r"\bprincipal risks?(?: and uncertainties)?\b"),
    ("post_balance_sheet", r"\bpost balance sheet events?\b"),
    ("turnover_note", r"\bturnover analysed by\b|\bturnover and other revenue\b|\ban analysis of turnover\b"),
    ("employee_note", r"\baverage (?:monthly )?number of (?:persons|employees)\b"),
]
SECTION_CHARS, LOOK_BACK = 6000, 1500
# What an auditor writes, and headings under which a company speaks again.
AUDITOR_TEXT = (
    r"(?i)\b(we have audited|in our opinion|our audit|audit procedures|engagement team|ISAs?\s*\(UK\)|auditor'?s?\s+responsibilit|reasonable assurance|"
    r"material misstatement|we considered the opportunities|independent auditor'?s?\s+report)\b"
)
COMPANY_HEADING = r"(?i)\b(strategic report|directors?[’']?\s+report|business review|chairman'?s?\s+statement|chief executive'?s?\s+(report|statement))\b"
#: Blocks of tagged filings that no reader sees.
HIDDEN_BLOCKS = r"(?is)<((?:\w+:)?(?:header|hidden|references|resources))\b[^>]*>.*?</\1\s*>"


def without_hidden_blocks(markup: Column) -> Column:
    return F.regexp_replace(markup, HIDDEN_BLOCKS, " ")


def narrative_text(markup: Column) -> Column:
    """What a reader sees of a tagged page, on one line."""
    bare = F.regexp_replace(without_hidden_blocks(F.coalesce(markup, F.lit(""))), r"(?is)<(head|style|script)\b.*?</\1\s*>", " ")
    return text.visible_text(bare)


def joined_pages(pages: Column) -> Column:
    """An array of page texts as one text with a mark before each page that has text."""
    numbered = F.transform(pages, lambda t, k: F.when(t != "", F.concat(F.lit("[Page "), (k + 1).cast("string"), F.lit("]\n"), t)))
    return F.array_join(F.array_compact(numbered), "\n\n")


def heading_spans(documents: DataFrame, key: str, body: str, headings: list[tuple[str, str]] = SECTION_HEADINGS) -> DataFrame:
    """(key, section_key, heading, start, end): each heading and where the next one begins.

    Matching is done by Arrow batches, since Spark gives no positions of matches.
    """
    patterns = [(k, re.compile(p, re.I)) for k, p in headings]
    kind = dict(documents.dtypes)[key]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text_ = text_ or ""
                found = sorted(((m.start(), k, m[0]) for k, p in patterns for m in p.finditer(text_)), key=lambda r: r[0])
                ends = [r[0] for r in found[1:]] + [len(text_)]
                rows += [(name, k, h, s, min(e, s + SECTION_CHARS)) for (s, k, h), e in zip(found, ends)]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), *[pa.array(c, t) for c, t in zip(columns[1:], (pa.string(), pa.string(), pa.int32(), pa.int32()))]], names=[key, "section_key", "heading", "start", "end"])

    return documents.select(key, body).mapInArrow(spans, f"{key} {kind}, section_key string, heading string, start int, end int")


def _last_match(value: Column, pattern: str) -> Column:
    """Where the last match ends in the text, 0 without one; looked for from the end once, not from every place."""
    inner = f"(?i:{pattern[4:]})" if pattern.startswith("(?i)") else f"(?:{pattern})"
    return F.length(F.regexp_extract(value, rf"(?s)\A(.*{inner})", 1))


def sections(documents: DataFrame, key: str, pages: str) -> DataFrame:
    """(key, section_key, heading, page, text, is_auditor_text): the best span of each section.

    The company's own words come before an auditor's, then the longest text wins,
    then the first. ``page`` is the first page mark within the section.
    """
    bodies = documents.select(key, joined_pages(F.col(pages)).alias("body"))
    rows = heading_spans(bodies, key, "body").join(bodies, key)
    content = text.collapse(F.expr("substring(body, start + 1, end - start)"))
    preceding = F.expr(f"substring(body, greatest(0, start - {LOOK_BACK}) + 1, start - greatest(0, start - {LOOK_BACK}))")
    auditor, company = _last_match(preceding, AUDITOR_TEXT), _last_match(preceding, COMPANY_HEADING)
    rows = rows.withColumns({"text": content, "before": preceding})
    rows = rows.withColumn("is_auditor_text", F.col("text").rlike(AUDITOR_TEXT) | ((auditor > 0) & ~(company > auditor)))
    rows = rows.withColumn("page", F.nullif(F.regexp_extract("text", r"\[Page (\d+)\]", 1), F.lit("")).cast("int"))
    best = Window.partitionBy(key, "section_key").orderBy("is_auditor_text", F.desc(F.length("text")), "start")
    return rows.withColumn("r", F.row_number().over(best)).where("r = 1").select(key, "section_key", "heading", "page", "text", "is_auditor_text")


def performance_statements(documents: DataFrame, key: str, pages: str, words: tuple[str, ...] = text.PERFORMANCE_WORDS) -> DataFrame:
    """(key, page, text) of the sentences about performance."""
    page = documents.select(key, F.posexplode(pages).alias("pos", "page_text"))
    rows = page.select(key, (F.col("pos") + 1).alias("page"), F.explode(text.sentences(F.col("page_text"))).alias("text"))
    return rows.where(text.about_performance(F.col("text"), words))


def text_quality(documents: DataFrame, key: str, pages: str) -> DataFrame:
    """Pages, pages with text, characters, and characters per page with text."""
    filled = F.size(F.filter(pages, lambda t: t != ""))
    chars = F.aggregate(pages, F.lit(0), lambda s, t: s + F.length(t))
    average = F.coalesce(F.round(chars / F.nullif(filled, F.lit(0)), 2), F.lit(0.0))
    return documents.select(key, F.size(pages).alias("pages"), filled.alias("non_empty_pages"), chars.alias("total_characters"), average.alias("average_characters"))
