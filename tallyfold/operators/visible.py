"""Figures read off the visible rows of a filing, and what replaces tagged ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import text

# Row labels of the figures that visible rows give, the window behind a label, and marks of cells.
ROW_LABELS = {"turnover": "Turnover", "gross_profit": "Gross profit", "operating_result": "Operating profit", "uk_revenue": "United Kingdom", "rest_of_europe_revenue": "Rest of Europe"}
OVERRIDES = ["turnover", "gross_profit", "operating_result"]
WINDOW = 1800
NEXT_LABEL = r'<div class="c[lj][a-z]'
VALUE_CELL = r'(?s)<div class="cr[nb] fn1"[^>]*>(.*?)</div>'
# Sentences of commentary with a figure; the mark before amounts is as filings of one agent garble it.
COMMENTARY = {
    "second_half_revenue_growth": r"(?i)resulted in a ([0-9]+%) revenue increase in the second half of the year",
    "backlog_million_gbp": r"(?i)backlog of Ł([0-9.]+) million",
    "management_stated_revenue_gbp": r"(?i)total revenue for the year reached Ł([0-9,]+)",
    "headcount_june_2024": r"(?i)headcount increased from ([0-9]+) in June 2024 to [0-9]+ in February 2025",
    "headcount_february_2025": r"(?i)headcount increased from [0-9]+ in June 2024 to ([0-9]+) in February 2025",
}


def row_values(markup: Column, label: str) -> Column:
    """(current, previous) of the row behind a label, or null.

    Two cells are the two years; six, nine and so on are blocks of three whose
    last cell is the total. Cells that hold a bare year are headings.
    """
    after = F.regexp_extract(markup, rf"(?is)>\Q{label}\E</div>(.{{0,{WINDOW}}})", 1)
    window = F.try_element_at(F.split(after, NEXT_LABEL, 2), F.lit(1))
    cells = F.transform(F.regexp_extract_all(window, F.lit(VALUE_CELL), 1), text.strip_tags)
    numbers = F.transform(F.filter(cells, lambda c: ~c.rlike(r"^(?:19|20|21)\d{2}$")), text.display_number)
    n = F.size(numbers)
    pair = lambda a, b: F.struct(F.try_element_at(numbers, F.lit(a)).alias("current"), F.try_element_at(numbers, F.lit(b)).alias("previous"))
    return F.when(n == 2, pair(1, 2)).when((n >= 6) & (n % 3 == 0), pair(3, 6))


def visible_rows(documents: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, period_type, <figure>...) of the labels in ``ROW_LABELS``."""
    rows = documents.select(key, *[row_values(F.col(markup), label).alias(m) for m, label in ROW_LABELS.items()])
    periods = [rows.select(key, F.lit(p).alias("period_type"), *[F.col(f"{m}.{p}").cast("double").alias(m) for m in ROW_LABELS]) for p in ("current", "previous")]
    return periods[0].unionByName(periods[1])


def with_visible(views: DataFrame, visible: DataFrame, key: str) -> DataFrame:
    """Period views in which a visible figure stands before the tagged one."""
    names = {m: f"__{m}" for m in ROW_LABELS}
    joined = views.join(visible.withColumnsRenamed(names), [key, "period_type"], "left")
    new = {m: F.coalesce(F.col(f"__{m}"), F.col(m)) if m in OVERRIDES else F.col(f"__{m}") for m in ROW_LABELS}
    return joined.withColumns(new).drop(*names.values())


def commentary(documents: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, name, value) of the sentences that a document has."""
    found = F.array(*[F.struct(F.lit(n).alias("name"), F.nullif(F.replace(F.regexp_extract(markup, p, 1), F.lit(","), F.lit("")), F.lit("")).alias("value")) for n, p in COMMENTARY.items()])
    return documents.select(key, F.explode(found).alias("f")).select(key, "f.*").where("value is not null")
