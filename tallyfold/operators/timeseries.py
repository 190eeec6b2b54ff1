"""Histories: latest rows, growth, coverage, filing history and comparative overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import arithmetic
from tallyfold.operators.upsert import latest_by

#: Figures that two filings of one period are compared on.
OVERLAP_METRICS = ["turnover", "gross_profit", "operating_result", "profit_after_tax", "cash", "net_assets", "employees"]


def latest_period(periods: DataFrame, key: str = "company_number") -> DataFrame:
    """Each company's newest row by year, then id; a null year is oldest."""
    return latest_by(periods, [key], [F.desc_nulls_last("financial_year"), F.desc("id")])


def upsert_latest(periods: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key by year, then id."""
    return latest_by(periods, keys, [F.desc_nulls_last("financial_year"), F.desc("id")])


def history_coverage(rows: DataFrame, key: str, year: str) -> DataFrame:
    """How many keys have how many distinct years."""
    years = rows.where(F.col(year).isNotNull()).groupBy(key).agg(F.count_distinct(year).alias("years_of_history"))
    return years.groupBy("years_of_history").agg(F.count("*").alias("companies"))


def with_history(rows: DataFrame, key: str, year: str, at_least: int) -> DataFrame:
    """Rows of keys with enough distinct years, with the number of these."""
    depth = rows.where(F.col(year).isNotNull()).groupBy(key).agg(F.count_distinct(year).alias("years_of_history"))
    return rows.join(depth.where(F.col("years_of_history") >= at_least), key)


def growth(rows: DataFrame, key: str, year: str, figures: list[str], tie: Column | None = None) -> DataFrame:
    """Rows with <figure>_change_pct: change on the row before, of its magnitude. All figures share one window."""
    w = Window.partitionBy(key).orderBy(F.col(year), *([tie] if tie is not None else []))
    return rows.withColumns({f"{c}_change_pct": arithmetic.change_over_magnitude(F.col(c), F.lag(c).over(w)) for c in figures})


def accounts_history(filings: DataFrame, as_of: Column, years: int = 3, most: int = 4, key: str = "company_number", kinds: tuple[str, ...] = ("AA", "AAMD"), position: str = "position") -> DataFrame:
    """The newest filing of each period end within ``years`` of 365 days, newest periods first, ``most`` per company.

    Columns: type, date, made_up_date, action_date and a position that breaks ties.
    """
    rows = filings.where(F.col("type").isin(list(kinds))).withColumn("period_end", F.coalesce("made_up_date", "action_date")).where("period_end is not null")
    one = latest_by(rows, [key, "period_end"], [F.desc_nulls_last("date"), F.asc(position)])
    recent = one.where(F.col("period_end") >= F.date_sub(as_of, 365 * years))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("period_end")))
    return recent.withColumn("rank", rank).where(F.col("rank") <= most)


def overlap(periods: DataFrame, metrics: list[str] = OVERLAP_METRICS) -> DataFrame:
    """(id, status, payload) of each previous-role row whose period another document filed as its current one.

    Of several counterparts the one with the smallest id counts. The payload
    lists the figures that differ, as JSON.
    """
    role = lambda r: periods.where((F.col("period_type") == r) & F.col("period_end_on").isNotNull())
    p, c = role("previous").alias("p"), role("current").alias("c")
    same = (F.col("p.company_number") == F.col("c.company_number")) & (F.col("p.period_end_on") == F.col("c.period_end_on")) & (F.col("p.document_id") != F.col("c.document_id"))
    pairs = p.join(c, same).groupBy(F.col("p.id").alias("id"), *[F.col(f"p.{m}").alias(m) for m in metrics]).agg(F.min_by(F.struct(*[F.col(f"c.{m}").alias(m) for m in metrics]), F.col("c.id")).alias("other"))
    differs = {m: F.coalesce(F.col(m) != F.col(f"other.{m}"), F.lit(False)) for m in metrics}
    any_ = F.lit(False)
    for d in differs.values():
        any_ = any_ | d
    reading = {m: F.when(d, F.struct(F.col(m).alias("previous_period_reading"), F.col(f"other.{m}").alias("adjacent_filing_reading"))) for m, d in differs.items()}
    payload = F.when(any_, F.to_json(F.struct(*[r.alias(m) for m, r in reading.items()])))
    return pairs.select("id", F.when(any_, "mismatch").otherwise("match").alias("status"), payload.alias("payload"))


def with_overlap(periods: DataFrame) -> DataFrame:
    """Periods with the outcome written on the previous-role row of each pair."""
    found = overlap(periods).withColumnRenamed("status", "__status").withColumnRenamed("payload", "__payload")
    joined = periods.join(found, "id", "left")
    checked = F.col("__status").isNotNull()
    return joined.withColumns(
        {
            "comparative_overlap_status": F.when(checked, F.col("__status")).otherwise(F.col("comparative_overlap_status")),
            "comparative_overlap_payload": F.when(checked, F.col("__payload")).otherwise(F.col("comparative_overlap_payload")),
        }
    ).select(periods.columns)
