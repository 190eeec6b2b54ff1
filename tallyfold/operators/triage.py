"""Trading status of companies from filed figures, names and industry codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import arithmetic
from tallyfold.operators.timeseries import latest_period

# Names of group vehicles, their industry codes, residual codes, and two thresholds.
HOLDING_NAME = r"(?i)\b(HOLDINGS?|HOLDCO|TOPCO|BIDCO|MIDCO|NEWCO)\b"
HOLDING_CODES = ["64209", "70100"]
RESIDUAL_CODES = ["43999", "46909", "47990", "64999", "70229", "74909", "81299", "82990", "96090"]
REVIEW_REVENUE_PER_EMPLOYEE = 2_000_000
DUPLICATE_TURNOVER_FLOOR = 10_000

SIGNALS = [
    "trading_status", "trading_status_reason", "name_suggests_holding", "sic_is_catch_all", "revenue_per_employee", "revenue_per_employee_flagged",
    "turnover_without_employees", "gross_margin_pct", "duplicate_of",
]


def holding_name(name: Column) -> Column:
    return F.coalesce(name.rlike(HOLDING_NAME), F.lit(False))


def trading_status(name: Column, status: Column, code: Column, turnover: Column, employees: Column, duplicate: Column) -> Column:
    """(status, reason), the most conclusive rule first. A head-count that is not filed is not zero."""

    def found(status_: str, reason: Column | str) -> Column:
        return F.struct(F.lit(status_).alias("status"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))

    nobody = F.coalesce(employees == 0, F.lit(False))
    sells = F.coalesce(turnover > 0, F.lit(False))
    holding = holding_name(name)
    return (
        F.when((status != "") & (status != "active"), found("non_trading", F.concat(F.lit("company_status is "), status)))
        .when(code.isin(HOLDING_CODES), found("holding", F.concat(F.lit("SIC "), code, F.lit(" is a holding or head-office code"))))
        .when(holding & nobody, found("holding", "holding-style name with zero reported employees"))
        .when(duplicate & nobody, found("holding", "duplicates another company's turnover and employs nobody"))
        .when(turnover.isNull() & employees.isNull(), found("unknown", "no current-period financial data"))
        .when(~sells & nobody, found("dormant", "no turnover and no employees"))
        .when(sells & nobody, found("unknown", "turnover reported against zero employees; needs narrative confirmation"))
        .when(holding, found("unknown", "holding-style name but active trading indicators"))
        .otherwise(found("trading", "active with trading indicators"))
    )


def duplicates(rows: DataFrame, entity: str, amount: str, period: str, name: str | None = None, floor: float = DUPLICATE_TURNOVER_FLOOR) -> DataFrame:
    """(entity, duplicate_of): entities that share an amount and a period with another one.

    The one referred to is the first whose name is not a group vehicle's, else
    the first. Aggregates per amount and period, so copies need no pairs; an
    entity in several groups keeps the one with the largest amount, then period.
    """
    operating = ~holding_name(F.col(name)) if name else F.lit(True)
    rows = rows.where((F.col(amount) > floor) & F.col(period).isNotNull())
    groups = rows.groupBy(amount, period).agg(
        F.count_distinct(entity).alias("n"), F.coalesce(F.min(F.when(operating, F.col(entity))), F.min(entity)).alias("duplicate_of")
    )
    pairs = rows.join(groups.where("n > 1"), [amount, period]).where(F.col(entity) != F.col("duplicate_of"))
    return pairs.groupBy(entity).agg(F.max_by("duplicate_of", F.struct(amount, period)).alias("duplicate_of"))


def triage(companies: DataFrame, periods: DataFrame) -> DataFrame:
    """One row per company with its nine signals."""
    current = periods.where("period_type = 'current'")
    keyed = current.withColumn("period_key", F.coalesce(F.col("period_end_on").cast("string"), F.concat(F.lit("FY"), F.col("financial_year"))))
    named = keyed.join(companies.select("company_number", "company_name"), "company_number")
    copies = duplicates(named, "company_number", "turnover", "period_key", "company_name")
    rows = companies.join(latest_period(current).select("company_number", "turnover", "employees", "gross_profit"), "company_number", "left").join(copies, "company_number", "left")
    turnover, employees = F.col("turnover"), F.col("employees")
    per_head = arithmetic.whole_ratio(turnover, employees)
    status = trading_status(F.col("company_name"), F.col("company_status"), F.col("sic_code_primary"), turnover, employees, F.col("duplicate_of").isNotNull())
    return rows.select(
        "company_number",
        status["status"].alias("trading_status"),
        status["reason"].alias("trading_status_reason"),
        holding_name(F.col("company_name")).alias("name_suggests_holding"),
        F.coalesce(F.col("sic_code_primary").isin(RESIDUAL_CODES), F.lit(False)).alias("sic_is_catch_all"),
        per_head.alias("revenue_per_employee"),
        F.coalesce(per_head >= REVIEW_REVENUE_PER_EMPLOYEE, F.lit(False)).alias("revenue_per_employee_flagged"),
        F.coalesce((turnover > 0) & (employees == 0), F.lit(False)).alias("turnover_without_employees"),
        arithmetic.share_within_bounds(F.col("gross_profit"), turnover).alias("gross_margin_pct"),
        "duplicate_of",
    )


def status_counts(triaged: DataFrame) -> DataFrame:
    """Companies per trading status, with the flags that a reviewer looks at."""
    flags = ["name_suggests_holding", "sic_is_catch_all", "revenue_per_employee_flagged", "turnover_without_employees"]
    return triaged.groupBy("trading_status").agg(F.count("*").alias("n"), *[F.count_if(f).alias(f) for f in flags])


def samples(triaged: DataFrame, n: int = 5) -> DataFrame:
    """The first n companies of each status."""
    rank = F.row_number().over(Window.partitionBy("trading_status").orderBy("company_number"))
    return triaged.withColumn("rank", rank).where(F.col("rank") <= n)
