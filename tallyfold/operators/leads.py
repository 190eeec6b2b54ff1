"""Leads from a bulk register: hard filters, scores, queues and pipeline counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import arithmetic, text
from tallyfold.operators.upsert import insert_new

# Industry codes by tier, in the register's five digits.
TIER_1 = [
    "47910", "47990", "64110", "64191", "64192", "64999", "65110", "65120", "65201", "65202", "66110", "66120", "66190", "66210", "66220",
    "69101", "69102", "85100", "85200", "85310", "85320", "86210", "86230", "86900",
]
TIER_2 = [
    "41100", "41201", "41202", "43210", "43220", "43290", "43310", "43320", "43341", "43342", "43390", "45111", "45112", "45190", "55100",
    "55201", "55202", "55209", "56101", "56102", "56103", "56210", "56290", "68100", "68201", "68209", "68310", "68320", "96010", "96020",
    "96030", "96040", "96090",
]
TIER_3 = [
    "47411", "47710", "47730", "47740", "47750", "49100", "49311", "49319", "49320", "62011", "62012", "62020", "62090", "69201", "69202",
    "69203", "70210", "70221", "70229", "71111", "71112", "71121", "71122", "72110", "72190", "72200", "73110", "73200", "74100", "74201",
    "74202", "74209", "82110", "82190", "82990", "85600", "90010", "90020", "90030", "90040", "93110", "93120", "93130", "93190", "93210",
    "93290",
]
# What is left out, and what counts.
EXCLUDED_STATUS = ["Active - Proposal to Strike off", "Administration", "Converted / Closed", "Dissolved", "Liquidation", "Receivership", "Voluntary Arrangement"]
EXCLUDED_ACCOUNTS = ["DORMANT", "INITIAL", "NO ACCOUNTS FILED"]
FULL_ACCOUNTS = ["AUDITED ABRIDGED", "FULL", "GROUP", "TOTAL EXEMPTION FULL", "UNAUDITED ABRIDGED"]
HOME_COUNTRIES = ["", "ENGLAND", "UNITED KINGDOM", "WALES"]
WANTED_CATEGORY = "Private Limited Company"
SHELL_NAME = r"(?i)\b(holding|holdings|holdco|trustee|nominee|property fund|pension|spv)\b"


@dataclass(frozen=True)
class Register:
    """The columns of a register that the rules read; all hold text."""

    name: str = "CompanyName"
    status: str = "CompanyStatus"
    category: str = "CompanyCategory"
    accounts: str = "Accounts.AccountCategory"
    made_up: str = "Accounts.LastMadeUpDate"
    incorporated: str = "IncorporationDate"
    industries: tuple[str, ...] = ("SICCode.SicText_1", "SICCode.SicText_2", "SICCode.SicText_3", "SICCode.SicText_4")
    town: str = "RegAddress.PostTown"
    country: str = "RegAddress.Country"
    charges: str = "Mortgages.NumMortOutstanding"

    def of(self, name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))


def first_failure(as_of: Column, r: Register = Register()) -> Column:
    """The first hard filter that a row fails, or ``ok``."""
    accounts, industry = F.upper(r.of(r.accounts)), text.industry_code(r.of(r.industries[0]))
    age = text.years_between(text.parse_date(r.of(r.incorporated)), as_of)
    stale = text.years_between(text.parse_date(r.of(r.made_up)), as_of)
    return (
        F.when(r.of(r.status).isin(EXCLUDED_STATUS) | (r.of(r.status) == ""), F.concat(F.lit("status:"), r.of(r.status)))
        .when(r.of(r.category) != WANTED_CATEGORY, F.concat(F.lit("category:"), r.of(r.category)))
        .when(accounts.isin(EXCLUDED_ACCOUNTS), F.concat(F.lit("accounts:"), accounts))
        .when(industry.isNull() | ~industry.isin(TIER_1 + TIER_2 + TIER_3), "sic:not_target")
        .when(age.isNull() | (age < 3.0), "too_young")
        .when(stale.isNull() | (stale > 3.0), "stale_accounts")
        .otherwise("ok")
    )


def score_parts(as_of: Column, r: Register = Register()) -> Column:
    """The points that a row earns, as (points, reason), in the rules' order."""

    def part(points: int, condition: Column, reason: Column | str) -> Column:
        return F.when(condition, F.struct(F.lit(points).alias("points"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason")))

    codes = F.array_compact(F.array(*[text.industry_code(r.of(c)) for c in r.industries]))
    first = text.industry_code(r.of(r.industries[0]))
    born, made_up = text.parse_date(r.of(r.incorporated)), text.parse_date(r.of(r.made_up))
    age = text.years_between(born, as_of)
    months = F.datediff(as_of, made_up).cast("double") / F.lit(30.0)
    accounts = F.upper(r.of(r.accounts))
    # as digits are dropped from a decimal, halves go to the even one
    years = F.format_string("%s", F.bround(age.cast("decimal(20,12)"), 1).cast("decimal(20,1)"))
    charges = F.when(r.of(r.charges) == "", 0).otherwise(r.of(r.charges).try_cast("int"))
    return F.array_compact(
        F.array(
            F.coalesce(*[part(p, first.isin(tier), f"tier-{n} SIC") for n, (p, tier) in enumerate([(30, TIER_1), (20, TIER_2), (10, TIER_3)], 1)]),
            part(5, F.size(codes) >= 2, "multi-SIC"),
            F.coalesce(part(15, age.between(3.0, 10.0), F.concat(F.lit("sweet-spot age "), years, F.lit("yr"))), part(8, age > 10.0, F.concat(F.lit("established "), years, F.lit("yr")))),
            F.coalesce(part(10, months <= 18.0, "accounts <18mo"), part(5, months <= 36.0, "accounts <36mo")),
            part(10, accounts.isin(FULL_ACCOUNTS), F.concat(F.lit("acct:"), F.lower(accounts))),
            part(5, F.upper(r.of(r.country)).isin(HOME_COUNTRIES) & (r.of(r.town) != ""), "GB address"),
            part(5, ~r.of(r.name).rlike(SHELL_NAME), "non-shell name"),
            part(5, charges == 0, "no charges"),
        )
    )


def score_leads(rows: DataFrame, as_of: Column, r: Register = Register()) -> DataFrame:
    """All rows with reason, lead_score and score_reasons (an array)."""
    scored = rows.withColumns({"reason": first_failure(as_of, r), "__parts": score_parts(as_of, r)})
    total = F.aggregate("__parts", F.lit(0), lambda s, p: s + p["points"])
    return scored.withColumns({"lead_score": total, "score_reasons": F.transform("__parts", lambda p: p["reason"])}).drop("__parts")


def qualified(scored: DataFrame, min_score: int = 30) -> DataFrame:
    """Rows that pass every filter with enough points."""
    return scored.where((F.col("reason") == "ok") & (F.col("lead_score") >= min_score))


def drop_reasons(scored: DataFrame) -> DataFrame:
    """How many rows each filter took out, and how many passed."""
    return scored.groupBy("reason").agg(F.count("*").alias("n"))


def load_leads(existing: DataFrame, rows: DataFrame, min_score: int, position: Column) -> DataFrame:
    """Leads put in if their number is new and their score high enough; the first of a number counts."""
    return insert_new(existing, rows.where(F.col("lead_score") >= min_score), ["company_number"], [position])


def matching(leads: DataFrame, query: str | None = None, min_score: int | None = None, statuses: list[str] | None = None, categories: list[str] | None = None, name: str = "company_name", number: str = "company_number", score: str = "lead_score", status: str = "status", category: str = "account_category") -> DataFrame:
    """Leads under all conditions that are given; the query is a part of the name or number, without regard to case."""
    conditions = []
    if query:
        q = F.lit(query.lower())
        conditions.append(F.contains(F.lower(F.col(name)), q) | F.contains(F.lower(F.col(number).cast("string")), q))
    if min_score is not None:
        conditions.append(F.col(score) >= min_score)
    if statuses:
        conditions.append(F.col(status).isin(statuses))
    if categories:
        conditions.append(F.col(category).isin(categories))
    return leads.where(reduce(lambda a, b: a & b, conditions)) if conditions else leads


def top(leads: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first rows in an order that the caller makes total."""
    return leads.orderBy(*order).limit(arithmetic.bounded(limit))


def pending(leads: DataFrame, categories: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The queue: pending leads, best score first."""
    rows = matching(leads, statuses=["pending"], categories=categories).orderBy(F.desc("lead_score"), "company_number")
    return rows.limit(limit) if limit else rows


def mark(leads: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Leads with the status and tracking columns of their newest outcome (column ``seq``)."""
    tracked = ["status", "xhtml_available", "filing_date", "filing_type", "error_message", "processed_at"]
    last = outcomes.groupBy("company_number").agg(F.max_by(F.struct(*tracked), "seq").alias("o"))
    joined = leads.join(last, "company_number", "left")
    return joined.withColumns({c: F.when(F.col("o").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(c)) for c in tracked}).select(leads.columns)


def pipeline_summary(counts: dict[str, DataFrame]) -> DataFrame:
    """(measure, n) of each table: one count per entry."""
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, rows)


def measures(tables: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(measure, n): rows of each table that meet the named conditions, counted in one pass a table."""
    rows = []
    for df, conditions in tables:
        counts = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
        rows.append(counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("n")) for n in conditions])).alias("m")).select("m.*"))
    return reduce(DataFrame.unionByName, rows)


def counts_by(df: DataFrame, key: str) -> DataFrame:
    """(key, n) without the null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
