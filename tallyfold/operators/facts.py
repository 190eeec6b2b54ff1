"""Tagged facts of filings: contexts, facts, and the figures that they agree on.

Tags are read by local name, since prefixes differ by filing agent. Reading the
markup is one Arrow pass that gives plain rows; everything after is relational.
"""

from __future__ import annotations

import datetime
import functools
import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tallyfold.functions import arithmetic, arrays

# Local names of the tags of each figure, in order.
SYNONYMS: dict[str, list[str]] = {
    "turnover": ["TurnoverRevenue", "Turnover", "Revenue"],
    "cost_of_sales": ["CostSales"],
    "gross_profit": ["GrossProfitLoss", "GrossProfit"],
    "administrative_expenses": ["AdministrativeExpenses"],
    "operating_result": ["OperatingProfitLoss", "OperatingResult"],
    "profit_before_tax": ["ProfitLossOnOrdinaryActivitiesBeforeTax"],
    "tax": ["TaxTaxCreditOnProfitOrLossOnOrdinaryActivities"],
    "profit_after_tax": ["ProfitLoss"],
    "cash": ["CashBankOnHand"],
    "current_assets": ["CurrentAssets"],
    "current_liabilities": ["Creditors"],
    "net_current_assets": ["NetCurrentAssetsLiabilities"],
    "net_assets": ["NetAssetsLiabilities", "Equity"],
    "debtors": ["Debtors"],
    "trade_debtors": ["TradeDebtorsTradeReceivables"],
    "employees": ["AverageNumberEmployeesDuringPeriod"],
    "staff_costs": ["StaffCostsEmployeeBenefitsExpense"],
}

_CONTEXT = re.compile(r"<(?:\w+:)?context\b[^>]*\bid=[\"']([^\"']+)[\"'][^>]*>(.*?)</(?:\w+:)?context>", re.I | re.S)
_DAY = re.compile(r"<(?:\w+:)?(endDate|instant)\b[^>]*>\s*(\d{4}-\d{2}-\d{2})", re.I)
_SEGMENT = re.compile(r"<(?:\w+:)?(?:segment|scenario)\b", re.I)
_FACT = re.compile(r"<(?:\w+:)?nonFraction\b([^>]*)>(.*?)</(?:\w+:)?nonFraction>", re.I | re.S)
_UNIT = re.compile(r"<(?:\w+:)?unit\b[^>]*\bid=[\"']([^\"']+)[\"'][^>]*>.*?<(?:\w+:)?measure\b[^>]*>([^<]*)<", re.I | re.S)
_ATTRIBUTE = re.compile(r"([\w:]+)\s*=\s*[\"']([^\"']*)[\"']")

ROWS = "kind string, name string, context string, day date, segmented boolean, raw string, scale int, negative boolean, unit string, position int"


#: Arrays of each document, in the order of its markup, and the same in Arrow.
TAGS = (
    "contexts array<struct<context:string, day:date, segmented:boolean>>, units array<struct<unit:string, raw:string>>, "
    "facts array<struct<name:string, context:string, scale:int, negative:boolean, unit:string, raw:string>>"
)
_ARROW = {
    "contexts": [("context", pa.string()), ("day", pa.date32()), ("segmented", pa.bool_())], "units": [("unit", pa.string()), ("raw", pa.string())],
    "facts": [("name", pa.string()), ("context", pa.string()), ("scale", pa.int32()), ("negative", pa.bool_()), ("unit", pa.string()), ("raw", pa.string())],
}


@functools.lru_cache(maxsize=4096)
def _date(text: str) -> datetime.date | None:
    try:
        return datetime.date.fromisoformat(text)
    except ValueError:
        return None


@functools.lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[str, str | None, int, bool, str | None]:
    """Name, context, scale, sign and unit; an agent's filings have the same ones over and over."""
    a = {k.rpartition(":")[2].lower(): v for k, v in _ATTRIBUTE.findall(text)}
    scale = int(a["scale"]) if re.fullmatch(r"-?\d+", a.get("scale", "")) else 0
    return a.get("name", "").rpartition(":")[2], a.get("contextref"), scale, a.get("sign") == "-", a.get("unitref")


def _contexts(text: str) -> list[tuple]:
    found = []
    for m in _CONTEXT.finditer(text):
        day = _DAY.search(m[2])
        found.append((m[1], day and _date(day[2]), bool(_SEGMENT.search(m[2])), m.start()))
    return found


def _units(text: str) -> list[tuple]:
    return [(m[1], m[2].strip().rpartition(":")[2], m.start()) for m in _UNIT.finditer(text)]


def _facts(text: str) -> list[tuple]:
    found = []
    for m in _FACT.finditer(text):
        raw = re.sub(r"<[^>]+>", "", m[2]) if "<" in m[2] else m[2]
        found.append((*_attributes(m[1]), (html.unescape(raw) if "&" in raw else raw).strip(), m.start()))
    return found


def tag_rows(documents: DataFrame, key: str, markup: str) -> DataFrame:
    """Contexts, facts and units of each document as rows; other columns of the kind are null."""
    kind = dict(documents.dtypes)[key]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(name, "context", None, context, day, segmented, None, None, None, None, at) for context, day, segmented, at in _contexts(text or "")]
                rows += [(name, "unit", unit, None, None, None, raw, None, None, None, at) for unit, raw, at in _units(text or "")]
                rows += [(name, "fact", tag, context, None, None, raw, scale, negative, unit, at) for tag, context, scale, negative, unit, raw, at in _facts(text or "")]
            columns = list(zip(*rows)) if rows else [()] * 11
            types = (pa.string(), pa.string(), pa.string(), pa.date32(), pa.bool_(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32())
            arrays = [pa.array(c, t) for c, t in zip(columns[1:], types)]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), *arrays], names=[key, *[c.split()[0] for c in ROWS.split(", ")]])

    return documents.select(key, markup).mapInArrow(read, f"{key} {kind}, {ROWS}")


def tagged(documents: DataFrame, markup: str) -> DataFrame:
    """Documents with their contexts, units and facts as arrays in place of the markup; one pass that deals nothing out."""
    own = documents.drop(markup)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(batch.num_columns - 1).to_pylist()]
            lists = []
            for find, fields in zip((_contexts, _units, _facts), _ARROW.values()):
                found, ends = [], [0]
                for text in texts:
                    found += find(text)
                    ends.append(len(found))
                columns = list(zip(*found)) or [()] * len(fields)
                items = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])
                lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*batch.schema.names[:-1], *_ARROW])

    return documents.select(*own.columns, markup).mapInArrow(read, StructType([*own.schema.fields, *StructType.fromDDL(TAGS).fields]))


def contexts(rows: DataFrame, key: str) -> DataFrame:
    """(key, context, day, segmented)."""
    return rows.where("kind = 'context'").select(key, "context", "day", "segmented")


def facts(rows: DataFrame, key: str) -> DataFrame:
    """(key, name, context, value): signed and scaled, the last tag of a name and context; head-counts keep decimals and take no negative scale."""
    found = rows.where("kind = 'fact'").withColumn("value", _value()).where("value is not null")
    return found.groupBy(key, "name", "context").agg(F.max_by("value", "position").alias("value"))


def _value(of: Callable[[str], Column] = F.col) -> Column:
    people = of("name").isin(SYNONYMS["employees"])
    number = F.regexp_replace(of("raw"), r"[,\s]", "").try_cast("double")
    number = F.when(of("raw").rlike(r"^[-–—]$"), 0.0).otherwise(number)
    scale = F.when(people & (of("scale") < 0), 0).otherwise(of("scale"))
    value = number * F.pow(F.lit(10.0), scale) * F.when(of("negative"), -1.0).otherwise(1.0)
    return F.when(people, value).otherwise(F.round(value, 0))


def _currency(raw: Column) -> Column:
    return F.nullif(F.regexp_extract(raw, "([A-Z]{3})$", 1), F.lit(""))


def currencies(rows: DataFrame, key: str) -> DataFrame:
    """(key, context, currency_code) of the last tag with a currency."""
    units = rows.where("kind = 'unit'").select(key, F.col("name").alias("unit"), _currency(F.col("raw")).alias("currency_code"))
    joined = rows.where("kind = 'fact'").select(key, "context", "unit", "position").join(units.where("currency_code is not null"), [key, "unit"])
    return joined.groupBy(key, "context").agg(F.max_by("currency_code", "position").alias("currency_code"))


def two_newest(ctx: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, period_type) of the two newest distinct dates or years of all contexts."""
    distinct = ctx.where(F.col(value).isNotNull()).select(key, value).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(value)))
    named = F.when(F.col("rank") == 1, "current").otherwise("previous")
    return distinct.withColumn("rank", rank).where("rank <= 2").select(key, value, named.alias("period_type"))


def resolved(rows: DataFrame, key: str) -> DataFrame:
    """(key, period_type, metric, value): figures on which all tags agree.

    A tag counts where it has exactly one value without dimensions at the
    period's date; tags of one figure that disagree leave it out.
    """
    ctx = contexts(rows, key)
    periods = two_newest(ctx, key, "day")
    plain = ctx.where(~F.col("segmented")).join(periods, [key, "day"])
    names = F.create_map(*[x for m, ns in SYNONYMS.items() for n in ns for x in (F.lit(n), F.lit(m))])
    found = facts(rows, key).withColumn("metric", F.try_element_at(names, F.col("name"))).where("metric is not null").join(plain, [key, "context"])
    by_name = found.groupBy(key, "period_type", "metric", "name").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo = hi")
    return by_name.groupBy(key, "period_type", "metric").agg(F.min("lo").alias("value"), F.max("lo").alias("other")).where("value = other").drop("other")


def year_views(rows: DataFrame, key: str) -> DataFrame:
    """One row per document and period with a column per figure, its year and its date.

    Figures are those of ``resolved``. Rows are read once and dealt out once, by
    document; all steps after that find a document's rows in one place.
    """
    names = F.create_map(*[x for m, ns in SYNONYMS.items() for n in ns for x in (F.lit(n), F.lit(m))])
    is_context = F.col("kind") == "context"
    tags = rows.select(key, "kind", F.when(~is_context, F.col("name")).alias("name"), "context", "day", "segmented", "position", F.when(~is_context, _value()).alias("value"))
    tags = tags.where(is_context | ((F.col("kind") == "fact") & F.col("name").isin([n for ns in SYNONYMS.values() for n in ns]) & F.col("value").isNotNull())).repartition(F.col(key))
    last = tags.groupBy(key, "kind", "name", "context").agg(F.max_by("value", "position").alias("value"), F.collect_set(F.when(is_context, F.struct("day", "segmented"))).alias("at"))
    each = last.groupBy(key).agg(
        F.flatten(F.collect_list(F.when(is_context, F.transform("at", lambda a: F.struct("context", a["day"].alias("day"), a["segmented"].alias("segmented")))))).alias("contexts"),
        F.collect_list(F.when(~is_context, F.struct("name", "context", "value"))).alias("facts"),
    )
    newest = lambda c: F.slice(F.sort_array(F.array_distinct(F.array_compact(c)), False), 1, 2)
    each = each.withColumn("days", newest(F.col("contexts.day")))
    each = each.withColumn("years", newest(F.transform("contexts", lambda c: F.year(c["day"]))))
    named = lambda i: F.when(i == 0, "current").otherwise("previous")
    periods = F.transform("days", lambda d, i: F.struct(named(i).alias("period_type"), d.alias("metric_date"), F.get("years", i).alias("financial_year"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("value")))
    at = F.filter("contexts", lambda c: ~c["segmented"] & F.coalesce(F.array_contains("days", c["day"]), F.lit(False)))
    at = F.transform(at, lambda c: F.struct(c["context"].alias("context"), named(F.array_position("days", c["day"]) - 1).alias("period_type")))
    whole = each.select(key, periods.alias("periods"), at.alias("at"), "facts")
    told = F.flatten(F.transform("facts", lambda f: F.transform(
        F.filter("at", lambda a: a["context"] == f["context"]),
        lambda a: F.struct(a["period_type"].alias("period_type"), F.lit(None).cast("date").alias("metric_date"), F.lit(None).cast("int").alias("financial_year"), f["name"].alias("name"), f["value"].alias("value")))))
    flat = whole.select(key, F.explode(F.concat("periods", told)).alias("x")).select(key, "x.*")
    dates = [F.max("metric_date").alias("metric_date"), F.max("financial_year").alias("financial_year")]
    by_name = flat.groupBy(key, "period_type", "name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), *dates).where("name is null or lo = hi").withColumn("metric", F.try_element_at(names, F.col("name")))
    by_metric = by_name.groupBy(key, "period_type", "metric").agg(F.min("lo").alias("value"), F.max("lo").alias("other"), F.max("metric_date").alias("metric_date"), F.max("financial_year").alias("financial_year")).where("metric is null or value = other")
    return by_metric.groupBy(key, "period_type").agg(*dates, *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in SYNONYMS]).where("metric_date is not null")


def period_views(tags: DataFrame) -> DataFrame:
    """``year_views`` of ``tagged`` documents, with the date of the year's end and the currency; other columns stay.

    Each row is a document of its own, so that no row leaves its task. The currency
    is that of the last tag with one, if it is the same for all contexts of the year.
    """
    own = [c for c in tags.columns if c not in _ARROW]
    newest = lambda c: F.slice(F.sort_array(F.array_distinct(F.array_compact(c)), False), 1, 2)
    each = tags.withColumns({"days": newest(F.col("contexts.day")), "years": newest(F.transform("contexts", lambda c: F.year(c["day"])))})
    units = F.transform("units", lambda u, i: F.struct(u["unit"].alias("unit"), i.alias("position"), _currency(u["raw"]).alias("code")))
    units = F.map_from_entries(F.transform(arrays.last_of(F.filter(units, lambda u: u["code"].isNotNull()), ["unit"]), lambda u: F.struct(u["unit"], u["code"])))
    told = arrays.bound(units, lambda m: F.transform("facts", lambda f, i: F.struct(f["context"].alias("context"), i.alias("position"), F.try_element_at(m, f["unit"]).alias("code"))))
    told = arrays.last_of(F.filter(told, lambda t: t["context"].isNotNull() & t["code"].isNotNull()), ["context"])
    of_year = lambda y: F.filter("contexts", lambda c: F.year(c["day"]) == y)
    codes = arrays.bound(told, lambda t: F.transform("years", lambda y: arrays.bound(of_year(y)["context"], lambda ids: arrays.same(F.filter(t, lambda x: F.array_contains(ids, x["context"]))["code"]))))
    named = [n for ns in SYNONYMS.values() for n in ns]
    values = F.transform("facts", lambda f, i: F.struct(f["name"].alias("name"), f["context"].alias("context"), i.alias("position"), F.when(f["name"].isin(named), _value(lambda c: f[c])).alias("value")))
    each = each.withColumns({"ends": F.transform("years", lambda y: F.array_max(of_year(y)["day"])), "codes": codes, "values": arrays.last_of(F.filter(values, lambda v: v["value"].isNotNull()), ["name", "context"])})
    rows = each.select("*", F.posexplode("days").alias("at", "metric_date"))
    plain = F.filter("contexts", lambda c: ~c["segmented"] & (c["day"] == F.col("metric_date")))["context"]
    mine = arrays.bound(plain, lambda ids: F.filter("values", lambda v: F.array_contains(ids, v["context"])))
    rows = rows.withColumn("found", arrays.bound(mine, lambda vs: F.transform(F.array(*map(F.lit, named)), lambda n: arrays.same(F.filter(vs, lambda v: v["name"] == n)["value"]))))
    figures = [arrays.same(F.array(*[F.get("found", F.lit(named.index(n))) for n in ns])).alias(m) for m, ns in SYNONYMS.items()]
    period = F.when(F.col("at") == 0, "current").otherwise("previous").alias("period_type")
    return rows.select(*own, period, "metric_date", F.get("years", "at").alias("financial_year"), *figures, F.get("ends", "at").alias("period_end_on"), F.get("codes", "at").alias("currency_code"))


def derived(views: DataFrame, key: str) -> DataFrame:
    """Growth of the current on the previous period, margins and ratios; one row per document."""
    of = {p: {m: F.max(F.when(F.col("period_type") == p, F.col(m))).alias(f"{p}_{m}") for m in SYNONYMS} for p in ("current", "previous")}
    wide = views.groupBy(key).agg(*of["current"].values(), *of["previous"].values())
    c, p = (lambda m: F.col(f"current_{m}")), (lambda m: F.col(f"previous_{m}"))
    growth = {f"{m}_growth_pct": arithmetic.change_over_base(c(m), p(m)) for m in ("turnover", "gross_profit", "operating_result", "profit_before_tax", "profit_after_tax", "cash", "net_assets", "employees")}
    ratios = {
        "gross_margin_pct": arithmetic.ratio(c("gross_profit"), c("turnover")),
        "operating_margin_pct": arithmetic.ratio(c("operating_result"), c("turnover")),
        "net_margin_pct": arithmetic.ratio(c("profit_after_tax"), c("turnover")),
        "current_ratio": arithmetic.ratio(c("current_assets"), F.abs(c("current_liabilities"))),
        "staff_cost_ratio": arithmetic.ratio(c("staff_costs"), c("turnover")),
        "revenue_per_employee": arithmetic.ratio(c("turnover"), c("employees")),
        "debtor_ratio": arithmetic.ratio(c("debtors"), c("turnover")),
    }
    return wide.withColumns(growth | ratios).select(key, *growth, *ratios)
