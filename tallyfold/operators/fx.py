"""Currency conversion: rates as of a date with a tolerance, and exact pence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import arithmetic
from tallyfold.operators.upsert import insert_new

#: Fixed value: amounts of a period that are converted.
AMOUNTS = ["turnover", "gross_profit", "operating_result", "profit_after_tax", "cash", "net_assets"]
TOLERANCE_DAYS = 10


def asof_join(
    facts: DataFrame, rates: DataFrame, on: list[str], at: str, rate_at: str, within: Column, values: list[str], tie: list[Column], bucket: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Facts with the newest rate at or before their time and no older than ``within`` (in the times' own units).

    Both sides are put in one order and the last rate seen is carried forward, so
    there are no pairs of rows and rates. ``bucket`` maps a time to a span of time
    (later times never to an earlier span): each key and span is then ordered on its
    own, however many rows a key has, and takes over the last rate of the spans before
    from one row per key and span.
    """
    span = bucket or (lambda t: F.lit(0))
    payload = F.struct(F.col(rate_at).alias("__at"), *[F.col(v) for v in values])
    kind = rates.select(payload.alias("x")).schema["x"].dataType
    left = facts.withColumns({"__rate": F.lit(None).cast(kind), "__when": F.col(at), "__side": F.lit(1), "__tie": F.lit(0)})
    best = rates.where(F.col(rate_at).isNotNull()).withColumn("__tie", F.row_number().over(Window.partitionBy(*on, rate_at).orderBy(*tie))).where("__tie = 1")
    right = best.select(*on, payload.alias("__rate"), F.col(rate_at).alias("__when"), F.lit(0).alias("__side"), "__tie")
    both = left.unionByName(right, allowMissingColumns=True).withColumn("__span", span(F.col("__when")))
    order = Window.partitionBy(*on, "__span").orderBy(F.col("__when").asc_nulls_first(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__seen", F.last("__rate", ignorenulls=True).over(order)).where("__side = 1")
    if bucket:
        spans = both.groupBy(*on, "__span").agg(F.max_by("__rate", F.when(F.col("__side") == 0, F.col("__when"))).alias("__last"))
        earlier = Window.partitionBy(*on).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
        before = spans.select(*on, "__span", F.last("__last", ignorenulls=True).over(earlier).alias("__before")).where("__before is not null")
        same = [seen[k].eqNullSafe(before[k]) for k in (*on, "__span")]
        seen = seen.join(before, same, "left").select(*[seen[c] for c in seen.columns], "__before").withColumn("__seen", F.coalesce("__seen", "__before")).drop("__before")
    fits = F.col("__seen.__at") >= F.col(at) - within
    found = {v: F.when(fits, F.col(f"__seen.{v}")) for v in values}
    found[rate_at] = F.when(fits, F.col("__seen.__at"))
    return seen.withColumns(found).drop("__rate", "__when", "__side", "__tie", "__seen", "__span")


def import_rates(existing: DataFrame, rates: DataFrame, currency: str, series: str, source_url: str) -> DataFrame:
    """Rates (rate_date, rate, payload) put in once per series, date and payload hash, as sterling per unit."""
    rows = rates.select(
        F.lit(currency).alias("source_currency"),
        F.lit("GBP").alias("target_currency"),
        "rate_date",
        F.lit(series).alias("series"),
        F.sha2(F.col("payload"), 256).alias("payload_hash"),
        arithmetic.inverse_rate(F.col("rate")).alias("rate"),
        F.lit(source_url).alias("source_url"),
    )
    return insert_new(existing, rows, ["source_currency", "target_currency", "rate_date", "series", "payload_hash"])


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def convert(periods: DataFrame, rates: DataFrame, tolerance_days: int = TOLERANCE_DAYS) -> DataFrame:
    """(summary_id, status, reason, rate_date, rate, <amount>_pence) of each period with a valid currency.

    Sterling periods need no rate and are not joined; the others are ordered with the
    rates by currency and month.
    """
    valid = periods.where("currency_validation_status = 'valid'").withColumn("source_currency", F.col("currency_code"))
    own = F.coalesce(F.col("source_currency") == "GBP", F.lit(False))
    home = rates.where("target_currency = 'GBP'")
    joined = asof_join(valid.where(~own), home, ["source_currency"], "period_end_on", "rate_date", F.expr(f"interval {tolerance_days} days"), ["rate"], [F.asc("payload_hash")], _month)
    at_par = valid.where(own).withColumns({"rate": F.lit(1).cast("decimal(38,20)"), "rate_date": F.lit(None).cast("date")})
    both = joined.withColumn("rate", F.col("rate").cast("decimal(38,20)")).unionByName(at_par)
    rate = F.col("rate")
    reason = F.when(rate.isNotNull(), None).when(F.col("period_end_on").isNull(), "missing_period_end").otherwise("missing_rate")
    # 18 digits before and 12 after the point leave room for the product
    amount = lambda c: F.col(c).cast("decimal(18,0)")
    narrow = rate.cast("decimal(18,12)")
    return both.select(
        F.col("id").alias("summary_id"),
        F.when(rate.isNotNull(), "converted").otherwise("pending").alias("status"),
        reason.alias("reason"),
        "rate_date",
        rate.alias("rate"),
        *[arithmetic.to_pence(amount(c), narrow).alias(f"{c}_pence") for c in AMOUNTS],
    )


def rate_months(rates: DataFrame, tolerance_days: int = TOLERANCE_DAYS) -> DataFrame:
    """(source_currency, month, rates_hash): a hash of all rates that a period ending in the month may take, whatever their order."""
    home = rates.where("target_currency = 'GBP' and rate_date is not null")
    reach = home.withColumn("month", F.explode(F.sequence(_month(F.col("rate_date")), _month(F.date_add("rate_date", tolerance_days)))))
    return reach.groupBy("source_currency", "month").agg(F.expr("bit_xor(xxhash64(rate_date, rate, payload_hash))").alias("rates_hash"))


def convert_changed(periods: DataFrame, rates: DataFrame, stored: DataFrame | None = None, tolerance_days: int = TOLERANCE_DAYS) -> DataFrame:
    """The columns of ``convert`` with ``basis`` and ``recomputed``: stored conversions where nothing that they rest on has changed, new ones elsewhere.

    A conversion's basis is a hash of the period's currency, end and amounts, and of
    the rates of its month; ``stored`` is an earlier result of this function. Only
    periods without a stored conversion of the same basis are looked up again, and
    only these rows have to be written. A period has one row, by its id.
    """
    valid = periods.where("currency_validation_status = 'valid'").withColumn("month", _month(F.col("period_end_on")))
    months = rate_months(rates, tolerance_days).alias("m")
    same = (F.col("p.currency_code") == F.col("m.source_currency")) & (F.col("p.month") == F.col("m.month"))
    based = valid.alias("p").join(months, same, "left").select("p.*", F.xxhash64("p.currency_code", "p.period_end_on", *[f"p.{c}" for c in AMOUNTS], F.when(F.col("p.currency_code") != "GBP", F.col("m.rates_hash"))).alias("basis"))
    if stored is None:
        return convert(based, rates, tolerance_days).join(based.select(F.col("id").alias("summary_id"), "basis"), "summary_id").withColumn("recomputed", F.lit(True))
    old = stored.drop("recomputed")
    kept = old.join(based.select(F.col("id").alias("summary_id"), "basis"), ["summary_id", "basis"], "left_semi")
    changed = based.join(old.select(F.col("summary_id").alias("id"), "basis"), ["id", "basis"], "left_anti")
    new = convert(changed, rates, tolerance_days).join(changed.select(F.col("id").alias("summary_id"), "basis"), "summary_id")
    return kept.withColumn("recomputed", F.lit(False)).unionByName(new.withColumn("recomputed", F.lit(True)))
