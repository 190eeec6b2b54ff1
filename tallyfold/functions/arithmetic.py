"""Null-safe arithmetic and the rounding rules that results depend on.

Spark raises on division by zero and on bad casts; every helper here gives null
instead, as the reports expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

EXACT = "decimal(38,6)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """a / b as a fraction; null where either is null or b is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """100 a / b, rounded half away from zero."""
    return F.round(ratio(numerator, denominator) * 100.0, digits)


def change_over_magnitude(now: Column, before: Column, digits: int = 1) -> Column:
    """100 (now - before) / |before|, rounded; the sign follows the direction of change."""
    return F.round((now.cast("double") - before.cast("double")) * 100.0 / F.nullif(F.abs(before.cast("double")), F.lit(0.0)), digits)


def change_over_base(now: Column, before: Column) -> Column:
    """(now / before - 1) * 100, not rounded; a negative base turns the sign."""
    return (ratio(now, before) - 1.0) * 100.0


def exact_sum(amount: Column, kind: str = "decimal(18,2)") -> Column:
    """A sum that does not depend on the order of rows, as double."""
    return F.sum(amount.cast(kind)).cast("double")


def to_pence(amount: Column, rate: Column) -> Column:
    """amount * rate * 100 as whole pence, halves to the even one; both are decimals."""
    return F.bround(amount * rate * F.lit(100), 0).cast("bigint")


def inverse_rate(rate: Column) -> Column:
    """1 / rate at 20 decimal places, from a decimal."""
    return (F.lit(1).cast("decimal(10,0)") / rate.cast("decimal(20,8)")).cast("decimal(38,20)")


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    """a / b cut to a whole number; null unless both are positive."""
    return F.when((numerator > 0) & (denominator > 0), (numerator.cast("double") / denominator.cast("double")).cast("bigint"))


def share_within_bounds(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 part / whole, rounded; null outside 0..100 or for a whole that is not positive."""
    share = F.when(whole > 0, part.cast("double") * 100.0 / whole.cast("double"))
    return F.when(share.between(0.0, 100.0), F.round(share, digits))


def percentiles(rows: DataFrame, key: str, value: str, shares: dict[str, float], digits: int = 6, buckets: int = 4096) -> DataFrame:
    """(key, n, one column per share): exact percentiles with linear interpolation, without a group in one task.

    Equal values are counted first, then the counts of ``buckets`` spans of each key's
    values are added up, and the values of the spans that hold a wanted rank are ranked.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    ends = counts.groupBy(F.col(key).alias("__k")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("total"))
    spanned = counts.join(ends, F.col(key).eqNullSafe(F.col("__k"))).select(key, "v", "c", "total", F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (buckets - 1))).otherwise(0).alias("span"))
    spans = spanned.groupBy(key, "span").agg(F.sum("c").alias("in_span"), F.first("total").alias("total"))
    spans = spans.withColumn("before", F.coalesce(F.sum("in_span").over(Window.partitionBy(key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = {n: F.lit(s) * (F.col("total") - 1) for n, s in shares.items()}  # rank from 0, between two rows
    ranks = F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in place.values()]))
    spans = spans.where(F.exists(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("in_span"))))
    held = spanned.drop("total").join(spans.withColumnRenamed(key, "__k").withColumnRenamed("span", "__s"), F.col(key).eqNullSafe(F.col("__k")) & (F.col("span") == F.col("__s")))
    upto = F.sum("c").over(Window.partitionBy(key, "span").orderBy("v"))
    held = held.withColumn("end", F.col("before") + upto).withColumn("start", F.col("end") - F.col("c"))
    at = lambda r: F.max(F.when((r >= F.col("start")) & (r < F.col("end")), F.col("v")))
    lows, highs = {f"{n}_lo": at(F.floor(p)) for n, p in place.items()}, {f"{n}_hi": at(F.ceil(p)) for n, p in place.items()}
    found = held.groupBy(key).agg(F.first("total").alias("total"), *[c.alias(n) for n, c in (lows | highs).items()])
    between = {n: F.round(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * (p - F.floor(p)), digits) for n, p in place.items()}
    return found.select(key, F.col("total").alias("n"), *[c.alias(n) for n, c in between.items()])


def bounded(limit: int, most: int = 100) -> int:
    """A result limit between 1 and ``most``."""
    return max(1, min(int(limit), most))
