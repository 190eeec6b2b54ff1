"""Seeded, stratified and systematic samples (the number of rows is what they are for)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Rows that are ranked together, about, and the most chunks that the keys are cut into.
CHUNK_ROWS, MAX_CHUNKS = 100_000, 4096


def _chunk(key: Column, cuts: list) -> Column:
    """How many of the ascending cuts lie below the key, by bisection; -1 for a null key."""
    table, last = F.array(*[F.lit(c) for c in cuts]), len(cuts)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(last.bit_length()))])
    further = lambda at, step: F.when((at + step <= last) & (F.get(table, at + step - 1) < key), at + step).otherwise(at)
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.aggregate(steps, F.lit(0), further) if cuts else F.lit(0))


def ranked(rows: DataFrame, strata: list[str], key: str, rank: str, size: str) -> DataFrame:
    """The rows with their rank in order of an ordered key within their stratum, from 1, and the stratum's size.

    Keys are cut into chunks of about equal numbers of rows, at quantiles of the
    keys themselves, and the chunks' sizes are added up, so that no task sorts a
    whole stratum however unevenly its keys lie. Rows with equal keys share a chunk;
    a null key comes first.
    """
    n = rows.count()
    chunks = min(MAX_CHUNKS, -(-n // CHUNK_ROWS))
    cuts: list = []
    if chunks > 1:
        shares = [k / chunks for k in range(1, chunks)]
        cuts = sorted(set(rows.agg(F.percentile_approx(key, shares, max(10_000, 10 * chunks))).first()[0] or []))
    rows = rows.withColumn("__chunk", _chunk(F.col(key), cuts))
    counts = rows.groupBy(*strata, "__chunk").agg(F.count("*").alias("__n"))
    own = Window.partitionBy(*strata)
    before = F.sum("__n").over(own.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*strata, "__chunk", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(own).alias(size))
    numbered = rows.withColumn(rank, F.row_number().over(Window.partitionBy(*strata, "__chunk").orderBy(key)))
    same = [numbered[c].eqNullSafe(offsets[c]) for c in (*strata, "__chunk")]
    joined = numbered.join(offsets, same).select(*[numbered[c] for c in numbered.columns], "__before", size)
    return joined.withColumn(rank, F.col(rank) + F.col("__before")).drop("__before", "__chunk")


def round_robin(rows: DataFrame, strata: list[str], key: str, n: int) -> DataFrame:
    """n rows, one from each stratum in turn, larger strata first within a round."""
    found = ranked(rows, strata, key, "round", "__size")
    return found.orderBy("round", F.desc("__size"), *strata, key).limit(n).drop("__size")


def every_nth(rows: DataFrame, strata: list[str], key: str, n: int) -> DataFrame:
    """The first of every n rows in order of the key, within each stratum."""
    return ranked(rows, strata, key, "__r", "__size").where(F.col("__r") % n == 1 % n).drop("__r", "__size")


def seeded_order(key: str, seed: int) -> Column:
    """A value in whose order keys look shuffled, the same for the same seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def seeded(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n distinct keys, the same for the same seed."""
    return rows.select(key).distinct().orderBy(seeded_order(key, seed), key).limit(n)


def unseen_first(rows: DataFrame, group: str, feature: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows in turn from each group, in a seeded order that takes each feature once before any again.

    Only a group's first n rows in that order can be taken, so each feature keeps no
    more than n before the groups are put in order.
    """
    shuffled = seeded_order(key, seed)
    repeat = F.row_number().over(Window.partitionBy(group, feature).orderBy(shuffled, key))
    found = rows.withColumn("__repeat", repeat).where(F.col("__repeat") <= n)
    turn = F.row_number().over(Window.partitionBy(group).orderBy("__repeat", shuffled, key))
    return found.withColumn("round", turn).where(F.col("round") <= n).orderBy("round", group).limit(n).drop("__repeat")
