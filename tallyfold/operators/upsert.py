"""Keyed upserts over plain tables, and the long signal form.

There is no MERGE on Parquet; an upsert is a full join by key of the stored rows
and the first incoming row of each key, so it shuffles each side once. Null keys
are equal to each other throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _one_of_each(incoming: DataFrame, keys: list[str], order: list[Column] | None) -> DataFrame:
    """The first row of each key; without an order, rows of a key are put in order of all their columns, so that every run takes the same one."""
    if order is None:
        order = [F.to_json(F.struct(*incoming.columns)).asc()]
    return latest_by(incoming, keys, order)


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; ties are the caller's to break."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str] | None = None, order: list[Column] | None = None, only_if: Column | None = None) -> DataFrame:
    """``existing`` with the rows of ``incoming`` put in by key.

    Of several incoming rows of a key the first in ``order`` counts. ``keep``
    names columns that an existing row holds on to (a creation time, say).
    ``only_if`` is a condition on the existing row without which it stays. Null
    keys are equal to each other.
    """
    new = _one_of_each(incoming, keys, order)
    e, n = existing.alias("e"), new.alias("n")
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = e.withColumn("__old", F.lit(True)).alias("e").join(n.withColumn("__new", F.lit(True)).alias("n"), same, "full")
    takes = F.col("__new") & (F.col("__old").isNull() | (only_if if only_if is not None else F.lit(True)))
    columns = []
    for c in existing.columns:
        fresh = F.coalesce(F.col(f"e.{c}"), F.col(f"n.{c}")) if c in (keep or []) else F.col(f"n.{c}")
        columns.append(F.when(F.coalesce(takes, F.lit(False)), fresh).otherwise(F.col(f"e.{c}")).alias(c))
    return both.select(*columns)


def insert_new(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``existing`` and those incoming rows whose key it lacks; the first of each key. Null keys are equal to each other."""
    new, there = _one_of_each(incoming, keys, order).alias("n"), existing.select(*keys).alias("e")
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    return existing.unionByName(new.join(there, same, "left_anti"))


#: The value column for each type of signal.
VALUE_COLUMN = {"boolean": "signal_bool", "int": "signal_int", "bigint": "signal_int", "double": "signal_real", "float": "signal_real"}


def to_signals(wide: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row per (key, signal) with the value in the column of its type."""
    kinds = dict(wide.dtypes)
    casts = {"signal_bool": "boolean", "signal_int": "bigint", "signal_real": "double", "signal_text": "string"}
    entries = []
    for name in names:
        place = VALUE_COLUMN.get(kinds[name], "signal_text")
        values = [(F.col(name) if c == place else F.lit(None)).cast(t).alias(c) for c, t in casts.items()]
        entries.append(F.struct(F.lit(name).alias("signal_key"), F.lit(place).alias("signal_type"), *values))
    return wide.select(key, F.explode(F.array(*entries)).alias("s")).select(key, "s.*")


def upsert_signals(existing: DataFrame, incoming: DataFrame, key: str, now: Column) -> DataFrame:
    """Signals put in by (key, signal); one without a value takes the existing row out. Creation times stay."""
    values = ["signal_bool", "signal_int", "signal_real", "signal_text"]
    stamped = incoming.withColumns({"created_at": now, "updated_at": now})
    for c in set(existing.columns) - set(stamped.columns):
        stamped = stamped.withColumn(c, F.lit(None))
    merged = upsert(existing, stamped.select(existing.columns), [key, "signal_key"], keep=["created_at"])
    return merged.where(F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull())


def from_signals(signals: DataFrame, key: str, numbers: list[str] = (), flags: list[str] = (), texts: list[str] = ()) -> DataFrame:
    """One row per key with a column per named signal; one aggregation without a pivot pass."""

    def of(name: str, value: Column) -> Column:
        return F.max(F.when(F.col("signal_key") == name, value)).alias(name)

    number = F.coalesce(F.col("signal_real"), F.col("signal_int").cast("double"))
    flag = F.coalesce(F.col("signal_bool").cast("bigint"), F.col("signal_int"))
    columns = [of(n, number) for n in numbers] + [of(n, flag) for n in flags] + [of(n, F.col("signal_text")) for n in texts]
    return signals.groupBy(key).agg(*columns)
