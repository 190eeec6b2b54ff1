"""Monitoring: counts per window, rates, snapshots, streaks and alerts, in batch and as streams.

The functions on frames work alike on static and streaming input; the last ones
set up streaming queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F


def tumbling_counts(events: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """(window, event_type, n); with a watermark late rows are dropped and windows close."""
    if watermark:
        events = events.withWatermark("ts", watermark)
    return events.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))


def calls_in_window(events: DataFrame, key: str, at: str, micros: int) -> DataFrame:
    """How many calls of the key lie in the window that ends with each call.

    A key's calls are dealt out by spans as long as the window; each span also gets
    a copy of the calls of the span before, moved on by the window's length, so no task
    sees more than two spans. Running counts give the calls of the own span so far, and
    the copies that are not yet behind: time is linear however dense the calls are.
    Calls without a time see each other only.
    """
    timed = events.withColumn("__at", F.unix_micros(F.col(at).cast("timestamp"))).withColumn("__span", F.floor(F.col("__at") / F.lit(micros)))
    own = timed.withColumn("__side", F.lit(0))
    copies = timed.where("__span is not null").select(key, (F.col("__at") + micros).alias("__at"), (F.col("__span") + 1).alias("__span"), F.lit(1).alias("__side"))
    part = Window.partitionBy(key, "__span")
    so_far = part.orderBy("__at", "__side").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # calls at one time count each other, and the copies at it
    both = own.unionByName(copies, allowMissingColumns=True)
    mine, behind, copied = F.count_if(F.col("__side") == 0).over(so_far), F.count_if(F.col("__side") == 1).over(so_far), F.count_if(F.col("__side") == 1).over(part)
    return both.withColumn("in_window", mine + copied - behind).where("__side = 0").drop("__at", "__span", "__side")


def hourly_snapshots(events: DataFrame) -> DataFrame:
    """One row per hour: events, errors, and when the last one was."""
    hours = events.groupBy(F.date_trunc("hour", "ts").alias("hour"))
    return hours.agg(F.count("*").alias("done"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("ts").alias("last_at"))


def error_streaks(hours: DataFrame) -> DataFrame:
    """Snapshots with the change in errors and the length of the run of hours that are no better.

    The window is over snapshots, one row per hour, not over events.
    """
    w = Window.orderBy("hour")
    before = F.lag("errors").over(w)
    rows = hours.withColumns({"error_change": F.col("errors") - before, "no_better": F.col("errors") >= F.coalesce(before, F.lit(0))})
    rows = rows.withColumn("island", F.count_if(~F.col("no_better")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.count_if(F.col("no_better")).over(Window.partitionBy("island").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("streak", F.when(F.col("no_better"), run).otherwise(0))


def alerts(snapshots: DataFrame, order: str, stall_minutes: int, streak: int) -> DataFrame:
    """(order, alert) from snapshots: taken_at, last_processed_at, pending, with_financials, errors.

    Stalls are told once per last processed time, streaks when they reach the
    length (then counting anew), more errors each time, completion once.
    """
    w = Window.orderBy(order)
    before = lambda c: F.lag(c).over(w)
    rows = snapshots.withColumns(
        {
            "stuck": (F.col("taken_at") - F.expr(f"interval {stall_minutes} minutes") > F.col("last_processed_at")) & (F.col("pending") > 0),
            "moved": F.coalesce(F.col("with_financials") > before("with_financials"), F.lit(True)),
            "more_errors": F.coalesce(F.col("errors") > before("errors"), F.lit(False)),
            "finished": F.col("pending") == 0,
        }
    )
    first = lambda cond, *keys: cond & (F.sum(cond.cast("int")).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rows = rows.withColumn("island", F.sum(F.col("moved").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    idle = F.sum((~F.col("moved")).cast("int")).over(Window.partitionBy("island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"stall": first(F.col("stuck"), "last_processed_at"), "idle": idle, "complete": first(F.col("finished"), F.lit(1))})
    kinds = {
        "stalled": F.col("stall"), "no_progress": ~F.col("moved") & (F.col("idle") > 0) & (F.col("idle") % streak == 0),
        "errors_increased": F.col("more_errors"), "completed": F.col("complete"),
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]))
    return rows.select(order, F.explode(found).alias("alert"))


def snapshot_change(snapshots: DataFrame, order: str, counters: list[str]) -> DataFrame:
    """Each counter's change on the snapshot before."""
    w = Window.orderBy(order)
    return snapshots.withColumns({f"{c}_delta": F.col(c) - F.lag(c).over(w) for c in counters})


def last_of_kind(log: DataFrame, position: str, kinds: list[str]) -> DataFrame:
    """The newest event of each kind."""
    return log.where(F.col("event").isin(kinds)).groupBy("event").agg(F.max_by(F.struct(*log.columns), position).alias("last"))


def running_counts(events: DataFrame, key: str) -> DataFrame:
    """Rows seen so far per key; as a stream in update mode a row per key and batch that has some."""
    return events.groupBy(key).agg(F.count("*").alias("seen"))


def for_each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Run ``apply`` on all that is there now and stop; the next call takes up where this one ended."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
