"""Alerts on the snapshots of many queues, as a stream with state and timers.

A snapshot (queue, taken_at, last_processed_at, pending, with_financials, errors)
waits in state until the watermark has passed it, so that snapshots of a queue are
judged in the order of their times however they arrive within the delay. Alerts:

- ``stalled``: something is pending and nothing has been processed for the stall
  time. Told once per last processed time, at the moment it falls due; a timer
  tells it also when no further snapshot comes.
- ``no_progress``: that many snapshots in a row without more results, while
  something is pending; then counted anew.
- ``errors_increased``: more errors than the snapshot before.
- ``completed``: nothing is pending; told once.

State is one value and the waiting snapshots per queue. Restarted from its
checkpoint the stream goes on as if it had not stopped.

Defined cases: of several snapshots of a queue at one time the greatest by its
values counts; a snapshot later than the delay is dropped; rows without a queue or
a time are left out; without a last processed time there is no stall; null counts
are zero.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VALUES = ["last_processed_at", "pending", "with_financials", "errors"]


class AlertProcessor(StatefulProcessor):
    """The rules for one queue; times are milliseconds."""

    def __init__(self, stall: int, streak: int):
        self.stall, self.streak = stall, streak

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, last_processed_at long, pending long, with_financials long, errors long")
        self.seen = handle.getValueState("seen", "with_financials long, errors long, idle int, finished boolean, processed long, told long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.at, r.last_processed_at, r.pending, r.with_financials, r.errors) for r in rows]
        self.waiting.appendList(new)
        self.handle.registerTimer(min(at for at, *_ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Judge all snapshots that the watermark has passed; a timer is set for the first of the others."""
        now = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(r) for r in self.waiting.get()]
        ready: dict[int, tuple] = {}
        for at, *values in waiting:
            if at < now:
                ready[at] = max(ready.get(at, tuple(values)), tuple(values), key=_rank)
        rest = [r for r in waiting if r[0] >= now]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(r[0] for r in rest))
        else:
            self.waiting.clear()
        state = tuple(self.seen.get()) if self.seen.exists() else None
        found = []
        for at in sorted(ready):
            state, told = self.step(state, at, ready[at])
            found += told
        if state:
            *rules, processed, told, due = state
            if due is not None and due < now:
                found.append(("stalled", due))
                state = (*rules, processed, processed, None)
            elif due is not None:
                self.handle.registerTimer(due)
            self.seen.update(state)
        return iter([Row(queue=key[0], alert=a, millis=t) for a, t in found])

    def step(self, state: tuple | None, at: int, snapshot: tuple) -> tuple[tuple, list[tuple[str, int]]]:
        """The state after a snapshot, and the alerts (kind, time) that it makes known."""
        processed, pending, results, errors = snapshot
        found = []
        if state is None:
            idle, finished, told, moved, more = 0, False, None, True, False
        else:
            results_before, errors_before, idle, finished, processed_before, told, due = state
            moved, more = results > results_before, errors > errors_before
            if due is not None and due < at:
                found.append(("stalled", due))
                told = processed_before
        idle = 0 if moved else idle + 1
        if pending > 0 and idle >= self.streak:
            found.append(("no_progress", at))
            idle = 0
        if more:
            found.append(("errors_increased", at))
        if pending == 0 and not finished:
            found.append(("completed", at))
            finished = True
        due = None
        if pending > 0 and processed is not None and processed != told:
            due = processed + self.stall
            if due < at:
                found.append(("stalled", at))
                told, due = processed, None
        return (results, errors, idle, finished, processed, told, due), found

    def close(self) -> None:
        pass


def _rank(values: tuple) -> tuple:
    return tuple((v is not None, v or 0) for v in values)


def alert_stream(snapshots: DataFrame, stall_minutes: int, streak: int, delay: str = "1 hour") -> DataFrame:
    """(queue, alert, at) of a stream of snapshots; the session's state store has to be ``ROCKSDB``."""
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    rows = snapshots.where("queue is not null and taken_at is not null").withWatermark("taken_at", delay)
    rows = rows.select("queue", "taken_at", millis("taken_at").alias("at"), millis("last_processed_at").alias("last_processed_at"), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in VALUES[1:]])
    found = rows.groupBy("queue").transformWithState(AlertProcessor(stall_minutes * 60_000, streak), "queue string, alert string, millis long", "Append", "EventTime")
    return found.select("queue", "alert", F.timestamp_millis("millis").alias("at"))


def run_alerts(snapshots: DataFrame, out: str, checkpoint: str, stall_minutes: int, streak: int, delay: str = "1 hour") -> None:
    """Judge all snapshots that are there now and stop; the next call goes on from the checkpoint.

    Each batch is written to a folder of its number, which a repeated batch replaces.
    """
    spark = snapshots.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        stream = alert_stream(snapshots, stall_minutes, streak, delay).writeStream
        write = lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        stream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def told(spark, out: str) -> DataFrame:
    """The alerts written so far."""
    return spark.read.schema("queue string, alert string, at timestamp").parquet(out).select("queue", "alert", "at")
