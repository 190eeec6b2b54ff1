"""Stages of model calls: each request is put to a client, checked, and asked again a bounded number of times.

``call_stage`` is one narrow pass. Every partition makes its own client once, from a
function given to it, and every attempt gives a row, also those that failed, so that
costs and repairs can be added up afterwards. Calls are not repeated by reading the
result twice if it is written first, as a caller should.

``RecordedClient`` answers from replies stored with the requests; a client for a live
service has the same one method.

Defined cases: a null request is put like any other; a reply that is no JSON object,
also after repair, counts as a failed attempt; a request whose client runs out of
recorded replies fails with ``no_reply``; requests that are in the table twice are
put twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.functions.text import repaired_json
from tallyfold.operators.evidence import CANONICAL

Check = Callable[[dict], str | None]


@dataclass(frozen=True)
class Reply:
    text: str | None
    usage: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0


class CallError(Exception):
    """A call without an answer; ``kind`` is the attempt's status."""

    def __init__(self, kind: str, message: str, usage: dict[str, int] | None = None, seconds: float = 0.0):
        super().__init__(message)
        self.kind, self.usage, self.seconds = kind, usage or {}, seconds


class Client(Protocol):
    def ask(self, request: dict, attempt: int) -> Reply: ...


class RecordedClient:
    """Answers attempt n of a request with the n-th of its ``replies``: structs of text, error, usage and seconds."""

    def ask(self, request: dict, attempt: int) -> Reply:
        replies = request.get("replies") or []
        if attempt > len(replies):
            raise CallError("no_reply", "no reply is recorded")
        reply = replies[attempt - 1] or {}
        usage, seconds = dict(reply.get("usage") or {}), reply.get("seconds") or 0.0
        if reply.get("error"):
            raise CallError("call_failed", reply["error"], usage, seconds)
        return Reply(reply.get("text"), usage, seconds)


def parsed(text: str | None) -> tuple[dict | None, bool]:
    """(object, repaired) of a reply; no object where it has none even after repair."""
    for candidate, repaired in ((text, False), (repaired_json(text), True)):
        try:
            found = json.loads(candidate) if candidate is not None else None
        except ValueError:
            continue
        if isinstance(found, dict):
            return found, repaired
    return None, False


def page_shape(pages: int | None = None, rows: bool = True) -> Check:
    """A check that ``pages`` is a list of objects, as many as were shown, each with a list of objects as ``rows``."""

    def check(payload: dict) -> str | None:
        found = payload.get("pages")
        if not isinstance(found, list):
            return "pages is no list"
        if pages is not None and len(found) != pages:
            return f"{len(found)} pages where {pages} were shown"
        for k, page in enumerate(found):
            if not isinstance(page, dict):
                return f"page {k} is no object"
            if rows and not isinstance(page.get("rows"), list):
                return f"page {k} has no list of rows"
            if rows and not all(isinstance(r, dict) for r in page["rows"]):
                return f"page {k} has a row that is no object"
        return None

    return check


def decision_shape(payload: dict) -> str | None:
    """A check of decisions: for both periods an object per metric, with a candidate's id or else a reason."""
    periods = payload.get("financial_period_summaries")
    if not isinstance(periods, dict):
        return "financial_period_summaries is no object"
    for name in ("current", "previous"):
        if not isinstance(periods.get(name), dict):
            return f"{name} is no object"
        for metric, choice in periods[name].items():
            if metric not in CANONICAL:  # others are not decided for
                continue
            if not isinstance(choice, dict):
                return f"{name}.{metric} is no object"
            chosen, reason = choice.get("candidate_id"), choice.get("reason")
            if chosen is not None and not isinstance(chosen, str):
                return f"{name}.{metric}.candidate_id is no text"
            if chosen is None and not (isinstance(reason, str) and reason.strip()):
                return f"{name}.{metric} has neither candidate nor reason"
    return None


ATTEMPT = "stage string, attempt int, status string, error string, raw_response string, payload string, usage map<string,bigint>, seconds double"


def attempts_of(client: Client, request: dict, check: Check, most: int) -> Iterator[dict]:
    """One entry per attempt, the last of which is ``parsed`` or ``repaired`` if any is."""
    for attempt in range(1, most + 1):
        try:
            reply = client.ask(request, attempt)
        except CallError as e:
            yield {"attempt": attempt, "status": e.kind, "error": str(e), "raw_response": None, "payload": None, "usage": e.usage, "seconds": e.seconds}
            continue
        payload, repaired = parsed(reply.text)
        error = "no JSON object" if payload is None else check(payload)
        status = ("repaired" if repaired else "parsed") if error is None else "invalid_json" if payload is None else "invalid_schema"
        accepted = json.dumps(payload, ensure_ascii=False, separators=(",", ":")) if error is None else None
        yield {"attempt": attempt, "status": status, "error": error, "raw_response": reply.text, "payload": accepted, "usage": reply.usage, "seconds": reply.seconds}
        if error is None:
            return


def call_stage(requests: DataFrame, stage: str, ids: list[str], make_client: Callable[[], Client], check: Check, max_attempts: int = 3) -> DataFrame:
    """The columns ``ids`` of each request with a row per attempt; a request is handed to the client as a dict of its columns."""
    if max_attempts < 1:
        raise ValueError("at least one attempt is needed")
    kinds = ", ".join(f"`{c}` {t}" for c, t in requests.select(*ids).dtypes)
    plain = pa.schema([("stage", pa.string()), ("attempt", pa.int32()), ("status", pa.string()), ("error", pa.string()), ("raw_response", pa.string()), ("payload", pa.string()), ("usage", pa.map_(pa.string(), pa.int64())), ("seconds", pa.float64())])

    def called(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for batch in batches:
            places, rows = [], []
            for place, request in enumerate(batch.to_pylist()):
                for row in attempts_of(client, request, check, max_attempts):
                    places.append(place)
                    rows.append(row | {"stage": stage, "usage": sorted(row["usage"].items())})
            own = batch.select(ids).take(pa.array(places, pa.int64()))
            table = pa.RecordBatch.from_pylist(rows, plain)
            yield pa.RecordBatch.from_arrays([*own.columns, *table.columns], names=[*ids, *plain.names])

    return requests.mapInArrow(called, f"{kinds}, {ATTEMPT}")


def accepted(attempts: DataFrame) -> DataFrame:
    """The attempts that gave an answer: one per request at most, with its payload as JSON text."""
    return attempts.where(F.col("status").isin("parsed", "repaired"))


def request_summary(attempts: DataFrame, ids: list[str]) -> DataFrame:
    """(ids, stage, attempts, status, seconds, usage): sums over a request's attempts, failed ones too; status is the last one's."""
    by = [*ids, "stage"]
    rows = attempts.groupBy(*by).agg(F.count("*").alias("attempts"), F.max_by("status", "attempt").alias("status"), F.sum("seconds").alias("seconds"))
    used = attempts.select(*by, F.explode("usage").alias("k", "v")).groupBy(*by, "k").agg(F.sum("v").alias("v"))
    used = used.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("usage"))  # an entry per kind of usage
    same = [rows[c].eqNullSafe(used[c]) for c in by]
    return rows.join(used, same, "left").select(*[rows[c] for c in rows.columns], "usage")
