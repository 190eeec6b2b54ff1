"""Saved extractions whose rows were lost since their page numbers are text: candidates made anew, decided for, and put back.

Only payloads that have lost rows are worked on; all others come out as they were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import text
from tallyfold.operators import calls, context, evidence
from tallyfold.sources import scratch

ROW = "struct<metric: string, source_label: string, current_display: string, previous_display: string, confidence: double>"
PAGE = f"struct<page: string, statement_type: string, statement_scope: string, unit: string, rows: array<{ROW}>>"
SAVED = "struct<raw_extraction: struct<candidates: array<string>, detail: struct<pages: array<string>>>>"


def saved_pages(payload: Column) -> Column:
    """(n_candidates, pages) of a saved payload's JSON; a page says whether its number is written as text, and has its rows."""
    raw = F.from_json(payload, SAVED)["raw_extraction"]
    pages = F.transform(
        F.coalesce(raw["detail"]["pages"], F.array().cast("array<string>")),
        lambda p: F.struct(p.rlike(r'"page"\s*:\s*"').alias("is_text"), F.from_json(p, PAGE).alias("p")),
    )
    flat = F.transform(
        pages,
        lambda x: F.struct(
            x["p"]["page"].alias("page"), x["is_text"].alias("is_text"), F.coalesce(F.size(x["p"]["rows"]), F.lit(0)).alias("n_rows"),
            x["p"]["statement_type"].alias("statement_type"), x["p"]["statement_scope"].alias("statement_scope"), x["p"]["unit"].alias("unit"), x["p"]["rows"].alias("rows"),
        ),
    )
    return F.struct(F.coalesce(F.size(raw["candidates"]), F.lit(0)).alias("n_candidates"), flat.alias("pages"))


def decisions_of(answers: DataFrame, key: str) -> DataFrame:
    """(key, period, metric, candidate_id) of accepted answers' payloads; metrics decided against have no row."""
    periods = F.from_json("payload", "struct<financial_period_summaries: map<string, map<string, struct<candidate_id: string>>>>")["financial_period_summaries"]
    by_period = answers.select(key, F.explode(periods).alias("period", "choices"))
    rows = by_period.where(F.col("period").isin("current", "previous")).select(key, "period", F.explode("choices").alias("metric", "choice"))
    return rows.where("choice.candidate_id is not null").select(key, "period", "metric", F.col("choice.candidate_id").alias("candidate_id"))


def replayed(saved: DataFrame, decide: Callable[[DataFrame], DataFrame], key: str, payload: str = "payload") -> DataFrame:
    """The saved rows with ``outcome`` and ``replayed``, the metrics selected anew.

    ``decide`` is given the candidates (key, candidate_id, metric, ...) and returns
    decisions (key, period, metric, candidate_id), from a stage of calls, say. The
    outcome is ``kept`` for payloads that have lost nothing, ``no_candidates`` where
    nothing can be made of the pages, else ``replayed``; only then is ``replayed`` an
    array, of (period, metric, candidate_id, reported_value, value_pence,
    value_count) in order of period and metric. Payloads are read once, and what is
    made of them is written, since decisions and selections both rest on it.
    """
    parts = saved.withColumn("__s", saved_pages(F.col(payload))).select("*", "__s.n_candidates", "__s.pages")
    parts = parts.withColumn("__lost", context.needs_page_numbers(parts))
    numbered = F.filter(F.transform("pages", lambda p: p.withField("page", text.page_number(p["page"]))), lambda p: p["page"].isNotNull())
    parts = scratch.written(parts.withColumn("pages", F.when(F.col("__lost"), numbered)).drop("__s", "n_candidates"), "parts")
    rows = scratch.written(evidence.exploded(parts.where("__lost").select(key, "pages"), key, "pages"), "rows")
    candidates = scratch.written(evidence.with_equivalents(rows, [key]), "candidates")
    chosen = evidence.selected(candidates, decide(candidates), [key])
    entry = F.struct("period", "metric", "candidate_id", "reported_value", "value_pence", "value_count")
    cells = chosen.select(key, entry.alias("__cell"))  # a cell per period and metric
    made = rows.select(key).distinct().withColumn("__cell", F.lit(None).cast(cells.schema["__cell"].dataType))
    replays = made.unionByName(cells).groupBy(key).agg(F.array_sort(F.collect_list("__cell")).alias("replayed"), F.lit(True).alias("__made"))
    out = parts.drop("pages").join(replays, key, "left")
    outcome = F.when(~F.col("__lost"), "kept").when(F.col("__made").isNull(), "no_candidates").otherwise("replayed")
    columns = [c for c in parts.columns if c not in ("pages", "__lost")]
    return out.withColumn("outcome", outcome).select(key, *[c for c in columns if c != key], "outcome", F.when(F.col("outcome") == "replayed", F.col("replayed")).alias("replayed"))


def decided_by_calls(candidates: DataFrame, key: str, replies: DataFrame, make_client: Callable[[], calls.Client] = calls.RecordedClient) -> DataFrame:
    """Decisions on candidates by one call per key; ``replies`` (key, replies) is what a recorded client answers with.

    A request holds its candidates as JSON; a key's candidates are the rows of one document.
    """
    shown = F.to_json(F.struct("candidate_id", "metric", "source_label", "current_display", "previous_display", "page", "statement_type", "unit"))
    requests = candidates.groupBy(key).agg(F.array_sort(F.collect_list(shown)).alias("candidates")).join(replies, key, "left")
    return decisions_of(calls.accepted(calls.call_stage(requests, "decisions", [key], make_client, calls.decision_shape)), key)
