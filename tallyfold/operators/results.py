"""What stages of model calls leave in the tables: extraction runs, their metrics and periods, saved results, traces and reviewed cases.

A payload is JSON text. Metrics of a payload are chosen by one aggregation that
combines on the map side; periods are an aggregation of the chosen ones, so that a
payload of any length is spread by (run, period, metric) and no window is needed.

Defined cases: a payload that is no JSON object gives a run with the status
``unreadable`` and nothing else; a metric without a name or a period forms a key of
its own, as nulls do; of equal metrics the first one in the payload counts; of
several runs of a document the one with the greatest run id is put in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import arithmetic, arrays, money
from tallyfold.operators import context, evidence, ingestion, scoring
from tallyfold.operators.profiles import FIELDS
from tallyfold.operators.upsert import upsert

_MODELS = ["locator", "vision", "rationalisation"]
_METRIC = (
    "period_type string, financial_year int, metric_name string, value_pence bigint, value_count bigint, displayed_value string, unit string, currency_code string, "
    "scale_multiplier bigint, reported_value string, source_page int, source_label string, evidence_text string, confidence double, validation struct<unit_known:boolean>"
)
MODEL_PAYLOAD = (
    f"pdf_path string, status string, models struct<{', '.join(f'{m}:string' for m in _MODELS)}>, pages_scanned array<int>, candidate_pages array<int>, raw_extraction string, "
    f"rationalisation string, usage string, cost struct<usd:double, gbp:double, method:string, pricing:string>, metrics array<struct<{_METRIC}>>"
)
MONEY_METRICS = [m for m in evidence.CANONICAL if m != "employees"]
PERIOD_KEYS = ["company_number", "document_id", "period_type"]
PERIODS = ["current", "previous"]


def _read(payloads: DataFrame) -> DataFrame:
    return payloads.select("run_id", "company_number", "document_id", F.from_json("payload", MODEL_PAYLOAD).alias("p"), F.coalesce(F.trim("payload").startswith("{"), F.lit(False)).alias("is_object"))


def run_rows(payloads: DataFrame) -> DataFrame:
    """One row per payload (run_id, company_number, document_id, payload): models, status, parts as JSON text, and cost."""
    p = F.col("p")
    readable = F.col("is_object") & F.exists(F.array(*[p[f].isNotNull() for f in ("pdf_path", "status", "models", "metrics", "cost", "usage", "raw_extraction", "rationalisation", "pages_scanned", "candidate_pages")]), lambda x: x)
    pages = lambda name: F.to_json(F.coalesce(p[name], F.array().cast("array<int>")))
    part = lambda c: F.coalesce(c, F.lit("{}"))
    return _read(payloads).select(
        "run_id", "company_number", "document_id", p["pdf_path"].alias("pdf_path"), *[p["models"][m].alias(f"{m}_model") for m in _MODELS],
        F.when(readable, F.coalesce(p["status"], F.lit("complete"))).otherwise("unreadable").alias("status"), pages("pages_scanned").alias("pages_scanned_payload"),
        pages("candidate_pages").alias("candidate_pages_payload"), part(p["raw_extraction"]).alias("raw_extraction_payload"), part(p["rationalisation"]).alias("rationalisation_payload"),
        part(p["usage"]).alias("usage_payload"), part(p["cost"]["pricing"]).alias("pricing_payload"), p["cost"]["usd"].alias("cost_usd"), p["cost"]["gbp"].alias("cost_gbp"),
        F.coalesce(p["cost"]["method"], F.lit("estimated")).alias("cost_method"),
    )


def metric_rows(payloads: DataFrame) -> DataFrame:
    """The metrics of each run, one per period and name: that with a known unit, then of the highest confidence, then the first."""
    rows = _read(payloads).select("run_id", "company_number", "document_id", F.posexplode("p.metrics").alias("position", "m")).where("m is not null")
    rank = F.struct(F.coalesce(F.col("m.validation.unit_known"), F.lit(False)), F.coalesce(F.col("m.confidence"), F.lit(0.0)), -F.col("position"))
    keys = ["run_id", "company_number", "document_id", F.col("m.period_type").alias("period_type"), F.col("m.metric_name").alias("metric_name")]
    best = rows.groupBy(*keys).agg(F.max_by("m", rank).alias("m"))
    own = ["financial_year", "value_pence", "value_count", "displayed_value", "unit", "currency_code", "scale_multiplier", "reported_value", "source_page", "source_label", "evidence_text", "confidence"]
    unit_known = F.coalesce(F.col("m.validation.unit_known"), F.lit(False)).alias("unit_known")
    return best.select("run_id", *PERIOD_KEYS, "metric_name", *[f"m.{c}" for c in own], unit_known)


def amount_text(pence: Column) -> Column:
    """Pence as pounds without zeros at the end: 12300 is 123, 12350 is 123.5."""
    return F.regexp_replace((pence.cast("decimal(38,2)") / 100).cast("decimal(38,2)").cast("string"), r"\.?0+$", "")


def period_rows(metrics: DataFrame) -> DataFrame:
    """One row per run and period with canonical metrics: amounts as reported, whole amounts, head-count, year and currency.

    The year is that on which all metrics agree. The currency is that of all
    amounts (``valid``); more than one is ``mixed`` and none ``unknown``, both
    without a code. An amount without a reported value is its pence, if no foreign
    currency is named. A currency that is not named is sterling where pence are.
    """
    rows = metrics.where(F.col("metric_name").isin(evidence.CANONICAL))
    sterling = F.coalesce("currency_code", F.lit("GBP")) == "GBP"
    value = F.when(F.col("metric_name") != "employees", F.coalesce("reported_value", F.when(sterling, amount_text(F.col("value_pence")))))
    code = F.when(value.isNotNull(), F.coalesce(F.nullif(F.col("currency_code"), F.lit("")), F.when(F.col("value_pence").isNotNull(), "GBP")))
    of = lambda m, c: F.max(F.when(F.col("metric_name") == m, c))
    wide = rows.withColumns({"value": value, "code": code}).groupBy("run_id", *PERIOD_KEYS).agg(
        *[of(m, F.col("value")).alias(f"{m}_reported_value") for m in MONEY_METRICS], of("employees", F.col("value_count")).alias("employees"),
        F.array_sort(F.collect_set("metric_name")).alias("metrics"), F.min("financial_year").alias("y1"), F.max("financial_year").alias("y2"), F.min("code").alias("c1"), F.max("code").alias("c2"),
    )
    status = F.when(F.col("c1") == F.col("c2"), "valid").when(F.col("c1").isNotNull(), "mixed").otherwise("unknown")
    source = F.struct(F.lit("vlm").alias("source"), F.col("run_id").alias("extraction_run_id"))
    return wide.select(
        "run_id", *PERIOD_KEYS, F.when(F.col("y1") == F.col("y2"), F.col("y1")).alias("financial_year"), *[ingestion.legacy_amount(F.col(f"{m}_reported_value")).alias(m) for m in MONEY_METRICS],
        "employees", F.to_json(source).alias("derived_payload"), F.to_json(F.struct(source["source"].alias("source"), source["extraction_run_id"].alias("extraction_run_id"), "metrics")).alias("raw_payload"),
        F.lit("vlm").alias("data_source"), F.when(F.col("c1") == F.col("c2"), F.col("c1")).alias("currency_code"), F.lit("vlm_statement").alias("currency_source"),
        status.alias("currency_validation_status"), *[f"{m}_reported_value" for m in MONEY_METRICS],
    )


def stored_periods(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored periods with those of the runs put in: new keys, and rows that came from a model before. Others stay."""
    rows = fresh.select(*[c if c in fresh.columns else F.lit(None).cast(t).alias(c) for c, t in existing.dtypes], F.col("run_id").alias("__run"))
    kept = existing.withColumn("__run", F.lit(None).cast("bigint"))
    return upsert(kept, rows, PERIOD_KEYS, order=[F.desc("__run")], only_if=F.col("e.data_source") == "vlm").drop("__run")


def with_located(pages: DataFrame, located: DataFrame, keys: list[str]) -> DataFrame:
    """Extracted pages with scope and type of the locator, which saw the heading.

    Its scope counts unless unknown, its type if that is a primary statement; else a
    type that is none becomes ``other``. Of several located rows of a page the last
    ``position`` counts. Pages without a number stay as they are read.
    """
    last = located.where("page is not null").groupBy(*keys, "page").agg(F.max_by(F.struct("statement_scope", "statement_type"), "position").alias("__l"))
    seen, own = evidence.statement_scope(F.col("__l.statement_scope")), evidence.statement_scope(F.col("statement_scope"))
    primary = lambda c: F.coalesce(c.isin(evidence.PRIMARY_STATEMENTS), F.lit(False))
    kind = F.when(primary(F.col("__l.statement_type")), F.col("__l.statement_type")).when(primary(F.col("statement_type")), F.col("statement_type")).otherwise("other")
    return pages.join(last, [*keys, "page"], "left").withColumns({"statement_scope": F.when(seen != "unknown", seen).otherwise(own), "statement_type": kind}).drop("__l")


def employee_count(period: str) -> Column:
    """A head-count that is stated and not negative, else what is displayed, if it is a whole number."""
    stated = F.col(f"{period}_value_count")
    return F.when(stated >= 0, stated).otherwise(money.count_value(F.col(f"{period}_display")))


def employee_evidence_kind(period: str) -> Column:
    """The stated kind of evidence, else ``numeric`` or ``none``, by whether a whole number is displayed."""
    shown = money.count_value(F.col(f"{period}_display")).isNotNull()
    return F.coalesce(F.col(f"{period}_evidence_kind"), F.when(shown, "numeric").otherwise("none"))


def saved_results(results: DataFrame, outcomes: DataFrame, config: dict[str, str | None]) -> DataFrame:
    """(case_id, payload, synthesised): the first attempt's payload of each case, and an error payload for outcomes without one.

    Results are (case_id, attempt, file, payload); of several first attempts the
    last file counts. Outcomes are (case_id, pdf_path, error, usage, elapsed_seconds).
    """
    first = results.where("attempt = 1 and case_id is not null").groupBy("case_id").agg(F.max_by("payload", "file").alias("payload")).withColumn("synthesised", F.lit(False))
    nothing = F.array().cast("array<string>")
    models = F.struct(*[F.lit(config.get(f"{m}_model")).cast("string").alias(m) for m in _MODELS])
    error = F.coalesce(F.nullif(F.col("error"), F.lit("")), F.lit("failed before a result was made"))
    payload = F.struct(
        "pdf_path", F.lit(config.get("provider")).cast("string").alias("provider"), models.alias("models"), F.lit("error").alias("status"), error.alias("error"),
        *[nothing.alias(c) for c in ("pages_scanned", "candidate_pages", "metrics")], F.coalesce("usage", F.create_map().cast("map<string,bigint>")).alias("usage"), "elapsed_seconds",
    )
    failed = outcomes.join(first.select("case_id"), "case_id", "left_anti").where("case_id is not null")
    made = failed.groupBy("case_id").agg(F.min(F.to_json(payload, {"ignoreNullFields": "false"})).alias("payload")).withColumn("synthesised", F.lit(True))
    return first.unionByName(made)


def preferred_traces(traces: DataFrame, cases: DataFrame) -> DataFrame:
    """(case_id, trace_id, reviewed) of the given cases: traces that a person answered come first, then the newest, then the greatest id."""
    rank = F.struct(F.coalesce("reviewed", F.lit(False)).alias("reviewed"), "timestamp_ms", "trace_id")
    best = traces.join(cases.select("case_id").distinct(), "case_id", "left_semi").groupBy("case_id").agg(F.max(rank).alias("t"))
    return best.select("case_id", "t.trace_id", "t.reviewed")


def latest_answers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """Answers (keys, name, value, updated_ms, position), the newest of each name; of equal times the last. Without a name they don't count."""
    rank = F.struct(F.coalesce("updated_ms", F.lit(0)), F.col("position"))
    return answers.where("name is not null").groupBy(*keys, "name").agg(F.max_by("value", rank).alias("value"))


def latest_of(answers: Column) -> Column:
    """``latest_answers`` of the answers (name, value, updated_ms) that a trace holds, as an array of the same with their positions."""
    known = F.transform(F.filter(answers, lambda a: a["name"].isNotNull()), lambda a, i: F.struct(a["name"].alias("name"), F.coalesce(a["updated_ms"], F.lit(0)).alias("updated_ms"), i.alias("position"), a["value"].alias("value")))
    return arrays.last_of(known, ["name"])


def statement_pages(answer: Column) -> Column:
    """Pages of a reviewer's list, sorted, each once; null unless all are positive whole numbers and there is one."""
    parts = F.filter(F.transform(F.split(answer, ","), lambda x: F.trim(x)), lambda x: x != "")
    pages = F.transform(parts, lambda x: x.try_cast("int"))
    return F.when((F.size(pages) > 0) & F.forall(pages, lambda p: F.coalesce(p > 0, F.lit(False))), F.array_sort(F.array_distinct(pages)))


GOLD = [(p, m, f"gold_{p}_{m}") for p in PERIODS for m in evidence.CANONICAL]
ASKED = ["gold_statement_pages", *[n for _, _, n in GOLD]]


def reviewed_cases(traces: DataFrame, answers: DataFrame, version: int = 1) -> DataFrame:
    """``reviewed_traces`` of answers that come as rows (case_id, name, value), one of each name."""
    read = answers.where(F.col("name").isin(ASKED) & F.col("case_id").isNotNull())
    # no join: a side of few bytes in the shuffle can be many in memory, and would be broadcast
    told = read.select("case_id", F.struct("name", "value").alias("told"))
    own = [c for c in traces.columns if c != "case_id"]
    both = traces.select("case_id", F.struct(*own).alias("trace")).unionByName(told, allowMissingColumns=True)
    wide = both.groupBy("case_id").agg(F.collect_list("trace").alias("traces"), F.collect_list("told").alias("answers"))
    return reviewed_traces(wide.select("case_id", F.explode("traces").alias("trace"), "answers").select("case_id", "trace.*", "answers"), version)


def reviewed_traces(traces: DataFrame, version: int = 1) -> DataFrame:
    """(case_id, missing, errors, case_json): answers of a completed review as a label case; one with faults has no case.

    Traces are (case_id, company_number, document_id, pdf_sha256, split, trace_id,
    reviewer, reviewed_at, answers), each with its answers (name, value, ...), one of
    each name, so that a trace is read where it lies.
    """
    a = arrays.bound(F.filter("answers", lambda x: x["name"].isin(ASKED)), lambda x: F.map_from_arrays(x["name"], x["value"]))
    rows = traces.withColumn("a", F.coalesce(a, F.create_map().cast("map<string,string>")))
    value = lambda n: F.try_element_at("a", F.lit(n))
    rows = rows.withColumns({"missing": F.sort_array(F.array_except(F.array(*map(F.lit, ASKED)), F.map_keys("a"))), "pages": arrays.bound(value(ASKED[0]), statement_pages)})
    rows = scoring.with_reviewed_metrics(rows, {n: (value(n), m) for _, m, n in GOLD})
    cell = F.col
    faults = [F.when(F.col("pages").isNull(), F.lit("gold_statement_pages: no list of pages"))]
    faults += [F.concat(F.lit(f"{n}: "), F.coalesce(cell(n)["error"], F.when(cell(n)["state"].isNull(), "no answer"))) for _, _, n in GOLD]
    none = F.array(F.lit(None).cast("string"))
    rows = rows.withColumn("errors", F.when(F.size("missing") > 0, F.array().cast("array<string>")).otherwise(F.array_except(F.array(*faults), none)))
    summaries = F.struct(*[F.struct(*[cell(n).dropFields("error").alias(m) for q, m, n in GOLD if q == p]).alias(p) for p in PERIODS])
    case = F.struct(
        F.lit(version).alias("schema_version"), F.col("case_id").alias("id"), "company_number", "document_id", F.concat(F.lit("trace:"), "trace_id").alias("pdf_path"), "pdf_sha256", "split",
        F.struct(F.lit("review").alias("label_source"), F.col("trace_id").alias("review_trace_id")).alias("metadata"),
        F.struct(F.col("pages").alias("statement_pages"), summaries.alias("financial_period_summaries")).alias("expected"),
        F.struct(F.lit("verified").alias("status"), "reviewer", "reviewed_at", F.lit(None).cast("string").alias("notes")).alias("review"),
    )
    fine = (F.size("missing") == 0) & (F.size("errors") == 0)
    return rows.select("case_id", "missing", "errors", F.when(fine, F.to_json(case, {"ignoreNullFields": "false"})).alias("case_json"))


def newest_documents(documents: DataFrame) -> DataFrame:
    """Each company's document with markup that was stored last."""
    fields = ["document_id", "transaction_id", "xhtml_url"]
    best = documents.where("xhtml_url is not null").groupBy("company_number").agg(F.max_by(F.struct(*fields), F.struct("ingest_seq", "document_id")).alias("d"))
    return best.select("company_number", *[f"d.{c}" for c in fields])


def profile_queue(narrative_runs: DataFrame, profiles: DataFrame, periods: DataFrame, limit: int | None = None) -> DataFrame:
    """(company_number, turnover) of companies with a narrative and without a profile, largest current turnover first."""
    current = periods.where("period_type = 'current'").groupBy("company_number").agg(F.max("turnover").alias("turnover"))
    rows = narrative_runs.select("company_number").distinct().join(profiles.select("company_number"), "company_number", "left_anti").join(current, "company_number", "left")
    rows = rows.orderBy(F.desc_nulls_last("turnover"), "company_number")
    return rows.limit(limit) if limit else rows


def lead_context(companies: DataFrame, leads: DataFrame) -> DataFrame:
    """Companies (company_number, sic_codes) as context, with the code of the lead after those that were given."""
    known = leads.where("sic_1 <> ''").select(F.col("company_number").alias("__number"), "sic_1")
    rows = companies.join(known, F.col("company_number") == F.col("__number"), "left").drop("__number")
    given = F.coalesce("sic_codes", F.array().cast("array<string>"))
    return context.normalised(rows.withColumn("sic_codes", F.array_compact(F.concat(given, F.array("sic_1")))).drop("sic_1"))


SCORED = [*FIELDS, "sic_agreement"]


def graded(rows: DataFrame) -> DataFrame:
    """Answers (answer, issues) with what they lose: ``grade`` is scored, partial or rejected, ``lost`` the fields that issues name.

    An answer is rejected whole if there is none, or if an issue names no field or
    the description.
    """
    named = F.transform("issues", context.error_field)
    whole = F.col("answer").isNull() | F.exists(named, lambda f: f.isNull() | (f == "business_description"))
    lost = F.array_intersect(F.coalesce(named, F.array().cast("array<string>")), F.array(*map(F.lit, SCORED)))
    return rows.withColumns({"grade": F.when(whole, "rejected").when(F.size(lost) > 0, "partial").otherwise("scored"), "lost": lost})


def combination_report(rows: DataFrame) -> DataFrame:
    """Per (model, context) of graded answers: cases, rejections, partial ones, shares of sound and of unclear answers, tokens and time."""
    counts = [F.when((F.col("grade") != "rejected") & ~F.array_contains("lost", f), F.coalesce(F.col(f"answer.{f}.value"), F.lit(""))) for f in FIELDS]
    told = F.size(F.array_compact(F.array(*counts)))
    unclear = F.size(F.filter(F.array(*counts), lambda v: F.coalesce(v == "unclear", F.lit(False))))
    rejected, partial = F.count_if(F.col("grade") != "scored"), F.count_if(F.col("grade") == "partial")
    return rows.groupBy("model", "context").agg(
        F.count("*").alias("cases"), rejected.alias("rejections"), partial.alias("partial_rejections"), F.round(1 - rejected / F.count("*"), 4).alias("quote_pass_rate"),
        F.round(arithmetic.ratio(F.sum(unclear), F.sum(told)), 4).alias("unclear_rate"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.round(F.sum("elapsed_seconds"), 1).alias("elapsed_seconds"),
    )


def combination_fields(rows: DataFrame) -> DataFrame:
    """Per (model, context, field) of graded answers with ``expected`` (a string per field): how many have a label, and the share that is right."""
    found = lambda f: F.when((F.col("grade") != "rejected") & ~F.array_contains("lost", f), F.col(f"answer.{f}.value"))
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"expected.{f}").alias("expected"), found(f).alias("found")) for f in SCORED])
    long = rows.select("model", "context", F.explode(entries).alias("x"))
    scored, right = F.count("x.expected"), F.count_if(F.col("x.expected") == F.col("x.found"))
    return long.groupBy("model", "context", "x.field").agg(scored.alias("scored"), F.round(arithmetic.ratio(right, scored), 4).alias("accuracy"))
