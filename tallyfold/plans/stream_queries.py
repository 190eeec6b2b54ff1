"""Streams with state, resumable sinks, keyed tables and stages of calls, with SQL for their last state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators import calls
from tallyfold.plans.registry import query, table
from tallyfold.sources import keyed, scratch
from tallyfold.streaming import alerts

SNAPSHOT_SQL = """
    SELECT CAST(user_id % 20 AS VARCHAR) AS queue, date_trunc('hour', ts) + INTERVAL 1 HOUR AS taken_at, max(date_trunc('second', ts)) AS last_at,
        count(*) FILTER (event_type = 'view') % 3 AS pending, count(*) FILTER (event_type = 'purchase') AS results, count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY 1, 2
"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty queues, a snapshot per hour with events."""
    events, kind = table(spark, sf_dir, "events"), F.col("event_type")
    by = [(F.col("user_id") % 20).cast("string").alias("queue"), (F.date_trunc("hour", "ts").cast("timestamp") + F.expr("interval 1 hour")).alias("taken_at")]
    return events.groupBy(*by).agg(
        F.max(F.date_trunc("second", "ts")).cast("timestamp").alias("last_processed_at"), (F.count_if(kind == "view") % 3).alias("pending"),
        F.count_if(kind == "purchase").alias("with_financials"), F.count_if(kind == "error").alias("errors"),
    )


@query(f"""
    WITH RECURSIVE every AS ({SNAPSHOT_SQL}), until AS (SELECT max(taken_at) - INTERVAL 2 HOURS AS t FROM every),
    s AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY taken_at) AS rn FROM every WHERE taken_at < (SELECT t FROM until)),
    walk AS (
        SELECT queue, rn, taken_at, last_at, results, errors, 0 AS idle, pending = 0 AS finished,
            CASE WHEN pending > 0 AND last_at + INTERVAL 30 MINUTES < taken_at THEN last_at END AS told,
            CASE WHEN pending > 0 AND last_at + INTERVAL 30 MINUTES >= taken_at THEN last_at + INTERVAL 30 MINUTES END AS due,
            CAST(NULL AS TIMESTAMP) AS earlier, pending > 0 AND last_at + INTERVAL 30 MINUTES < taken_at AS now_stalled, false AS no_progress, false AS more, pending = 0 AS completed
        FROM s WHERE rn = 1
        UNION ALL
        SELECT queue, rn, taken_at, last_at, results, errors, CASE WHEN no_progress THEN 0 ELSE still END, p_finished OR pending = 0,
            CASE WHEN now_stalled THEN last_at ELSE told_before END, CASE WHEN waits AND NOT now_stalled THEN last_at + INTERVAL 30 MINUTES END,
            earlier, now_stalled, no_progress, errors > p_errors, pending = 0 AND NOT p_finished
        FROM (
            SELECT *, pending > 0 AND still >= 2 AS no_progress, waits AND last_at + INTERVAL 30 MINUTES < taken_at AS now_stalled FROM (
                SELECT *, pending > 0 AND last_at IS DISTINCT FROM told_before AS waits FROM (
                    SELECT c.*, p.errors AS p_errors, p.finished AS p_finished, CASE WHEN c.results > p.results THEN 0 ELSE p.idle + 1 END AS still,
                        CASE WHEN p.due < c.taken_at THEN p.due END AS earlier, CASE WHEN p.due < c.taken_at THEN p.last_at ELSE p.told END AS told_before
                    FROM walk p JOIN s c ON c.queue = p.queue AND c.rn = p.rn + 1)))
    )
    SELECT queue, 'stalled' AS alert, earlier AS at FROM walk WHERE earlier IS NOT NULL
    UNION ALL SELECT queue, 'stalled', taken_at FROM walk WHERE now_stalled
    UNION ALL SELECT queue, 'no_progress', taken_at FROM walk WHERE no_progress
    UNION ALL SELECT queue, 'errors_increased', taken_at FROM walk WHERE more
    UNION ALL SELECT queue, 'completed', taken_at FROM walk WHERE completed
    UNION ALL SELECT queue, 'stalled', due FROM walk WHERE due < (SELECT t FROM until) QUALIFY row_number() OVER (PARTITION BY queue ORDER BY rn DESC) = 1 AND rn = (SELECT max(rn) FROM s WHERE s.queue = walk.queue)
""")
def alerts_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream that is stopped and started again twice while snapshots come in."""
    rows = scratch.written(snapshots(spark, sf_dir), "snapshots")
    first, last = rows.agg(F.min("taken_at"), F.max("taken_at")).first()
    part = F.lit(0) if first is None or first == last else F.floor(3 * F.unix_seconds(F.col("taken_at")).__sub__(F.unix_seconds(F.lit(first))) / (F.unix_seconds(F.lit(last)) - F.unix_seconds(F.lit(first)) + 1))
    where = scratch.folder(spark, "alerts")
    for k in range(3):
        rows.where(part == k).write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{where}/in")
        alerts.run_alerts(stream, f"{where}/out", f"{where}/checkpoint", 30, 2, "2 hours")
    return alerts.told(spark, f"{where}/out").withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("""
    WITH r AS (SELECT o_custkey AS company_number, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'error' END AS status, CAST(o_orderdate AS DATE) AS processed_on, o_orderkey AS result_id, o_orderkey % 3 AS part FROM orders),
    one AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY company_number, part ORDER BY processed_on DESC, result_id DESC) = 1)
    SELECT company_number, arg_max(status, part) AS status, arg_max(processed_on, part) AS processed_on, arg_max(result_id, part) AS result_id, arg_min(result_id, part) AS first_result_id FROM one GROUP BY 1
""")
def queue_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a queue in three runs of a stream, and a batch of the first run given again after the last."""
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("error")
    results = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("company_number"), status.alias("status"), F.col("o_orderdate").cast("date").alias("processed_on"), F.col("o_orderkey").alias("result_id"), F.col("o_orderkey").alias("first_result_id"), (F.col("o_orderkey") % 3).alias("part")
    )
    where = scratch.folder(spark, "queue")
    queue = keyed.KeyedTable(spark, f"{where}/queue", "company_number long, status string, processed_on date, result_id long, first_result_id long", ["company_number"], buckets=16)
    how = {"keep": ["first_result_id"], "order": [F.desc("processed_on"), F.desc("result_id")]}
    for k in range(3):
        results.where(F.col("part") == k).write.mode("append").parquet(f"{where}/in")
        keyed.upsert_stream(queue, spark.readStream.schema(results.schema).parquet(f"{where}/in"), "results", f"{where}/checkpoint", **how)
    queue.upsert(results.where("part = 0"), "results", 0, **how)
    return queue.rows()


@query("""
    WITH n AS (SELECT o_custkey, max(o_orderkey) AS k, count(*) AS n FROM orders WHERE o_custkey % 50 = 3 GROUP BY 1)
    SELECT coalesce(c_custkey, o_custkey) AS company_number, coalesce(k, 0) AS latest, coalesce(n, 0) AS filings, coalesce(c_name, 'unknown') AS company_name
    FROM (SELECT * FROM customer WHERE c_custkey % 100 <> 3) c FULL JOIN n ON c_custkey = o_custkey
""")
def upsert_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies loaded, then a fiftieth of them changed or added in the buckets that these fall in."""
    companies = table(spark, sf_dir, "customer").where("c_custkey % 100 <> 3").select(F.col("c_custkey").alias("company_number"), F.lit(0).cast("long").alias("latest"), F.lit(0).cast("long").alias("filings"), F.col("c_name").alias("company_name"))
    new = table(spark, sf_dir, "orders").where("o_custkey % 50 = 3").groupBy(F.col("o_custkey").alias("company_number")).agg(F.max("o_orderkey").alias("latest"), F.count("*").alias("filings")).withColumn("company_name", F.lit("unknown"))
    store = keyed.KeyedTable(spark, scratch.folder(spark, "companies"), "company_number long, latest long, filings long, company_name string", ["company_number"], buckets=64)
    store.upsert(companies, "load", 0)
    store.upsert(new, "change", 0, keep=["company_name"])
    return store.rows()


CALL_SQL = """
    d AS (SELECT doc_id, coalesce(length(text), 0) AS n, doc_id % 7 AS kind FROM documents),
    a AS (SELECT d.*, CAST(t AS INTEGER) AS attempt FROM d, generate_series(1, 3) AS g(t)),
    s AS (SELECT *, CASE kind WHEN 0 THEN 'parsed' WHEN 1 THEN 'repaired' WHEN 2 THEN CASE attempt WHEN 1 THEN 'invalid_json' ELSE 'parsed' END
        WHEN 3 THEN CASE attempt WHEN 1 THEN 'invalid_schema' ELSE 'repaired' END WHEN 4 THEN CASE WHEN attempt < 3 THEN 'call_failed' ELSE 'parsed' END
        WHEN 5 THEN 'invalid_schema' ELSE CASE attempt WHEN 1 THEN 'invalid_json' ELSE 'no_reply' END END AS status FROM a),
    made AS (SELECT *, min(CASE WHEN status IN ('parsed', 'repaired') THEN attempt END) OVER (PARTITION BY doc_id) AS accepted FROM s),
    attempts AS (SELECT * FROM made WHERE attempt <= coalesce(accepted, 3))
"""


def recorded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per document, with replies that are right at once, after repair, later, or never."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("string").alias("n"), (F.col("doc_id") % 7).alias("kind"))
    right = F.concat(F.lit('{"pages": [{"rows": [{"source_label": "characters", "value": '), "n", F.lit("}]}]}"))
    fenced = F.concat(F.lit("Here it is:\n```json\n"), F.replace(right, F.lit("}]}]}"), F.lit("},]}]}")), F.lit("\n```"))
    two = F.lit('{"pages": [{"rows": []}, {"rows": []}]}')
    usage = F.create_map(F.lit("tokens_in"), F.lit(10).cast("long"), F.lit("tokens_out"), F.lit(3).cast("long"))
    reply = lambda text, error=None: F.struct(F.lit(text).cast("string").alias("text") if not isinstance(text, F.Column) else text.alias("text"), F.lit(error).cast("string").alias("error"), usage.alias("usage"), F.lit(0.5).alias("seconds"))
    given = {
        0: [reply(right)], 1: [reply(fenced)], 2: [reply("I cannot read this page."), reply(right)], 3: [reply(two), reply(fenced)],
        4: [reply(None, "timed out"), reply(None, "timed out"), reply(right)], 5: [reply('{"pages": [{"rows": [1]}]}'), reply('{"pages": {}}'), reply(two), reply(right)], 6: [reply('{"pages": [')],
    }
    kind, replies = F.col("kind"), F.array(*given[0])
    for k in range(1, 7):
        replies = F.when(kind == k, F.array(*given[k])).otherwise(replies)
    return docs.select("doc_id", replies.alias("replies"))


@query(f"WITH {CALL_SQL} SELECT doc_id, attempt, status, CASE WHEN attempt = accepted THEN n END AS characters FROM attempts")
def model_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt of a stage of calls, and what the accepted answers hold."""
    found = calls.call_stage(recorded_requests(spark, sf_dir), "pages", ["doc_id"], calls.RecordedClient, calls.page_shape(1))
    value = F.get_json_object("payload", "$.pages[0].rows[0].value").cast("long")
    return found.select("doc_id", "attempt", "status", value.alias("characters"))


@query(f"""WITH {CALL_SQL} SELECT doc_id, count(*) AS attempts, arg_max(status, attempt) AS status, count(*) FILTER (status <> 'no_reply') * 10 AS tokens_in, CAST(count(*) FILTER (status <> 'no_reply') * 0.5 AS DOUBLE) AS seconds FROM attempts GROUP BY 1""")
def model_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts, tokens and time of each request, failed attempts included."""
    found = calls.call_stage(recorded_requests(spark, sf_dir), "pages", ["doc_id"], calls.RecordedClient, calls.page_shape(1))
    return calls.request_summary(found, ["doc_id"]).select("doc_id", "attempts", "status", F.coalesce(F.try_element_at("usage", F.lit("tokens_in")), F.lit(0)).alias("tokens_in"), "seconds")


@query("""
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'current is no object' WHEN 2 THEN 'previous.turnover is no object' WHEN 3 THEN 'current.cash has neither candidate nor reason' ELSE 'current.turnover.candidate_id is no text' END AS error,
        o_orderkey % 5 = 0 AS accepted FROM orders
""")
def decisions_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with decisions for both periods, by their shape."""
    other = '"unknown_metric": 5, "cash": {"candidate_id": "c1"}'
    shapes = [
        f'{{"current": {{{other}}}, "previous": {{"turnover": {{"candidate_id": null, "reason": "not shown"}}}}}}', '{"current": [], "previous": {}}', f'{{"current": {{{other}}}, "previous": {{"turnover": null}}}}',
        '{"current": {"cash": {"candidate_id": null, "reason": " "}}, "previous": {}}', '{"current": {"turnover": {"candidate_id": 7}}, "previous": {}}',
    ]
    k = (F.col("o_orderkey") % 5).cast("int")
    text = F.concat(F.lit('{"financial_period_summaries": '), F.get(F.array(*map(F.lit, shapes)), k), F.lit("}"))
    reply = F.struct(text.alias("text"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("map<string,bigint>").alias("usage"), F.lit(0.0).alias("seconds"))
    requests = table(spark, sf_dir, "orders").select("o_orderkey", F.array(reply).alias("replies"))
    found = calls.call_stage(requests, "decisions", ["o_orderkey"], calls.RecordedClient, calls.decision_shape, 1)
    return found.select("o_orderkey", "error", F.col("status").isin("parsed", "repaired").alias("accepted"))
