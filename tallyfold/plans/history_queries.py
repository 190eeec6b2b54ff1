"""Histories, joins and aggregations of the engine over the star-schema tables.

A customer stands for a company, an order's year for a financial year, an
order's total for turnover, an order's status for an account category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfold.functions import arithmetic
from tallyfold.operators import evidence, fx, leads, sampling, scoring, timeseries, triage, upsert
from tallyfold.plans.registry import query, table

YEARLY_SQL = """
    yearly AS (
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS turnover,
            CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS gross_profit
        FROM orders GROUP BY ALL
    )
"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover and finished turnover per customer and year."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_totalprice", "o_orderstatus")
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)")).otherwise(F.lit(0))
    return orders.groupBy("o_custkey", "yr").agg(arithmetic.exact_sum(F.col("o_totalprice")).alias("turnover"), arithmetic.exact_sum(done).alias("gross_profit"))


@query(f"""
    WITH {YEARLY_SQL}, depth AS (SELECT o_custkey, count(DISTINCT yr) AS years_of_history FROM yearly GROUP BY 1 HAVING count(DISTINCT yr) >= 3)
    SELECT o_custkey, n_name, r_name, yr, years_of_history, turnover, gross_profit,
        round(100.0 * gross_profit / nullif(turnover, 0), 1) + 0.0 AS gross_margin_pct,
        round(100.0 * (turnover - lag(turnover) OVER w) / nullif(abs(lag(turnover) OVER w), 0), 1) + 0.0 AS turnover_change_pct
    FROM yearly JOIN depth USING (o_custkey) LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    WINDOW w AS (PARTITION BY o_custkey ORDER BY yr)
""")
def growth_history_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timeseries.growth(timeseries.with_history(yearly(spark, sf_dir), "o_custkey", "yr", 3), "o_custkey", "yr", ["turnover"])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    joined = rows.join(customers, F.col("c_custkey") == F.col("o_custkey"), "left").join(places, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    margin = arithmetic.percent(F.col("gross_profit"), F.col("turnover"))
    return joined.select("o_custkey", "n_name", "r_name", "yr", "years_of_history", "turnover", "gross_profit", margin.alias("gross_margin_pct"), "turnover_change_pct")


@query("""
    WITH d AS (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS years_of_history FROM orders GROUP BY 1)
    SELECT years_of_history, count(*) AS companies FROM d GROUP BY 1
""")
def history_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"))
    return timeseries.history_coverage(orders, "o_custkey", "yr")


@query("""
    SELECT o_orderkey, o_custkey, c_mktsegment, n_name, r_name, o_totalprice FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    WHERE o_totalprice BETWEEN 50000 AND 200000 AND o_orderstatus IS NOT NULL
""")
def band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_totalprice").between(50000, 200000) & F.col("o_orderstatus").isNotNull())
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    joined = joined.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    joined = joined.join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return joined.select("o_orderkey", "o_custkey", "c_mktsegment", "n_name", "r_name", "o_totalprice")


@query("""
    SELECT 'overall' AS segment, o_orderstatus, count(*) AS periods FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT coalesce(c_mktsegment, 'unknown') AS segment, o_orderstatus, count(*) AS periods
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus IS NOT NULL GROUP BY ALL
""")
def status_overall_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted once by segment; the overall rows add these up, so orders are read and joined once."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus is not null")
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    part = joined.groupBy(F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment"), "o_orderstatus").agg(F.count("*").alias("periods"))
    every = part.groupBy("o_orderstatus").agg(F.sum("periods").alias("periods")).select(F.lit("overall").alias("segment"), "o_orderstatus", "periods")
    return every.unionByName(part)


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return upsert.latest_by(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("""
    WITH one AS (
        SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R')
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1
    )
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS period_end, l_orderkey, l_linenumber,
        CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS INTEGER) AS rank
    FROM one WHERE CAST(l_shipdate AS DATE) >= DATE '2001-08-01' - INTERVAL 1095 DAY
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) <= 4
""")
def history_dedupe_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as filings: the flag is the type, the ship date the period end, the price the filing date."""
    lines = table(spark, sf_dir, "lineitem")
    filings = lines.select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("type"), F.col("l_extendedprice").alias("date"),
        F.col("l_shipdate").cast("date").alias("made_up_date"), F.lit(None).cast("date").alias("action_date"), F.struct("l_orderkey", "l_linenumber").alias("position"),
    )
    found = timeseries.accounts_history(filings, F.to_date(F.lit("2001-08-01")), key="l_suppkey", kinds=("A", "R"))
    return found.select("l_suppkey", "period_end", "l_orderkey", "l_linenumber", "rank")


@query("""
    WITH d AS (SELECT DISTINCT o_custkey, CAST(round(o_totalprice / 1000) AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS period FROM orders),
    g AS (SELECT amount, period, count(DISTINCT o_custkey) AS n, min(o_custkey) AS duplicate_of FROM d WHERE amount > 10 GROUP BY ALL HAVING count(DISTINCT o_custkey) > 1)
    SELECT o_custkey, duplicate_of FROM d JOIN g USING (amount, period) WHERE o_custkey <> duplicate_of
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY amount DESC, period DESC) = 1
""")
def duplicate_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_custkey", F.round(F.col("o_totalprice") / 1000).cast("bigint").alias("amount"), F.col("o_orderdate").cast("date").alias("period")).distinct()
    return triage.duplicates(rows, "o_custkey", "amount", "period", floor=10)


RATES_SQL = """
    rates AS (
        SELECT event_type, ts AS rate_ts, event_id AS rate_id, CAST(value AS DECIMAL(18,4)) AS rate FROM events WHERE value > 0
        QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) = 1
    )
"""


@query(f"""
    WITH {RATES_SQL}, facts AS (SELECT event_id, event_type, ts + INTERVAL 1 HOUR AS due FROM events)
    SELECT event_id, f.event_type, due, CASE WHEN rate_ts >= due - INTERVAL 2 HOUR THEN rate_id END AS rate_id,
        CASE WHEN rate_ts >= due - INTERVAL 2 HOUR THEN rate_ts END AS rate_ts
    FROM facts f ASOF LEFT JOIN rates r ON f.event_type = r.event_type AND f.due >= r.rate_ts
""")
def asof_rate_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rates = events.where("value > 0").select("event_type", F.col("ts").alias("rate_ts"), F.col("event_id").alias("rate_id"))
    facts = events.select("event_id", "event_type", (F.col("ts") + F.expr("interval 1 hour")).alias("due"))
    joined = fx.asof_join(facts, rates, ["event_type"], "due", "rate_ts", F.expr("interval 2 hours"), ["rate_id"], [F.asc("rate_id")], lambda t: F.date_trunc("hour", t))
    return joined.select("event_id", "event_type", "due", "rate_id", "rate_ts")


@query("""
    SELECT event_id, CAST(round_even(CAST(value AS DECIMAL(18,4)) * CAST(0.125 AS DECIMAL(9,6)) * 100, 0) AS BIGINT) AS pence FROM events
""")
def fx_convert_half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("value").cast("decimal(18,4)")
    return table(spark, sf_dir, "events").select("event_id", arithmetic.to_pence(amount, F.lit("0.125").cast("decimal(9,6)")).alias("pence"))


@query("""
    WITH o AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS yr, o_orderstatus, o_orderpriority FROM orders),
    p AS (SELECT * FROM o WHERE o_orderpriority LIKE '1%'), c AS (SELECT * FROM o WHERE o_orderpriority LIKE '2%'),
    pairs AS (
        SELECT p.o_orderkey AS id, p.o_orderstatus AS mine, c.o_orderstatus AS other FROM p JOIN c ON p.o_custkey = c.o_custkey AND p.yr = c.yr AND p.o_orderkey <> c.o_orderkey
        QUALIFY row_number() OVER (PARTITION BY p.o_orderkey ORDER BY c.o_orderkey) = 1
    )
    SELECT id, CASE WHEN mine <> other THEN 'mismatch' ELSE 'match' END AS status,
        CASE WHEN mine <> other THEN '{"o_orderstatus":{"previous_period_reading":"' || mine || '","adjacent_filing_reading":"' || other || '"}}' END AS payload
    FROM pairs
""")
def overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as periods: priority 1 is the previous role, priority 2 the current one."""
    role = F.when(F.col("o_orderpriority").startswith("1"), "previous").when(F.col("o_orderpriority").startswith("2"), "current")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("document_id"), F.col("o_custkey").alias("company_number"), role.alias("period_type"),
        F.year("o_orderdate").alias("period_end_on"), "o_orderstatus",
    )
    return timeseries.overlap(rows, ["o_orderstatus"])


@query("""
    SELECT c_custkey, max(o_totalprice) AS turnover FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = c_custkey AND x.o_orderpriority LIKE '1%')
    GROUP BY ALL
""")
def anti_join_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    done = orders.where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    queue = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").join(done, "c_custkey", "left_anti")
    return queue.join(orders, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey").agg(F.max("o_totalprice").alias("turnover"))


@query("""
    SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS "view",
        max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase
    FROM events GROUP BY 1 HAVING max(CASE WHEN event_type = 'click' THEN value END) <> 0
""")
def eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("signal_key"), F.col("value").alias("signal_real"), F.lit(None).cast("bigint").alias("signal_int"))
    return upsert.from_signals(signals, "user_id", numbers=["click", "view", "purchase"]).where("click <> 0")


@query("""
    SELECT c_custkey, 'c_acctbal' AS signal_key, 'signal_real' AS signal_type, NULL::BIGINT AS signal_int, c_acctbal AS signal_real, NULL::VARCHAR AS signal_text FROM customer
    UNION ALL SELECT c_custkey, 'c_nationkey', 'signal_int', c_nationkey, NULL, NULL FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', 'signal_text', NULL, NULL, c_mktsegment FROM customer
""")
def eav_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.to_signals(table(spark, sf_dir, "customer"), "c_custkey", ["c_acctbal", "c_nationkey", "c_mktsegment"]).drop("signal_bool")


@query("""
    WITH base AS (SELECT user_id, event_id, ts, event_type FROM events WHERE event_type IN ('signup', 'view')),
    old AS (SELECT * FROM base WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    new AS (SELECT * FROM base WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_id, o.event_id) AS event_id, coalesce(o.ts, n.ts) AS created_at, coalesce(n.event_type, o.event_type) AS event_type
    FROM old o FULL JOIN new n USING (user_id)
""")
def upsert_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("created_at"), "event_type")
    old = upsert.latest_by(events.where("event_type = 'signup'"), ["user_id"], [F.asc("created_at"), F.asc("event_id")])
    return upsert.upsert(old, events.where("event_type = 'view'"), ["user_id"], keep=["created_at"], order=[F.desc("created_at"), F.desc("event_id")])


@query("""
    SELECT 'customers' AS measure, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lines', count(*) FROM lineitem UNION ALL SELECT 'open_orders', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'error_events', count(*) FROM events WHERE event_type = 'error'
""")
def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.lit(True)
    return leads.measures(
        [
            (table(spark, sf_dir, "customer"), {"customers": every}), (table(spark, sf_dir, "lineitem"), {"lines": every}),
            (table(spark, sf_dir, "orders"), {"orders": every, "open_orders": F.col("o_orderstatus") == "O"}),
            (table(spark, sf_dir, "events"), {"events": every, "error_events": F.col("event_type") == "error"}),
        ]
    )


@query("""
    WITH u AS (SELECT user_id, bool_or(event_type = 'purchase') AS p, bool_or(event_type = 'signup') AS s FROM events GROUP BY 1)
    SELECT count(*) AS users, count(*) FILTER (p AND s) AS both_, count(*) FILTER (p AND NOT s) AS purchase_only FROM u
""")
def group_having_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("p"), F.bool_or(F.col("event_type") == "signup").alias("s"))
    return users.agg(F.count("*").alias("users"), F.count_if(F.col("p") & F.col("s")).alias("both_"), F.count_if(F.col("p") & ~F.col("s")).alias("purchase_only"))


@query("""
    WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT user_id, day, sum(n) AS total FROM c GROUP BY ALL)
    SELECT user_id, day, event_type AS majority FROM c JOIN t USING (user_id, day) WHERE n >= 2 AND n > total - n
""")
def majority_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return evidence.majority(events, ["user_id", "day"], "event_type").withColumnRenamed("event_type", "majority")


@query("""
    SELECT o_custkey, min(o_orderstatus) AS status FROM orders WHERE o_totalprice > 100000 GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1
""")
def unanimous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_totalprice > 100000")
    return evidence.unanimous(rows, ["o_custkey"], "o_orderstatus").withColumnRenamed("o_orderstatus", "status")


@query("""
    WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tier FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus, tier FROM t QUALIFY tier = min(tier) OVER (PARTITION BY o_custkey, o_orderstatus)
""")
def min_tier_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"))
    return evidence.of_least_tier(rows, ["o_custkey", "o_orderstatus"])


@query("""
    WITH t AS (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN 'Group' WHEN 'O' THEN 'Company' ELSE 'Unknown' END AS scope,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tier FROM orders),
    w AS (SELECT *, min(CASE WHEN scope = 'Group' THEN tier END) OVER (PARTITION BY o_custkey) AS g, min(CASE WHEN scope = 'Company' THEN tier END) OVER (PARTITION BY o_custkey) AS c FROM t)
    SELECT o_orderkey, o_custkey, scope, tier FROM w
    WHERE NOT coalesce(CASE scope WHEN 'Company' THEN g <= 2 WHEN 'Group' THEN NOT coalesce(g <= 2, false) AND tier >= c END, false)
""")
def scope_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = F.when(F.col("o_orderstatus") == "F", "Group").when(F.col("o_orderstatus") == "O", "Company").otherwise("Unknown")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", scope.alias("scope"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"))
    return evidence.preferred_scope(rows, ["o_custkey"])


@query(f"""
    WITH {YEARLY_SQL}, a AS (SELECT * FROM yearly WHERE yr = 1996), b AS (SELECT * FROM yearly WHERE yr = 1995)
    SELECT o_custkey, coalesce(a.turnover, b.turnover) AS current_value, coalesce(b.turnover, a.turnover) AS previous_value,
        a.turnover IS NULL OR b.turnover IS NULL AS completed
    FROM a FULL JOIN b USING (o_custkey)
""")
def paired_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = yearly(spark, sf_dir).where("yr in (1995, 1996)").select("o_custkey", F.when(F.col("yr") == 1996, "current").otherwise("previous").alias("period"), "turnover")
    return evidence.completed_pairs(rows, ["o_custkey"], "period", "turnover")


@query("""
    WITH d AS (SELECT l.doc_id, quality, CAST(n_chars > 500 AS INTEGER) AS predicted FROM labels l JOIN documents USING (doc_id))
    SELECT count(*) AS cells, count(*) FILTER (quality = 1 AND predicted = 1) AS tp, count(*) FILTER (quality = 0 AND predicted = 1) AS fp,
        count(*) FILTER (quality = 1 AND predicted = 0) AS fn,
        round(count(*) FILTER (quality = 1 AND predicted = 1) / nullif(count(*) FILTER (quality = 1), 0), 6) AS recall,
        round(count(*) FILTER (quality = 1 AND predicted = 1) / nullif(count(*) FILTER (predicted = 1), 0), 6) AS precision_
    FROM d
""")
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 500).alias("predicted"))
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    amount = lambda there: F.struct(F.lit("GBP").alias("code"), F.when(there, F.lit(1).cast("decimal(38,6)")).alias("amount"))
    cell = [F.col("doc_id").alias("case_id"), F.lit("current").alias("period"), F.lit("quality").alias("metric")]
    gold, found = rows.select(*cell, amount(F.col("quality") == 1).alias("value")), rows.select(*cell, amount(F.col("predicted")).alias("value"))
    summary = scoring.cell_summary(scoring.cells(gold, found), ["metric"])
    counts = {"tp": "true_positives", "fp": "false_positives", "fn": "false_negatives"}
    return summary.select("cells", *[F.col(c).alias(n) for n, c in counts.items()], F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision_"))


@query("""
    SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1
""")
def percentile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arithmetic.percentiles(table(spark, sf_dir, "events"), "event_type", "value", {"median": 0.5, "p95": 0.95})


@query("""
    WITH s AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS round, count(*) OVER (PARTITION BY lang, source) AS size FROM documents)
    SELECT doc_id, lang, source, CAST(round AS INTEGER) AS round FROM s ORDER BY round, size DESC, lang, source, doc_id LIMIT 50
""")
def stratified_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sampling.round_robin(docs, ["lang", "source"], "doc_id", 50).select("doc_id", "lang", "source", "round")


@query("""
    SELECT doc_id FROM documents QUALIFY (row_number() OVER (PARTITION BY lang ORDER BY doc_id)) % 3 = 1
""")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.every_nth(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 3).select("doc_id")


@query("""
    WITH p AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS n, role FROM conversations)
    SELECT DISTINCT conv_id, unnest(range(greatest(0, turn - 1), least(n, turn + 1) + 1)) AS turn FROM p WHERE role = 'user'
""")
def page_neighbour_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("n", F.max("turn").over(Window.partitionBy("conv_id"))).where("role = 'user'")
    return evidence.with_neighbours(rows, ["conv_id"], "turn", "n", first=0)


@query("""
    WITH h AS (SELECT user_id, event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL)
    SELECT event_type, hour, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY ALL
""")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyfold.streaming import monitor

    return monitor.tumbling_counts(table(spark, sf_dir, "events").select("ts", "event_type"), "1 hour").select("event_type", F.col("window.start").cast("timestamp_ntz").alias("hour"), "n")


@query("""
    SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS in_window FROM events
""")
def rate_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyfold.streaming import monitor

    return monitor.calls_in_window(table(spark, sf_dir, "events"), "event_type", "ts", 3_600_000_000).select("event_id", "in_window")


STREAK_SQL = """
    h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS done, count(*) FILTER (event_type = 'error') AS errors, max(ts) AS last_at FROM events GROUP BY 1),
    d AS (SELECT *, errors - lag(errors) OVER (ORDER BY hour) AS error_change, errors >= coalesce(lag(errors) OVER (ORDER BY hour), 0) AS no_better FROM h),
    g AS (SELECT *, count(*) FILTER (NOT no_better) OVER (ORDER BY hour ROWS UNBOUNDED PRECEDING) AS island FROM d)
"""


@query(f"""
    WITH {STREAK_SQL}
    SELECT hour, done, errors, error_change, CASE WHEN no_better THEN count(*) FILTER (no_better) OVER (PARTITION BY island ORDER BY hour ROWS UNBOUNDED PRECEDING) ELSE 0 END AS streak
    FROM g
""")
def streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyfold.streaming import monitor

    hours = monitor.hourly_snapshots(table(spark, sf_dir, "events"))
    return monitor.error_streaks(hours).select(F.col("hour").cast("timestamp_ntz").alias("hour"), "done", "errors", "error_change", "streak")
