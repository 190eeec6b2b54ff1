"""Rule engines of the engine over the star-schema tables: filters, scores, searches, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.functions import arithmetic
from tallyfold.operators import leads, triage
from tallyfold.plans.registry import query, table

#: The register's columns made from customers: segment to industry and category, balance to charges, nation to country.
REGISTER_SQL = """
    first_orders AS (SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at FROM orders GROUP BY 1),
    register AS (
        SELECT c_custkey, c_name AS name,
            CASE WHEN c_custkey % 11 = 0 THEN 'Liquidation' WHEN c_custkey % 13 = 0 THEN '' ELSE 'Active' END AS status,
            CASE WHEN c_mktsegment = 'FURNITURE' THEN 'PRI/LTD BY GUAR' ELSE 'Private Limited Company' END AS category,
            CASE c_custkey % 5 WHEN 0 THEN 'DORMANT' WHEN 1 THEN 'full' WHEN 2 THEN 'GROUP' ELSE 'MICRO ENTITY' END AS accounts,
            CASE c_custkey % 4 WHEN 0 THEN '47910 - Retail' WHEN 1 THEN '41100 - Property' WHEN 2 THEN '62020 - Consultancy' ELSE '01110 - Crops' END AS sic1,
            CASE WHEN c_custkey % 3 = 0 THEN '62012 - Software' ELSE '' END AS sic2,
            strftime(first_at, '%d/%m/%Y') AS incorporated, strftime(last_at, '%Y-%m-%d') AS made_up,
            CAST(CASE WHEN c_acctbal < 0 THEN 2 ELSE 0 END AS VARCHAR) AS charges,
            CASE WHEN c_nationkey < 12 THEN 'ENGLAND' ELSE 'FRANCE' END AS country, 'Town' AS town
        FROM customer LEFT JOIN first_orders ON o_custkey = c_custkey
    ),
    dated AS (
        SELECT *, (DATE '2004-06-30' - strptime(incorporated, '%d/%m/%Y')::DATE) / 365.25::DOUBLE AS age,
            (DATE '2004-06-30' - made_up::DATE) / 365.25::DOUBLE AS stale, (DATE '2004-06-30' - made_up::DATE) / 30.0::DOUBLE AS months,
            substr(sic1, 1, 5) AS code
        FROM register
    ),
    judged AS (
        SELECT *, CASE
            WHEN status IN ('Liquidation', '') THEN 'status:' || status
            WHEN category <> 'Private Limited Company' THEN 'category:' || category
            WHEN accounts = 'DORMANT' THEN 'accounts:DORMANT'
            WHEN code NOT IN ('47910', '41100', '62020') THEN 'sic:not_target'
            WHEN age IS NULL OR age < 3 THEN 'too_young'
            WHEN stale IS NULL OR stale > 3 THEN 'stale_accounts' ELSE 'ok' END AS reason
        FROM dated
    )
"""

REGISTER = leads.Register("name", "status", "category", "accounts", "made_up", "incorporated", ("sic1", "sic2"), "town", "country", "charges")


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of the bulk register, every column text."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"))
    rows = table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    k = F.col("c_custkey")
    return rows.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.when(k % 11 == 0, "Liquidation").when(k % 13 == 0, "").otherwise("Active").alias("status"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "PRI/LTD BY GUAR").otherwise("Private Limited Company").alias("category"),
        F.when(k % 5 == 0, "DORMANT").when(k % 5 == 1, "full").when(k % 5 == 2, "GROUP").otherwise("MICRO ENTITY").alias("accounts"),
        F.when(k % 4 == 0, "47910 - Retail").when(k % 4 == 1, "41100 - Property").when(k % 4 == 2, "62020 - Consultancy").otherwise("01110 - Crops").alias("sic1"),
        F.when(k % 3 == 0, "62012 - Software").otherwise("").alias("sic2"),
        F.date_format("first_at", "dd/MM/yyyy").alias("incorporated"),
        F.date_format("last_at", "yyyy-MM-dd").alias("made_up"),
        F.when(F.col("c_acctbal") < 0, "2").otherwise("0").alias("charges"),
        F.when(F.col("c_nationkey") < 12, "ENGLAND").otherwise("FRANCE").alias("country"),
        F.lit("Town").alias("town"),
    )


def as_of() -> Column:
    return F.to_date(F.lit("2004-06-30"))


@query(f"WITH {REGISTER_SQL} SELECT c_custkey, reason FROM judged")
def lead_hard_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register(spark, sf_dir).select("c_custkey", leads.first_failure(as_of(), REGISTER).alias("reason"))


@query(f"""
    WITH {REGISTER_SQL}, s AS (
        SELECT c_custkey, [
            CASE code WHEN '47910' THEN {{'p': 30, 'r': 'tier-1 SIC'}} WHEN '41100' THEN {{'p': 20, 'r': 'tier-2 SIC'}} WHEN '62020' THEN {{'p': 10, 'r': 'tier-3 SIC'}} END,
            CASE WHEN sic2 <> '' THEN {{'p': 5, 'r': 'multi-SIC'}} END,
            CASE WHEN age BETWEEN 3 AND 10 THEN {{'p': 15, 'r': 'sweet-spot age ' || round_even(CAST(age AS DECIMAL(20,12)), 1)::DECIMAL(20,1) || 'yr'}}
                 WHEN age > 10 THEN {{'p': 8, 'r': 'established ' || round_even(CAST(age AS DECIMAL(20,12)), 1)::DECIMAL(20,1) || 'yr'}} END,
            CASE WHEN months <= 18 THEN {{'p': 10, 'r': 'accounts <18mo'}} WHEN months <= 36 THEN {{'p': 5, 'r': 'accounts <36mo'}} END,
            CASE WHEN upper(accounts) IN ('FULL', 'GROUP') THEN {{'p': 10, 'r': 'acct:' || lower(accounts)}} END,
            CASE WHEN country = 'ENGLAND' THEN {{'p': 5, 'r': 'GB address'}} END,
            {{'p': 5, 'r': 'non-shell name'}},
            CASE WHEN charges = '0' THEN {{'p': 5, 'r': 'no charges'}} END] AS parts
        FROM judged
    )
    SELECT c_custkey, CAST(list_sum(list_transform(list_filter(parts, lambda x: x IS NOT NULL), lambda x: x.p)) AS INTEGER) AS lead_score,
        array_to_string(list_transform(list_filter(parts, lambda x: x IS NOT NULL), lambda x: x.r), '|') AS score_reasons
    FROM s
""")
def lead_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = leads.score_leads(register(spark, sf_dir), as_of(), REGISTER)
    return scored.select("c_custkey", "lead_score", F.array_join("score_reasons", "|").alias("score_reasons"))


@query(f"WITH {REGISTER_SQL} SELECT reason, count(*) AS n FROM judged GROUP BY 1")
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.drop_reasons(register(spark, sf_dir).withColumn("reason", leads.first_failure(as_of(), REGISTER)))


@query("""
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE (contains(lower(c_name), '7') OR contains(CAST(c_custkey AS VARCHAR), '7')) AND c_acctbal >= 1000
        AND c_mktsegment IN ('BUILDING', 'MACHINERY')
    ORDER BY c_acctbal DESC, c_name, c_custkey LIMIT 100
""")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leads.matching(table(spark, sf_dir, "customer"), "7", 1000, ["BUILDING", "MACHINERY"], name="c_name", number="c_custkey", score="c_acctbal", status="c_mktsegment")
    return leads.top(found, [F.desc("c_acctbal"), F.asc("c_name"), F.asc("c_custkey")], 500).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def bounded_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.top(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 1000)


@query("""
    WITH s AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t, count(*) FILTER (o_orderstatus = 'F') AS e FROM orders GROUP BY 1),
    j AS (SELECT c_custkey, c_name, c_mktsegment, CAST(t AS DOUBLE) AS turnover, CASE WHEN c_custkey % 3 > 0 THEN e END AS employees FROM customer LEFT JOIN s ON o_custkey = c_custkey),
    r AS (SELECT *, CASE
        WHEN c_mktsegment = 'MACHINERY' THEN 'non_trading' WHEN turnover IS NULL AND employees IS NULL THEN 'unknown'
        WHEN coalesce(turnover, 0) <= 0 AND employees = 0 THEN 'dormant' WHEN turnover > 0 AND employees = 0 THEN 'unknown' ELSE 'trading' END AS status FROM j)
    SELECT c_custkey, status, CASE WHEN turnover > 0 AND employees > 0 THEN CAST(trunc(turnover / employees) AS BIGINT) END AS revenue_per_employee FROM r
""")
def triage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(arithmetic.exact_sum(F.col("o_totalprice")).alias("turnover"), F.count_if(F.col("o_orderstatus") == "F").alias("e"))
    rows = table(spark, sf_dir, "customer").join(sums, F.col("o_custkey") == F.col("c_custkey"), "left")
    employees = F.when(F.col("c_custkey") % 3 > 0, F.col("e"))
    filed = F.when(F.col("c_mktsegment") == "MACHINERY", "dissolved").otherwise("active")
    status = triage.trading_status(F.col("c_name"), filed, F.lit("47910"), F.col("turnover"), employees, F.lit(False))
    return rows.select("c_custkey", status["status"].alias("status"), arithmetic.whole_ratio(F.col("turnover"), employees).alias("revenue_per_employee"))


@query("""
    WITH s AS (
        SELECT date_trunc('day', ts) AS day, max(ts) AS last_at, count(*) FILTER (event_type = 'purchase') AS fin, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1
    ), w AS (SELECT day, fin > lag(fin) OVER (ORDER BY day) AS up, errors > lag(errors) OVER (ORDER BY day) AS worse FROM s),
    i AS (SELECT *, count(*) FILTER (coalesce(up, true)) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS island FROM w),
    k AS (SELECT *, count(*) FILTER (NOT coalesce(up, true)) OVER (PARTITION BY island ORDER BY day ROWS UNBOUNDED PRECEDING) AS idle FROM i)
    SELECT day, 'errors_increased' AS alert FROM k WHERE worse
    UNION ALL SELECT day, 'no_progress' FROM k WHERE NOT coalesce(up, true) AND idle > 0 AND idle % 2 = 0
""")
def stall_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as snapshots; the queue never empties and never stalls, so streaks and errors remain."""
    from tallyfold.streaming import monitor

    kind = F.col("event_type")
    days = table(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").alias("day")).agg(
        F.max("ts").alias("last_processed_at"), F.count_if(kind == "purchase").alias("with_financials"), F.count_if(kind == "error").alias("errors")
    )
    snapshots = days.withColumns({"taken_at": F.col("last_processed_at"), "pending": F.lit(1)})
    return monitor.alerts(snapshots, "day", 30, 2).select(F.col("day").cast("timestamp_ntz").alias("day"), "alert")
