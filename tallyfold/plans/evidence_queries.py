"""The evidence policy over candidate rows made from order lines, and tagged filings made from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions import money
from tallyfold.operators import evidence, facts, ingestion, narrative
from tallyfold.plans.registry import query, table

#: Order lines as transcribed rows; Spark and DuckDB read it alike.
CANDIDATES = """
    SELECT l_orderkey AS document_id, 'p' || CAST(l_linenumber % 3 AS STRING) || '-r' || CAST(l_linenumber + 10 * l_partkey AS STRING) AS candidate_id, CAST(l_linenumber % 3 AS INT) AS page_pos, CAST(l_linenumber + 10 * l_partkey AS INT) AS row_pos,
        CAST(l_linenumber % 3 AS INT) + 1 AS page,
        CASE l_suppkey % 9 WHEN 0 THEN 'turnover' WHEN 1 THEN 'gross_profit' WHEN 2 THEN 'operating_result' WHEN 3 THEN 'profit_after_tax' WHEN 4 THEN 'net_assets' WHEN 5 THEN 'shareholders_funds'
            WHEN 6 THEN 'net_earned_premiums' WHEN 7 THEN 'claims_incurred_net_reinsurance' ELSE 'employees' END AS metric,
        CASE l_linenumber % 3 WHEN 0 THEN 'income_statement' WHEN 1 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'balance_sheet' ELSE 'income_statement' END ELSE 'other' END AS statement_type,
        CASE l_orderkey % 3 WHEN 0 THEN 'consolidated' WHEN 1 THEN 'Parent company' ELSE 'notes' END AS statement_scope,
        CASE l_partkey % 6 WHEN 0 THEN 'GBP' WHEN 1 THEN 'GBP_THOUSANDS' WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR' WHEN 4 THEN 'GBP' ELSE 'UNKNOWN' END AS unit,
        CASE l_partkey % 10 WHEN 0 THEN 'Turnover' WHEN 1 THEN 'Gross profit' WHEN 2 THEN 'Profit before tax' WHEN 3 THEN 'Group operating profit' WHEN 4 THEN 'Cost of sales'
            WHEN 5 THEN 'Shareholders'' funds' WHEN 6 THEN 'Earned premiums, net of reinsurance' WHEN 7 THEN 'Claims incurred, net of reinsurance' WHEN 8 THEN ' ' ELSE 'Operating profit before exceptional items' END AS source_label,
        CASE WHEN l_returnflag = 'A' THEN '-' WHEN l_linestatus = 'F' THEN '(' || CAST(CAST(l_quantity AS INT) AS STRING) || ')' WHEN l_suppkey % 7 = 0 THEN '2023' WHEN l_suppkey % 7 = 1 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) || ',000' END AS current_display,
        CASE WHEN l_suppkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE CAST(CAST(l_quantity AS INT) + 1 AS STRING) END AS previous_display,
        CAST(l_discount * 10 AS DOUBLE) AS confidence
    FROM {lineitem}
"""
SQL = CANDIDATES.format(lineitem="lineitem")
#: What the rules read, said again for DuckDB.
RULES_SQL = f"""
    c AS ({SQL}),
    l AS (SELECT *, trim(regexp_replace(lower(source_label), '[^a-z0-9]+', ' ', 'g')) AS label, nullif(trim(current_display), '') AS cur, nullif(trim(previous_display), '') AS prev,
        metric <> 'employees' AS is_money FROM c),
    fits AS (SELECT *, CASE metric WHEN 'net_earned_premiums' THEN starts_with(label, 'earned premiums net of reinsurance') WHEN 'claims_incurred_net_reinsurance' THEN starts_with(label, 'claims incurred net of reinsurance') ELSE true END AS insurance_fits,
        CASE metric WHEN 'operating_result' THEN label = 'group operating profit' WHEN 'profit_after_tax' THEN label <> 'profit before tax' ELSE true END AS canonical_fits,
        CASE WHEN statement_type = 'other' THEN true WHEN metric IN ('turnover', 'gross_profit', 'operating_result', 'profit_after_tax') THEN statement_type = 'income_statement' WHEN metric = 'net_assets' THEN statement_type = 'balance_sheet' ELSE true END AS statement_fits
        FROM l)
"""
TIER_SQL = f"""{RULES_SQL}, tiered AS (SELECT *, CASE
        WHEN metric IN ('net_earned_premiums', 'claims_incurred_net_reinsurance') THEN CASE WHEN NOT insurance_fits THEN 'incompatible_insurance_evidence' WHEN statement_type = 'income_statement' THEN 'primary_insurance_income_statement'
            WHEN statement_type = 'other' THEN 'exact_insurance_note' ELSE 'incompatible_insurance_evidence' END
        WHEN metric = 'shareholders_funds' THEN CASE WHEN label = 'shareholders funds' AND statement_type = 'balance_sheet' THEN 'direct_synonym' ELSE 'not_eligible' END
        WHEN NOT canonical_fits THEN 'incompatible_canonical_label' WHEN NOT statement_fits THEN 'incompatible_canonical_statement' WHEN statement_type <> 'other' THEN 'primary_statement' ELSE 'exact_supporting_note' END AS role FROM fits),
    ranked AS (SELECT *, CASE role WHEN 'primary_statement' THEN 1 WHEN 'primary_insurance_income_statement' THEN 2 WHEN 'direct_synonym' THEN 3 WHEN 'exact_insurance_note' THEN 4 WHEN 'exact_supporting_note' THEN 4 ELSE 5 END AS tier FROM tiered)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CANDIDATES, lineitem=table(spark, sf_dir, "lineitem"))


@query(f"""
    WITH {RULES_SQL}, i AS (SELECT document_id, row_pos, list_filter([
        CASE WHEN label = '' THEN 'missing_source_label' END,
        CASE WHEN CASE WHEN is_money THEN cur IS NULL AND prev IS NULL ELSE (cur IS NULL) AND prev IS NULL END THEN 'missing_period_values' END,
        CASE WHEN is_money AND unit NOT IN ('GBP', 'GBP_THOUSANDS', 'USD') THEN 'unknown_money_unit' END,
        CASE WHEN NOT insurance_fits THEN 'insurance_metric_label_conflict' END,
        CASE WHEN metric IN ('turnover', 'gross_profit', 'operating_result', 'profit_after_tax', 'net_assets') AND NOT canonical_fits THEN 'metric_label_conflict' END,
        CASE WHEN metric IN ('turnover', 'gross_profit', 'operating_result', 'profit_after_tax', 'net_assets') AND NOT statement_fits THEN 'metric_statement_conflict' END,
        CASE WHEN cur = '2023' THEN 'year_used_as_value' END,
        CASE WHEN (label = 'cost of sales' AND metric IN ('turnover', 'gross_profit', 'operating_result')) OR (label = 'gross profit' AND metric = 'turnover') THEN 'metric_label_conflict' END], lambda x: x IS NOT NULL) AS issues FROM fits)
    SELECT document_id, row_pos, array_to_string(issues, ',') AS issues FROM i WHERE len(issues) > 0
""")
def evidence_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = evidence.validated(candidates(spark, sf_dir))[1]
    return rejected.select("document_id", "row_pos", F.array_join(F.col("issues.code"), ",").alias("issues"))


@query(f"""WITH {RULES_SQL} SELECT document_id, page, count(*) AS n FROM fits WHERE label = '' GROUP BY ALL""")
def evidence_issue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evidence.issue_report(evidence.validated(candidates(spark, sf_dir))[1])
    return report.where("code = 'missing_source_label'").drop("code")


@query(f"WITH {TIER_SQL} SELECT document_id, row_pos, role, tier FROM ranked")
def evidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).withColumn("e", evidence.evidence_tier())
    return rows.select("document_id", "row_pos", "e.role", "e.tier")


@query(f"""
    WITH {TIER_SQL}, best AS (SELECT * FROM ranked WHERE tier < 5 QUALIFY row_number() OVER (PARTITION BY document_id, metric ORDER BY tier, (unit <> 'UNKNOWN') DESC,
        (current_display IS NOT NULL)::INT + (previous_display IS NOT NULL)::INT DESC, coalesce(confidence, 0) DESC, page_pos, row_pos) = 1),
    num AS (SELECT *, CASE WHEN cur = '-' THEN 0 WHEN cur LIKE '(%' THEN -TRY_CAST(replace(replace(cur, '(', ''), ')', '') AS BIGINT) ELSE TRY_CAST(replace(cur, ',', '') AS BIGINT) END AS v FROM ranked)
    SELECT document_id, candidate_id, metric, tier, NULL AS derived_from, current_display FROM ranked
    UNION ALL SELECT document_id, candidate_id || ':net_assets', 'net_assets', 2, candidate_id, current_display FROM best WHERE metric = 'shareholders_funds'
    UNION ALL SELECT p.document_id, p.candidate_id || '+' || c.candidate_id, 'gross_profit', p.tier, p.candidate_id || '+' || c.candidate_id,
        CASE WHEN p.v + c.v < 0 THEN '(' || format('{{:,}}', abs(p.v + c.v)) || ')' ELSE format('{{:,}}', p.v + c.v) END
        FROM num p JOIN num c ON p.document_id = c.document_id AND p.page = c.page AND p.statement_scope = c.statement_scope AND p.unit = c.unit AND p.tier = c.tier
        WHERE p.metric = 'net_earned_premiums' AND c.metric = 'claims_incurred_net_reinsurance'
""")
def evidence_equivalents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.with_equivalents(candidates(spark, sf_dir), ["document_id"])
    return found.select("document_id", "candidate_id", "metric", "tier", "derived_from", "current_display")


@query(f"""
    WITH {TIER_SQL}, scoped AS (SELECT * REPLACE (CASE WHEN row_pos % 4 = 3 THEN 'segment' WHEN statement_scope = 'consolidated' THEN 'consolidated_group' WHEN statement_scope = 'Parent company' THEN 'company' ELSE 'unknown' END AS statement_scope) FROM ranked), known AS (SELECT * FROM scoped WHERE statement_scope IN ('consolidated_group', 'company', 'unknown')),
    best AS (SELECT * FROM known WHERE tier < 5 QUALIFY row_number() OVER (PARTITION BY document_id, statement_scope, metric ORDER BY tier, (unit <> 'UNKNOWN') DESC,
        (current_display IS NOT NULL)::INT + (previous_display IS NOT NULL)::INT DESC, coalesce(confidence, 0) DESC, page_pos, row_pos) = 1),
    num AS (SELECT *, CASE WHEN cur = '-' THEN 0 WHEN cur LIKE '(%' THEN -TRY_CAST(replace(replace(cur, '(', ''), ')', '') AS BIGINT) ELSE TRY_CAST(replace(cur, ',', '') AS BIGINT) END AS v FROM known)
    SELECT document_id, candidate_id, metric, CASE WHEN statement_scope <> 'segment' THEN tier END AS tier, NULL AS derived_from, current_display FROM scoped
    UNION ALL SELECT document_id, candidate_id || ':net_assets', 'net_assets', 2, candidate_id, current_display FROM best WHERE metric = 'shareholders_funds'
    UNION ALL SELECT p.document_id, p.candidate_id || '+' || c.candidate_id, 'gross_profit', p.tier, p.candidate_id || '+' || c.candidate_id,
        CASE WHEN p.v + c.v < 0 THEN '(' || format('{{:,}}', abs(p.v + c.v)) || ')' ELSE format('{{:,}}', p.v + c.v) END
        FROM num p JOIN num c ON p.document_id = c.document_id AND p.page = c.page AND p.statement_scope = c.statement_scope AND p.unit = c.unit AND p.tier = c.tier
        WHERE p.metric = 'net_earned_premiums' AND c.metric = 'claims_incurred_net_reinsurance'
""")
def evidence_scope_equivalents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equivalents within each scope; rows of a segment have none."""
    rows = candidates(spark, sf_dir).withColumn("statement_scope", F.when(F.col("row_pos") % 4 == 3, "segment").otherwise(evidence.statement_scope(F.col("statement_scope"))))
    found = evidence.with_scope_equivalents(rows, ["document_id"])
    return found.select("document_id", "candidate_id", "metric", "tier", "derived_from", "current_display")


@query(f"""
    WITH {TIER_SQL}, m AS (SELECT *, min(tier) FILTER (current_display IS NOT NULL) OVER (PARTITION BY document_id, metric) AS c0, min(tier) FILTER (previous_display IS NOT NULL) OVER (PARTITION BY document_id, metric) AS p0 FROM ranked),
    s AS (SELECT document_id, candidate_id, metric, CASE WHEN tier = c0 THEN current_display END AS current_display, CASE WHEN tier = p0 THEN previous_display END AS previous_display FROM m)
    SELECT * FROM s WHERE current_display IS NOT NULL OR previous_display IS NOT NULL
""")
def evidence_strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).withColumn("e", evidence.evidence_tier()).withColumn("tier", F.col("e.tier"))
    return evidence.strongest(rows, ["document_id"]).select("document_id", "candidate_id", "metric", "current_display", "previous_display")


@query(f"""
    WITH c AS ({SQL}), p AS (SELECT document_id, page, count(*) FILTER (metric IN ('turnover', 'gross_profit', 'operating_result', 'profit_after_tax', 'net_earned_premiums', 'claims_incurred_net_reinsurance')) AS income,
        count(DISTINCT metric) FILTER (metric IN ('net_assets', 'shareholders_funds')) AS balance FROM c GROUP BY ALL)
    SELECT document_id, row_pos, CASE WHEN statement_type = 'income_statement' AND income = 0 AND balance >= 2 THEN 'balance_sheet' ELSE statement_type END AS statement_type,
        CASE statement_scope WHEN 'consolidated' THEN 'consolidated_group' WHEN 'Parent company' THEN 'company' ELSE 'unknown' END AS scope
    FROM c JOIN p USING (document_id, page)
""")
def evidence_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evidence.corrected_statement(candidates(spark, sf_dir), ["document_id", "page"])
    return rows.select("document_id", "row_pos", "statement_type", evidence.statement_scope(F.col("statement_scope")).alias("scope"))


@query(f"""
    WITH c AS ({SQL}), pages AS (SELECT DISTINCT document_id, page, CASE WHEN unit <> 'UNKNOWN' THEN substr(unit, 1, 3) END AS code FROM c WHERE statement_type <> 'other'),
    n AS (SELECT document_id, code, count(*) AS n FROM pages WHERE code IS NOT NULL GROUP BY ALL),
    maj AS (SELECT document_id, max_by(code, n) AS code FROM n GROUP BY 1 HAVING max(n) >= 2 AND max(n) > sum(n) - max(n))
    SELECT document_id, row_pos, CASE WHEN unit <> 'UNKNOWN' AND code IS NOT NULL THEN code || substr(unit, 4) ELSE unit END AS unit FROM c LEFT JOIN maj USING (document_id)
""")
def evidence_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.in_majority_currency(candidates(spark, sf_dir)).select("document_id", "row_pos", "unit")



@query(f"""
    WITH c AS ({SQL}), located AS (SELECT document_id, page, min(statement_type) AS statement_type, 2 AS page_count, bool_or(metric = 'employees') AS direct FROM c GROUP BY ALL),
    inside AS (SELECT * FROM located WHERE page BETWEEN 1 AND page_count),
    m AS (SELECT *, count(*) FILTER (direct) OVER (PARTITION BY document_id) AS d, count(*) FILTER (statement_type <> 'other') OVER (PARTITION BY document_id) AS p FROM inside)
    SELECT document_id, page, statement_type <> 'other' AS is_primary, CASE WHEN d > 0 THEN direct ELSE p > 0 AND statement_type = 'other' END AS is_employee FROM m
""")
def evidence_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = candidates(spark, sf_dir).groupBy("document_id", "page").agg(F.min("statement_type").alias("statement_type"), F.lit(2).alias("page_count"), F.bool_or(F.col("metric") == "employees").alias("contains_employee_count"))
    primary = evidence.primary_pages(located).select("document_id", "page", F.lit(True).alias("a"))
    people = evidence.employee_pages(located, ["document_id"]).select("document_id", "page", F.lit(True).alias("b"))
    rows = located.where("page <= page_count").join(primary, ["document_id", "page"], "left").join(people, ["document_id", "page"], "left")
    return rows.select("document_id", "page", F.col("a").isNotNull().alias("is_primary"), F.col("b").isNotNull().alias("is_employee"))


@query(f"""
    WITH c AS ({SQL}), located AS (SELECT document_id, page, min(statement_type) AS statement_type, max(confidence) AS confidence FROM c GROUP BY ALL),
    f AS (SELECT document_id, page, bool_or(metric = 'turnover') AS t, bool_or(metric = 'gross_profit') AS g, bool_or(metric = 'operating_result') AS o, bool_or(metric = 'profit_after_tax') AS a,
        bool_or(metric IN ('turnover', 'gross_profit', 'operating_result', 'profit_after_tax', 'net_earned_premiums', 'claims_incurred_net_reinsurance')) AS inc,
        count(DISTINCT metric) FILTER (metric IN ('net_assets', 'shareholders_funds')) AS nb,
        bool_or(metric = 'net_assets' OR (metric = 'shareholders_funds' AND source_label = 'Shareholders'' funds')) AS eq, bool_or(metric <> 'employees') AS mon FROM c GROUP BY ALL),
    j AS (SELECT l.document_id, l.page, f.*, CASE WHEN statement_type = 'income_statement' AND NOT inc AND nb >= 2 THEN 'balance_sheet' ELSE statement_type END AS kind FROM located l JOIN f USING (document_id, page) WHERE confidence >= 0.3),
    r AS (SELECT document_id, page, list_filter([CASE WHEN kind = 'income_statement' AND (t OR g OR o OR a) AND NOT (t AND g AND o AND a) THEN 'income_statement_partial_core_family' END,
        CASE WHEN kind = 'balance_sheet' AND NOT eq THEN 'balance_sheet_missing_net_assets' END, CASE WHEN kind = 'balance_sheet' AND mon THEN 'balance_sheet_missing_cash' END], lambda x: x IS NOT NULL) AS triggers FROM j),
    w AS (SELECT *, CASE WHEN list_contains(triggers, 'balance_sheet_missing_net_assets') THEN 0 WHEN list_contains(triggers, 'balance_sheet_missing_cash') THEN 1 ELSE 3 END AS worst FROM r WHERE len(triggers) > 0)
    SELECT document_id, page, array_to_string(triggers, ',') AS triggers FROM w QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY worst, page) <= 2
""")
def evidence_recovery_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    located = rows.groupBy("document_id", "page").agg(F.min("statement_type").alias("statement_type"), F.max("confidence").alias("confidence"))
    found = evidence.recovery_pages(rows.drop("statement_type", "confidence"), located, ["document_id"], 0.3, 2)
    return found.select("document_id", "page", F.array_join("triggers", ",").alias("triggers"))


VALUE_SQL = "CASE WHEN {0} = '-' THEN 0 WHEN {0} LIKE '(%' THEN -TRY_CAST(replace(replace({0}, '(', ''), ')', '') AS BIGINT) ELSE TRY_CAST(replace({0}, ',', '') AS BIGINT) END"


@query(f"""
    WITH c AS ({SQL}), d AS (SELECT document_id, metric, candidate_id, unnest(['current', 'previous']) AS period FROM c WHERE row_pos % 2 = 1),
    v AS (SELECT c.*, {VALUE_SQL.format('current_display')} AS cv, {VALUE_SQL.format('previous_display')} AS pv FROM c),
    j AS (SELECT period, v.*, CASE period WHEN 'current' THEN current_display ELSE previous_display END AS shown, CASE period WHEN 'current' THEN cv ELSE pv END AS amount FROM d JOIN v USING (document_id, metric, candidate_id)),
    b AS (SELECT * FROM j WHERE shown IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id, period, metric ORDER BY 9 - page_pos DESC, (unit <> 'UNKNOWN') DESC,
        (current_display IS NOT NULL)::INT + (previous_display IS NOT NULL)::INT DESC, coalesce(confidence, 0) DESC, page_pos, row_pos) = 1)
    SELECT document_id, period, metric, candidate_id, CASE WHEN metric <> 'employees' AND unit <> 'UNKNOWN' THEN CAST(amount * CASE WHEN unit LIKE '%THOUSANDS' THEN 1000 ELSE 1 END AS DOUBLE) END AS reported_value,
        CASE WHEN metric <> 'employees' AND unit LIKE 'GBP%' THEN amount * CASE WHEN unit LIKE '%THOUSANDS' THEN 100000 ELSE 100 END END AS value_pence,
        CASE WHEN metric = 'employees' THEN amount END AS value_count
    FROM b
""")
def evidence_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other row is decided for; the page stands for the tier."""
    rows = candidates(spark, sf_dir).withColumn("tier", F.col("page_pos"))
    decisions = rows.where("row_pos % 2 = 1").select("document_id", "metric", "candidate_id", F.explode(F.array(F.lit("current"), F.lit("previous"))).alias("period"))
    found = evidence.selected(rows, decisions, ["document_id"])
    return found.select("document_id", "period", "metric", "candidate_id", F.col("reported_value").cast("double").alias("reported_value"), "value_pence", "value_count")


@query(f"""
    WITH c AS ({SQL}), o AS (SELECT *, trim(regexp_replace(lower(source_label), '[^a-z0-9]+', ' ', 'g')) AS label FROM c WHERE row_pos % 10 <= 3), r AS (SELECT *, trim(regexp_replace(lower(source_label), '[^a-z0-9]+', ' ', 'g')) AS label FROM c WHERE row_pos % 10 > 3)
    SELECT 'row' AS kind, document_id, candidate_id, NULL AS had FROM o
    UNION ALL SELECT 'row', document_id, candidate_id, NULL FROM r WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.document_id = r.document_id AND o.metric = r.metric AND o.label = r.label)
    UNION ALL SELECT 'conflict', r.document_id, r.candidate_id, o.current_display FROM r JOIN o ON o.document_id = r.document_id AND o.metric = r.metric AND o.label = r.label
        WHERE o.current_display IS DISTINCT FROM r.current_display OR o.previous_display IS DISTINCT FROM r.previous_display
""")
def evidence_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    merged, conflicts = evidence.with_recovered(rows.where("row_pos % 10 <= 3"), rows.where("row_pos % 10 > 3"), ["document_id"])
    told = conflicts.select(F.lit("conflict").alias("kind"), "document_id", "candidate_id", F.col("had_current").alias("had"))
    return merged.select(F.lit("row").alias("kind"), "document_id", "candidate_id", F.lit(None).cast("string").alias("had")).unionByName(told)


@query(f"""
    WITH c AS ({SQL}), calls AS (SELECT document_id, page, row_pos % 2 AS call_seq, count(*) AS n FROM c GROUP BY ALL),
    best AS (SELECT * FROM calls QUALIFY row_number() OVER (PARTITION BY document_id, page ORDER BY n DESC, call_seq DESC) = 1),
    need AS (SELECT DISTINCT document_id, unnest([1, 2, 3]) AS page FROM c)
    SELECT 'best' AS kind, document_id, page, CAST(call_seq AS INTEGER) AS call_seq, CAST(n AS INTEGER) AS n FROM best
    UNION ALL SELECT 'missing', document_id, page, NULL, NULL FROM need WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.document_id = need.document_id AND b.page = need.page)
""")
def evidence_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several transcriptions of a page, and the pages that none returned."""
    rows = candidates(spark, sf_dir)
    calls = rows.groupBy("document_id", "page", (F.col("row_pos") % 2).alias("call_seq")).agg(F.collect_list("row_pos").alias("rows"))
    best = evidence.longest_call(calls, ["document_id"])
    need = rows.select("document_id").distinct().select("document_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("page"))
    gaps = evidence.missing_and_empty(best, need, ["document_id"]).select(F.col("reason").alias("kind"), "document_id", "page", F.lit(None).cast("int").alias("call_seq"), F.lit(None).cast("int").alias("n"))
    return best.select(F.lit("best").alias("kind"), "document_id", "page", F.col("call_seq").cast("int").alias("call_seq"), F.size("rows").alias("n")).unionByName(gaps)


@query(f"""
    WITH {TIER_SQL}, best AS (SELECT * FROM ranked WHERE tier < 5 AND metric = 'shareholders_funds' QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY tier, (unit <> 'UNKNOWN') DESC,
        (current_display IS NOT NULL)::INT + (previous_display IS NOT NULL)::INT DESC, coalesce(confidence, 0) DESC, page_pos, row_pos) = 1)
    SELECT c.document_id, CASE WHEN b.candidate_id IS NOT NULL THEN c.candidate_id || ':net_assets' ELSE c.candidate_id END AS candidate_id, CASE WHEN b.candidate_id IS NOT NULL THEN c.candidate_id END AS canonicalised_from
    FROM ranked c LEFT JOIN best b ON b.document_id = c.document_id AND b.candidate_id = c.candidate_id WHERE c.metric = 'shareholders_funds'
""")
def evidence_choices_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net assets decided for by the row of shareholders' funds that they were made from."""
    rows = evidence.with_equivalents(candidates(spark, sf_dir), ["document_id"])
    decisions = rows.where("metric = 'shareholders_funds' and derived_from is null").select("document_id", F.lit("net_assets").alias("metric"), "candidate_id")
    return evidence.resolved_choices(decisions, rows, ["document_id"]).select("document_id", "candidate_id", "canonicalised_from")


@query(f"""
    WITH c AS ({SQL}), docs AS (SELECT DISTINCT document_id FROM c), cells AS (SELECT document_id, period, metric FROM docs, (SELECT unnest(['current', 'previous']) AS period) p, (SELECT unnest(['turnover', 'gross_profit', 'operating_result', 'profit_after_tax', 'cash', 'net_assets', 'employees']) AS metric) m),
    v AS (SELECT c.*, {VALUE_SQL.format('current_display')} AS cv, {VALUE_SQL.format('previous_display')} AS pv FROM c WHERE page_pos > 0),
    had AS (SELECT document_id, metric, count(*) AS n, count(*) FILTER (cv IS NOT NULL AND (metric = 'employees' OR unit LIKE 'GBP%')) AS nc, count(*) FILTER (pv IS NOT NULL AND (metric = 'employees' OR unit LIKE 'GBP%')) AS np FROM v GROUP BY ALL),
    ref AS (SELECT document_id, metric, count(*) AS rejected FROM c WHERE page_pos = 0 GROUP BY ALL),
    dec AS (SELECT document_id, metric, min(candidate_id) AS candidate_id FROM c WHERE row_pos % 10 = 1 GROUP BY ALL)
    SELECT document_id, period, metric, CASE WHEN period = 'current' AND dec.candidate_id IS NOT NULL THEN 'selected' WHEN coalesce(CASE period WHEN 'current' THEN nc ELSE np END, 0) > 0 THEN 'unselected_despite_usable_candidate'
        WHEN rejected > 0 THEN 'only_rejected_candidates' WHEN n > 0 THEN 'no_usable_candidate' ELSE 'no_candidate_extracted' END AS status,
        CAST(coalesce(CASE period WHEN 'current' THEN nc ELSE np END, 0) AS INTEGER) AS n_usable
    FROM cells LEFT JOIN had USING (document_id, metric) LEFT JOIN ref USING (document_id, metric) LEFT JOIN dec USING (document_id, metric)
""")
def evidence_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    decisions = rows.where("row_pos % 10 = 1").groupBy("document_id", "metric").agg(F.min("candidate_id").alias("candidate_id")).withColumn("period", F.lit("current"))
    found = evidence.selection_diagnostics(rows, rows.where("page_pos > 0"), rows.where("page_pos = 0"), decisions, ["document_id"])
    return found.select("document_id", "period", "metric", "status", F.size("usable_ids").alias("n_usable"))


@query(f"""
    WITH c AS ({SQL}), b AS (SELECT *, row_number() OVER (PARTITION BY document_id, metric ORDER BY (unit <> 'UNKNOWN') DESC, confidence DESC NULLS LAST, row_pos) AS r, {VALUE_SQL.format('current_display')} AS cv FROM c WHERE metric IN ('turnover', 'net_assets')),
    one AS (SELECT *, CASE WHEN unit <> 'UNKNOWN' THEN cv * CASE WHEN unit LIKE '%THOUSANDS' THEN 1000 ELSE 1 END END AS v, CASE WHEN unit <> 'UNKNOWN' THEN substr(unit, 1, 3) END AS code FROM b WHERE r = 1)
    SELECT document_id, CAST(max(v) FILTER (metric = 'turnover') AS DOUBLE) AS turnover, CAST(max(v) FILTER (metric = 'net_assets') AS DOUBLE) AS net_assets,
        CASE WHEN min(code) = max(code) THEN min(code) END AS currency_code
    FROM one GROUP BY 1
""")
def evidence_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the current period as one row per document, with the currency if there is one for all."""
    rows = candidates(spark, sf_dir).where("metric in ('turnover', 'net_assets')").withColumns({
        "period_type": F.lit("current"), "position": F.col("row_pos"), "currency_code": money.currency(F.col("unit")), "reported_value": money.reported_value(F.col("current_display"), F.col("unit")),
    })
    found = ingestion.metric_periods(rows, ["document_id"])
    return found.select("document_id", F.col("turnover").cast("double").alias("turnover"), F.col("net_assets").cast("double").alias("net_assets"), "currency_code")


@query(f"""
    WITH c AS ({SQL}) SELECT document_id, row_pos, CASE WHEN CAST(row_pos AS INTEGER) % 2 = 0 THEN NULL
        WHEN (nullif(trim(current_display), '') IS NULL) <> (nullif(trim(previous_display), '') IS NULL) AND metric <> 'employees' THEN CASE WHEN nullif(trim(current_display), '') IS NOT NULL THEN 'previous' ELSE 'current' END END AS lacks,
        CASE WHEN unit <> 'UNKNOWN' THEN CAST({VALUE_SQL.format('current_display')} * CASE WHEN unit LIKE '%THOUSANDS' THEN 1000 ELSE 1 END AS DOUBLE) END AS reported,
        {VALUE_SQL.format('current_display')} AS people
    FROM c
""")
def evidence_one_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("row_pos") % 2 == 1, "2024")
    rows = candidates(spark, sf_dir).withColumns({"current_column": odd, "previous_column": F.lit("2023")})
    reported, people = money.reported_value(F.col("current_display"), F.col("unit")), money.count_value(F.col("current_display"))
    return rows.select("document_id", "row_pos", evidence.one_sided_row().alias("lacks"), reported.cast("double").alias("reported"), people.alias("people"))


#: Fixed value: prose about employees, by document.
PROSE = ["The company had no employees.", "There were no employees other than the directors in 2021.", "The company had no employees in the prior period either.", "Average number of employees: 12."]


@query(f"""
    WITH e AS (SELECT p_partkey AS id, CASE p_partkey % 4 {' '.join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(PROSE))} END AS prose FROM part)
    SELECT id, CASE WHEN id % 4 IN (0, 3) THEN 'current' ELSE 'both' END AS period_scope, CASE WHEN id % 4 IN (0, 3) THEN NULL ELSE 0 END AS previous_value_count,
        CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN 'ambiguous_narrative_zero_evidence,ambiguous_narrative_zero_evidence' WHEN 2 THEN '' ELSE 'invalid_narrative_zero_evidence' END AS issues
    FROM e
""")
def evidence_narrative_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero told in prose for both periods: what it may count for, and what is wrong with it."""
    k = F.col("p_partkey")
    prose = F.element_at(F.array(*map(F.lit, PROSE)), (k % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select(
        k.alias("id"), F.lit("employees").alias("metric"), prose.alias("evidence_text"), F.lit("both").alias("period_scope"), F.lit("nil").alias("current_display"), F.lit("nil").alias("previous_display"),
        F.lit(0).alias("current_value_count"), F.lit(0).alias("previous_value_count"), F.lit("narrative_zero").alias("current_evidence_kind"), F.lit("narrative_zero").alias("previous_evidence_kind"),
    )
    scoped = evidence.with_narrative_scope(rows)
    return scoped.select("id", "period_scope", "previous_value_count", F.array_join(evidence.narrative_zero_issues(), ",").alias("issues"))


# tagged filings


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a tagged filing of two years: total as turnover, key as net assets, with a fact of another dimension and one that disagrees."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    total = F.floor("o_totalprice").cast("bigint")

    def ctx(name: str, year, segment: str = "") -> F.Column:
        return F.concat(F.lit(f'<xbrli:context id="{name}"><xbrli:entity>{segment}</xbrli:entity><xbrli:period><xbrli:endDate>'), year.cast("string"), F.lit("-12-31</xbrli:endDate></xbrli:period></xbrli:context>"))

    def fact(tag: str, context: str, value, more: str = "") -> F.Column:
        return F.concat(F.lit(f'<ix:nonFraction name="core:{tag}" contextRef="{context}" unitRef="u" {more}>'), value, F.lit("</ix:nonFraction>"))

    head = F.lit('<html><xbrli:unit id="u"><xbrli:measure>iso4217:GBP</xbrli:measure></xbrli:unit>')
    body = F.concat(
        head, ctx("c", y), ctx("p", y - 1), ctx("s", y, "<xbrli:segment>x</xbrli:segment>"), F.lit("<p>Accounts &amp; notes</p>"),
        fact("TurnoverRevenue", "c", F.format_number(total, 0)), fact("TurnoverRevenue", "p", F.format_number(total - k, 0)), fact("TurnoverRevenue", "s", F.lit("1")),
        F.when(k % 2 == 0, fact("Turnover", "c", F.format_number(total + 1, 0))).otherwise(""),
        fact("NetAssetsLiabilities", "c", k.cast("string"), 'scale="3" sign="-"'), fact("NetAssetsLiabilities", "p", F.lit("-")),
        fact("AverageNumberEmployeesDuringPeriod", "c", (k % 7).cast("string"), 'scale="-2"'), F.lit("</html>"),
    )
    return table(spark, sf_dir, "orders").select(k.alias("document_id"), F.col("o_custkey").cast("string").alias("company_number"), body.alias("xhtml"))


FILINGS_SQL = "f AS (SELECT o_orderkey AS document_id, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(floor(o_totalprice) AS BIGINT) AS total, o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS company_number FROM orders)"


@query(f"""
    WITH {FILINGS_SQL} SELECT document_id, 'current' AS period_type, y AS financial_year, y || '-12-31' AS metric_date, CASE WHEN k % 2 = 1 THEN CAST(total AS DOUBLE) END AS turnover, CAST(-1000 * k AS DOUBLE) AS net_assets, CAST(k % 7 AS DOUBLE) AS employees FROM f
    UNION ALL SELECT document_id, 'previous', y - 1, (y - 1) || '-12-31', CAST(total - k AS DOUBLE), 0.0::DOUBLE, NULL FROM f
""")
def facts_year_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of both years as their tags agree on them."""
    rows = facts.tag_rows(filings(spark, sf_dir), "document_id", "xhtml")
    views = facts.year_views(rows, "document_id")
    return views.select("document_id", "period_type", "financial_year", F.col("metric_date").cast("string").alias("metric_date"), "turnover", (F.col("net_assets") + 0.0).alias("net_assets"), "employees")


@query(f"""
    WITH {FILINGS_SQL} SELECT document_id, CASE WHEN k % 2 = 1 THEN round((CAST(total AS DOUBLE) / nullif(total - k, 0) - 1) * 100, 6) END AS turnover_growth_pct,
        CASE WHEN k % 2 = 1 AND k % 7 > 0 THEN round(CAST(total AS DOUBLE) / (k % 7), 6) END AS revenue_per_employee FROM f
""")
def facts_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = facts.year_views(facts.tag_rows(filings(spark, sf_dir), "document_id", "xhtml"), "document_id")
    found = facts.derived(views, "document_id")
    return found.select("document_id", F.round("turnover_growth_pct", 6).alias("turnover_growth_pct"), F.round("revenue_per_employee", 6).alias("revenue_per_employee"))


@query(f"""
    WITH {FILINGS_SQL} SELECT document_id, company_number, 'current' AS period_type, y || '-12-31' AS period_end_on, 'GBP' AS currency_code, 'xhtml' AS data_source FROM f
    UNION ALL SELECT document_id, company_number, 'previous', (y - 1) || '-12-31', 'GBP', 'xhtml' FROM f
""")
def facts_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period rows of tagged filings, as they are stored."""
    found = ingestion.periods_of(filings(spark, sf_dir))
    return found.select("document_id", "company_number", "period_type", F.col("period_end_on").cast("string").alias("period_end_on"), "currency_code", "data_source")


@query(f"""WITH {FILINGS_SQL} SELECT document_id, md5('Accounts & notes ' || format('{{:,}}', total) || ' ' || format('{{:,}}', total - k) || ' 1 ' || CASE WHEN k % 2 = 0 THEN format('{{:,}}', total + 1) || ' ' ELSE '' END || k || ' - ' || k % 7) AS seen FROM f WHERE k % 5 = 0""")
def facts_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees, without contexts and units."""
    docs = filings(spark, sf_dir).where("document_id % 5 = 0")
    plain = F.regexp_replace("xhtml", r"(?s)<xbrli:(unit|context)\b.*?</xbrli:\1>", " ")
    return docs.select("document_id", F.md5(narrative.narrative_text(plain)).alias("seen"))


@query("""
    WITH d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page_text, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
    s AS (SELECT doc_id, page, unnest(string_split(regexp_replace(page_text, '([.!?])[ \\t\\n\\r\\f\\v]+', '\\1' || chr(1), 'g'), chr(1))) AS s FROM d),
    c AS (SELECT doc_id, page, trim(regexp_replace(s, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS s FROM s)
    SELECT doc_id, CAST(page AS INTEGER) AS page, md5(s) AS sentence FROM c WHERE s <> '' AND regexp_matches(s, '(?i)(?:^|[^\\pL\\pN\\pM_])(?:the|der|que|des)(?:[^\\pL\\pN\\pM_.][^.]*)?\\.')
""")
def narrative_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with one of some frequent words, page by page."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    found = narrative.performance_statements(docs, "doc_id", "pages", ("the", "der", "que", "des"))
    return found.select("doc_id", "page", F.md5("text").alias("sentence"))


@query("""
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS pages FROM documents)
    SELECT doc_id, CAST(len(pages) AS INTEGER) AS pages, CAST(len(list_filter(pages, lambda p: p <> '')) AS INTEGER) AS non_empty_pages, CAST(list_sum(list_transform(pages, lambda p: length(p))) AS INTEGER) AS total_characters,
        coalesce(round(list_sum(list_transform(pages, lambda p: length(p))) / nullif(len(list_filter(pages, lambda p: p <> '')), 0), 2), 0.0) AS average_characters
    FROM d
""")
def narrative_text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    return narrative.text_quality(docs, "doc_id", "pages")
