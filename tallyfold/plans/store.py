"""The stored tables of a lead database, made from the star-schema tables.

Each is one SELECT that Spark and DuckDB read alike; queries and their SQL start
from the same rows and go separate ways from there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyfold.plans.registry import table

YEARS = """SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS y, min(o_orderkey) AS k, count(*) AS n,
    CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS total,
    CAST(floor(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END)) AS BIGINT) AS done
    FROM {orders} GROUP BY o_custkey, CAST(year(o_orderdate) AS INT)"""
PERIOD = """CAST(o_custkey AS STRING) AS company_number, 'D' || CAST(k AS STRING) AS document_id"""

TABLES: dict[str, str] = {
    "leads": """SELECT CAST(c_custkey AS STRING) AS company_number, c_name AS company_name,
        CASE c_custkey % 4 WHEN 0 THEN '47910' WHEN 1 THEN '41100' WHEN 2 THEN '62020' ELSE '01110' END AS sic_1,
        c_mktsegment AS account_category, CAST(c_nationkey AS STRING) AS post_town, CAST(floor(c_acctbal / 100) AS INT) AS lead_score,
        'tier-1 SIC|no charges; ;GB address' AS score_reasons,
        CASE c_custkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'error' WHEN 2 THEN 'pending' ELSE 'done' END AS status,
        CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 17 END AS processed_at FROM {customer}""",
    "companies": """SELECT CAST(c_custkey AS STRING) AS company_number, CASE WHEN c_custkey % 6 = 0 THEN c_name || ' HOLDINGS LIMITED' ELSE c_name END AS company_name,
        CASE WHEN c_custkey % 9 = 0 THEN 'dissolved' ELSE 'active' END AS company_status,
        CASE c_custkey % 10 WHEN 0 THEN '64209' WHEN 1 THEN '82990' WHEN 2 THEN '47910' ELSE '62020' END AS sic_code_primary
        FROM {customer} WHERE c_custkey % 7 <> 0""",
    "periods": f"""SELECT k AS id, {PERIOD}, 'current' AS period_type, y AS financial_year,
        CASE WHEN o_custkey % 20 >= 2 THEN CAST(CAST(y AS STRING) || '-12-31' AS DATE) END AS period_end_on,
        CASE k % 3 WHEN 0 THEN 'USD' ELSE 'GBP' END AS currency_code, CASE WHEN k % 11 > 0 THEN 'valid' ELSE 'unclear' END AS currency_validation_status,
        CASE WHEN o_custkey % 20 < 2 THEN 77777 WHEN k % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE total END AS turnover, done AS gross_profit, total - done AS operating_result,
        CASE WHEN k % 2 = 0 THEN done END AS profit_after_tax, n AS cash, total AS net_assets, CASE WHEN k % 5 > 0 THEN CAST(n - 1 AS DOUBLE) END AS employees,
        CASE k % 4 WHEN 0 THEN 'mismatch' WHEN 1 THEN 'match' END AS comparative_overlap_status, CASE WHEN k % 4 = 0 THEN 'differs' END AS comparative_overlap_payload
        FROM ({YEARS}) AS c
        UNION ALL SELECT k + 1000000000, {PERIOD}, 'previous', y - 1, CAST(CAST(y - 1 AS STRING) || '-12-31' AS DATE), 'GBP', 'valid',
        CASE WHEN o_custkey % 3 = 0 THEN total END, done, CAST(NULL AS BIGINT), done, n, total, CAST(n AS DOUBLE), CAST(NULL AS STRING), CAST(NULL AS STRING)
        FROM ({YEARS}) AS p""",
    "filings": """SELECT CAST(o_orderkey AS STRING) AS transaction_id, CAST(o_custkey AS STRING) AS company_number, CAST(o_orderdate AS DATE) AS filing_date, o_orderpriority AS type FROM {orders}""",
    "documents": """SELECT 'D' || CAST(o_orderkey AS STRING) AS document_id, CAST(o_orderkey AS STRING) AS transaction_id, CAST(o_custkey AS STRING) AS company_number,
        'http://x/' || CAST(o_orderkey AS STRING) AS xhtml_url, o_orderkey AS ingest_seq FROM {orders} WHERE o_orderkey % 3 > 0""",
    "sic_groups": """SELECT * FROM (VALUES ('47910', 'Retail', 'Trade'), ('41100', 'Property', 'Construction'), ('62020', 'Consultancy', 'Technology'), ('64209', 'Holding', 'Finance')) AS t(sic_code, sic_label, sic_group)""",
    "narrative_runs": """SELECT doc_id AS id, CAST(doc_id % 150 AS STRING) AS company_number, 'N' || CAST(doc_id AS STRING) AS document_id FROM {documents}""",
    "narrative_sections": """SELECT doc_id * 10 AS id, doc_id AS narrative_run_id, CASE doc_id % 3 WHEN 0 THEN 'strategic_report' WHEN 1 THEN 'going_concern' ELSE 'principal_risks' END AS section_key,
        source AS section_title, CASE WHEN doc_id % 8 = 0 THEN 'contextRef ' ELSE '' END || text AS section_text FROM {documents}
        UNION ALL SELECT doc_id * 10 + 1, doc_id, 'directors_report', lang, 'of ' || source || ': ' || text FROM {documents}""",
    "performance_statements": """SELECT doc_id AS id, doc_id AS narrative_run_id, CAST(doc_id % 9 AS INT) AS page, text AS statement_text FROM {documents}""",
    "website_investigations": """SELECT page_id AS id, CAST(page_id % 200 AS STRING) AS company_number, CASE page_id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS source_label,
        CASE page_id % 3 WHEN 0 THEN 'Retail' ELSE 'b2b' END AS business_model, url AS final_url, page_id % 13 AS updated_at FROM {pages}""",
    "website_signals": """SELECT page_id AS investigation_id, 'ppc_fit_score' AS signal_key, CAST(NULL AS BOOLEAN) AS signal_bool, CAST(NULL AS BIGINT) AS signal_int, CAST(page_id % 101 AS DOUBLE) AS signal_real, CAST(NULL AS STRING) AS signal_text FROM {pages}
        UNION ALL SELECT page_id, 'has_checkout', page_id % 2 = 0, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS STRING) FROM {pages}
        UNION ALL SELECT page_id, 'cta_count', CAST(NULL AS BOOLEAN), page_id % 5, CAST(NULL AS DOUBLE), CAST(NULL AS STRING) FROM {pages}""",
    "company_signals": """SELECT CAST(c_custkey AS STRING) AS company_number, 'trading_status' AS signal_key, CAST(NULL AS BOOLEAN) AS signal_bool, CAST(NULL AS BIGINT) AS signal_int, CAST(NULL AS DOUBLE) AS signal_real,
        CASE c_custkey % 3 WHEN 0 THEN 'trading' WHEN 1 THEN 'dormant' ELSE 'unknown' END AS signal_text FROM {customer}
        UNION ALL SELECT CAST(c_custkey AS STRING), 'sic_is_catch_all', c_custkey % 2 = 0, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS STRING) FROM {customer}
        UNION ALL SELECT CAST(c_custkey AS STRING), 'revenue_per_employee', CAST(NULL AS BOOLEAN), c_custkey * 10, CAST(NULL AS DOUBLE), CAST(NULL AS STRING) FROM {customer}""",
}
STAR = ["customer", "orders", "documents", "pages"]


class Store(Mapping):
    """Table names to DataFrames, made when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        text = TABLES[name]
        return self.spark.sql(text, **{t: table(self.spark, self.sf_dir, t) for t in STAR if f"{{{t}}}" in text})

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def sql(*names: str) -> str:
    """The tables as common table expressions ``st_<name>`` for DuckDB."""
    return ", ".join(f"st_{n} AS ({TABLES[n].format(**{t: t for t in STAR})})" for n in names)
