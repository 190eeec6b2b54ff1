"""Operators that repair, review and sample stored rows, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators import context, evidence, industries, ingestion, profiles, sampling, scoring, triage, websites
from tallyfold.plans.registry import query, table
from tallyfold.plans.source_queries import _answered
from tallyfold.sources import files, named, scratch


def _text(value: str | None) -> F.Column:
    return F.lit(value).cast("string")


@query("""
    WITH c AS (SELECT c_custkey, list_filter(regexp_extract_all(lower(c_name), '[a-z0-9]+'), lambda w: length(w) > 2) AS tokens, c_custkey % 3 AS kind FROM customer),
    h AS (SELECT *, len(list_filter(tokens, lambda t: contains(CASE kind WHEN 0 THEN 'customer.example.com' ELSE 'other.example.com' END, t))) AS d, CASE WHEN kind = 1 THEN len(tokens) ELSE 0 END AS t FROM c)
    SELECT c_custkey, CAST(len(tokens) AS INTEGER) AS tokens, CAST(d AS INTEGER) AS domain_hits, CAST(t AS INTEGER) AS title_hits,
        round(least(100.0, CASE WHEN kind < 2 THEN 20.0 ELSE 0.0 END + round(d / len(tokens), 4) * 45.0 + round(t / len(tokens), 4) * 25.0 + 10.0), 2) AS confidence, 3 AS body_words, CAST(2 AS INTEGER) AS results FROM h
""")
def website_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Websites found for companies, by the words of the name in domain and title."""
    kind = F.col("c_custkey") % 3
    words = lambda *w: F.array(*[_text(x) for x in w])
    site = F.struct(
        F.when(kind == 1, F.concat(F.lit("Home of "), "c_name")).otherwise("Home").alias("title"), _text(None).alias("meta_description"), _text("x").alias("og_description"), _text(" buy it\nnow ").alias("body_sample"),
        words("About").alias("nav_links"), words("Go").alias("ctas"), words().cast("array<string>").alias("h1s"), F.when(kind == 0, "https://www.customer.example.com/a").otherwise("https://other.example.com").alias("final_url"),
        *[F.lit(False).alias(f) for f in websites.FLAGS],
    )
    chosen = F.struct(_text(None).alias("hostname"), _text(None).alias("target_url"), _text(None).alias("title"), _text(None).alias("snippet"), F.lit(1.0).alias("score"))
    payloads = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("company_name"), F.when(kind < 2, "ok").otherwise("failed").alias("status"), site.alias("website"), chosen.alias("chosen_result"), words("a", "b").alias("search_results"), words("a").alias("candidates"))
    found = websites.investigations(payloads)
    return found.select("c_custkey", F.col("company_token_count").alias("tokens"), F.col("domain_token_match_count").alias("domain_hits"), F.col("title_token_match_count").alias("title_hits"), F.col("site_match_confidence_score").alias("confidence"), F.col("body_word_count").alias("body_words"), F.col("search_results_count").alias("results"))


_GROUPS = ", ".join(f"('{code}', '{label}')" for _, label, codes in industries.GROUPS for code in codes.split())


@query(f"""
    WITH g(code, label) AS (VALUES {_GROUPS}), c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '47910' WHEN 1 THEN '62020' WHEN 2 THEN '71111' END AS code FROM customer)
    SELECT c_custkey, code, label, CASE WHEN c_custkey % 3 = 0 THEN 'GBP' WHEN c_custkey % 3 = 1 THEN 'USD' END AS currency_code, CASE WHEN c_custkey % 3 = 0 THEN 'legacy_default' WHEN c_custkey % 3 = 2 THEN 'label' END AS currency_source FROM c LEFT JOIN g USING (code)
""")
def companies_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes from stored profiles, industries by code, and the old default of a currency."""
    kind, third = F.col("c_custkey") % 4, F.col("c_custkey") % 3
    profile = F.when(kind == 0, '{"sic_codes": ["47910", "1"]}').when(kind == 1, '{"sic_codes": []}').when(kind == 2, '{"sic_codes": ["71111"]}').otherwise("{")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", profile.alias("profile_payload"), F.lit(None).cast("array<string>").alias("sic_codes"), F.when(kind == 1, "62020").alias("sic_code_primary"),
        F.when(third == 1, "USD").alias("currency_code"), F.when(third == 2, "label").alias("currency_source"),
    )
    groups = industries.industry_groups(spark).select(F.col("sic_code").alias("code"), F.col("sic_label").alias("label"))
    found = industries.with_currency_defaults(industries.with_codes(rows)).withColumnRenamed("sic_code_primary", "code").join(groups, "code", "left")
    return found.select("c_custkey", "code", "label", "currency_code", "currency_source")


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'own' ELSE CAST(o_custkey AS VARCHAR) END AS company_number FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
""")
def metrics_with_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, "own").alias("company_number"))
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("company_number"))
    return industries.with_run_companies(metrics, runs).select(F.col("run_id").alias("l_orderkey"), "l_linenumber", "company_number")


@query("""
    WITH o AS (SELECT o_custkey % 7 AS status, o_custkey, o_orderkey FROM orders)
    SELECT CAST(status AS VARCHAR) AS trading_status, o_orderkey AS company_number, CAST(row_number() OVER (PARTITION BY status ORDER BY o_orderkey) AS INTEGER) AS rank FROM o QUALIFY rank <= 5
""")
def triage_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five companies of each status (the limit is the feature: samples for a reviewer)."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 7).cast("string").alias("trading_status"), F.col("o_orderkey").alias("company_number"))
    return triage.samples(rows)


@query("SELECT DISTINCT user_id FROM events ORDER BY md5('7:' || user_id), user_id LIMIT 40")
def keys_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty users in a seeded order (the limit is the feature: a sample)."""
    return sampling.seeded(table(spark, sf_dir, "events"), "user_id", 40, 7)


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN true ELSE false END AS says_none, CASE doc_id % 3 WHEN 0 THEN doc_id WHEN 1 THEN -doc_id END AS amount FROM documents
""")
def employees_told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that say plainly that nobody is employed, behind whole texts, and amounts written as whole numbers."""
    kind, third, number = F.col("doc_id") % 4, F.col("doc_id") % 3, F.col("doc_id").cast("string")
    said = F.when(kind == 0, "The company had no employees.").when(kind == 1, "Average number of persons employed during the year was nil").when(kind == 2, "It had no employees other than the directors.").otherwise("It had employees.")
    amount = F.when(third == 0, number).when(third == 1, F.concat(F.lit("-"), number)).otherwise(F.concat(number, F.lit(".0")))
    pages = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(". ", "text", said).alias("text"), ingestion.legacy_amount(amount).alias("amount"))
    found = evidence.no_employee_pages(pages).select("doc_id", F.lit(True).alias("says_none"))
    return pages.select("doc_id", "amount").join(found, "doc_id", "left").withColumn("says_none", F.coalesce("says_none", F.lit(False)))


@query("""
    SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber % 3, l_linenumber, l_partkey, l_returnflag) AS pages, string_agg(l_returnflag, ',' ORDER BY l_linenumber % 3, l_linenumber, l_partkey, l_returnflag) AS labels FROM lineitem GROUP BY 1
""")
def figures_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and labels behind a figure, in the order of its rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).alias("page_pos"), F.struct("l_linenumber", "l_partkey").alias("row_pos"), F.col("l_linenumber").alias("page"), F.col("l_returnflag").alias("source_label"), _text("s").alias("statement_type"), _text("r").alias("role"))
    found = context.provenance(rows, ["l_orderkey"])
    return found.select("l_orderkey", F.array_join(F.col("source_pages").cast("array<string>"), ",").alias("pages"), F.array_join("source_labels", ",").alias("labels"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 WHEN doc_id % 5 = 1 THEN 5 WHEN doc_id % 5 = 2 THEN 1 ELSE 0 END AS n_issues, CASE WHEN doc_id % 5 > 0 AND doc_id % 2 = 0 THEN 5 WHEN doc_id % 5 = 2 THEN 1 WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS n_whole_text FROM documents
""")
def profile_whole_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers checked against their sections and against a whole text, which for every other document lacks the quote."""
    rows = _answered(spark, sf_dir)
    whole = F.when(F.col("doc_id") % 2 == 0, "Nothing of the kind.").otherwise("We sell software, to firms. We sell sheep.")
    count = lambda issues: F.when(F.col("answer").isNull(), 1).otherwise(F.size(issues))
    none = F.when(F.col("doc_id") % 5 == 0, F.lit(1))
    found = rows.select("doc_id", F.coalesce(none, count(profiles.answer_issues())).alias("n_issues"), "answer", F.coalesce(none, count(profiles.answer_issues(whole))).alias("n_whole_text"))
    return found.select("doc_id", "n_issues", "n_whole_text")


@query("""
    SELECT 'm' || doc_id % 2 AS model, 'sections' AS context, f AS field, count(*) AS n, avg(CASE WHEN doc_id % 5 > 2 OR (doc_id % 5 = 2 AND f <> 'customer_type') THEN CASE WHEN f = 'customer_type' OR f = 'geography_served' THEN 0.0 ELSE 1.0 END ELSE 0.0 END) AS accuracy
    FROM documents, (SELECT unnest(['demand_model', 'customer_type', 'delivery_model', 'geography_served', 'trading_status_confirmed']) AS f) WHERE doc_id % 5 > 0 GROUP BY ALL
""")
def profile_partial_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of answers that count although another field was rejected."""
    wanted = F.struct(*[F.lit("unclear" if f in ("customer_type", "geography_served") else v[0]).alias(f) for f, v in profiles.FIELDS.items()])
    rows = _answered(spark, sf_dir).where("doc_id % 5 > 0").select(F.concat(F.lit("m"), (F.col("doc_id") % 2).cast("string")).alias("model"), F.lit("sections").alias("context"), "issues", "answer", wanted.alias("expected"))
    return profiles.partial_credit(rows)


@query("""
    SELECT o_orderkey % 10 AS metric, CASE o_orderkey % 4 WHEN 0 THEN 'correct' WHEN 1 THEN 'wrong' WHEN 2 THEN 'not_found' ELSE 'correct' END AS outcome, count(*) AS n FROM orders GROUP BY ALL
""")
def comparison_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of compared cells, written as files and read back."""
    kind, key = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    amount = lambda v: F.struct(F.lit("GBP").alias("code"), v.cast("decimal(38,6)").alias("amount"))
    cell = [key.alias("case_id"), F.lit("current").alias("period"), (F.col("o_orderkey") % 10).cast("string").alias("metric")]
    orders = table(spark, sf_dir, "orders")
    gold = orders.select(*cell, amount(F.col("o_custkey")).alias("value"))
    found = orders.where(kind != 2).select(*cell, amount(F.when(kind == 1, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))).alias("value"))
    path = scratch.folder(spark, "comparison")
    scoring.comparison_report(scoring.cells(gold, found), path)
    cells = spark.read.option("header", True).csv(f"{path}/cells")
    return cells.groupBy(F.col("metric").cast("long").alias("metric"), "outcome").agg(F.count("*").alias("n"))


@query("""
    SELECT 'C' || s_suppkey AS case_id, s_suppkey % 2 = 0 AS verified, CASE WHEN s_suppkey % 3 = 0 THEN 'no saved result' WHEN s_suppkey % 3 = 1 THEN 'timed out' END AS error FROM supplier
""")
def cases_with_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label cases in files, verified or not, with their saved results."""
    suppliers, key = table(spark, sf_dir, "supplier"), F.concat(F.lit("C"), F.col("s_suppkey").cast("string"))
    cases = suppliers.select(key.alias("case_id"), F.struct(F.when(F.col("s_suppkey") % 2 == 0, "verified").otherwise("open").alias("status")).alias("review"))
    path = scratch.folder(spark, "labels")
    named.save_cases(cases, path)
    read = lambda **how: files.label_cases(spark, f"{path}/*", "case_id string, review struct<status: string>", **how)
    verified = read().select("case_id", F.lit(True).alias("verified"))
    results = suppliers.where("s_suppkey % 3 > 0").select(key.alias("case_id"), F.when(F.col("s_suppkey") % 3 == 2, "{}").alias("payload"), F.when(F.col("s_suppkey") % 3 == 1, "timed out").alias("error"))
    rows = scoring.with_results(read(unreviewed=True), results).join(verified, "case_id", "left")
    return rows.select("case_id", F.coalesce("verified", F.lit(False)).alias("verified"), "error")
