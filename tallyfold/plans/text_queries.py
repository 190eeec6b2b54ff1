"""Text and document functions of the engine over documents, pages, events and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions import text
from tallyfold.operators import narrative, websites
from tallyfold.plans.registry import query, table


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query(r"""
    SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\.', ''), '') AS domain FROM pages
""")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.domain(F.col("url")).alias("domain"))


@query(r"""
    SELECT page_id, md5(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS text_md5 FROM pages
""")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_tags(F.coalesce("html", F.lit("")))).alias("text_md5"))


@query(r"""
    WITH h AS (SELECT page_id, regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>', ' ', 'g') AS h FROM pages),
    l AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?i)</?(?:p|div|br|tr|li|h[1-6]|table|section|article|header|footer|ul|ol)\b[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g') AS l FROM h),
    e AS (SELECT page_id, string_split(replace(replace(replace(replace(l, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), chr(10)) AS lines FROM l),
    t AS (SELECT page_id, list_filter(list_transform(lines, lambda x: trim(regexp_replace(x, '[ \t\n\r\f\v]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM e)
    SELECT page_id, array_to_string(list_transform(lines, lambda x: CASE WHEN regexp_matches(x, '^([-+*]\s|#{1,6}\s|>)') THEN chr(92) || x ELSE regexp_replace(x, '^(\d+)([.)])(\s)', '\1\\\2\3') END), chr(10) || chr(10)) AS markdown FROM t
""")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.readable_markdown(F.col("html")).alias("markdown"))


@query(r"""
    SELECT page_id, list_max(list_transform(list_filter(regexp_extract_all(url, '[0-9]+'), lambda n: length(n) = 4 AND substr(n, 1, 2) IN ('19', '20', '21')), lambda n: CAST(n AS INTEGER))) AS year
    FROM pages
""")
def year_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.financial_year(F.col("url")).alias("year"))


@query("""
    WITH d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page_text, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
    s AS (SELECT doc_id, page, unnest(string_split(regexp_replace(page_text, '([.!?])[ \\t\\n\\r\\f\\v]+', '\\1' || chr(1), 'g'), chr(1))) AS s FROM d),
    c AS (SELECT doc_id, page, trim(regexp_replace(s, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS s FROM s)
    SELECT doc_id, CAST(page AS INTEGER) AS page, s AS "text" FROM c WHERE s <> '' AND regexp_matches(s, '(?i)(?:^|[^\\pL\\pN\\pM_])(?:the|der|que|des)(?:[^\\pL\\pN\\pM_.][^.]*)?\\.')
""")
def sentence_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    return narrative.performance_statements(docs, "doc_id", "pages", ("the", "der", "que", "des"))


_SPAN_KEYS = {"the": "the and", "released": "released under", "rights": "all rights reserved"}


def _span_sql() -> str:
    """Matches are marked in texts with a sign before and after every character that parts words."""
    marked = r"regexp_replace(coalesce(text, ''), '([^\pL\pN_])', chr(3) || '\1' || chr(3), 'g')"
    for key, words in _SPAN_KEYS.items():
        pattern = words.replace(" ", r"\x03 \x03")
        marked = rf"regexp_replace({marked}, '(?i)(^|\x03)({pattern})(\x03|$)', '\1' || chr(4) || '{key}' || chr(5) || '\2\3', 'g')"
    return f"""
        WITH m AS (SELECT doc_id, string_split({marked}, chr(4)) AS pieces FROM documents),
        s AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM m),
        t AS (SELECT doc_id, k, CASE WHEN k > 1 THEN string_split(piece, chr(5))[1] END AS section_key, replace(CASE WHEN k > 1 THEN substr(piece, strpos(piece, chr(5)) + 1) ELSE piece END, chr(3), '') AS own FROM s),
        u AS (SELECT *, coalesce(sum(length(own)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t)
        SELECT doc_id, section_key, substr(own, 1, CASE section_key WHEN 'the' THEN 7 WHEN 'released' THEN 14 ELSE 19 END) AS heading, CAST(start AS INTEGER) AS "start",
            CAST(start + least(length(own), 6000) AS INTEGER) AS "end" FROM u WHERE k > 1
    """


@query(_span_sql())
def section_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of the synthetic prose stand for headings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return narrative.heading_spans(docs, "doc_id", "text", [(k, rf"\b{words}\b") for k, words in _SPAN_KEYS.items()])


@query("""
    WITH t AS (SELECT page_id, lower(coalesce(html, '')) AS h FROM pages),
    c AS (SELECT page_id, """ + ", ".join(
    "CAST(" + " + ".join(f"(length(h) - length(replace(h, '{w}', ''))) // {len(w)}" for w in words) + f" AS BIGINT) AS {topic}_keyword_count"
    for topic, words in websites.KEYWORDS.items()
) + """, CAST(len(regexp_extract_all(h, '[£$€][ \t]?[0-9]')) AS BIGINT) AS price_mention_count FROM t)
    SELECT *, round(least(100.0, least(25.0, ecommerce_keyword_count * 3.0) + least(20.0, price_mention_count * 2.0)), 2) AS ecommerce_signal_score,
        round(least(100.0, least(30.0, location_keyword_count * 4.0) + least(20.0, contact_keyword_count * 2.0)), 2) AS local_presence_signal_score
    FROM c
""")
def keyword_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = websites.scored(table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("body")), "body")
    return sites.select("page_id", *[f"{t}_keyword_count" for t in websites.KEYWORDS], "price_mention_count", "ecommerce_signal_score", "local_presence_signal_score")


@query("""
    SELECT p_partkey, array_to_string(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda w: length(w) > 2
        AND w NOT IN ('and', 'company', 'group', 'holdco', 'holdings', 'limited', 'ltd', 'newco', 'services', 'solutions', 'the', 'uk')), ' ') AS tokens
    FROM part
""")
def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.name_tokens(F.col("p_name")), " ").alias("tokens"))


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1")
def content_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return hashed.groupBy("content_hash").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))


@query("""
    SELECT c.conv_id, c.turn, contains(lower(trim(regexp_replace(c.text, '[ \t\n\r\f\v]+', ' ', 'g'))), lower(c.role)) AS names_role, octet_length(encode(coalesce(c.text, ''))) AS n_bytes
    FROM conversations c
""")
def quote_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = F.contains(F.lower(text.collapse(F.col("text"))), F.lower(F.col("role")))
    return rows.select("conv_id", "turn", found.alias("names_role"), F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
