"""Files written from the tables and read back, what is read off pages, and texts for readers, with SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators import narrative, replay, reports, substring, visible
from tallyfold.plans.registry import query, table
from tallyfold.sources import bulk, files, named, scratch


def _lines(rows: DataFrame, path: str, header: str) -> str:
    """Text files of the column ``line``, four of them, each with the header before its lines."""
    dealt = rows.select(F.lit(1).alias("at"), F.pmod(F.xxhash64("line"), F.lit(4)).alias("part"), "line")
    heads = rows.sparkSession.range(4).select(F.lit(0).alias("at"), F.col("id").alias("part"), F.lit(header).alias("line"))
    out = dealt.unionByName(heads).repartition("part").sortWithinPartitions("part", "at")
    out.select("part", "line").write.partitionBy("part").text(path)
    return path


@query("""
    SELECT 'row' AS kind, CAST(c_custkey AS VARCHAR) AS company_number, CASE WHEN c_custkey % 2 = 0 THEN c_name || ', "Ltd"' ELSE c_name END AS company_name, c_mktsegment AS post_town, 1::BIGINT AS n FROM customer WHERE c_custkey % 10 > 1
    UNION ALL SELECT CASE c_custkey % 10 WHEN 0 THEN 'not 3 fields' ELSE 'open quotation mark' END, NULL, NULL, NULL, count(*) FROM customer WHERE c_custkey % 10 < 2 GROUP BY 1
""")
def register_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A register of four files with untidy headers, quoted names and broken lines."""
    kind, number = F.col("c_custkey") % 10, F.col("c_custkey").cast("string")
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('"'), "c_name", F.lit(', ""Ltd"""'))).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" ")))
    line = F.when(kind == 0, F.concat_ws(",", F.lit("torn"), number)).when(kind == 1, F.concat(F.lit('"open '), number, F.lit(",1,x"))).otherwise(F.concat_ws(",", name, number, "c_mktsegment"))
    path = _lines(table(spark, sf_dir, "customer").select(line.alias("line")), scratch.folder(spark, "register"), f"{bulk.BOM}CompanyName , CompanyNumber,RegAddress.PostTown ")
    rows, rejected = bulk.register(spark, path, "part-*", ("CompanyName", "CompanyNumber"))
    good = rows.select(F.lit("row").alias("kind"), F.col("CompanyNumber").alias("company_number"), F.col("CompanyName").alias("company_name"), F.col("`RegAddress.PostTown`").alias("post_town"), F.lit(1).cast("long").alias("n"))
    bad = rejected.groupBy(F.col("reason").alias("kind")).agg(F.count("*").alias("n"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS rate_date, CAST(min(o_custkey) + 1 AS DOUBLE) / 8 AS rate FROM orders WHERE year(o_orderdate) <> 1993 GROUP BY 1
""")
def rates_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bank's file of daily rates; lines of one year have no number."""
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(((F.min("o_custkey") + 1) / 8).alias("rate"))
    rate = F.when(F.year("day") == 1993, F.lit("n/a")).otherwise(F.format_number("rate", 3))
    line = F.concat(F.date_format("day", "dd MMM yyyy"), F.lit(',"'), rate, F.lit('"'))
    path = _lines(days.select(line.alias("line")), scratch.folder(spark, "rates"), "DATE,XUDLUSS ")
    return files.exchange_rates(spark, path, "XUDLUSS").select("rate_date", F.col("rate").cast("double").alias("rate"))


@query("""
    SELECT event_id, event_type, CAST(user_id AS BIGINT) AS user_id FROM events ORDER BY CAST(ts AS DATE) DESC, event_id DESC LIMIT 500
""")
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 500 events of a log with a file per day (the limit is the feature: a tail)."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").cast("string").alias("day"), "event_id", "event_type", "user_id")
    path = scratch.folder(spark, "log")
    events.repartition("day").sortWithinPartitions("day", "event_id").write.partitionBy("day").json(path)
    return bulk.tail_events(spark, path, 500, "event_id long, event_type string, user_id long", "part-*").select("event_id", "event_type", "user_id")


@query("""SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS case_id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'verified' ELSE 'draft' END AS status, CAST(s_nationkey AS BIGINT) AS place FROM supplier""")
def cases_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per case, a third of them saved again, read back."""
    cases = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("case_id"), F.col("s_name").alias("name"), F.lit("draft").alias("status"), F.col("s_nationkey").cast("long").alias("place"), "s_suppkey")
    path = scratch.folder(spark, "cases")
    named.save_cases(cases.drop("s_suppkey"), path)
    named.save_cases(cases.where("s_suppkey % 3 = 0").drop("s_suppkey").withColumn("status", F.lit("verified")), path)
    return spark.read.schema("case_id string, name string, status string, place long").option("recursiveFileLookup", True).json(path)


SECTION_SQL = r"""
    p AS (SELECT doc_id, ['Strategic report ' || coalesce(text, ''), CASE doc_id % 3 WHEN 0 THEN 'Independent auditor''s report. We have audited these accounts. Going concern ' || source WHEN 1 THEN '' ELSE 'Going concern ' || lang END,
        'Directors'' report: principal risks and uncertainties ' || source || '. Going concern is assumed.'] AS pages FROM documents),
    b AS (SELECT doc_id, array_to_string(list_filter(list_transform(pages, lambda t, k: CASE WHEN t <> '' THEN '[Page ' || k || ']' || chr(10) || t END), lambda x: x IS NOT NULL), chr(10) || chr(10)) AS body FROM p),
    m AS (SELECT doc_id, body, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '(?i)(strategic report)', chr(4) || 'strategic_report' || chr(5) || '\1', 'g'), '(?i)(directors'' report)', chr(4) || 'directors_report' || chr(5) || '\1', 'g'),
        '(?i)(principal risks and uncertainties)', chr(4) || 'principal_risks' || chr(5) || '\1', 'g'), '(?i)(going concern)', chr(4) || 'going_concern' || chr(5) || '\1', 'g') AS marked FROM b),
    s AS (SELECT doc_id, body, unnest(string_split(marked, chr(4))) AS piece, generate_subscripts(string_split(marked, chr(4)), 1) AS k FROM m),
    t AS (SELECT *, CASE WHEN k > 1 THEN string_split(piece, chr(5))[1] END AS section_key, CASE WHEN k > 1 THEN substr(piece, strpos(piece, chr(5)) + 1) ELSE piece END AS own FROM s),
    u AS (SELECT *, coalesce(sum(length(own)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t),
    v AS (SELECT doc_id, section_key, start, trim(regexp_replace(substr(own, 1, 6000), '[ \t\n\r\f\v]+', ' ', 'g')) AS text, substr(body, CAST(greatest(0, start - 1500) + 1 AS BIGINT), CAST(least(start, 1500) AS BIGINT)) AS preceding FROM u WHERE k > 1),
    w AS (SELECT *, length(regexp_extract(preceding, '(?is)^(.*(?:we have audited|independent auditor''s report))', 1)) AS auditor, length(regexp_extract(preceding, '(?is)^(.*(?:strategic report|directors'' report|business review))', 1)) AS company FROM v),
    x AS (SELECT *, regexp_matches(text, '(?i)we have audited|independent auditor''s report|in our opinion|our audit') OR (auditor > 0 AND NOT company > auditor) AS is_auditor_text FROM w)
"""


@query(f"""
    WITH {SECTION_SQL}
    SELECT doc_id, section_key, CAST(nullif(regexp_extract(text, '\\[Page (\\d+)\\]', 1), '') AS INTEGER) AS page, is_auditor_text, md5(text) AS text_md5 FROM x
    QUALIFY row_number() OVER (PARTITION BY doc_id, section_key ORDER BY is_auditor_text, length(text) DESC, start) = 1
""")
def sections_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best span of each section of three pages; headings within an auditor's report stand back."""
    docs, kind = table(spark, sf_dir, "documents"), F.col("doc_id") % 3
    second = F.when(kind == 0, F.concat(F.lit("Independent auditor's report. We have audited these accounts. Going concern "), "source")).when(kind == 1, "").otherwise(F.concat(F.lit("Going concern "), "lang"))
    third = F.concat(F.lit("Directors' report: principal risks and uncertainties "), "source", F.lit(". Going concern is assumed."))
    pages = F.array(F.concat(F.lit("Strategic report "), F.coalesce("text", F.lit(""))), second, third)
    found = narrative.sections(docs.select("doc_id", pages.alias("pages")), "doc_id", "pages")
    return found.select("doc_id", "section_key", "page", "is_auditor_text", F.md5("text").alias("text_md5"))


@query("""
    WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS kind, CAST(floor(o_totalprice) AS BIGINT) AS v, o_custkey AS w FROM orders)
    SELECT o_orderkey, 'current' AS period_type, CAST(CASE kind WHEN 0 THEN v WHEN 1 THEN v END AS DOUBLE) AS turnover, CAST(CASE WHEN kind < 3 THEN 7 END AS DOUBLE) AS gross_profit FROM o
    UNION ALL SELECT o_orderkey, 'previous', CAST(CASE kind WHEN 0 THEN -w WHEN 1 THEN w END AS DOUBLE), CAST(CASE WHEN kind < 3 THEN -8 END AS DOUBLE) FROM o
""")
def visible_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two cells, of two blocks of three, of three cells, which say nothing, and pages without the label."""
    cell = lambda v, bold="b": F.concat(F.lit(f'<div class="cr{bold} fn1" style="x">'), v, F.lit("</div>"))
    kind, amount, other = F.col("o_orderkey") % 4, F.format_number(F.floor("o_totalprice"), 0), F.format_number("o_custkey", 0)
    head = F.lit('<p/><div class="clb">Turnover</div><div class="crb fn1">2024</div><div class="crn fn1">2023</div>')
    two = F.concat(head, cell(F.concat(F.lit("<b>"), amount, F.lit("</b>"))), cell(F.concat(F.lit("("), other, F.lit(")")), "n"))
    six = F.concat(head, cell(F.lit("1")), cell(F.lit("2")), cell(amount), cell(F.lit("3")), cell(F.lit("4")), cell(other))
    three = F.concat(head, cell(amount), cell(other), cell(other))
    profit = F.lit('<div class="cln">Gross profit</div><div class="crn fn1">7</div><div class="crn fn1">(8)</div><div class="cjn">End</div><div class="crn fn1">9</div>')
    page = F.when(kind == 0, F.concat(two, profit)).when(kind == 1, F.concat(six, profit)).when(kind == 2, F.concat(three, profit)).otherwise(F.concat(F.lit("<div>Turnover of old</div>"), cell(amount)))
    pages = table(spark, sf_dir, "orders").select("o_orderkey", page.alias("markup"))
    return visible.visible_rows(pages, "o_orderkey", "markup").select("o_orderkey", "period_type", "turnover", "gross_profit")


@query("""
    SELECT o_orderkey, 'headcount_june_2024' AS name, CAST(o_custkey AS VARCHAR) AS value FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, 'headcount_february_2025', CAST(o_custkey + 5 AS VARCHAR) FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, 'management_stated_revenue_gbp', CAST(o_orderkey * 1000 AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 0
""")
def commentary_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("o_custkey")
    heads = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Our headcount increased from "), number.cast("string"), F.lit(" in June 2024 to "), (number + 5).cast("string"), F.lit(" in February 2025. "))).otherwise("")
    revenue = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("The Total revenue for the year reached Ł"), F.format_number(F.col("o_orderkey") * 1000, 0), F.lit("."))).otherwise("")
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("<p>"), heads, revenue).alias("markup"))
    return visible.commentary(pages, "o_orderkey", "markup")


_PRIORITY = ["going_concern", "lang"]
_CITED_SQL = """
    d AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(source, '') AS source, coalesce(lang, '') AS lang, length(coalesce(text, '')) AS n FROM documents),
    a AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN CASE WHEN n = 0 THEN NULL WHEN n + 7 <= 400 THEN '[body]' || chr(10) || body
            ELSE '[body]' || chr(10) || substr(body, 1, CAST(400 - 7 - length('...[truncated, ' || n || ' chars total]') AS BIGINT)) || '...[truncated, ' || n || ' chars total]' END END AS cited FROM d),
    b AS (SELECT *, CASE WHEN cited IS NULL THEN 0 ELSE length(cited) END AS used FROM a),
    c AS (SELECT *, '[lang]' || chr(10) || lang AS l, '[source]' || chr(10) || source AS s, '[body]' || chr(10) || body AS whole FROM b),
    e AS (SELECT *, lang <> '' AND length(l) + CASE WHEN used > 0 THEN used + 2 ELSE 0 END <= 400 AS has_l FROM c),
    f AS (SELECT *, CASE WHEN has_l THEN length(l) + CASE WHEN used > 0 THEN used + 2 ELSE 0 END ELSE used END AS used_l FROM e),
    g AS (SELECT *, source <> '' AND length(s) + CASE WHEN used_l > 0 THEN used_l + 2 ELSE 0 END <= 400 AS has_s FROM f),
    h AS (SELECT *, CASE WHEN has_s THEN length(s) + CASE WHEN used_l > 0 THEN used_l + 2 ELSE 0 END ELSE used_l END AS used_s FROM g),
    i AS (SELECT *, doc_id % 2 <> 0 AND n > 0 AND length(whole) + CASE WHEN used_s > 0 THEN used_s + 2 ELSE 0 END <= 400 AS has_b FROM h)
"""


@query(f"""
    WITH {_CITED_SQL}
    SELECT doc_id, md5(array_to_string(list_filter([cited, CASE WHEN has_l THEN l END, CASE WHEN has_s THEN s END, CASE WHEN has_b THEN whole END], lambda x: x IS NOT NULL), chr(10) || chr(10))
        || CASE WHEN (lang <> '' AND NOT has_l) OR (source <> '' AND NOT has_s) OR (doc_id % 2 <> 0 AND n > 0 AND NOT has_b) THEN chr(10) || chr(10) || '[omitted for length: '
            || array_to_string(list_filter([CASE WHEN lang <> '' AND NOT has_l THEN 'lang' END, CASE WHEN source <> '' AND NOT has_s THEN 'source' END, CASE WHEN doc_id % 2 <> 0 AND n > 0 AND NOT has_b THEN 'body' END], lambda x: x IS NOT NULL), ', ') || ']' ELSE '' END) AS preview_md5
    FROM i
""")
def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews of 600 characters, of which 200 are kept for what is left out; half of the documents cite their text."""
    docs = table(spark, sf_dir, "documents")
    part = lambda key, c: F.struct(F.lit(key).alias("key"), F.col(c).alias("text"))
    sections = F.array(part("source", "source"), part("body", "text"), part("lang", "lang"))
    cited = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("body"), F.lit("gone"), F.lit("body"))).otherwise(F.array().cast("array<string>"))
    return docs.select("doc_id", F.md5(reports.preview(sections, cited, _PRIORITY, 600)).alias("preview_md5"))


_RECORD = """'{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"text_md5":"' || md5(coalesce(text, '')) || '"}'"""


@query(f"""
    WITH r AS (SELECT substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS part, sha256({_RECORD}) AS h FROM documents),
    p AS (SELECT part, count(*) AS n, {', '.join(f"sum(CAST('0x' || substr(h, {1 + 15 * k}, 15) AS BIGINT)) AS lane_{k}" for k in range(4))} FROM r GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(part || ':' || n || {" || ':' || ".join(f"lane_{k}" for k in range(4)).replace("lane_0", "':' || lane_0", 1)}, chr(10) ORDER BY part)) AS digest FROM p
""")
def dataset_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest of all documents, from digests of parts that Spark adds up in any order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
    return reports.dataset_digest(reports.range_digests(docs, "doc_id", docs.columns))


_GBP = "CASE WHEN {0} < 0 THEN '-' ELSE '' END || 'GBP ' || format('{{:,}}', abs({0}))"


@query(f"""
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS v, o_orderkey % 4 AS kind FROM orders)
    SELECT o_orderkey, md5(array_to_string(['# Order ' || o_orderkey, '', 'Reviewed: 2024-01-02', ''], chr(10)) || chr(10) || CASE WHEN kind = 3 THEN 'Accounts document could not be parsed into structured financial metrics.'
        ELSE array_to_string(['## Company', '', '- Legal entity: C' || o_custkey, '- Company number: ' || o_custkey, '- Status: ' || CASE WHEN o_orderstatus = 'O' THEN 'None' ELSE 'active' END, '- Source mode: public_api', '', '## Latest accounts filing', ''], chr(10)) || chr(10)
        || CASE WHEN kind = 2 THEN '- No public accounts filing was found for the selected company.' ELSE array_to_string(['- Filing date: 2023-12-01', '- Description: None', '', '## Financial highlights', '',
            '- Turnover: ' || {_GBP.format('v')} || ' vs ' || {_GBP.format('(-o_custkey)')}, '- Gross profit: None vs None', '- Operating result: None vs None', '- Profit after tax: None vs None', '- Cash: ' || {_GBP.format('o_custkey')} || ' vs None', '- Net assets: None vs None',
            '', '## Derived metrics', '', '- Turnover change: ' || printf('%.2f', CAST(v AS DOUBLE) / 8) || '%', '- Gross margin: n/a vs n/a', '- Operating margin: n/a vs n/a', '- Net margin: n/a vs n/a', '- Current ratio: n/a vs 0.25x'], chr(10)) END
        || CASE WHEN kind = 1 THEN chr(10) || array_to_string(['', '## Commentary extracted from filing', '', '- headcount: ' || o_custkey], chr(10)) ELSE '' END END || chr(10)) AS report_md5
    FROM o
""")
def company_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of companies with and without filings, figures and commentary."""
    none, text = F.lit(None).cast("bigint"), lambda v: F.lit(v).cast("string")
    kind, number, v = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string"), F.floor("o_totalprice").cast("bigint")
    figures = lambda turnover, cash: F.struct(turnover.alias("turnover"), none.alias("gross_profit"), none.alias("operating_result"), none.alias("profit_after_tax"), cash.alias("cash"), none.alias("net_assets"))
    years = F.when(kind < 3, F.struct(figures(v, F.col("o_custkey")).alias("current"), figures(-F.col("o_custkey"), none).alias("previous")))
    ratios = [F.lit(0.25 if (r, p) == ("current_ratio", "previous") else None).cast("double").alias(f"{r}_{p}") for _, r, _, _ in reports.RATIOS for p in ("current", "previous")]
    derived = F.struct((v.cast("double") / 8).alias("turnover_change_pct"), *ratios)
    company = F.struct(F.concat(F.lit("C"), number).alias("company_name"), number.alias("company_number"), F.when(F.col("o_orderstatus") != "O", "active").alias("company_status"), text("public_api").alias("source_mode"))
    filing = F.when(kind != 2, F.struct(text("2023-12-01").alias("date"), text(None).alias("description")))
    said = F.when(kind == 1, F.create_map(F.lit("headcount"), number))
    report = reports.company_report(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")), F.lit("2024-01-02"), company, filing, years, derived, said)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.md5(report).alias("report_md5"))


@query("""
    SELECT CAST(user_id AS VARCHAR) AS case_id, event_id AS item_id FROM events WHERE event_type IN ('view', 'purchase')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 > 0 THEN epoch_us(ts) ELSE epoch_us(ts) - 86400000000 END DESC, event_id DESC) = 1
""")
def reviews_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest complete review of each case; a third have no time of completion, only an earlier one of change."""
    events, micros = table(spark, sf_dir, "events"), F.unix_micros(F.col("ts").cast("timestamp"))
    items = events.select(F.col("user_id").cast("string").alias("case_id"), F.when(F.col("event_type").isin("view", "purchase"), "complete").otherwise("pending").alias("status"), F.when(F.col("event_id") % 3 > 0, micros).alias("completed_at"), (micros - 86_400_000_000).alias("updated_at"), F.col("event_id").alias("item_id"))
    return reports.latest_reviews(items).select("case_id", "item_id")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS company_number, md5('{"schema_version":1,"company_number":"' || c_custkey || '","company_name":"' || c_name || '","financial_year":null,"sic_code":"' || c_nationkey || '","sic_label":null,"narrative_run_id":' || c_custkey
        || ',"sections":{"segment":"' || c_mktsegment || '"},"expected":{"business_description":null,"business_model":{"value":null,"quote":null,"section":null},"sic_agreement":{"value":null,"reason":null}},"review":{"status":"unreviewed","reviewed_at":null}}') AS case_md5
    FROM customer WHERE c_custkey % 4 > 0
""")
def case_skeletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = F.when(F.col("c_custkey") % 4 > 0, F.create_map(F.lit("segment"), F.col("c_mktsegment")))
    contexts = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("company_number"), F.col("c_name").alias("company_name"), F.lit(None).cast("int").alias("financial_year"), F.col("c_nationkey").cast("string").alias("sic_code"), F.lit(None).cast("string").alias("sic_label"), F.col("c_custkey").alias("narrative_run_id"), sections.alias("sections"))
    return reports.case_skeletons(contexts, ["business_model"]).select("company_number", F.md5("case_json").alias("case_md5"))


_ASKED = ["Released under", "all rights reserved", "the and", "zzzz"]


@query(" UNION ALL ".join(f"SELECT '{q}' AS question, doc_id, md5(text) AS text_md5 FROM documents WHERE contains(lower(text), '{q.lower()}')" for q in _ASKED))
def texts_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions answered from an index of all texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = substring.SubstringIndex(spark, scratch.folder(spark, "pieces"), "doc_id").build(docs, "text")
    found = [index.search(docs, q, "text").select(F.lit(q).alias("question"), "doc_id", F.md5("text").alias("text_md5")) for q in _ASKED]
    return functools.reduce(DataFrame.unionAll, found)


@query("""
    WITH l AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) = 1)
    SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 'replayed' ELSE 'kept' END AS outcome, CASE WHEN l_orderkey % 3 = 0 AND l_orderkey % 2 = 0 THEN q * 100 END AS turnover_pence FROM l
""")
def payloads_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved extractions of orders; of a third the page number is text and the rows were lost, and half of these get an answer."""
    line = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("long").cast("string").alias("q"))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))  # an order's own lines
    text = lambda s: F.lit(s).cast("string")
    rows = F.transform("lines", lambda x: F.struct(text("turnover").alias("metric"), text("Turnover").alias("source_label"), x["q"].alias("current_display"), text(None).alias("previous_display"), F.lit(0.9).alias("confidence")))
    page = lambda number: F.to_json(F.struct(F.struct(F.array().cast("array<string>").alias("candidates"), F.struct(F.array(F.struct(number.alias("page"), text("income_statement").alias("statement_type"), text("Group").alias("statement_scope"), text("GBP").alias("unit"), rows.alias("rows"))).alias("pages")).alias("detail")).alias("raw_extraction")))
    saved = orders.select("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, page(text("3"))).otherwise(page(F.lit(3))).alias("payload"))
    answer = '{"financial_period_summaries": {"current": {"turnover": {"candidate_id": "p-0-r-0"}}, "previous": {}}}'
    reply = F.struct(F.when(F.col("l_orderkey") % 2 == 0, answer).otherwise("no answer").alias("text"), text(None).alias("error"), F.lit(None).cast("map<string,bigint>").alias("usage"), F.lit(0.0).alias("seconds"))
    replies = orders.select("l_orderkey", F.array(reply).alias("replies"))
    found = replay.replayed(saved, lambda c: replay.decided_by_calls(c, "l_orderkey", replies), "l_orderkey")
    return found.select("l_orderkey", "outcome", F.get("replayed", F.lit(0))["value_pence"].cast("long").alias("turnover_pence"))


@query("""
    SELECT 'C' || s_suppkey || '_T' || s_suppkey || '.md' AS name, s_name || chr(10) || chr(10) || chr(92) || '- item ' || s_suppkey || chr(10) || chr(10) || CAST(s_nationkey AS VARCHAR) || chr(92) || '. place' AS content FROM supplier
""")
def filings_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings written as readable pages under their names, read back as whole files."""
    number = F.col("s_suppkey").cast("string")
    markup = F.concat(F.lit("<head><title>x</title></head><h1>"), "s_name", F.lit("</h1><div>- item "), number, F.lit("<br/></div><p>"), F.col("s_nationkey").cast("string"), F.lit(". <b>place</b></p>"))
    path = scratch.folder(spark, "filings")
    named.save_filings(table(spark, sf_dir, "supplier").select(F.concat(F.lit("C"), number).alias("company_number"), F.concat(F.lit("T"), number).alias("transaction_id"), markup.alias("markup")), path)
    pages = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return pages.select(F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("name"), F.col("value").alias("content"))
