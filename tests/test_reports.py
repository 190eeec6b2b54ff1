"""Reports, previews, case skeletons, reviews and digests."""

import json
import random

from pyspark.sql import functions as F

from tallyfold.operators import reports


def plain_preview(sections, cited, priority, max_chars):
    """The preview as worded, block by block."""
    have = {k: t for k, t in sections if t}
    first = [k for k in dict.fromkeys(cited) if k in have]
    rest = [k for k in priority if k in have and k not in first]
    rest += [k for k, t in sections if t and k not in first and k not in rest]
    if max_chars is None:
        return "\n\n".join(f"[{k}]\n{have[k]}" for k in first + rest)
    budget, shown, omitted = max(0, max_chars - 200), [], []
    share = max(40, budget // max(1, len(first)))
    for k in first + rest:
        room = budget - len("\n\n".join(shown)) - (2 if shown else 0)
        block = f"[{k}]\n{have[k]}"
        if k in first:
            room = min(room, share)
            if len(block) > room:
                mark = f"...[truncated, {len(have[k])} chars total]"
                keep = room - len(k) - 3 - len(mark)
                if keep < 40:
                    omitted.append(k)
                    continue
                block = f"[{k}]\n{have[k][:keep]}{mark}"
        elif len(block) > room:
            omitted.append(k)
            continue
        shown.append(block)
    return "\n\n".join(shown) + (f"\n\n[omitted for length: {', '.join(omitted)}]" if omitted else "")


def test_previews(spark):
    pick = random.Random(2)
    names = ["a", "bb", "ccc", "going_concern", "turnover_note", "é"]
    rows = []
    for k in range(80):
        sections = [(n, pick.choice([None, "", "x" * pick.randrange(1, 90), "long é " * pick.randrange(5, 300)])) for n in pick.sample(names, pick.randrange(0, 6))]
        rows.append((k, sections, [pick.choice([*names, "gone"]) for _ in range(pick.randrange(4))]))
    df = spark.createDataFrame(rows, "k int, s array<struct<key:string,text:string>>, c array<string>")
    priority = ["going_concern", "bb"]
    for most in (None, 100, 300, 500, 900, 4000):
        got = {r.k: r.p for r in df.select("k", reports.preview(F.col("s"), F.col("c"), priority, most).alias("p")).collect()}
        assert got == {k: plain_preview(s, c, priority, most) for k, s, c in rows}
        assert most is None or most < 300 or all(len(p) <= most for p in got.values())
    assert df.select(reports.preview(F.col("s"), F.col("c"), [], 900)).count() == 80


REPORT = """# Acme

Reviewed: 2024-01-02

## Company

- Legal entity: ACME LTD
- Company number: 01
- Status: active
- Source mode: public_api

## Latest accounts filing

- Filing date: 2023-12-01
- Description: full

## Financial highlights

- Turnover: GBP 1,234,567 vs -GBP 5
- Gross profit: None vs GBP 0
- Operating result: GBP 1 vs GBP 1
- Profit after tax: GBP 1 vs GBP 1
- Cash: GBP 1 vs GBP 1
- Net assets: GBP 1 vs GBP 1

## Derived metrics

- Turnover change: 12.35%
- Gross margin: 50.00% vs n/a
- Operating margin: n/a vs n/a
- Net margin: n/a vs n/a
- Current ratio: 1.50x vs n/a

## Commentary extracted from filing

- backlog_million_gbp: 2.5
"""


def test_company_report(spark):
    figures = "struct<turnover:bigint,gross_profit:bigint,operating_result:bigint,profit_after_tax:bigint,cash:bigint,net_assets:bigint>"
    ratios = ", ".join(f"{r}_{p}:double" for r in ("gross_margin", "operating_margin", "net_margin", "current_ratio") for p in ("current", "previous"))
    kind = f"label string, at string, company struct<company_name:string,company_number:string,company_status:string,source_mode:string>, filing struct<date:string,description:string>, years struct<current:{figures},previous:{figures}>, derived struct<turnover_change_pct:double, {ratios}>, said map<string,string>"
    one, years = ("ACME LTD", "01", "active", "public_api"), ((1234567, None, 1, 1, 1, 1), (-5, 0, 1, 1, 1, 1))
    derived = (12.345678, 0.5, None, None, None, None, None, 1.5, None)
    rows = [("Acme", "2024-01-02", one, ("2023-12-01", "full"), years, derived, {"backlog_million_gbp": "2.5"}), ("No", "t", one, None, years, derived, {}), ("Bad", "t", one, None, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    got = {r.label: r.r for r in df.select("label", reports.company_report(*[F.col(c) for c in ("label", "at", "company", "filing", "years", "derived", "said")]).alias("r")).collect()}
    assert got["Acme"] == REPORT
    assert got["No"].endswith("## Latest accounts filing\n\n- No public accounts filing was found for the selected company.\n")
    assert got["Bad"] == "# Bad\n\nReviewed: t\n\nAccounts document could not be parsed into structured financial metrics.\n"


def test_skeletons_and_reviews(spark):
    kind = "company_number string, company_name string, financial_year int, sic_code string, sic_label string, narrative_run_id long, sections map<string,string>"
    df = spark.createDataFrame([("1", "A", 2024, "9", None, 4, {"s": "t"}), ("2", "B", None, None, None, 5, {}), ("3", "C", None, None, None, 6, None)], kind)
    (found,) = reports.case_skeletons(df, ["business_model"]).collect()
    case = json.loads(found.case_json)
    assert found.company_number == "1" and case["sections"] == {"s": "t"} and case["sic_label"] is None and case["review"] == {"status": "unreviewed", "reviewed_at": None}
    assert case["expected"] == {"business_description": None, "business_model": {"value": None, "quote": None, "section": None}, "sic_agreement": {"value": None, "reason": None}}
    items = [("a", "complete", 5, 9, 1), ("a", "complete", None, 7, 2), ("a", "pending", 99, 99, 3), ("a", "complete", 7, 1, 4), ("b", "complete", None, None, 5), ("", "complete", 1, 1, 6), (None, "complete", 1, 1, 7)]
    got = reports.latest_reviews(spark.createDataFrame(items, "case_id string, status string, completed_at long, updated_at long, item_id int")).collect()
    assert sorted((r.case_id, r.item_id) for r in got) == [("a", 4), ("b", 5)]


def test_digests_do_not_depend_on_order_and_add_up(spark):
    rows = [(k, f"v{k % 7}", None if k % 5 else float(k)) for k in range(3000)] + [(None, "x", 1.0)]
    df = spark.createDataFrame(rows, "k long, a string, b double")
    digest = lambda d: tuple(reports.dataset_digest(reports.range_digests(d, "k", d.columns)).first())
    whole = digest(df)
    assert whole[0] == 3001 and digest(df.repartition(7, "a").select("b", "k", "a")) == whole == digest(df.orderBy(F.desc("k")))
    assert digest(df.unionAll(df.limit(1))) != whole != digest(df.withColumn("a", F.when(F.col("k") == 5, "w").otherwise(F.col("a"))))
    parts = [reports.range_digests(df.where(c), "k", df.columns) for c in ("k < 900", "k >= 900 or k is null")]
    both = parts[0].unionAll(parts[1]).groupBy("part").agg(F.sum("n").alias("n"), *[F.sum(f"lane_{k}").alias(f"lane_{k}") for k in range(4)])
    assert tuple(reports.dataset_digest(both).first()) == whole
    assert digest(df.limit(0))[0] == 0
