"""Scalar functions against values worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import arithmetic, money, text


def values(spark, f, rows, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], f"k int, x {kind}").repartition(2)
    return [r.y for r in sorted(df.select("k", f(F.col("x")).alias("y")).collect(), key=lambda r: r.k)]


CASES = [
    (text.parse_date, ["31/12/2020", "2020-02-29", "30/02/2020", "x", "", None, "1/2/2021"], [date(2020, 12, 31), date(2020, 2, 29), None, None, None, None, date(2021, 2, 1)]),
    (text.industry_code, ["62020 - Consultancy", " 01110", "6202", "None Supplied", "", None], ["62020", "01110", None, None, None, None]),
    (text.domain, ["https://www.Example.co.uk:80/x", "http://user@a.b/?q", "nonsense", "", None, "https://www./"], ["example.co.uk", "a.b", None, None, None, None]),
    (text.collapse, [" a \n\t b ", None, ""], ["a b", "", ""]),
    (lambda c: text.keyword_hits(c, ["shop", "product", "products"]), ["Workshop products", "aaa", None], [3, 0, 0]),
    (text.name_tokens, ["The ACME-Trading & Co Group LTD acme", None], [["acme", "trading", "acme"], []]),
    (text.financial_year, ["year ended 2023 and 2022", "12020 20201", "in 1899", None, "31/12/2101x"], [2023, None, None, None, 2101]),
    (text.visible_text, ["<p>a &amp; b</p><br>c&nbsp;d", None], ["a & b c d", ""]),
    (text.sentences, ["One. Two!  Three? four", "", None], [["One.", "Two!", "Three?", "four"], [], None]),
    (text.about_performance, ["Revenue rose.", "Revenue rose", "The workshop closed.", "Market share fell to 3.5 per cent."], [True, False, False, True]),
    (text.display_number, ["(1,234)", "£5,678", "-", "", "n/a", "12 %"], [-1234, 5678, None, None, None, 12]),
    (text.score_reasons, ["tier-3 SIC; established 7.3yr", "a|b||", None], [["tier-3 SIC", "established 7.3yr"], ["a", "b"], []]),
    (text.page_number, ["7", "page 7", "Document page 12", "p7", "", None], [7, 7, 12, None, None, None]),
    (text.page_list, ["3, 1,x,3", "", None], [[1, 3], [], []]),
    (text.last_path_segment, ["http://a/b/c/", "c", None], ["c", "c", None]),
    (text.label_text, ["Shareholders' funds (Note 3)", None], ["shareholders funds note 3", ""]),
    (text.quote_text, ["“Sales  rose, by 3.5%”", "a - b"], ["Sales rose by 3.5%", "a b"]),
    (text.repair_json, ['```json\n{"a": [1, 2,], "b": ",}",}\n```', "none", None], ['{"a": [1, 2], "b": ",}"}', None, None]),
    (text.readable_markdown, ["<h1>Title</h1><p>- item</p><p>1. one &lt;x&gt;</p><script>x</script>", None], ["Title\n\n\\- item\n\n1\\. one <x>", ""]),
    (money.unit, ["£", "£000", "£'000", "USD millions", "GBP", "x", None], ["GBP", "GBP_THOUSANDS", "GBP_THOUSANDS", "USD_MILLIONS", "GBP", "UNKNOWN", "UNKNOWN"]),
    (money.display_decimal, ["1,234.5", "(99)", "-", "–", "abc", None], [Decimal("1234.5"), Decimal(-99), Decimal(0), Decimal(0), None, None]),
    (lambda c: money.pence(c, F.lit("GBP_THOUSANDS")), ["12.345", "(1)", "-"], [1234500, -100000, 0]),
    (lambda c: money.pence(c, F.lit("USD")), ["12"], [None]),
    (money.count_value, ["12", "2.5", "-", "x"], [12, None, 0, None]),
    (lambda c: money.with_currency(c, F.lit("EUR")), ["GBP_THOUSANDS", "UNKNOWN"], ["EUR_THOUSANDS", "UNKNOWN"]),
]


@pytest.mark.parametrize("f, rows, want", CASES)
def test_text_functions(spark, f, rows, want):
    assert values(spark, f, rows) == want


def test_arithmetic(spark):
    row = spark.sql("select 150.0D a, 100.0D b, -100.0D c, 0.0D z, cast(null as double) n")
    got = row.select(
        arithmetic.change_over_magnitude(F.col("a"), F.col("b")), arithmetic.change_over_magnitude(F.col("b"), F.col("c")), arithmetic.change_over_base(F.col("b"), F.col("c")),
        arithmetic.ratio(F.col("a"), F.col("z")), arithmetic.percent(F.col("a"), F.col("n")), arithmetic.share_within_bounds(F.col("a"), F.col("b")),
        arithmetic.share_within_bounds(F.lit(1), F.lit(3)), arithmetic.whole_ratio(F.lit(7), F.lit(2.0)), arithmetic.whole_ratio(F.lit(7), F.lit(0.0)),
    ).first()
    assert tuple(got) == (50.0, 200.0, -200.0, None, None, None, 33.33, 3, None)
    ties = spark.sql("select cast(x as decimal(18,4)) x from values ('0.005'), ('0.015'), ('0.025'), ('-0.005') t(x)")
    assert [r.p for r in ties.select(arithmetic.to_pence(F.col("x"), F.lit(1).cast("decimal(9,6)")).alias("p")).collect()] == [0, 2, 2, 0]
    assert [arithmetic.bounded(n) for n in (-1, 0, 5, 1000)] == [1, 1, 5, 100]
    assert values(spark, money.display_text, [1234, -5, None], "bigint") == ["1,234", "(5)", None]
    assert values(spark, text.currency_text, [-1234, 0, None], "bigint") == ["-GBP 1,234", "GBP 0", None]


def test_markdown_resolves_only_entities_that_end(spark):
    rows = ["<p>a &amp b</p><p>&amp</p><p>&lt;x &copy; &#39;&#x41; &#39 &nope; &ampx;</p>"]
    assert values(spark, text.readable_markdown, rows) == ["a &amp b\n\n&amp\n\n<x © 'A &#39 &nope; &ampx;"]
