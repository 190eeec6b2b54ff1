"""Texts for readers: company reports, previews within a budget of characters, case skeletons, data-set digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import text
from tallyfold.operators.upsert import latest_by

#: The figures of a report in order, and the ratios with their scale and mark.
HIGHLIGHTS = [("Turnover", "turnover"), ("Gross profit", "gross_profit"), ("Operating result", "operating_result"), ("Profit after tax", "profit_after_tax"), ("Cash", "cash"), ("Net assets", "net_assets")]
RATIOS = [("Gross margin", "gross_margin", 100, "%"), ("Operating margin", "operating_margin", 100, "%"), ("Net margin", "net_margin", 100, "%"), ("Current ratio", "current_ratio", 1, "x")]
#: Room kept for the list of what is left out, and the shortest excerpt worth showing.
OMITTED_ROOM, LEAST_EXCERPT = 200, 40


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def _fixed(value: Column, scale: int, mark: str) -> Column:
    """Two decimals, ties to the even digit; n/a for null."""
    return F.when(value.isNull(), "n/a").otherwise(F.concat(F.format_string("%.2f", F.bround((value * scale).cast("double"), 2)), F.lit(mark)))


def company_report(label: Column, generated_at: Column, company: Column, filing: Column, years: Column, derived: Column, commentary: Column) -> Column:
    """A company's report in markdown.

    ``company`` is a struct (company_name, company_number, company_status,
    source_mode); ``filing`` (date, description) or null; ``years`` (current,
    previous) of figures, null where the filing has none; ``derived`` the change and
    ratios; ``commentary`` a map of texts, in its own order.
    """
    # pieces are texts or columns; None within a line would swallow the line
    line = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    top = [line("# ", label), line(""), line("Reviewed: ", generated_at), line("")]
    none = F.array(*top, line("Accounts document could not be parsed into structured financial metrics."))
    about = [line("## Company"), line("")] + [line(f"- {name}: ", _shown(company[f])) for name, f in (("Legal entity", "company_name"), ("Company number", "company_number"), ("Status", "company_status"), ("Source mode", "source_mode"))]
    both = [line(f"- {name}: ", _shown(text.currency_text(years["current"][f])), " vs ", _shown(text.currency_text(years["previous"][f]))) for name, f in HIGHLIGHTS]
    ratios = [line("- Turnover change: ", _fixed(derived["turnover_change_pct"], 1, "%"))]
    for name, f, scale, mark in RATIOS:
        now, before = (_fixed(derived[f"{f}_{period}"], scale, mark) for period in ("current", "previous"))
        ratios.append(line(f"- {name}: ", now, " vs ", before))
    filed = F.array(line("- Filing date: ", _shown(filing["date"])), line("- Description: ", _shown(filing["description"])), line(""), line("## Financial highlights"), line(""), *both, line(""), line("## Derived metrics"), line(""), *ratios)
    accounts = F.when(filing.isNull(), F.array(line("- No public accounts filing was found for the selected company."))).otherwise(filed)
    told = F.transform(F.map_entries(commentary), lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"]))
    more = F.when(F.coalesce(F.size(told), F.lit(0)) > 0, F.concat(F.array(line(""), line("## Commentary extracted from filing"), line("")), told)).otherwise(F.array().cast("array<string>"))
    whole = F.concat(F.array(*top, *about, line(""), line("## Latest accounts filing"), line("")), accounts, more)
    return F.concat(F.array_join(F.when(years.isNull(), none).otherwise(whole), "\n"), F.lit("\n"))


def preview(sections: Column, cited: Column, priority: list[str], max_chars: int | None = None) -> Column:
    """Sections (an array of structs key, text, each key once) as one text of at most ``max_chars`` characters.

    Cited sections come first, in the order of citation, each with an equal share of
    the budget and cut to an excerpt where it is longer. What is left goes to the
    others, by ``priority`` and then as they stand, whole or not at all. What does
    not fit is named at the end. Sections without text do not count.
    """
    filled = F.filter(sections, lambda s: F.coalesce(s["text"] != "", F.lit(False)))
    of = lambda among, key: F.filter(among, lambda s: s["key"] == key)
    first = F.flatten(F.transform(F.array_distinct(cited), lambda key: of(filled, key)))
    keys = F.transform(first, lambda s: s["key"])
    left = F.filter(filled, lambda s: ~F.array_contains(keys, s["key"]))
    rest = F.concat(*[of(left, F.lit(p)) for p in priority], F.filter(left, lambda s: ~s["key"].isin(priority))) if priority else left
    block = lambda s: F.concat(F.lit("["), s["key"], F.lit("]\n"), s["text"])
    if max_chars is None:
        return F.array_join(F.transform(F.concat(first, rest), block), "\n\n")
    budget = max(0, max_chars - OMITTED_ROOM)
    share = F.greatest(F.lit(LEAST_EXCERPT), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.size(first)))).cast("int")
    none = F.array().cast("array<string>")
    state = lambda used, shown, omitted: F.struct(used.cast("int").alias("used"), shown.alias("shown"), omitted.alias("omitted"))

    def put(s: Column, b: Column) -> Column:
        return state(s["used"] + F.length(b) + F.when(s["used"] > 0, 2).otherwise(0), F.array_append(s["shown"], b), s["omitted"])

    def room(s: Column) -> Column:
        return F.lit(budget) - s["used"] - F.when(s["used"] > 0, 2).otherwise(0)

    def put_cited(s: Column, x: Column) -> Column:
        may = F.least(room(s), share)
        mark = F.concat(F.lit("...[truncated, "), F.length(x["text"]).cast("string"), F.lit(" chars total]"))
        keep = may - F.length(x["key"]) - 3 - F.length(mark)
        excerpt = F.concat(F.lit("["), x["key"], F.lit("]\n"), F.substr(x["text"], F.lit(1), keep), mark)
        skip = state(s["used"], s["shown"], F.array_append(s["omitted"], x["key"]))
        return F.when(F.length(block(x)) <= may, put(s, block(x))).when(keep < LEAST_EXCERPT, skip).otherwise(put(s, excerpt))

    def put_whole(s: Column, x: Column) -> Column:
        skip = state(s["used"], s["shown"], F.array_append(s["omitted"], x["key"]))
        return F.when(F.length(block(x)) <= room(s), put(s, block(x))).otherwise(skip)

    done = F.aggregate(rest, F.aggregate(first, state(F.lit(0), none, none), put_cited), put_whole)
    told = F.when(F.size(done["omitted"]) > 0, F.concat(F.lit("\n\n[omitted for length: "), F.array_join(done["omitted"], ", "), F.lit("]"))).otherwise("")
    return F.concat(F.array_join(done["shown"], "\n\n"), told)


def case_skeletons(contexts: DataFrame, fields: list[str], version: int = 1) -> DataFrame:
    """(company_number, case_json): an unreviewed case with empty expectations for every context that has sections.

    A context is (company_number, company_name, financial_year, sic_code, sic_label,
    narrative_run_id, sections map). Nulls are written, since a label has to be
    there to be filled in.
    """
    nothing = lambda *names: F.struct(*[F.lit(None).cast("string").alias(n) for n in names])
    expected = F.struct(F.lit(None).cast("string").alias("business_description"), *[nothing("value", "quote", "section").alias(f) for f in fields], nothing("value", "reason").alias("sic_agreement"))
    review = F.struct(F.lit("unreviewed").alias("status"), F.lit(None).cast("string").alias("reviewed_at"))
    own = ["company_number", "company_name", "financial_year", "sic_code", "sic_label", "narrative_run_id", "sections"]
    case = F.struct(F.lit(version).alias("schema_version"), *own, expected.alias("expected"), review.alias("review"))
    return contexts.where(F.coalesce(F.size("sections"), F.lit(0)) > 0).select("company_number", F.to_json(case, {"ignoreNullFields": "false"}).alias("case_json"))


def latest_reviews(items: DataFrame, case: str = "case_id") -> DataFrame:
    """The newest complete review of each case: items (case_id, status, completed_at, updated_at, item_id, ...).

    The time of completion counts, else that of the last change; of equal times the
    greater item id. Items without a case are left out.
    """
    done = items.where((F.col("status") == "complete") & F.coalesce(F.col(case) != "", F.lit(False)))
    at = F.coalesce("completed_at", "updated_at")
    return latest_by(done, [case], [at.desc_nulls_last(), F.desc("item_id")])


def record_hash(columns: list[str]) -> Column:
    """A digest of a row's values, by column name and independent of the columns' order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def range_digests(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(part, n, lanes): 256 parts of the keys' hashes, each with its count and four sums of 60 bits of its rows' digests.

    Sums do not depend on the rows' order or partitioning, and the digests of two
    data sets with different keys add up to that of both.
    """
    digest = record_hash(columns)
    lane = lambda k: F.conv(F.substring("__digest", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")
    found = rows.select(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 2).alias("part"), digest.alias("__digest"))
    return found.groupBy("part").agg(F.count("*").alias("n"), *[F.sum(lane(k)).alias(f"lane_{k}") for k in range(4)])


def dataset_digest(parts: DataFrame) -> DataFrame:
    """(n, digest) of a whole data set from the digests of its parts (256 rows at most, whatever its size)."""
    line = F.concat_ws(":", "part", F.col("n").cast("string"), *[F.col(f"lane_{k}").cast("string") for k in range(4)])
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))
