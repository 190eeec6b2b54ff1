"""Website evidence: keyword counts, matches with the company's name, and capped scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import text

# Words counted for each topic, as substrings.
KEYWORDS: dict[str, list[str]] = {
    "ecommerce": ["shop", "product", "products", "buy", "basket", "cart", "checkout", "delivery", "sale", "collection"],
    "service": ["service", "services", "maintenance", "installation", "contractor", "solution", "solutions", "project", "projects", "support", "refurbishment"],
    "b2b": ["client", "clients", "sector", "sectors", "commercial", "framework", "contract", "nationwide", "public sector"],
    "location": ["postcode", "find us", "find a store", "find a dealer", "store locator", "location", "locations", "branch", "branches", "nationwide"],
    "trust": ["award", "accredited", "trusted", "established", "experience", "years", "family-run", "certified"],
    "contact": ["contact", "call us", "email us", "get in touch", "enquiry", "enquiries", "request a quote", "book"],
}
FLAGS = ["has_checkout", "has_store_locator", "has_quote_form", "has_booking", "has_demo", "has_finance"]
PRICE = r"([£$€]\s?\d)"


def topic_counts(body: Column) -> dict[str, Column]:
    """<topic>_keyword_count of each topic, and price_mention_count."""
    counts = {f"{topic}_keyword_count": text.keyword_hits(body, words) for topic, words in KEYWORDS.items()}
    return counts | {"price_mention_count": F.size(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(PRICE), 1)).cast("bigint")}


def scores() -> dict[str, Column]:
    """The five scores from the counts and flags, each at most 100."""
    count = lambda t: F.col(f"{t}_keyword_count")
    flag = lambda f, points: F.when(F.col(f), points).otherwise(0.0)
    capped = lambda most, value: F.least(F.lit(most), value)
    top = lambda *parts: F.least(F.lit(100.0), sum(parts, F.lit(0.0)))
    shop = top(flag("has_checkout", 35.0), capped(25.0, count("ecommerce") * 3.0), capped(20.0, F.col("price_mention_count") * 2.0), flag("has_store_locator", 10.0))
    lead = top(flag("has_quote_form", 30.0), flag("has_booking", 25.0), flag("has_demo", 20.0), capped(15.0, count("contact") * 2.0), capped(10.0, count("service") * 1.5))
    b2b = top(capped(35.0, count("service") * 3.0), capped(25.0, count("b2b") * 4.0), capped(15.0, count("trust") * 3.0), flag("has_quote_form", 10.0))
    local = top(flag("has_store_locator", 25.0), flag("has_booking", 15.0), capped(30.0, count("location") * 4.0), capped(20.0, count("contact") * 2.0))
    fit = F.least(F.lit(100.0), F.greatest(shop, lead * 0.9 + b2b * 0.35, local * 0.7 + lead * 0.3))
    named = {"ecommerce_signal_score": shop, "lead_generation_signal_score": lead, "b2b_service_signal_score": b2b, "local_presence_signal_score": local, "ppc_fit_score": fit}
    return {k: F.round(v, 2) for k, v in named.items()}


def scored(sites: DataFrame, body: str) -> DataFrame:
    """Sites with counts and scores; flags that are missing are false."""
    absent = {f: F.coalesce(F.col(f), F.lit(False)) if f in sites.columns else F.lit(False) for f in FLAGS}
    return sites.withColumns(absent).withColumns(topic_counts(F.col(body))).withColumns(scores())


def name_match(name: Column, domain_text: Column, title_text: Column, status_ok: Column, has_url: Column) -> Column:
    """Token hits and shares in domain and title, and the confidence that the site is the company's."""
    tokens = text.name_tokens(name)
    n = F.size(tokens)
    hits = {k: F.size(F.filter(tokens, lambda t: F.contains(F.lower(v), t))) for k, v in (("domain", domain_text), ("title", title_text))}
    share = {k: F.coalesce(F.round(h / F.nullif(n, F.lit(0)), 4), F.lit(0.0)) for k, h in hits.items()}
    confidence = F.when(status_ok, 20.0).otherwise(0.0) + share["domain"] * 45.0 + share["title"] * 25.0 + F.when(has_url, 10.0).otherwise(0.0)
    return F.struct(
        n.alias("company_token_count"), hits["domain"].alias("domain_token_match_count"), hits["title"].alias("title_token_match_count"),
        share["domain"].alias("domain_match_ratio"), share["title"].alias("title_match_ratio"), F.round(F.least(F.lit(100.0), confidence), 2).alias("site_match_confidence_score"),
    )


def investigations(payloads: DataFrame) -> DataFrame:
    """Signals of website payloads (company_name, status, website and chosen_result structs, arrays of results)."""
    w, r = (lambda c: F.col(f"website.{c}")), (lambda c: F.col(f"chosen_result.{c}"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    body = F.concat_ws(" ", w("title"), w("meta_description"), w("og_description"), w("body_sample"), F.array_join(w("nav_links"), " "), F.array_join(w("ctas"), " "), r("title"), r("snippet"))
    domain_text = F.concat_ws(" ", text.domain(w("final_url")), r("hostname"), r("target_url"))
    title_text = F.concat_ws(" ", r("title"), r("snippet"), w("title"), w("meta_description"))
    match = name_match(F.col("company_name"), domain_text, title_text, F.col("status") == "ok", empty(w("final_url")) != "")
    length = lambda c: F.coalesce(F.size(c), F.lit(0))
    rows = payloads.withColumns({f: F.coalesce(w(f), F.lit(False)) for f in FLAGS}).withColumns({"__body": text.collapse(body), "__match": match})
    rows = rows.withColumns(
        {
            "search_results_count": length(F.col("search_results")), "candidate_count": length(F.col("candidates")), "body_char_count": F.length(empty(w("body_sample"))),
            "body_word_count": F.size(F.filter(F.split(empty(w("body_sample")), r"\s+"), lambda x: x != "")), "nav_link_count": length(w("nav_links")),
            "cta_count": length(w("ctas")), "h1_count": length(w("h1s")), "chosen_result_score": r("score"),
        }
    )
    return scored(rows.select("*", "__match.*"), "__body").drop("__body", "__match")
