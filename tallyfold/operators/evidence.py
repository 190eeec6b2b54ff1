"""Evidence policy: candidate rows from transcribed pages, their tiers, and the values chosen.

Every step is a projection, a filter, an aggregation or a window within one
document (or the keys that the caller names), so documents are independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.functions import money, text

# Metrics, statement types, scopes, and what belongs to what.
CANONICAL = ["turnover", "gross_profit", "operating_result", "profit_after_tax", "cash", "net_assets", "employees"]
INSURANCE_LABELS: dict[str, list[str]] = {
    "gross_premiums_written": ["gross premiums written", "premiums written gross amount"],
    "outward_reinsurance_premiums": ["outward reinsurance premiums"],
    "net_premiums_written": ["net premiums written"],
    "net_change_unearned_premiums": ["net change in the provision for unearned premiums"],
    "net_earned_premiums": ["earned premiums net of reinsurance"],
    "allocated_investment_return": ["allocated investment return"],
    "total_technical_income": ["total technical income"],
    "claims_incurred_net_reinsurance": ["claims incurred net of reinsurance"],
    "net_operating_expenses": ["net operating expenses"],
    "technical_account_result": ["balance on the technical account", "result on the technical account"],
    "investment_income": ["investment income"],
}
INSURANCE = list(INSURANCE_LABELS)
INCOME_FAMILY = ["turnover", "cost_of_sales", "gross_profit", "administrative_expenses", "operating_result", "profit_before_tax", "tax", "profit_after_tax", *INSURANCE]
BALANCE_FAMILY = ["current_assets", "net_current_assets", "net_assets", "shareholders_funds"]
MONEY = [*INCOME_FAMILY, *BALANCE_FAMILY, "cash"]
PRIMARY_STATEMENTS = ["income_statement", "balance_sheet", "cash_flow"]
ALLOWED_STATEMENTS = {
    "turnover": ["income_statement"],
    "gross_profit": ["income_statement"],
    "operating_result": ["income_statement"],
    "profit_after_tax": ["income_statement"],
    "cash": ["balance_sheet", "cash_flow"],
    "net_assets": ["balance_sheet"],
}
SCOPE_ALIASES = {"consolidated": "consolidated_group", "group": "consolidated_group", "group_accounts": "consolidated_group", "parent_company": "company"}
SCOPES = ["consolidated_group", "company"]
EQUITY_LABELS = ["shareholders funds", "shareholder funds", "total equity"]
OPERATING_LABELS = [
    "operating profit", "operating loss", "operating result", "profit from operations", "loss from operations", "profit on ordinary activities before interest",
    "loss on ordinary activities before interest",
]
OPERATING_SUBTOTAL = r"\bebitda\b|\badjusted\b|\bunderlying\b|\bbefore\s+(?:non\s+recurring|exceptional|one\s+off|special|amortisation|amortization|depreciation)\b"
BEFORE_TAX = r"\b(?:profit|loss)(?: on ordinary activities)? before tax(?:ation)?\b"
WRONG_LABELS = {
    "turnover": ["cost of sales", "gross profit", "administrative", "net assets"],
    "gross_profit": ["cost of sales", "administrative", "total assets", "net assets"],
    "operating_result": ["other operating", "administrative expenses", "cost of sales"],
    "profit_after_tax": ["tax charge", "taxation charge"],
    "cash": ["current assets", "total assets", "net assets", "total equity", "total liabilities"],
    "net_assets": ["current assets", "total assets", "cash and cash equivalents", "total liabilities", "total equity and liabilities"],
    "shareholders_funds": ["total liabilities", "total equity and liabilities", "total assets"],
    "employees": ["staff costs", "wages and salaries", "social security costs"],
}
NO_EMPLOYEES = (
    r"(?i)\b(?:has|had|have) no employees?\b|\bemployed no (?:employees?|persons?)\b|\bdid not employ (?:any )?(?:employees?|persons?)\b|"
    r"\bdoes? not (?:directly )?employ (?:any )?(?:staff|employees?|persons?)\b|\b(?:average\s+)?number of (?:staff|employees?|persons?)(?:\s+\w+){0,12}\s+(?:was|were)\s+nil\b"
)
QUALIFIED_NO_EMPLOYEES = r"(?i)\bno employees?\b[^.;:\n]{0,120}\b(?:other than|except(?:\s+for)?)\b"
BOTH_PERIODS = r"(?i)\b(?:prior|previous|comparative)\s+period\b|\bboth\s+periods\b|\b20\d{2}\b[^.;:\n]{0,40}\b(?:nil|zero|no employees?)\b"
SUSPECT_YEARS = [2022, 2023, 2024, 2025, 2026]
INELIGIBLE = 5


def statement_scope(value: Column) -> Column:
    """The scope that a heading names, by its aliases, else unknown."""
    key = F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), "[- ]", "_")
    aliases = F.create_map(*[F.lit(x) for item in SCOPE_ALIASES.items() for x in item])
    named = F.coalesce(F.try_element_at(aliases, key), key)
    return F.when(named.isin(SCOPES), named).otherwise("unknown")


def insurance_label_fits(metric: Column, label: Column) -> Column:
    """Whether an insurance metric's label begins as one of its family; other metrics always fit."""
    fits = F.lit(True)
    for name, starts in INSURANCE_LABELS.items():
        any_ = F.lit(False)
        for start in starts:
            any_ = any_ | label.startswith(start)
        fits = F.when(metric == name, any_).otherwise(fits)
    return fits


def canonical_label_fits(metric: Column, label: Column) -> Column:
    """Whether a label can stand for the whole figure: no subtotals as operating result, no figure before tax as one after it."""
    unscoped = F.regexp_replace(label, "^(?:group|company|consolidated|parent) (?=.)", "")
    operating = F.lit(False)
    for start in OPERATING_LABELS:
        operating = operating | unscoped.startswith(start)
    return F.when(metric == "operating_result", operating & ~label.rlike(OPERATING_SUBTOTAL)).when(metric == "profit_after_tax", ~label.rlike(BEFORE_TAX)).otherwise(True)


def statement_fits(metric: Column, statement: Column) -> Column:
    """Whether a figure belongs on the primary statement that it stands on."""
    allowed = F.try_element_at(F.create_map(*[x for m, s in ALLOWED_STATEMENTS.items() for x in (F.lit(m), F.array(*map(F.lit, s)))]), metric)
    return allowed.isNull() | ~F.coalesce(statement.isin(PRIMARY_STATEMENTS), F.lit(False)) | F.array_contains(allowed, statement)


def exploded(documents: DataFrame, key: str = "document_id", pages: str = "pages") -> DataFrame:
    """Pages with rows as one row per transcribed line, numbered in order of appearance."""
    page = documents.select(key, F.posexplode(pages).alias("page_pos", "p"))
    rows = page.select(key, "page_pos", F.col("p.page").alias("page"), "p.statement_type", "p.statement_scope", "p.unit", F.posexplode("p.rows").alias("row_pos", "r"))
    named = rows.select(key, "page_pos", "row_pos", "page", "statement_type", "statement_scope", "unit", "r.*")
    return named.withColumn("candidate_id", F.concat_ws("-", F.lit("p"), "page_pos", F.lit("r"), "row_pos"))


def corrected_statement(rows: DataFrame, page_keys: list[str]) -> DataFrame:
    """An income statement page with no income row and two balance sheet metrics or more is a balance sheet."""
    page = Window.partitionBy(*page_keys)
    income = F.count_if(F.col("metric").isin(INCOME_FAMILY)).over(page)
    balance = F.size(F.collect_set(F.when(F.col("metric").isin(BALANCE_FAMILY), F.col("metric"))).over(page))
    wrong = (F.col("statement_type") == "income_statement") & (income == 0) & (balance >= 2)
    return rows.withColumn("statement_type", F.when(wrong, "balance_sheet").otherwise(F.col("statement_type")))


def majority(rows: DataFrame, keys: list[str], value: str, at_least: int = 2) -> DataFrame:
    """(keys, value) where one value occurs more often than all others together, and often enough."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.max_by(value, "n").alias(value))
    return top.where((F.col("most") >= at_least) & (F.col("most") > F.col("total") - F.col("most"))).select(*keys, value)


def unanimous(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value) where all rows that have a value have the same one."""
    found = rows.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("most"))
    return found.where(F.col(value) == F.col("most")).select(*keys, value)


def in_majority_currency(rows: DataFrame, key: str = "document_id") -> DataFrame:
    """Units of a minority currency become the majority's, at the same scale."""
    pages = rows.where(F.col("statement_type").isin(PRIMARY_STATEMENTS)).withColumn("code", money.currency(F.col("unit"))).select(key, "page", "code").distinct()
    return rows.join(majority(pages, [key], "code"), key, "left").withColumn("unit", money.with_currency(F.col("unit"), F.col("code"))).drop("code")


def _shown(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _plain_label() -> Column:
    return F.regexp_replace(F.lower(F.coalesce("source_label", F.lit(""))), "['‘’]", "")


def validation_issues(label: Column | None = None, plain: Column | None = None) -> Column:
    """The rules that a candidate breaks, as (code, message), in order; ``label`` and ``plain`` are its label's two forms, if columns hold them."""
    metric, statement = F.col("metric"), F.col("statement_type")
    label = text.label_text(F.col("source_label")) if label is None else label
    plain = _plain_label() if plain is None else plain
    values = [_shown("current_display"), _shown("previous_display")]
    counts = [money.count_value(v) for v in values]
    employees = metric == "employees"
    year = F.lit(False)
    for v in values:
        year = year | F.coalesce(F.regexp_replace(v, "^[() -]+|[() -]+$", "").isin([str(y) for y in SUSPECT_YEARS]), F.lit(False))
    wrong = F.lit(None).cast("string")
    for name, phrases in WRONG_LABELS.items():
        first = F.coalesce(*[F.when(plain.contains(p), F.lit(p)) for p in phrases])
        wrong = F.when(metric == name, first).otherwise(wrong)

    def issue(code: str, broken: Column, message: Column | str) -> Column:
        told = F.array(F.struct(F.lit(code).alias("code"), (F.lit(message) if isinstance(message, str) else message).alias("message")))
        return F.when(broken, told).otherwise(F.array().cast("array<struct<code:string,message:string>>"))

    return (
        F.concat(  # arrays of one or none, which Spark compiles; rules within a lambda's argument would be interpreted
            issue("missing_source_label", label == "", "the row has no label"),
            issue("missing_period_values", F.when(employees, F.coalesce(*counts).isNull()).otherwise(F.coalesce(*values).isNull()), "the row has no value for either period"),
            issue("unknown_money_unit", metric.isin(MONEY) & ~F.coalesce(money.currency(F.col("unit")).isin("GBP", "USD"), F.lit(False)), "a money row needs a sterling or dollar unit"),
            issue("insurance_metric_label_conflict", ~insurance_label_fits(metric, label), "the label is none of the metric's family"),
            issue("metric_label_conflict", metric.isin(CANONICAL) & ~canonical_label_fits(metric, label), "the label names another figure"),
            issue("metric_statement_conflict", metric.isin(CANONICAL) & ~statement_fits(metric, statement), "the metric does not belong on this statement"),
            issue("year_used_as_value", year, "a year stands where a value should"),
            issue("metric_label_conflict", wrong.isNotNull(), F.concat(F.lit("the label holds "), wrong)),
        )
    )


def narrative_zero_issues() -> Column:
    """The rules on evidence for a head-count of zero: columns evidence_text, period_scope, and <period>_evidence_kind, <period>_value_count."""
    prose = F.coalesce("evidence_text", F.lit(""))
    direct, qualified = prose.rlike(NO_EMPLOYEES), prose.rlike(QUALIFIED_NO_EMPLOYEES)
    says = {p: (F.col(f"{p}_evidence_kind") == "narrative_zero") & F.col(f"{p}_value_count").isNotNull() for p in ("current", "previous")}
    codes = []
    for p, is_prose in says.items():
        count, shown = F.col(f"{p}_value_count"), F.coalesce(_shown(f"{p}_display"), F.lit(""))
        codes += [
            F.when(is_prose & qualified, "ambiguous_narrative_zero_evidence").when(is_prose & ((count != 0) | ~direct), "invalid_narrative_zero_evidence"),
            F.when((F.col(f"{p}_evidence_kind") == "dash_zero") & count.isNotNull() & ((count != 0) | ~shown.rlike("^[-–—]+$")), "invalid_dash_zero_evidence"),
            F.when((F.col(f"{p}_evidence_kind") == "numeric") & count.isNotNull() & money.count_value(shown).isNull(), "invalid_numeric_employee_evidence"),
        ]
    both = F.concat(F.when(says["current"], "current").otherwise(""), F.when(says["previous"], "previous").otherwise(""))
    scope = F.when(F.col("period_scope") == "both", "currentprevious").otherwise(F.coalesce("period_scope", F.lit("none")))
    codes.append(F.when((both != "") & (both != scope), "narrative_zero_period_scope_mismatch"))
    return F.when(F.col("metric") == "employees", F.array_compact(F.array(*codes))).otherwise(F.array().cast("array<string>"))


def with_narrative_scope(candidates: DataFrame) -> DataFrame:
    """A zero told once, without a word on the period before, counts for the current period only."""
    prose = F.coalesce("evidence_text", F.lit(""))
    kinds = (F.col("current_evidence_kind") == "narrative_zero") & (F.col("previous_evidence_kind") == "narrative_zero")
    told = kinds & F.col("current_value_count").isNotNull() & F.col("previous_value_count").isNotNull()
    once = F.coalesce((F.col("metric") == "employees") & told & (F.col("period_scope") == "both") & ~prose.rlike(QUALIFIED_NO_EMPLOYEES) & ~prose.rlike(BOTH_PERIODS), F.lit(False))
    new = {"previous_display": F.lit(None), "previous_value_count": F.lit(None), "previous_evidence_kind": F.lit("none"), "period_scope": F.lit("current")}
    return candidates.withColumns({c: F.when(once, v).otherwise(F.col(c)) for c, v in new.items()})


def no_employee_pages(pages: DataFrame) -> DataFrame:
    """Pages whose text says plainly that nobody is employed."""
    return pages.where(F.col("text").rlike(NO_EMPLOYEES) & ~F.col("text").rlike(QUALIFIED_NO_EMPLOYEES))


def one_sided_row() -> Column:
    """The period that a money row lacks although both columns have a heading, or null."""
    headed = (F.coalesce(_shown("current_column"), F.lit("")) != "") & (F.coalesce(_shown("previous_column"), F.lit("")) != "")
    now, before = _shown("current_display").isNotNull(), _shown("previous_display").isNotNull()
    return F.when(F.col("metric").isin(MONEY) & headed & (now != before), F.when(now, "previous").otherwise("current"))


def primary_pages(located: DataFrame) -> DataFrame:
    """Located pages (page, statement_type, page_count) with a primary statement, within the document."""
    return located.where(F.col("statement_type").isin(PRIMARY_STATEMENTS) & F.col("page").between(1, F.col("page_count")))


def employee_pages(located: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with a head-count; where a document has none, its other pages if it has any primary statement."""
    inside = located.where(F.col("page").between(1, F.col("page_count")))
    w = Window.partitionBy(*keys)
    marked = inside.withColumns({"__direct": F.count_if(F.col("contains_employee_count")).over(w), "__primary": F.count_if(F.col("statement_type").isin(PRIMARY_STATEMENTS)).over(w)})
    wanted = F.when(F.col("__direct") > 0, F.col("contains_employee_count")).otherwise((F.col("__primary") > 0) & (F.col("statement_type") == "other"))
    return marked.where(wanted).select(*keys, "page").distinct()


#: Why a page is read again, the most serious first.
RECOVERY_SEVERITY = {
    "balance_sheet_missing_net_assets": 0,
    "balance_sheet_missing_cash": 1,
    "balance_sheet_current_assets_without_cash": 1,
    "cash_flow_missing_cash_row": 2,
    "income_statement_partial_core_family": 3,
}


def recovery_pages(rows: DataFrame, located: DataFrame, keys: list[str], min_confidence: float = 0.8, most: int = 3) -> DataFrame:
    """(keys, page, triggers) of confidently located primary pages whose rows look incomplete, the most serious ones.

    ``rows`` are candidates; pages without any row count as they were located.
    """
    page = [*keys, "page"]
    equity = (F.col("metric") == "net_assets") | ((F.col("metric") == "shareholders_funds") & text.label_text(F.col("source_label")).isin(EQUITY_LABELS))
    has = lambda *m: F.coalesce(F.bool_or(F.col("metric").isin(*m)), F.lit(False))
    facts = rows.groupBy(*page).agg(
        has("turnover").alias("turnover"), has("gross_profit").alias("gross_profit"), has("operating_result", "profit_before_tax").alias("operating"), has("profit_after_tax").alias("after_tax"),
        has(*INCOME_FAMILY).alias("any_income"), F.size(F.collect_set(F.when(F.col("metric").isin(BALANCE_FAMILY), F.col("metric")))).alias("n_balance"), F.coalesce(F.bool_or(equity), F.lit(False)).alias("equity"),
        has("cash").alias("cash"), has("current_assets").alias("current_assets"), has(*MONEY).alias("money"),
    )
    flags = [c for c in facts.columns if c not in page and c != "n_balance"]
    joined = located.where(F.col("confidence") >= min_confidence).join(facts, page, "left").fillna(False, flags).fillna(0, ["n_balance"])
    kind = F.when((F.col("statement_type") == "income_statement") & ~F.col("any_income") & (F.col("n_balance") >= 2), "balance_sheet").otherwise(F.col("statement_type"))
    core = F.col("turnover") | F.col("gross_profit") | F.col("operating") | F.col("after_tax")
    whole = F.col("turnover") & F.col("gross_profit") & F.col("operating") & F.col("after_tax")
    balance, no_cash = kind == "balance_sheet", ~F.col("cash")
    rules = {
        "income_statement_partial_core_family": (kind == "income_statement") & core & ~whole,
        "balance_sheet_missing_net_assets": balance & ~F.col("equity"),
        "balance_sheet_current_assets_without_cash": balance & no_cash & F.col("current_assets"),
        "balance_sheet_missing_cash": balance & no_cash & ~F.col("current_assets") & F.col("money"),
        "cash_flow_missing_cash_row": (kind == "cash_flow") & F.col("money") & no_cash,
    }
    found = joined.withColumn("triggers", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).where(F.size("triggers") > 0)
    severity = F.create_map(*[F.lit(x) for item in RECOVERY_SEVERITY.items() for x in item])
    worst = F.array_min(F.transform("triggers", lambda t: F.element_at(severity, t)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(worst, "page"))
    return found.withColumn("__rank", rank).where(F.col("__rank") <= most).select(*page, "triggers")


def validated(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected rows tell their issues."""
    labelled = candidates.withColumns({"__label": text.label_text(F.col("source_label")), "__plain": _plain_label()})  # once a row, not once a rule
    checked = labelled.withColumn("issues", validation_issues(F.col("__label"), F.col("__plain"))).drop("__label", "__plain")
    return checked.where(F.size("issues") == 0).drop("issues"), checked.where(F.size("issues") > 0)


def issue_report(rejected: DataFrame, key: str = "document_id") -> DataFrame:
    """Issues per page and kind."""
    return rejected.select(key, "page", F.explode("issues").alias("i")).groupBy(key, "page", "i.code").agg(F.count("*").alias("n"))


def evidence_tier(label: Column | None = None) -> Column:
    """(role, tier): 1 a primary statement, 2 a native insurance row, 3 a direct synonym, 4 a note, 5 not eligible; ``label`` is the label's text, if a column holds it."""
    label = text.label_text(F.col("source_label")) if label is None else label
    metric, statement = F.col("metric"), F.col("statement_type")
    allowed = F.try_element_at(F.create_map(*[x for m, s in ALLOWED_STATEMENTS.items() for x in (F.lit(m), F.array(*map(F.lit, s)))]), metric)
    primary = F.coalesce(F.array_contains(allowed, statement), F.lit(False)) | ((metric == "employees") & statement.isin(PRIMARY_STATEMENTS))

    def found(role: str, tier: int) -> Column:
        return F.struct(F.lit(role).alias("role"), F.lit(tier).alias("tier"))

    insurance = (
        F.when(~insurance_label_fits(metric, label), found("incompatible_insurance_evidence", 5))
        .when(statement == "income_statement", found("primary_insurance_income_statement", 2))
        .when(statement == "other", found("exact_insurance_note", 4))
        .otherwise(found("incompatible_insurance_evidence", 5))
    )
    canonical = (
        F.when(~canonical_label_fits(metric, label), found("incompatible_canonical_label", 5))
        .when(~statement_fits(metric, statement), found("incompatible_canonical_statement", 5))
        .when(primary, found("primary_statement", 1))
        .otherwise(found("exact_supporting_note", 4))
    )
    return (
        F.when(metric.isin(INSURANCE), insurance)
        .when((metric == "shareholders_funds") & label.isin(EQUITY_LABELS) & (statement == "balance_sheet"), found("direct_synonym", 3))
        .when((metric == "profit_before_tax") & label.rlike(BEFORE_TAX) & (statement == "income_statement"), found("direct_synonym", 3))
        .when(metric.isin(CANONICAL), canonical)
        .otherwise(found("not_eligible", INELIGIBLE))
    )


def with_tier(candidates: DataFrame) -> DataFrame:
    """Candidates with role and tier; the label's text is made once a row, not once a rule."""
    labelled = candidates.withColumn("__label", text.label_text(F.col("source_label")))
    return labelled.withColumn("e", evidence_tier(F.col("__label"))).withColumns({"role": F.col("e.role"), "tier": F.col("e.tier")}).drop("e", "__label")


#: Which metric stands in for which, at which tier (null: its own).
EQUIVALENTS = [("shareholders_funds", "net_assets", 2), ("gross_premiums_written", "turnover", None), ("technical_account_result", "operating_result", None), ("profit_before_tax", "operating_result", None)]


def candidate_rank() -> Column:
    """Larger is better: low tier, known unit, more values, more confidence."""
    values = F.col("current_display").isNotNull().cast("int") + F.col("previous_display").isNotNull().cast("int")
    return F.struct((-F.col("tier")).alias("t"), (F.col("unit") != money.UNKNOWN).cast("int").alias("u"), values.alias("v"), F.coalesce("confidence", F.lit(0.0)).alias("c"))


def with_equivalents(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates with role and tier, and rows of other metrics that stand in for canonical ones.

    Per key and source metric the best eligible row gives the equivalent; earned
    premiums and claims of one page, scope, unit and tier add up to gross profit.
    """
    found = with_tier(candidates)
    found = found.withColumn("derived_from", F.lit(None).cast("string"))
    table = F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("target"), F.lit(t).cast("int").alias("as_tier")) for a, b, t in EQUIVALENTS])
    best = Window.partitionBy(*keys, "metric").orderBy(candidate_rank().desc(), "page_pos", "row_pos")
    standing_in = F.col("metric").isin([a for a, _, _ in EQUIVALENTS])  # no other metric's rows are ranked
    sources = found.where(standing_in & (F.col("tier") < INELIGIBLE)).withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")
    matched = sources.withColumn("m", F.explode(F.filter(table, lambda x: x["source"] == F.col("metric"))))
    derived = matched.withColumns({"derived_from": F.col("candidate_id"), "candidate_id": F.concat("candidate_id", F.lit(":"), "m.target"), "tier": F.coalesce("m.as_tier", "tier"), "metric": F.col("m.target")}).drop("m")
    return found.unionByName(derived).unionByName(_premiums_less_claims(found, keys))


def with_scope_equivalents(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The same within each statement scope, so that the evidence of a company and of its group does not mix; rows of any other scope stay without."""
    known = F.coalesce(F.col("statement_scope").isin(*SCOPES, "unknown"), F.lit(False))
    return with_equivalents(candidates.where(known), [*keys, "statement_scope"]).unionByName(candidates.where(~known), allowMissingColumns=True)


def _premiums_less_claims(found: DataFrame, keys: list[str]) -> DataFrame:
    place = list(dict.fromkeys([*keys, "page", "statement_scope", "unit", "tier"]))
    value = {p: money.display_decimal(F.col(f"{p}_display")) for p in ("current", "previous")}

    def side(metric: str, name: str) -> DataFrame:
        return found.where(F.col("metric") == metric).select(*place, *[v.alias(f"{name}_{p}") for p, v in value.items()], F.col("confidence").alias(f"{name}_confidence"), F.col("candidate_id").alias(f"{name}_id"))

    premiums = found.where("metric = 'net_earned_premiums'").withColumn("p_id", F.col("candidate_id"))
    pairs = premiums.join(side("claims_incurred_net_reinsurance", "c"), place)
    sums = {f"{p}_display": money.display_text(value[p] + F.col(f"c_{p}")) for p in value}
    pairs = pairs.withColumns(sums | {"metric": F.lit("gross_profit"), "confidence": F.least("confidence", "c_confidence"), "derived_from": F.concat_ws("+", "p_id", "c_id"), "candidate_id": F.concat("p_id", F.lit("+"), "c_id")})
    return pairs.select(found.columns)


def of_least_tier(rows: DataFrame, keys: list[str], tier: str = "tier") -> DataFrame:
    """Rows of the lowest tier of their key."""
    return rows.withColumn("__least", F.min(tier).over(Window.partitionBy(*keys))).where(F.col(tier) == F.col("__least")).drop("__least")


def strongest(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, metric and period only values of the lowest tier that has one; rows left without a value go."""
    w = Window.partitionBy(*keys, "metric")
    out = candidates
    for p in ("current", "previous"):
        shown = F.col(f"{p}_display")
        out = out.withColumn(f"__{p}", F.min(F.when(shown.isNotNull(), F.col("tier"))).over(w))
    for p in ("current", "previous"):
        out = out.withColumn(f"{p}_display", F.when(F.col("tier") == F.col(f"__{p}"), F.col(f"{p}_display")))
    return out.where("current_display is not null or previous_display is not null").drop("__current", "__previous")


def preferred_scope(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Group rows of tier 2 or better take out Company rows; else Group rows no better than the best Company row go."""
    w = Window.partitionBy(*keys)
    of = {s: F.min(F.when(F.col("scope") == s, F.col("tier"))).over(w) for s in ("Group", "Company")}
    marked = rows.withColumns({"__group": of["Group"], "__company": of["Company"]})
    strong = F.coalesce(F.col("__group") <= 2, F.lit(False))
    drop = F.when(F.col("scope") == "Company", strong).when(F.col("scope") == "Group", ~strong & F.coalesce(F.col("tier") >= F.col("__company"), F.lit(False))).otherwise(F.lit(False))
    return marked.where(~drop).drop("__group", "__company")


def selected(candidates: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Decisions (keys, period, metric, candidate_id) joined to their candidates, as exact values; the best per cell."""
    joined = decisions.join(candidates, [*keys, "metric", "candidate_id"])
    shown = F.when(F.col("period") == "current", F.col("current_display")).otherwise(F.col("previous_display"))
    rows = joined.withColumn("shown", shown).where("shown is not null")
    best = Window.partitionBy(*keys, "period", "metric").orderBy(candidate_rank().desc(), "page_pos", "row_pos")
    rows = rows.withColumn("r", F.row_number().over(best)).where("r = 1")
    employees = F.col("metric") == "employees"
    return rows.select(
        *keys, "period", "metric", "candidate_id", "page", "source_label", "unit", "confidence",
        F.when(~employees, money.reported_value(F.col("shown"), F.col("unit"))).alias("reported_value"),
        F.when(~employees, money.currency(F.col("unit"))).alias("currency_code"),
        F.when(~employees, money.pence(F.col("shown"), F.col("unit"))).alias("value_pence"),
        F.when(employees, money.count_value(F.col("shown"))).alias("value_count"),
    )


def completed_pairs(rows: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Current and previous values side by side, a missing one filled from the other, with a mark."""
    of = {p: F.max(F.when(F.col(period) == p, F.col(value))) for p in ("current", "previous")}
    both = rows.groupBy(*keys).agg(of["current"].alias("c"), of["previous"].alias("p"))
    return both.select(*keys, F.coalesce("c", "p").alias("current_value"), F.coalesce("p", "c").alias("previous_value"), (F.col("c").isNull() | F.col("p").isNull()).alias("completed"))


def with_neighbours(pages: DataFrame, keys: list[str], page: str, last: str, first: int = 1) -> DataFrame:
    """The pages and those next to them, within the document, each once."""
    around = F.sequence(F.greatest(F.lit(first).cast("bigint"), F.col(page).cast("bigint") - 1), F.least(F.col(last).cast("bigint"), F.col(page).cast("bigint") + 1))
    return pages.select(*keys, F.explode(around).alias(page)).distinct()


def longest_call(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Of several transcriptions of a page the one with most rows, the later call where they are equal."""
    best = Window.partitionBy(*keys, "page").orderBy(F.desc(F.size("rows")), F.desc("call_seq"))
    return pages.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def missing_and_empty(returned: DataFrame, required: DataFrame, keys: list[str]) -> DataFrame:
    """Required pages that were not returned, or returned without a row, with the reason."""
    sizes = returned.groupBy(*keys, "page").agg(F.max(F.size("rows")).alias("n"))
    joined = required.join(sizes, [*keys, "page"], "left")
    return joined.where("n is null or n = 0").select(*keys, "page", F.when(F.col("n").isNull(), "missing").otherwise("empty").alias("reason"))


def with_recovered(original: DataFrame, recovered: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, conflicts): recovered rows with an unseen metric and label are added; seen ones that differ are conflicts."""
    mark = lambda df: df.withColumn("label", text.label_text(F.col("source_label")))
    o, r = mark(original), mark(recovered)
    same = [*keys, "metric", "label"]
    added = r.join(o.select(*same), same, "left_anti")
    other = o.select(*same, F.col("current_display").alias("had_current"), F.col("previous_display").alias("had_previous"))
    seen = r.join(other, same)
    conflicts = seen.where(~F.col("current_display").eqNullSafe(F.col("had_current")) | ~F.col("previous_display").eqNullSafe(F.col("had_previous")))
    return o.unionByName(added.select(o.columns)).drop("label"), conflicts


def resolved_choices(decisions: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Decisions that name a source row of a canonical metric, with the one equivalent made from it in its place.

    ``canonicalised_from`` holds the id that was named; decisions that name a
    candidate of their metric, or a source of several equivalents, stay.
    """
    own = candidates.select(*keys, "metric", "candidate_id").withColumn("__own", F.lit(True))
    sources = candidates.where("derived_from is not null").select(*keys, "metric", F.col("candidate_id").alias("__to"), F.explode(F.split("derived_from", r"\+")).alias("candidate_id"))
    one = sources.groupBy(*keys, "metric", "candidate_id").agg(F.count("*").alias("__n"), F.min("__to").alias("__to")).where("__n = 1").drop("__n")
    on = [*keys, "metric", "candidate_id"]
    joined = decisions.join(own, on, "left").join(one, on, "left")
    moved = F.col("__own").isNull() & F.col("__to").isNotNull()
    return joined.withColumn("canonicalised_from", F.when(moved, F.col("candidate_id"))).withColumn("candidate_id", F.when(moved, F.col("__to")).otherwise(F.col("candidate_id"))).drop("__own", "__to")


def selection_diagnostics(documents: DataFrame, candidates: DataFrame, rejected: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, period, metric, status, usable_ids, rejected_ids) for every document, period and canonical metric."""
    cells = documents.select(*keys).distinct().select(*keys, F.explode(F.array(F.lit("current"), F.lit("previous"))).alias("period")).select("*", F.explode(F.array(*map(F.lit, CANONICAL))).alias("metric"))
    per = [*keys, "metric"]
    usable = lambda p: (money.count_value(F.col(f"{p}_display")).isNotNull() & (F.col("metric") == "employees")) | money.pence(F.col(f"{p}_display"), F.col("unit")).isNotNull()
    had = candidates.groupBy(*per).agg(F.count("*").alias("n"), *[F.array_sort(F.collect_list(F.when(usable(p), F.col("candidate_id")))).alias(p) for p in ("current", "previous")])
    refused = rejected.groupBy(*per).agg(F.array_sort(F.collect_list("candidate_id")).alias("rejected_ids"))
    chosen = decisions.select(*keys, "period", "metric", "candidate_id")
    joined = cells.join(had, per, "left").join(refused, per, "left").join(chosen, [*keys, "period", "metric"], "left")
    none = F.array().cast("array<string>")
    ids = F.coalesce(F.when(F.col("period") == "current", F.col("current")).otherwise(F.col("previous")), none)
    status = (
        F.when(F.col("candidate_id").isNotNull(), "selected").when(F.size(ids) > 0, "unselected_despite_usable_candidate").when(F.col("rejected_ids").isNotNull(), "only_rejected_candidates")
        .when(F.col("n") > 0, "no_usable_candidate").otherwise("no_candidate_extracted")
    )
    return joined.select(*keys, "period", "metric", status.alias("status"), ids.alias("usable_ids"), F.coalesce("rejected_ids", none).alias("rejected_ids"))
