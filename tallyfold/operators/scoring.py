"""Scoring against reviewed labels: cells, groups, pages and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions import arithmetic, arrays

CELL = ["period", "metric"]


def comparable(currency: Column, reported: Column, pence: Column, count: Column, metric: Column) -> Column:
    """(currency, amount) as cells are compared: the reported amount, else sterling pence / 100; a head-count without currency."""
    amount = F.coalesce(reported, (pence.cast("decimal(38,6)") / 100).cast("decimal(38,6)"))
    code = F.when(amount.isNotNull(), F.coalesce(currency, F.when(reported.isNull(), F.lit("GBP"))))
    people = F.struct(F.lit(None).cast("string").alias("code"), count.cast("decimal(38,6)").alias("amount"))
    return F.when(metric == "employees", people).otherwise(F.struct(code.alias("code"), amount.alias("amount")))


def cells(gold: DataFrame, predicted: DataFrame, key: str = "case_id") -> DataFrame:
    """Gold cells with what was predicted and the outcome; both sides have a struct ``value`` (code, amount)."""
    joined = gold.withColumnRenamed("value", "expected").join(predicted.select(key, *CELL, F.col("value").alias("found")), [key, *CELL], "left")
    wanted, got = F.col("expected.amount").isNotNull(), F.col("found.amount").isNotNull()
    same = (F.col("expected.amount") == F.col("found.amount")) & F.col("expected.code").eqNullSafe(F.col("found.code"))
    outcome = F.when(~wanted & ~got, "correct_missing").when(wanted & got & same, "correct").when(wanted & got, "wrong").when(wanted, "not_found").otherwise("unexpected")
    return joined.withColumn("outcome", outcome)


def cell_summary(scored: DataFrame, by: list[str]) -> DataFrame:
    """Counts and shares per group. A wrong value counts against recall only; shares of nothing are null."""
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    tp, fp, fn = n("correct"), n("unexpected"), n("wrong", "not_found")
    return scored.groupBy(*by).agg(
        F.count("*").alias("cells"), n("correct", "correct_missing").alias("exact"), tp.alias("true_positives"), fp.alias("false_positives"), fn.alias("false_negatives"),
        arithmetic.ratio(n("correct", "correct_missing"), F.count("*")).alias("accuracy"), arithmetic.ratio(tp, tp + fn).alias("recall"), arithmetic.ratio(tp, tp + fp).alias("precision"),
    )


def page_overlap(expected: Column, found: Column) -> Column:
    """(precision, recall, f1) of two arrays of pages."""
    both = F.size(F.array_intersect(expected, found))
    precision, recall = arithmetic.ratio(both, F.size(F.array_distinct(found))), arithmetic.ratio(both, F.size(F.array_distinct(expected)))
    return F.struct(precision.alias("precision"), recall.alias("recall"), arithmetic.ratio(2 * precision * recall, precision + recall).alias("f1"))


def run_report(runs: DataFrame) -> DataFrame:
    """Over runs with elapsed_seconds, cost_usd and pages_overlap: percentiles, throughput and cost."""
    hours = F.sum("elapsed_seconds") / 3600.0
    return runs.agg(
        F.count("*").alias("documents"), F.percentile("elapsed_seconds", 0.5).alias("median_seconds"), F.percentile("elapsed_seconds", 0.95).alias("p95_seconds"),
        arithmetic.ratio(F.count("*"), hours).alias("documents_per_hour"), F.sum("cost_usd").alias("cost_usd"), F.avg("pages_overlap.f1").alias("mean_page_f1"),
    )


def field_accuracy(rows: DataFrame, fields: list[str], key: str = "case_id") -> DataFrame:
    """(field, n, accuracy) from wide rows with expected_<field> and found_<field>; fields without a label do not count."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"expected_{f}").alias("expected"), F.col(f"found_{f}").alias("found")) for f in fields])
    long = rows.select(key, F.explode(entries).alias("e")).where("e.expected is not null")
    hit = F.coalesce((F.col("e.expected") == F.col("e.found")).cast("double"), F.lit(0.0))
    return long.groupBy("e.field").agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def usage_totals(calls: DataFrame, by: list[str], usage: str = "usage") -> DataFrame:
    """Sums of a map of numbers, per group, as a map."""
    long = calls.select(*by, F.explode(usage).alias("k", "v")).groupBy(*by, "k").agg(F.sum("v").alias("v"))
    return long.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(usage))


def stage_summary(calls: DataFrame) -> DataFrame:
    """Attempts, retries, repairs and failures per stage and model."""
    return calls.groupBy("stage", "model").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("attempt") > 1).alias("retries"), F.count_if("repaired").alias("repaired"), F.count_if("failed").alias("failed"),
        F.sum("elapsed_seconds").alias("elapsed_seconds"),
    )


def call_cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column, stated: Column) -> Column:
    """(cost, method): what the provider stated, else tokens at their prices, else unknown."""
    priced = tokens_in.cast("decimal(20,0)") * price_in.cast("decimal(18,12)") + tokens_out.cast("decimal(20,0)") * price_out.cast("decimal(18,12)")
    return F.struct(F.coalesce(stated.cast("double"), priced.cast("double")).alias("cost_usd"), F.when(stated.isNotNull(), "provider").when(priced.isNotNull(), "tokens").otherwise("unknown").alias("method"))


def quote_issues(response: Column, allowed: dict[str, list[str]], source: Column) -> Column:
    """The fields whose value is not allowed or whose quote the source text does not hold; response is a map of structs (value, quote)."""
    from tallyfold.functions import text

    def of(name: str, values: list[str]) -> Column:
        field = F.try_element_at(response, F.lit(name))
        return F.array(
            F.when(field.isNull() | field["value"].isNull() | ~field["value"].isin(values), F.lit(f"{name}: value not allowed")),
            F.when((F.coalesce(field["quote"], F.lit("")) != "") & ~F.contains(text.quote_text(source), text.quote_text(field["quote"])), F.lit(f"{name}: quote not found")),
        )

    return F.array_compact(F.flatten(F.array(*[of(n, v) for n, v in allowed.items()])))


def _named(parts: Column, metric: Column) -> dict[str, Column]:
    from tallyfold.functions import money

    unit = F.when(metric == "employees", "COUNT").when(parts.isNull(), money.UNKNOWN).otherwise(money.unit(F.try_element_at(parts, F.lit(3))))
    return {"n": F.size(parts), "shown": F.try_element_at(parts, F.lit(1)), "page": F.try_element_at(parts, F.lit(2)).try_cast("int"), "unit": unit}


def _valued(x: Callable[[str], Column], metric: Column) -> dict[str, Column]:
    from tallyfold.functions import money

    told = (metric == "employees") & (F.upper(x("shown")) == "NARRATIVE_ZERO")
    count = F.when(told, 0).otherwise(F.when(metric == "employees", money.count_value(x("shown"))))
    return {"told": told, "count": count, "amount": F.when(metric != "employees", money.reported_value(x("shown"), x("unit")))}


def _checked(x: Callable[[str], Column], missing: Column) -> dict[str, Column]:
    error = (
        F.when(missing, None).when(x("n") != 3, "expected three parts").when(x("page").isNull() | (x("page") < 1), "page is no positive number")
        .when(x("unit") == "UNKNOWN", "unit is not known").when(x("count").isNull() & x("amount").isNull(), "value is no number")
    )
    return {"error": error}


def _reviewed(x: Callable[[str], Column], missing: Column, metric: Column) -> Column:
    from tallyfold.functions import money

    told, fine = x("told"), ~missing & x("error").isNull()
    kind = F.when(told, "narrative_zero").when((metric == "employees") & x("shown").rlike("^[-–—]+$"), "dash_zero")
    return F.struct(
        F.when(missing, "missing").when(fine, "present").alias("state"), F.when(fine & ~told, x("shown")).alias("displayed_value"), F.when(fine, x("unit")).alias("unit"), F.when(fine, x("page")).alias("source_page"),
        F.when(fine, x("count")).alias("value_count"), F.when(fine, x("amount")).alias("reported_value"), F.when(fine & (metric != "employees"), money.pence_of(x("amount"), x("unit"))).alias("value_pence"),
        F.when(fine, kind).alias("evidence_kind"), x("error").alias("error"),
    )


def _answer_parts(answer: Column) -> Column:
    return F.transform(F.split(answer, r"\|"), lambda x: F.trim(x))


def reviewed_metric(answer: Column, metric: Column) -> Column:
    """A reviewer's answer "value | page | unit", or MISSING, as a cell; ``error`` names what is wrong with it."""
    missing = F.upper(F.trim(answer)) == "MISSING"
    known = lambda s, more: F.struct(*[s[n].alias(n) for n in _STEPS[: _STEPS.index(next(iter(more)))]], *[c.alias(n) for n, c in more.items()])
    once = F.array(_answer_parts(answer))  # each step is bound once, since expressions that use another several times would work it out as often
    once = F.transform(once, lambda parts: F.struct(*[c.alias(n) for n, c in _named(parts, metric).items()]))
    once = F.transform(once, lambda s: known(s, _valued(lambda n: s[n], metric)))
    once = F.transform(once, lambda s: known(s, _checked(lambda n: s[n], missing)))
    return F.transform(once, lambda s: _reviewed(lambda n: s[n], missing, metric))[0]


_STEPS = ["n", "shown", "page", "unit", "told", "count", "amount", "error"]


def with_reviewed_metrics(rows: DataFrame, answers: dict[str, tuple[Column, str]]) -> DataFrame:
    """Rows with ``reviewed_metric`` of several answers, each by its metric, as columns of the given names.

    All take each step together, as columns, which Spark compiles. What is bound in a
    step keeps it out of whole-stage code: that many expressions would be one method,
    which is too long for the JVM to compile. MISSING is not read any further.
    """
    metrics = {i: F.lit(metric) for i, (_, metric) in enumerate(answers.values())}
    of = lambda i: lambda n: F.col(f"__{n}_{i}")
    told = lambda i: of(i)("told_missing")
    steps = [
        lambda i: {"value": list(answers.values())[i][0]},
        lambda i: {"parts": F.when(F.upper(F.trim(of(i)("value"))) != "MISSING", _answer_parts(of(i)("value")))},
        lambda i: _named(of(i)("parts"), metrics[i]) | {"told_missing": of(i)("value").isNotNull() & of(i)("parts").isNull()},
        lambda i: _valued(of(i), metrics[i]),
        lambda i: _checked(of(i), told(i)),
        lambda i: {"cell": _reviewed(of(i), told(i), metrics[i])},
    ]
    own, out = rows.columns, rows
    for step in steps:
        out = out.withColumns({f"__{n}_{i}": c for i in metrics for n, c in step(i).items()} | {own[0]: arrays.bound(F.col(own[0]), lambda x: x)})
    return out.select(*own, *[of(i)("cell").alias(name) for i, name in enumerate(answers)])


def case_issues(cells_: DataFrame, key: str = "case_id") -> DataFrame:
    """(key, period, metric, issue) of label cells that are incomplete: state, value, unit and page have to agree."""
    value = F.coalesce("value_pence", "value_count", F.col("reported_value").cast("bigint"))
    issue = (
        F.when(~F.coalesce(F.col("state").isin("present", "missing"), F.lit(False)), "state is not known")
        .when((F.col("state") == "missing") & value.isNotNull(), "a missing cell has a value")
        .when((F.col("state") == "present") & value.isNull(), "a present cell has no value")
        .when((F.col("state") == "present") & (F.col("source_page").isNull() | (F.col("source_page") < 1)), "a present cell has no page")
    )
    return cells_.withColumn("issue", issue).where("issue is not null").select(key, *CELL, "issue")


def with_results(cases: DataFrame, results: DataFrame, key: str = "case_id") -> DataFrame:
    """Cases with their saved result (key, payload, error); a case without one has the error "no saved result"."""
    return cases.join(results, key, "left").withColumn("error", F.when(F.col("payload").isNull(), F.coalesce("error", F.lit("no saved result"))).otherwise(F.col("error")))


def comparison_report(scored: DataFrame, path: str) -> None:
    """All cells and the wrong ones as CSV, and their counts as JSON, below a path."""
    flat = scored.select("case_id", *CELL, "outcome", F.col("expected.code").alias("expected_code"), F.col("expected.amount").alias("expected_amount"), F.col("found.code").alias("found_code"), F.col("found.amount").alias("found_amount"))
    flat.write.mode("overwrite").option("header", True).csv(f"{path}/cells")
    flat.where(~F.col("outcome").isin("correct", "correct_missing")).write.mode("overwrite").option("header", True).csv(f"{path}/errors")
    cell_summary(scored, ["metric"]).write.mode("overwrite").json(f"{path}/summary")
