"""Readers of files: bulk registers, leads, rates, JSON documents, event logs, label cases.

Schemas are stated, never inferred; text stays text until an operator casts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfold import schemas


def bulk_register(spark: SparkSession, path: str, patterns: tuple[str, ...] = ("BasicCompanyData-*.csv", "*.csv")) -> DataFrame:
    """All columns of the register's CSV files as text, header names trimmed; the first pattern that matches a file counts.

    Column names that hold dots need backquotes.
    """
    for pattern in patterns:
        rows = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').option("pathGlobFilter", pattern).csv(path)
        if rows.inputFiles():
            return rows.toDF(*[c.strip().lstrip("﻿") for c in rows.columns])
    raise FileNotFoundError(f"no register file in {path}")


def leads_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scored leads as written by ``write_leads``, typed, with a column ``position`` in file order."""
    kinds = ", ".join(f"{c} string" for c in LEAD_COLUMNS)
    rows = spark.read.schema(kinds).option("header", True).csv(path)
    typed = rows.withColumns({"lead_score": F.col("lead_score").try_cast("int"), "incorporation_date": F.col("incorporation_date").try_cast("date"), "last_accounts_date": F.col("last_accounts_date").try_cast("date")})
    return typed.withColumn("position", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")))


LEAD_COLUMNS = ["company_number", "company_name", "sic_1", "sic_2", "sic_3", "sic_4", "incorporation_date", "last_accounts_date", "account_category", "post_town", "post_code", "country", "outstanding_charges", "lead_score", "score_reasons"]


def write_leads(leads: DataFrame, path: str) -> None:
    """Scored leads as CSV files, the reasons joined by bars."""
    leads.withColumn("score_reasons", F.array_join("score_reasons", "|")).select(LEAD_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def exchange_rates(spark: SparkSession, path: str, series: str) -> DataFrame:
    """(rate_date, rate, payload) of a bank's daily CSV: the date column and the one whose name holds the series.

    Rates that are no numbers or not positive, and dates that are none, are dropped.
    """
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = {c.strip().lstrip("﻿"): c for c in rows.columns}
    day = next(names[n] for n in names if n.upper() == "DATE")
    rate = names.get(series) or next(names[n] for n in names if series in n)
    found = rows.select(
        F.try_to_timestamp(F.trim(F.col(f"`{day}`")), F.lit("dd MMM yyyy")).cast("date").alias("rate_date"),
        F.replace(F.trim(F.col(f"`{rate}`")), F.lit(","), F.lit("")).try_cast("decimal(20,8)").alias("rate"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("payload"),
    )
    return found.where("rate_date is not null and rate > 0")


def json_documents(spark: SparkSession, path: str, schema: str, pattern: str = "*.json", without: str | None = None) -> DataFrame:
    """Whole-file JSON documents or arrays with a stated schema; files named ``without`` are left out."""
    rows = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).json(path)
    return rows.where(~F.input_file_name().endswith("/" + without)) if without else rows


def label_cases(spark: SparkSession, path: str, schema: str, unreviewed: bool = False) -> DataFrame:
    """Label cases, verified ones only unless asked otherwise."""
    rows = json_documents(spark, path, schema, without="manifest.json")
    return rows if unreviewed else rows.where("review.status = 'verified'")


def event_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; malformed lines are dropped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", f"{schema}, _corrupt string", options).alias("e"))
    return rows.where("e._corrupt is null").select("e.*").drop("_corrupt")


def append_events(events: DataFrame, path: str) -> None:
    """Events added to a log as JSON lines; what is there stays."""
    events.write.mode("append").json(path)


def store_cases(cases: DataFrame, path: str, key: str = "case_id") -> None:
    """Label cases as JSON, one folder per case; only the folders of these cases are replaced."""
    spread = cases.withColumn("__case", F.col(key)).repartition("__case")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__case").json(path)


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same log as a stream of files."""
    return spark.readStream.schema(schema).json(path)


def last_events(log: DataFrame, order: str, n: int = 5000) -> DataFrame:
    """The newest n events (the limit is the feature: a tail)."""
    return log.orderBy(F.desc(order)).limit(n)


def latest_by_key(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key."""
    last = Window.partitionBy(key).orderBy(F.desc(position))
    return rows.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def merged_report(entries: DataFrame, report: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Entries with the report's fields where the report has a value that is not empty."""
    other = report.select(key, *[F.nullif(F.col(f), F.lit("")).alias(f"__{f}") for f in fields])
    joined = entries.join(other, key, "left")
    return joined.withColumns({f: F.coalesce(F.col(f"__{f}"), F.col(f) if f in entries.columns else F.lit(None)) for f in fields}).drop(*[f"__{f}" for f in fields])


def store(df: DataFrame, path: str, table: str, partition: str | None = None) -> None:
    """A table's rows as Parquet in its own schema."""
    writer = schemas.ensure_schema(df, table).write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/{table}")


def load(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(schemas.schema(table)).parquet(f"{path}/{table}")
