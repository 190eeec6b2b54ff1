"""Industry groups: the dimension that leads and companies are labelled with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold import schemas

# Group, label and codes.
GROUPS: list[tuple[str, str, str]] = [
    ("ecommerce_online_retail", "E-commerce / online retail", "47910 47990"),
    ("banking_lending_credit", "Banking / lending / credit", "64110 64191 64192 64999"),
    ("insurance", "Insurance", "65110 65120 65201 65202"),
    ("financial_services_brokers", "Financial services / brokers", "66110 66120 66190 66210 66220"),
    ("legal_services", "Legal services", "69101 69102"),
    ("dental", "Dental", "86230"),
    ("general_medical", "General medical", "86210"),
    ("other_health", "Other health services", "86900"),
    ("education_tutoring_schools", "Education / tutoring / schools", "85100 85200 85310 85320"),
    ("property_development", "Property development", "41100 41201 41202"),
    ("estate_property_management", "Estate agents / property management", "68100 68201 68209 68310 68320"),
    ("car_dealers", "Car dealers", "45111 45112 45190"),
    ("restaurants_catering", "Restaurants / catering", "56101 56102 56103 56210 56290"),
    ("hotels_bnb", "Hotels / B&Bs", "55100 55201 55202 55209"),
    ("personal_care_wellness", "Personal care / beauty / wellness", "96010 96020 96030 96040 96090"),
    ("specialist_construction_trades", "Specialist construction / trades", "43210 43220 43290 43310 43320 43341 43342 43390"),
    ("software_it_consultancy", "Software / IT consultancy", "62011 62012 62020 62090"),
    ("management_consultancy_pr", "Management consultancy / PR", "70210 70221 70229"),
    ("advertising_market_research", "Advertising / market research", "73110 73200"),
    ("design_photography", "Design / photography", "74100 74201 74202 74209"),
    ("accountancy_bookkeeping_audit", "Accountancy / bookkeeping / audit", "69201 69202 69203"),
    ("architecture_engineering", "Architecture / engineering", "71111 71112 71121 71122"),
    ("research_biotech", "R&D / biotech", "72110 72190 72200"),
    ("business_support_services", "Business support services", "82110 82190 82990"),
    ("educational_support", "Educational support", "85600"),
    ("arts_entertainment", "Arts / entertainment", "90010 90020 90030 90040"),
    ("sport_fitness_gyms", "Sport / fitness / gyms", "93110 93120 93130 93190"),
    ("theme_parks_amusement", "Theme parks / amusement", "93210 93290"),
    ("specialist_retail", "Specialist retail", "47411 47710 47730 47740 47750"),
    ("transport_taxi_logistics", "Transport / taxi / logistics", "49100 49311 49319 49320"),
]


def industry_groups(spark: SparkSession) -> DataFrame:
    """One row per code: about a hundred rows, fixed."""
    rows = [(code, label, group) for group, label, codes in GROUPS for code in codes.split()]
    return spark.createDataFrame(rows, schemas.schema("sic_groups"))


def with_codes(companies: DataFrame) -> DataFrame:
    """Companies whose codes are null get them from the stored profile; unreadable profiles give none."""
    read = F.from_json("profile_payload", "sic_codes array<string>")["sic_codes"]
    codes = F.coalesce("sic_codes", read, F.array().cast("array<string>"))
    return companies.withColumn("sic_codes", codes).withColumn("sic_code_primary", F.coalesce("sic_code_primary", F.try_element_at("sic_codes", F.lit(1))))


def with_currency_defaults(periods: DataFrame) -> DataFrame:
    """Periods without currency and source are sterling by an old default."""
    bare = F.col("currency_code").isNull() & F.col("currency_source").isNull()
    new = {"currency_code": "GBP", "currency_source": "legacy_default"}
    return periods.withColumns({c: F.when(bare, v).otherwise(F.col(c)) for c, v in new.items()})


def with_run_companies(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Metrics whose company is null get their run's."""
    known = runs.select(F.col("id").alias("run_id"), F.col("company_number").alias("__company"))
    return metrics.join(known, "run_id", "left").withColumn("company_number", F.coalesce("company_number", "__company")).drop("__company")
