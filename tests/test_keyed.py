"""Keyed tables: the rows of a plain upsert, only the touched buckets, and batches that come again."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import upsert as up
from tallyfold.sources import keyed

KIND = "k long, g string, v int, made int"


def state(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts_equal_the_whole_table_upsert(spark, tmp_path):
    pick = random.Random(4)
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", KIND, ["k", "g"], buckets=8)
    assert state(table.rows()) == [] and table.version() == 0
    whole = spark.createDataFrame([], KIND)
    for batch in range(4):
        rows = [(pick.choice([None, *range(30)]), pick.choice(["a", None]), pick.randrange(100), batch) for _ in range(25)]
        new = spark.createDataFrame(rows, KIND)
        table.upsert(new.withColumn("other", F.lit(1)), "s", batch, keep=["made"])
        whole = spark.createDataFrame(up.upsert(whole, new, ["k", "g"], keep=["made"]).collect(), KIND)
        assert state(table.rows()) == state(whole)
    assert table.version() == 4 and len(state(table.rows())) > 30


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", KIND, ["k"], buckets=16)
    table.upsert(spark.range(400).selectExpr("id as k", "'a' as g", "1 as v", "0 as made"), "load", 0)
    before = table.folders()
    new = spark.createDataFrame([(7, "b", 2, 1), (7, "c", 3, 1), (1000, "b", 2, 1)], KIND)
    touched = table.upsert(new, "change", 0, order=[F.desc("v")])
    after = table.folders()
    assert 1 <= len(touched) <= 2 and {b for b in after if before.get(b) != after[b]} == touched
    read = {f.rsplit("/", 2)[1] for f in table.rows(touched).inputFiles()}
    assert read == {f"{keyed.BUCKET}={b}" for b in touched}
    assert {r.k: r.g for r in table.rows().where("v > 1").collect()} == {7: "c", 1000: "b"} and table.rows().count() == 401


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", KIND, ["k"], buckets=4)
    first, second = ([(k, "a", v, v) for k in range(9)] for v in (1, 2))
    table.upsert(spark.createDataFrame(first, KIND), "s", 0)
    table.upsert(spark.createDataFrame(second, KIND), "s", 1)
    folders = table.folders()
    assert table.upsert(spark.createDataFrame(first, KIND), "s", 0) == set() and table.folders() == folders
    assert table.upsert(spark.createDataFrame(first, KIND), "other", 0) and {r.v for r in table.rows().collect()} == {1}
    assert table.upsert(spark.createDataFrame([], KIND), "s", 2) == set() and table.has("s", 2)
    gone = table.upsert(spark.createDataFrame([(k, "a", 0, 0) for k in range(9)], KIND), "s", 3, gone=F.col("v") == 0)
    assert gone and state(table.rows()) == [] and table.folders() == {}


def test_a_failed_batch_leaves_the_table(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", KIND, ["k"], buckets=4)
    table.upsert(spark.createDataFrame([(1, "a", 1, 1)], KIND), "s", 0)
    bad = spark.range(2).select(F.col("id").alias("k"), F.lit("a").alias("g"), F.when(F.col("id") == 1, F.raise_error(F.lit("lost")).cast("int")).otherwise(5).alias("v"), F.lit(1).alias("made"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad, "s", 1)
    assert state(table.rows()) == [(1, "a", 1, 1)] and not table.has("s", 1)
    table.upsert(spark.createDataFrame([(1, "b", 7, 1)], KIND), "s", 1)
    assert state(table.rows()) == [(1, "b", 7, 1)]


def test_a_stream_into_the_table_goes_on_after_a_lost_checkpoint(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", KIND, ["k"], buckets=4)
    for part in range(3):
        spark.createDataFrame([(k, "a", part, part) for k in range(part, part + 5)], KIND).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(KIND).parquet(f"{tmp_path}/in")
        keyed.upsert_stream(table, stream, "s", f"{tmp_path}/cp", keep=["made"])
    want = {0: (0, 0), 1: (1, 0), 2: (2, 0), 3: (2, 0), 4: (2, 0), 5: (2, 1), 6: (2, 2)}
    assert {r.k: (r.v, r.made) for r in table.rows().collect()} == want and table.version() == 3
    last = max((tmp_path / "cp" / "commits").iterdir(), key=lambda p: (p.name.isdigit(), p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    keyed.upsert_stream(table, spark.readStream.schema(KIND).parquet(f"{tmp_path}/in"), "s", f"{tmp_path}/cp", keep=["made"])  # the last batch comes again
    assert {r.k: (r.v, r.made) for r in table.rows().collect()} == want and table.version() == 3
