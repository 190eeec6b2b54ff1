"""Files by name: what is written, replaced, and left by a job that fails."""

import json

import pytest
from pyspark.sql import functions as F

from tallyfold.sources import named


def files(path):
    return {str(p.relative_to(path)): p.read_text(encoding="utf-8") for p in path.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_cases_and_filings(spark, tmp_path):
    top = tmp_path / "out"
    named.save_cases(spark.createDataFrame([("a", 1, "é"), ("b", 2, None)], "case_id string, v int, s string").repartition(2), str(top))
    assert {k: json.loads(v) for k, v in files(top).items()} == {"a/case.json": {"case_id": "a", "v": 1, "s": "é"}, "b/case.json": {"case_id": "b", "v": 2}}
    named.save_cases(spark.createDataFrame([("b", 3, "x")], "case_id string, v int, s string"), f"file://{top}")
    assert json.loads(files(top)["b/case.json"])["v"] == 3 and len(files(top)) == 2
    named.save_filings(spark.createDataFrame([("01", "t9", "<p>One</p><p>1. two</p>")], "company_number string, transaction_id string, markup string"), str(top))
    assert files(top)["01_t9.md"] == "One\n\n1\\. two"
    named.save(spark.createDataFrame([("e", None)], "name string, content binary"), str(top))
    assert files(top)["e"] == "" and not (top / named.STAGED).exists()
    named.save(spark.createDataFrame([], "name string, content string"), str(tmp_path / "none"))
    assert files(tmp_path / "none") == {}


@pytest.mark.parametrize("bad", ["", None, "../x", "/etc/x", "a//b", "_staged/x"])
def test_a_job_that_fails_leaves_nothing(spark, tmp_path, bad):
    top = tmp_path / "out"
    rows = spark.range(40).select(F.concat(F.lit("f"), "id").alias("name"), F.lit("x").alias("content")).unionByName(spark.createDataFrame([(bad, "y")], "name string, content string"))
    with pytest.raises(Exception, match="no name of a file"):
        named.save(rows.repartition(3), str(top))
    assert files(top) == {}
