import time

import numpy as np
import pytest

from tallyfold.llm import url_filter as uf

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/1", "https://www.example.com/en/x?q#f", "http://m.example.com/en/", "http://example.com/de",
    "http://example.com", "http://notexample.com/en/", "ftp://a.net/es/9", "http://a.net/fr/", "http://bad.org/x", "http://a.bad.org?x=/en/", "http://notbad.org/",
    "http://a..b/x", "http://x.com#://y.net/es/", "x\n://É.Net/es/a", "http://bad.org/x",
]


def plainly(url, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    return host, path, None, "block" if any(host == b or host.endswith("." + b) for b in blocked) else "allow"


@pytest.mark.parametrize("blocked", [[], ["bad.org", "b", "unseen.org"]])
def test_verdicts(spark, blocked):
    pages = spark.createDataFrame([(k, u, 1, "x") for k, u in enumerate(URLS)] + [(None, None, 1, "x")], "page_id long, url string, rule int, key string").repartition(3)
    listed = spark.createDataFrame([(b,) for b in blocked] + [(None,)], "key string")
    got = uf.judge_urls(pages, RULES, listed).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plainly(r.url, blocked), r.url
    assert uf.judge_urls(pages.limit(0), RULES, listed).collect() == []


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(6000).selectExpr("concat('k', id) AS key", "id % 7 = 0 AS listed")
    cascade = uf.build_cascade(keys)
    assert len(cascade.levels) > 2
    rows = keys.select(uf.hashed(keys.key).alias("h"), "listed").select("h.first", "h.second", "listed").toPandas()
    assert np.array_equal(cascade.listed(rows["first"].to_numpy(), rows["second"].to_numpy()), rows["listed"].to_numpy())


def test_filters_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(uf, "MAX_BITS", 64)
    with pytest.raises(ValueError):
        uf.build_cascade(spark.range(600).selectExpr("concat('k', id) AS key", "id % 2 = 0 AS listed"))


def test_very_long_hosts(spark):
    host = "a." * 50_000 + "bad.org"
    pages = spark.createDataFrame([(1, f"http://{host}/x"), (2, "http://" + "b" * 100_000 + "/")], "page_id long, url string")
    listed = spark.createDataFrame([("bad.org",)], "key string")
    began = time.time()
    assert {r.page_id: r.verdict for r in uf.judge_urls(pages, RULES, listed).collect()} == {1: "block", 2: "allow"}
    assert time.time() - began < 30
