"""Register filters and scores row by row against a plain calculator, and the queue."""

import itertools
import re
from datetime import date

from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators import leads
from tallyfold.sources import files

AS_OF = date(2024, 6, 30)
COLUMNS = [
    "CompanyName", "CompanyNumber", "CompanyStatus", "CompanyCategory", "Accounts.AccountCategory", "Accounts.LastMadeUpDate", "SICCode.SicText_1",
    "SICCode.SicText_2", "SICCode.SicText_3", "SICCode.SicText_4", "IncorporationDate", "RegAddress.PostTown", "RegAddress.PostCode", "RegAddress.Country", "Mortgages.NumMortOutstanding",
]


def rows():
    good = ["Acme Ltd", "01", "Active", "Private Limited Company", "FULL", "31/03/2023", "47910 - Retail", "", "", "", "01/01/2018", "Leeds", "LS1", "ENGLAND", "0"]
    changes = {0: ["X Holdings", "spv one"], 2: ["", "Liquidation", "Active - Proposal to Strike off"], 3: ["Charity"], 4: ["dormant", "Micro", "group "], 5: ["", "01/01/2020", "31/12/2022", "2021-07-01"], 6: ["41100", "62020 x", "01110", "", "junk"], 7: ["62012"], 10: ["", "30/06/2021", "01/07/2021", "01/01/2000", "2014-06-30"], 11: [""], 13: ["FRANCE", "", "wales"], 14: ["3", "", "x"]}
    yield good
    for k, vs in changes.items():
        for v in vs:
            yield [v if j == k else g for j, g in enumerate(good)]
    for (a, va), (b, vb) in itertools.combinations([(k, v) for k, vs in changes.items() for v in vs[:2]], 2):
        if a != b:
            yield [va if j == a else vb if j == b else g for j, g in enumerate(good)]


def day(s):
    m = re.fullmatch(r"(\d\d)/(\d\d)/(\d{4})", s)
    return date(int(m[3]), int(m[2]), int(m[1])) if m else date.fromisoformat(s) if s else None


def plainly(r):
    r = dict(zip(COLUMNS, (x.strip() for x in r)))
    code = lambda c: r[c][:5] if re.match(r"\d{5}", r[c]) else None
    first, account = code("SICCode.SicText_1"), r["Accounts.AccountCategory"].upper()
    born, made = day(r["IncorporationDate"]), day(r["Accounts.LastMadeUpDate"])
    years = lambda d: (AS_OF - d).days / 365.25
    tier = next((t for t, codes in enumerate((leads.TIER_1, leads.TIER_2, leads.TIER_3), 1) if first in codes), None)
    if r["CompanyStatus"] in leads.EXCLUDED_STATUS or not r["CompanyStatus"]:
        reason = "status:" + r["CompanyStatus"]
    elif r["CompanyCategory"] != "Private Limited Company":
        reason = "category:" + r["CompanyCategory"]
    elif account in leads.EXCLUDED_ACCOUNTS:
        reason = "accounts:" + account
    elif not tier:
        reason = "sic:not_target"
    elif born is None or years(born) < 3:
        reason = "too_young"
    elif made is None or years(made) > 3:
        reason = "stale_accounts"
    else:
        reason = "ok"
    parts = []
    if tier:
        parts.append(({1: 30, 2: 20, 3: 10}[tier], f"tier-{tier} SIC"))
    if sum(code(f"SICCode.SicText_{k}") is not None for k in range(1, 5)) > 1:
        parts.append((5, "multi-SIC"))
    if born and years(born) >= 3:
        parts.append((15, f"sweet-spot age {years(born):.1f}yr") if years(born) <= 10 else (8, f"established {years(born):.1f}yr"))
    if made and (AS_OF - made).days / 30 <= 36:
        parts.append((10, "accounts <18mo") if (AS_OF - made).days / 30 <= 18 else (5, "accounts <36mo"))
    if account in leads.FULL_ACCOUNTS:
        parts.append((10, "acct:" + account.lower()))
    if r["RegAddress.Country"].upper() in ("ENGLAND", "WALES", "UNITED KINGDOM", "") and r["RegAddress.PostTown"]:
        parts.append((5, "GB address"))
    if not re.search(leads.SHELL_NAME, r["CompanyName"]):
        parts.append((5, "non-shell name"))
    if r["Mortgages.NumMortOutstanding"] in ("0", ""):
        parts.append((5, "no charges"))
    return reason, sum(p for p, _ in parts), [t for _, t in parts]


def test_register_rules(spark, tmp_path):
    data = [[*r[:1], f"{k:08d}", *r[2:]] for k, r in enumerate(rows())]
    lines = [",".join(f" {c}" for c in COLUMNS)] + [",".join(f'"{x}"' for x in r) for r in data]
    (tmp_path / "BasicCompanyData-part1.csv").write_text("\n".join(lines))
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    read = files.bulk_register(spark, str(tmp_path))
    assert read.columns == COLUMNS
    scored = leads.score_leads(read.fillna(""), F.lit(AS_OF))
    got = {r.CompanyNumber: (r.reason, r.lead_score, r.score_reasons) for r in scored.collect()}
    assert got == {r[1]: plainly(r) for r in data}
    counts = {r.reason: r.n for r in leads.drop_reasons(scored).collect()}
    assert sum(counts.values()) == len(data) and counts["ok"] == sum(plainly(r)[0] == "ok" for r in data)
    assert leads.qualified(scored, 80).count() == sum(plainly(r)[0] == "ok" and plainly(r)[1] >= 80 for r in data)


def lead(number, name, score, status, **more):
    return {"company_number": number, "company_name": name, "lead_score": score, "status": status} | more


def frame(spark, rows_):
    return schemas.ensure_schema(spark.createDataFrame(rows_, "company_number string, company_name string, lead_score int, status string, account_category string"), "leads")


def test_search_queue_and_outcomes(spark):
    table = frame(spark, [lead("13406761", "Mesh Ltd", 82, "done"), lead("22222222", "Wire MESH", 88, "error"), lead("33333333", "Other", 76, "pending"), lead("4", "Z", 90, "pending", account_category="FULL")])
    order = [F.desc("lead_score"), F.asc("company_name"), F.asc("company_number")]
    assert [r.company_number for r in leads.top(leads.matching(table, "mesh", 70), order, 5).collect()] == ["22222222", "13406761"]
    assert [r.company_number for r in leads.pending(table).collect()] == ["4", "33333333"]
    assert [r.company_number for r in leads.pending(table, ["FULL"]).collect()] == ["4"]
    outcomes = spark.createDataFrame([("4", "error", "boom", 1), ("4", "done", None, 2)], "company_number string, status string, error_message string, seq int")
    for c, t in (("xhtml_available", "boolean"), ("filing_date", "date"), ("filing_type", "string"), ("processed_at", "timestamp")):
        outcomes = outcomes.withColumn(c, F.lit(None).cast(t))
    marked = {r.company_number: (r.status, r.error_message) for r in leads.mark(table, outcomes).collect()}
    assert marked == {"13406761": ("done", None), "22222222": ("error", None), "33333333": ("pending", None), "4": ("done", None)}
    assert {r.status: r.n for r in leads.counts_by(table, "status").collect()} == {"done": 1, "error": 1, "pending": 2}


def test_leads_are_loaded_once(spark):
    have = spark.createDataFrame([("4", 90)], "company_number string, lead_score int").withColumn("position", F.lit(0))
    new = spark.createDataFrame([("4", 99, 0), ("5", 40, 1), ("5", 45, 2), ("6", 10, 3)], "company_number string, lead_score int, position int")
    got = leads.load_leads(have, new, 30, F.asc("position")).collect()
    assert sorted((r.company_number, r.lead_score) for r in got) == [("4", 90), ("5", 40)]
