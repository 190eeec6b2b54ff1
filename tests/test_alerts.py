"""The alert stream against a plain reading of its rules, in order, out of order, and after restarts."""

import random
from datetime import datetime, timedelta

from tallyfold.streaming import alerts

START = datetime(2024, 1, 1)
KIND = "queue string, taken_at timestamp, last_processed_at timestamp, pending int, with_financials int, errors int, extra string"


def plain(rows, stall, streak, delay):
    """Alerts of the snapshots before the last time less the delay, by the rules as worded."""
    horizon, out = max(r[1] for r in rows) - delay, []
    for q in {r[0] for r in rows}:
        best = {}
        for r in (r for r in rows if r[0] == q and r[1] < horizon):
            best[r[1]] = max(best.get(r[1], r[2:]), r[2:], key=lambda v: [(x is not None, x or 0) if not isinstance(x, datetime) else (True, x.timestamp()) for x in v])
        told, idle, done, prior = set(), 0, False, None
        times = sorted(best)
        for k, t in enumerate(times):
            last, pending, results, errors = best[t][:4]
            idle = idle + 1 if prior and results <= prior[2] else 0
            if pending > 0 and idle >= streak:
                out.append((q, "no_progress", t))
                idle = 0
            if prior and errors > prior[3]:
                out.append((q, "errors_increased", t))
            if pending == 0 and not done:
                out.append((q, "completed", t))
                done = True
            if pending > 0 and last is not None and (not told or told != {last}):
                due = last + stall
                until = times[k + 1] if k + 1 < len(times) else horizon
                if due < t or due < until:
                    out.append((q, "stalled", max(due, t) if due < t else due))
                    told = {last}
            prior = best[t]
    return sorted(out)


def history(seed):
    pick, rows = random.Random(seed), []
    for q in ("a", "b", "c", "d"):
        at, last, results, errors, pending = START, START, 0, 0, 5
        for _ in range(60):
            at += timedelta(minutes=pick.choice([5, 10, 30, 70]))
            if pick.random() < 0.5:
                last = at - timedelta(minutes=pick.randrange(4))
            results += pick.choice([0, 0, 1])
            errors += pick.choice([0, 0, 0, 1, -1])
            pending = max(0, pending + pick.choice([-1, -1, 0, 1]))
            rows.append((q, at, last if q != "d" or pick.random() < 0.8 else None, pending, results, errors, "x"))
    return rows + [rows[3], ("z", START + timedelta(days=9), None, 1, 0, 0, "x")]


def run(spark, parts, where, stall, streak):
    for part in parts:
        spark.createDataFrame(part, KIND).repartition(2).write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(KIND).parquet(f"{where}/in")
        alerts.run_alerts(stream, f"{where}/out", f"{where}/cp", stall, streak)
    return sorted(map(tuple, alerts.told(spark, f"{where}/out").collect()))


def test_alerts_follow_the_rules_over_restarts(spark, tmp_path):
    rows = history(1)
    want = plain(rows, timedelta(minutes=20), 2, timedelta(hours=1))
    assert {a for _, a, _ in want} == {"stalled", "no_progress", "errors_increased", "completed"}
    ordered = sorted(rows, key=lambda r: r[1])
    assert run(spark, [ordered[:90], ordered[90:160], ordered[160:]], f"{tmp_path}/a", 20, 2) == want
    assert spark.conf.get(alerts.STATE_STORE, "") != alerts.ROCKSDB


def test_snapshots_out_of_order_within_the_delay(spark, tmp_path):
    rows = [r for r in history(2) if r[0] != "z"]
    last = max(r[1] for r in rows)
    rows.append(("z", last + timedelta(days=1), None, 1, 0, 0, "x"))
    want = plain(rows, timedelta(minutes=45), 3, timedelta(hours=1))
    pick = random.Random(3)
    mixed = sorted(rows, key=lambda r: r[1] + timedelta(minutes=pick.randrange(50)) if r[0] != "z" else r[1])
    assert run(spark, [mixed[:120], mixed[120:]], f"{tmp_path}/b", 45, 3) == want
