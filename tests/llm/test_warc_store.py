import gzip
import hashlib

from tallyfold.llm import warc_store as ws

BIG, OTHER = "x" * 999 + "é", "y" * 1000
ROWS = [
    (1, "http://a/", BIG), (5, "http://b/ \r\nX: y", BIG), (3, None, BIG), (2, "http://c/", "small"), (9, "http://d/", "small"),
    (7, "http://e/", None), (8, "http://f/", ""), (4, "", OTHER), (6, "http://g/", OTHER[:999]), (10, "http://g/", OTHER[:999]),
    (None, "http://h/", BIG), (11, "http://i/", OTHER), (12, "http://l/", "\r\n\r\nWARC/1.1 " * 90_000), (11, "http://i/", OTHER),
]


def expected(rows):
    keeper = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            keeper[raw] = max(page, keeper.get(raw, page))
    out = []
    for page, url, html in rows:
        raw = (html or "").encode()
        to = keeper.get(raw) if page is not None and keeper.get(raw) != page else None
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to, url))
    return sorted(out, key=str)


def frame(spark, rows, n=3):
    return spark.createDataFrame([(a, b, c, "z", 1) for a, b, c in rows], "page_id long, url string, html string, digest string, length int").repartition(n)


def test_archives_give_back_what_was_written(spark):
    got = sorted(map(tuple, ws.archived(frame(spark, ROWS)).collect()), key=str)
    assert got == expected(ROWS)
    assert ws.archived(frame(spark, []).limit(0)).collect() == []


def test_selected_records_are_read_by_range(spark, tmp_path, monkeypatch):
    index = ws.write_archives(frame(spark, ROWS, 1), f"file://{tmp_path}/w")
    some = ws.read_records(index.where("page_id in (2, 12, 5)")).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {2: "small", 12: ROWS[12][2], 5: BIG}
    files = {r.file for r in index.collect()}
    whole = b"".join(gzip.open(f.removeprefix("file://")).read() for f in files)
    assert whole.count(b"WARC-Record-ID") == len(ROWS)


def test_close_ranges_are_read_together():
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 15 + ws.GAP, 5), ("f", 21 + 2 * ws.GAP, 5), ("g", 0, ws.READ), ("g", ws.READ, 1)]
    assert list(ws._ranges(rows)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert list(ws._ranges([])) == []
