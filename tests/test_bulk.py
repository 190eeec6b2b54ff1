"""Registers with their rejected lines, and tails that read only the ends of files."""

import json

import pytest

from tallyfold.sources import bulk


def test_headers_are_repaired():
    assert bulk.repaired_header("﻿ Name , \"No\",,Town,Town,, Town\r") == ["Name", "No", "column_3", "Town", "Town_2", "column_6", "Town_3"]


def test_registers_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Name, Number ,Town.Post\r\n"A, B ""x""",1,Leeds\r\nonly two,2\r\n\r\nName, Number ,Town.Post\r\nC,3,\r\n"open,4,York\r\n', encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.csv").write_text("Number,Name,Extra\n5,E,x\n6,F,y,z\n")
    (tmp_path / "sub" / "empty.csv").write_text("")
    (tmp_path / "no.txt").write_text("Name\nq\n")
    rows, rejected = bulk.register(spark, str(tmp_path), required=("Name", "Number"))
    assert rows.columns == ["Name", "Number", "Town.Post", "Extra"]
    assert sorted(map(tuple, rows.collect())) == [('A, B "x"', "1", "Leeds", None), ("C", "3", None, None), ("E", "5", None, "x")]
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in rejected.collect()) == [("a.csv", '"open,4,York', "open quotation mark"), ("a.csv", "only two,2", "not 3 fields"), ("b.csv", "6,F,y,z", "not 3 fields")]
    assert rejected.count() == 3 and rows.select("Name").count() == 3
    with pytest.raises(ValueError, match="Town"):
        bulk.register(spark, str(tmp_path), required=("Town",))
    with pytest.raises(ValueError, match="no file"):
        bulk.register(spark, str(tmp_path), "*.tsv")
    rows, rejected = bulk.register(spark, str(tmp_path / "sub"), "empty.csv")
    assert rows.count() == rejected.count() == 0


def test_the_tail_reads_the_ends_only(spark, tmp_path):
    every = []
    for k in range(6):
        lines = [json.dumps({"k": k, "j": j, "pad": "é" * (j % 50)}, ensure_ascii=False) for j in range(400)]
        every += lines
        (tmp_path / f"log-{k}.json").write_text("\n".join(lines) + ("\n" if k % 2 else ""), encoding="utf-8")
    size = sum(p.stat().st_size for p in tmp_path.iterdir())
    for n in (1, 7, 399, 400, 401, 1000, 2400, 5000):
        found = bulk.tail(spark, str(tmp_path), n)
        assert [r.line for r in found.lines.collect()] == every[::-1][:n]
        assert found.bytes_read <= size and (n > 10 or found.bytes_read <= n * 256)
    for guess in (1, 40):
        assert [r.line for r in bulk.tail(spark, str(tmp_path), 450, guess=guess).lines.collect()] == every[::-1][:450]
    (tmp_path / "log-9.json").write_text('{"k": 9, "j": 0}\nnot json\n\n[1]\n{"k": 9, "j": 1}')
    assert [(r.k, r.j) for r in bulk.tail_events(spark, str(tmp_path), 5, "k int, j int").collect() if r.k is not None] == [(9, 1), (9, 0), (5, 399)]


def test_an_empty_log(spark, tmp_path):
    (tmp_path / "x.json").write_text("")
    assert bulk.tail(spark, str(tmp_path), 5).lines.collect() == []


def test_a_log_of_many_files(spark, tmp_path):
    for k in range(150):
        (tmp_path / f"log-{k:03}.json").write_text(f'{{"k": {k}}}\n' * (k % 3))
    every = [k for k in range(150) for _ in range(k % 3)]
    for n in (1, 20, 140, 500):
        rows = bulk.tail(spark, str(tmp_path), n, guess=10).lines.collect()
        assert [json.loads(r.line)["k"] for r in rows] == every[::-1][:n]
