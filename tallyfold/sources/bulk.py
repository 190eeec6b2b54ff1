"""Bulk text files: delimited registers with repaired headers and a channel of rejected lines, and the tails of logs.

Registers are read as lines, which Spark splits within files, and parsed by column
functions; a field does not run over lines. Logs are read from their ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BOM = "﻿"


class Register(NamedTuple):
    """``rows`` with all columns as text, and ``rejected`` lines (file, line, reason)."""

    rows: DataFrame
    rejected: DataFrame


def repaired_header(line: str, separator: str = ",") -> list[str]:
    """Column names of a header line: without byte order mark, quotes and outer white space; blank and repeated ones numbered."""
    names: list[str] = []
    for k, raw in enumerate(line.lstrip(BOM).rstrip("\r").split(separator), 1):
        name = raw.strip().strip('"').strip() or f"column_{k}"
        same = sum(n == name or n.rsplit("_", 1)[0] == name and n.rsplit("_", 1)[-1].isdigit() for n in names)
        names.append(f"{name}_{same + 1}" if name in names else name)
    return names


def register(spark: SparkSession, path: str, pattern: str = "*.csv", required: tuple[str, ...] = (), separator: str = ",") -> Register:
    """All files below a path, each by its own header; files may differ in the columns and their order.

    A line is rejected if its number of fields is not the header's or a quotation
    mark is left open; blank lines and repeated headers are passed over. A file
    without the ``required`` columns is a ValueError, as is a path without files.
    Each file's header is read by a small job of its own, so files should be many
    megabytes rather than many.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path)
    files = sorted(lines.inputFiles())
    if not files:
        raise ValueError(f"no file {pattern} in {path}")
    by_header: dict[str, list[str]] = {}
    for file in files:
        first = spark.read.text(file).first()
        if first is not None:
            by_header.setdefault(first.value, []).append(file)
    parts = []
    for header, own in by_header.items():
        names = repaired_header(header, separator)
        if lacking := [c for c in required if c not in names]:
            raise ValueError(f"{own[0]} has no column {', '.join(lacking)}")
        schema = ", ".join(f"`{n}` string" for n in [*names, "__line"])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__line", "sep": separator, "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
        text = spark.read.text(own).select(F.col("_metadata.file_path").alias("__file"), F.rtrim("value", F.lit("\r")).alias("__text"))
        text = text.where((F.trim("__text") != "") & (F.col("__text") != header.rstrip("\r")))
        found = text.withColumn("__row", F.from_csv("__text", schema, options))
        reason = F.when(F.length(F.regexp_replace("__text", '[^"]', "")) % 2 == 1, "open quotation mark").when(F.col("__row.__line").isNotNull(), f"not {len(names)} fields")
        parts.append((found.withColumn("__reason", reason), names))
    if not parts:
        empty = spark.createDataFrame([], "file string, line string, reason string")
        return Register(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in required) or "line string"), empty)
    good = [f.where("__reason is null").select(*[F.col(f"__row.`{n}`").alias(n) for n in names]) for f, names in parts]
    bad = [f.where("__reason is not null").select(F.col("__file").alias("file"), F.col("__text").alias("line"), F.col("__reason").alias("reason")) for f, _ in parts]
    rows, rejected = good[0], bad[0]
    for more, worse in zip(good[1:], bad[1:]):
        rows, rejected = rows.unionByName(more, allowMissingColumns=True), rejected.unionAll(worse)
    return Register(rows, rejected)


class Tail(NamedTuple):
    """``lines`` (file, at, line), newest first, and how many bytes were read for them."""

    lines: DataFrame
    bytes_read: int


def _open(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    system, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    return system.open_input_file(path)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of (path, length, take): the last ``take`` bytes of a file, without the line that they begin within."""
    for batch in batches:
        for row in batch.to_pylist():
            start = max(0, row["length"] - row["take"])
            with _open(row["path"]) as f:
                f.seek(max(0, start - 1))
                data = f.read(row["length"] - max(0, start - 1))
            at = 0 if start == 0 else data.find(b"\n") + 1 or len(data)  # a line begins after a line end only
            base, found = max(0, start - 1), []
            while at < len(data):
                end = data.find(b"\n", at)
                end = len(data) if end < 0 else end
                if data[at:end].strip():
                    found.append((base + at, data[at:end].rstrip(b"\r").decode("utf-8", "replace")))
                at = end + 1
            yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())], names=["file", "at", "line"])


def _newest(files: DataFrame, size: int, at_once: int = 64) -> list[tuple[str, int]]:
    """(path, length) of the last files by name that hold this many bytes; no more of the list reaches the driver than about four times these."""
    while True:
        found = [(r.path, r.length) for r in files.orderBy(F.desc("path")).limit(at_once).collect()]
        if len(found) < at_once or sum(length for _, length in found) >= size:
            return found
        at_once *= 4


def tail(spark: SparkSession, path: str, n: int, pattern: str = "*", guess: int = 256) -> Tail:
    """The last n lines of a log whose files sort by name in the order of time (the limit is the feature).

    Only the ends of the newest files are read: as many bytes as n lines of ``guess``
    bytes take, then four times as many, until n lines are there or the log is read
    whole. Blank lines do not count. Files are listed by name and size, not opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length").where("length > 0")
    budget, whole = max(1, n) * guess, files.agg(F.sum("length")).first()[0] or 0
    while True:
        wanted, left = [], budget
        for name, size in _newest(files, min(budget, whole)):
            if left <= 0:
                break
            wanted.append((name, size, min(size, left)))
            left -= size
        takes = spark.createDataFrame(wanted, "path string, length long, take long")
        lines = takes.repartition(max(1, min(len(wanted), 200))).mapInArrow(_ends, "file string, at long, line string")
        last = lines.orderBy(F.desc("file"), F.desc("at")).limit(n)
        if budget >= whole or last.count() >= n:
            return Tail(last, min(budget, whole))
        budget *= 4


def tail_events(spark: SparkSession, path: str, n: int, schema: str, pattern: str = "*.json") -> DataFrame:
    """The JSON objects among the last n lines of a log, with ``file`` and ``at``; lines that are none are dropped."""
    lines = tail(spark, path, n, pattern).lines
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = lines.withColumn("e", F.from_json("line", f"{schema}, _corrupt string", options))
    return rows.where("e is not null and e._corrupt is null").select("file", "at", "e.*").drop("_corrupt")
