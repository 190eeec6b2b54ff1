"""A sink that writes one file per row under the row's name, all of them or none.

Tasks write into a folder of their own below ``_staged``; the commit moves the files
to their names once every task has finished, and a failed job takes its staged
files away. Files of other names stay; a file of the same name is replaced.

    spark.dataSource.register(NamedFiles)
    rows.write.format("named_files").mode("append").save(path)

Rows are (name, content), content a text or binary column. A name may hold folders
(``case-1/case.json``).

Defined cases: a null or empty name, and one that leaves the folder (``..``, a
leading slash), fail the job; null content is an empty file; of rows of one name any
one is kept, as all are moved to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGED = "_staged"


def _system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("named files are added to a folder; use append")
        if schema.names[:2] != ["name", "content"]:
            raise ValueError("rows have to be name and content")
        return NamedWriter(self.options["path"])


class NamedWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.run = path.rstrip("/"), uuid.uuid4().hex

    def write(self, rows: Iterator) -> Staged:
        system, top = _system(self.path)
        folder, files = f"{STAGED}/{self.run}/{uuid.uuid4().hex}", 0
        try:
            for row in rows:
                name = row[0] or ""
                parts = name.split("/")
                if not name or any(p in ("", ".", "..") for p in parts) or parts[0] == STAGED:
                    raise ValueError(f"{name!r} is no name of a file")
                at = f"{top}/{folder}/{name}"
                system.create_dir(at.rpartition("/")[0], recursive=True)
                with system.open_output_stream(at) as out:
                    out.write(row[1].encode("utf-8", "surrogatepass") if isinstance(row[1], str) else bytes(row[1] or b""))
                files += 1
        except BaseException:
            _remove(system, f"{top}/{folder}")
            raise
        return Staged(folder, files)

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        system, top = _system(self.path)
        system.create_dir(top, recursive=True)
        for message in messages:
            if message is None or not message.files:
                continue
            staged = f"{top}/{message.folder}"
            for found in system.get_file_info(fs.FileSelector(staged, recursive=True)):
                if found.is_file:
                    to = f"{top}/{found.path[len(staged) + 1 :] if found.path.startswith(staged) else found.path.rpartition(message.folder)[2].lstrip('/')}"
                    system.create_dir(to.rpartition("/")[0], recursive=True)
                    system.move(found.path, to)
        self._clean(system, top)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clean(*_system(self.path))

    def _clean(self, system, top: str) -> None:
        from pyarrow import fs

        _remove(system, f"{top}/{STAGED}/{self.run}")
        if system.get_file_info(f"{top}/{STAGED}").type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(f"{top}/{STAGED}")):
            system.delete_dir(f"{top}/{STAGED}")


def _remove(system, folder: str) -> None:
    from pyarrow import fs

    if system.get_file_info(folder).type == fs.FileType.Directory:
        system.delete_dir(folder)


def save(rows: DataFrame, path: str) -> None:
    """(name, content) rows as files below the path."""
    rows.sparkSession.dataSource.register(NamedFiles)
    rows.select("name", "content").write.format("named_files").mode("append").save(path)


def save_cases(cases: DataFrame, path: str, key: str = "case_id") -> None:
    """Label cases as ``<key>/case.json``, one JSON object a file."""
    save(cases.select(F.concat(F.col(key), F.lit("/case.json")).alias("name"), F.to_json(F.struct(*cases.columns)).alias("content")), path)


def save_filings(filings: DataFrame, path: str) -> None:
    """Filings (company_number, transaction_id, markup) as readable pages, ``<company>_<transaction>.md``."""
    from tallyfold.functions.text import readable_markdown

    name = F.concat(F.col("company_number"), F.lit("_"), F.col("transaction_id"), F.lit(".md"))
    save(filings.select(name.alias("name"), readable_markdown(F.col("markup")).alias("content")), path)
