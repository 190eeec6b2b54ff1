"""WARC archives with an index: write, select, read by byte range.

Every page becomes one record, compressed on its own. A payload that occurs more
than once and has at least ``MIN_REVISIT`` bytes is written once, in the record
of the page with the largest id; the other pages' records are revisits that
refer to it. The index names each record's file, offset, length, URL and digest,
and is written before anything is read: a reader selects index rows, sorts them
by place and joins close ranges into one read.

Tasks write their own files under names that no second attempt reuses, and the
index holds the files of finished tasks only.

Defined cases: a null html is an empty payload; a null URL is written as
``urn:page:<id>`` and read back as null; control characters and spaces in a URL
are percent-encoded in the record header only; rows with a null id are responses;
of repeated rows with the largest id, each is a response; other columns are
ignored; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import file_system, scratch_dir, stored

MIN_REVISIT = 1000
FILE_BYTES = 256 << 20
#: Records up to this far apart are read together, up to so many bytes in one read.
GAP, READ = 64 << 10, 8 << 20
#: Index rows of so many bytes of one file form a task's share.
SHARE = 64 << 20

INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record's bytes, uncompressed."""
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else _urn(page).strip("<>")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    ]
    block = _HTTP % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, str, int | None, str, bytes]:
    """(page, record type, page referred to, hex digest of the payload as stated, payload) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
    return _page(fields["WARC-Record-ID"]), kind, _page(refers) if refers else None, digest, payload


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of each page.

    Repeated payloads are found on digests alone; payloads move only if the
    repeated digests are too many for Spark to broadcast.
    """
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    large = pages.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    repeated = stored(large.where("n > 1 and keeper is not null").select("digest", "keeper"), "repeated")
    refers = F.when(F.col("page_id") != F.col("keeper"), F.col("keeper"))
    typed = pages.join(repeated, "digest", "left").withColumn("refers_to", refers)
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    return typed.select("page_id", "url", "payload", "digest", kind.alias("record_type"), "refers_to")


def write_archives(pages: DataFrame, uri: str, date: str = "2024-01-01T00:00:00Z", level: int = 4, **columns) -> DataFrame:
    """Write a record per page below ``uri``; the index, stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, path = None, 0, ""
        for batch in batches:
            rows = []
            for page, url, payload, digest, _, refers_to in zip(*(c for c in batch.columns)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    path, at = f"{uri}/{uuid.uuid4().hex}.warc.gz", 0
                    filesystem, place = file_system(path)
                    filesystem.create_dir(place.rpartition("/")[0], recursive=True)
                    out = filesystem.open_output_stream(place, compression=None)
                one = zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), date)
                packed = one.compress(raw) + one.flush()
                out.write(packed)
                rows.append((path, at, len(packed)))
                at += len(packed)
            files, offsets, lengths = zip(*rows) if rows else ((), (), ())
            arrays = [pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), *(batch.column(k) for k in (0, 1, 3, 4, 5))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in INDEX.split(", ")])
        if out is not None:
            out.close()

    return stored(classified(pages, **columns).mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows name, as written: ``RECORD`` columns.

    Without ``payloads`` the bytes are replaced by their number: payload_bytes
    long. ``payload_digest`` is worked out from a response's bytes and checked
    against its header (ValueError if they differ); a revisit states it.
    """
    last = "payload binary" if payloads else "payload_bytes long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            for start, end in _ranges(rows):
                filesystem, path = file_system(rows[start][0])
                base = rows[start][1]
                with filesystem.open_input_file(path) as source:
                    raw = source.read_at(max(r[1] + r[2] for r in rows[start:end]) - base, base)
                out = []
                for _, offset, length, url in rows[start:end]:
                    page, kind, refers, digest, payload = parse(zlib.decompress(raw[offset - base : offset - base + length], 31))
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"page {page}: the payload is not the one that was written")
                    out.append((page, url, kind, refers, digest, payload if payloads else len(payload)))
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary() if payloads else pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "url", "record_type", "refers_to", "payload_digest", last.split()[0]])

    rows = index.select("file", "offset", "length", "url")
    share = F.floor(F.col("offset") / SHARE)
    n_tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n_tasks, "file", share).sortWithinPartitions("file", "offset")
    return rows.mapInArrow(read, RECORD.rpartition(", ")[0] + ", " + last)


def _ranges(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """Runs of sorted (file, offset, length, ...) rows to read at once."""
    start, reach = 0, 0
    for k, (file, offset, length, *_) in enumerate(rows):
        if k > start and (file != rows[start][0] or offset - reach > GAP or offset + length - rows[start][1] > READ):
            yield start, k
            start, reach = k, 0
        reach = max(reach, offset + length)
    if rows:
        yield start, len(rows)


def with_full_payloads(records: DataFrame) -> DataFrame:
    """Records read without payloads, where revisits have the size of the payload they refer to."""
    responses = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full"))
    revisits = records.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return records.where("record_type = 'response'").select(names).unionAll(revisits.withColumn("payload_bytes", F.col("full")).select(names))


def archived(pages: DataFrame, **how) -> DataFrame:
    """Write all pages to new archives and return what the archives say of each page."""
    index = write_archives(pages, scratch_dir(pages.sparkSession, "warc"), **how)
    return with_full_payloads(stored(read_records(index, payloads=False), "warc-records"))
