"""Search for substrings without regard to case, by an index of three-character pieces.

The index is made of segments, each of as many texts as one task has read in a row. For
every piece of a segment it holds the ids of the texts that have it, as one list, in
Parquet files that are dealt out by the piece's hash and ordered by piece. Lists of
different segments are never brought together, so nothing is shuffled to build it. A
search takes the rarest pieces of what is asked for, reads their lists only, and keeps
the ids that are in all of a segment's lists; nothing else of the texts is searched. Rows
are those that a scan of all texts finds.

Defined cases: null texts are in no result; what is asked for is compared in lower
case as Spark makes it; a question of fewer than three characters has no piece and
is answered by a scan, an empty one by all texts that are not null; repeated ids
are all found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

PIECE, RAREST = 3, 4
#: A segment is closed at so many entries of its lists, or so many texts.
ENTRIES, TEXTS = 2_000_000, 100_000


def _pieces(text: str) -> np.ndarray:
    """The distinct pieces of a text in order, each as one number of its three characters."""
    at = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    if len(at) < PIECE:
        return np.empty(0, np.int64)
    found = np.sort(at[:-2] | at[1:-1] << 21 | at[2:] << 42)
    return found[np.append(True, found[1:] != found[:-1])]


def _bucket(pieces: np.ndarray, buckets: int) -> np.ndarray:
    mixed = pieces.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _segments(buckets: int, entries: int, texts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (bucket, piece, segment, n, ids) of texts (id, text); one row without a piece has a segment's number of texts as n."""

    def closed(number: int, ids: list[pa.Array], found: list[np.ndarray]) -> pa.RecordBatch:
        pieces = np.concatenate(found)
        order = np.argsort(pieces, kind="stable")
        pieces = pieces[order]
        owner = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])[order]
        starts = np.flatnonzero(np.append(True, pieces[1:] != pieces[:-1])) if len(pieces) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(pieces)) if len(starts) else starts
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(pieces), len(pieces)], pa.int32()), pa.concat_arrays(ids).take(pa.array(owner)))
        known = pieces[starts]
        columns = [
            pa.array(np.append(_bucket(known, buckets), 0), pa.int32()),
            pa.array([*known.tolist(), None], pa.int64()),
            pa.array(np.full(len(known) + 1, number), pa.int64()),
            pa.array(np.append(ends - starts, len(found)), pa.int64()),
            lists,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "piece", "segment", "n", "ids"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, found, size = [], [], 0
        for batch in batches:
            first = 0
            for k in range(len(batch)):
                found.append(_pieces(batch.column(1)[k].as_py()))
                size += len(found[-1])
                if size >= entries or len(found) >= texts:
                    yield closed(number, [*ids, batch.column(0).slice(first, k + 1 - first)], found)
                    ids, found, size, first, number = [], [], 0, k + 1, number + 1
            ids.append(batch.column(0).slice(first))
        if found:
            yield closed(number, ids, found)

    return made


class SubstringIndex:
    """The index of one text column below ``path``."""

    def __init__(self, spark: SparkSession, path: str, id_col: str, buckets: int = 16, entries: int = ENTRIES, texts: int = TEXTS):
        self.spark, self.path, self.id_col, self.buckets = spark, path.rstrip("/"), id_col, buckets
        self.entries, self.texts = entries, texts

    def build(self, docs: DataFrame, text_col: str) -> SubstringIndex:
        """Write the index of all texts."""
        rows = docs.select(F.col(self.id_col).alias("id"), F.lower(F.col(text_col)).alias("text")).where("text is not null and id is not null")
        kind = dict(rows.dtypes)["id"]
        made = rows.mapInArrow(_segments(self.buckets, self.entries, self.texts), f"bucket int, piece bigint, segment bigint, n bigint, ids array<{kind}>")
        made.sortWithinPartitions("bucket", "piece").write.partitionBy("bucket").parquet(f"{self.path}/pieces")
        self.spark.createDataFrame([], f"id {kind}").write.parquet(f"{self.path}/kind")
        return self

    def _rows(self) -> DataFrame:
        kind = dict(self.spark.read.parquet(f"{self.path}/kind").dtypes)["id"]  # an index of no texts has no file to tell it
        return self.spark.read.schema(f"piece bigint, segment bigint, n bigint, ids array<{kind}>, bucket int").parquet(f"{self.path}/pieces")

    def share_read(self, question: str) -> float:
        """The share of the indexed texts that a search for the question looks into."""
        found = self.candidates(question)
        texts = self._rows().where("bucket = 0 and piece is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return 1.0 if found is None else found.distinct().count() / max(1, texts)

    def _asked(self, question: str) -> list[int]:
        return _pieces(self.spark.range(1).select(F.lower(F.lit(question))).first()[0]).tolist()

    def candidates(self, question: str) -> DataFrame | None:
        """(id) of the texts that have the question's rarest pieces; None if it is too short to have one."""
        pieces = self._asked(question)
        if not pieces:
            return None
        buckets = dict(zip(pieces, _bucket(np.array(pieces, np.int64), self.buckets).tolist(), strict=True))
        of = lambda chosen: F.col("bucket").isin(sorted({buckets[p] for p in chosen})) & F.col("piece").isin(chosen)
        known = {r.piece: r.n for r in self._rows().where(of(pieces)).groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        # where no text has one of the pieces, nothing is chosen
        chosen = sorted(pieces, key=lambda p: (known[p], p))[:RAREST] if len(known) == len(pieces) else []
        lists = self._rows().where(of(chosen)).groupBy("segment").agg(F.collect_list("ids").alias("lists"))  # a segment's lists: as many as pieces
        whole = lists.where(F.size("lists") == max(1, len(chosen)))
        both = F.aggregate(F.slice("lists", 2, RAREST), F.array_distinct(F.element_at("lists", 1)), F.array_intersect)
        return whole.select(F.explode(both).alias("id"))

    def search(self, docs: DataFrame, question: str, text_col: str) -> DataFrame:
        """The rows of the indexed table whose text holds the question."""
        hit = F.contains(F.lower(F.col(text_col)), F.lower(F.lit(question)))
        found = self.candidates(question)
        if found is None:
            return docs.where(hit)
        return docs.join(found.withColumnRenamed("id", self.id_col), self.id_col, "left_semi").where(hit).select(docs.columns)
