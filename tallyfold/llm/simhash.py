"""Near duplicates by SimHash fingerprints of 64 bits, found by deletion variants.

Two fingerprints link if they differ in at most ``MAX_BITS`` (2) bits. Cut into
two halves, they differ by at most one bit in one of these. So each half is
indexed once for every bit in it, with that bit as a wildcard: 64 variants of a
fingerprint. Linked fingerprints meet in an equality join on a variant, and what
meets there is verified on all 64 bits.

1. Fingerprints are made in one narrow pass and written; equal ones become one.
2. Every variant's key is a cell. A cell of more than ``cell`` fingerprints is not
   compared: as in the first step, its open bits are cut into two segments, each
   with a wildcard in every place, and the rows go to these smaller cells; after
   the third cut at most eleven bits of a cell are open, that is 2,048
   fingerprints. Which cells are too large follows from how many fingerprints
   share a segment, counted before any variant is made.
3. A task holds one cell at a time, and gives for every fingerprint linked there
   its root in the cell: no more rows than it has read.
4. Links become components; every document takes the least id of its component.

Words are parts between ASCII white space of the text with A-Z in lower case. A
shingle is three words with single spaces between them, repeats count; h is its
XXH64 with seed 42, and a bit is 1 if more than half of the shingles' h have it.

Defined cases: a text of one or two words is one shingle; a null, empty or blank
text has fingerprint zero, which links like any other; a null id has a
fingerprint and is never a component's least id (a component of null ids only has
a null id); repeated rows stay repeated; ids in use by several texts connect
nothing by themselves; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import components, joined_spread, release_memory, stored, text_runs

WORDS, SEED, BITS, MAX_BITS = 3, 42, 64, 2
CELL = 1024
#: Bits of a segment after the first, second and third cut.
CUTS = (32, 16, 8)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The SimHash of a text, unsigned."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, size = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), 1 << 15):  # a bounded number of shingles at a time
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + (1 << 15)], stops[k : k + (1 << 15)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for run in text_runs(batch.column(1)) for t in run]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(made, "doc_id long, fp long")


def _segments(open_: Column, bits: int) -> Column:
    """The two segments of ``bits`` bits each that the open bits are cut into."""
    mask = (1 << bits) - 1
    return F.array(open_.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(open_, bits).bitwiseAND(F.lit(mask)))


def _variants(segment: str, bits: int) -> Column:
    """(p, v) for every place p of the segment; v is the segment without that bit."""
    return F.expr(f"transform(sequence(0, {bits - 1}), p -> struct(p, {segment} & ~shiftleft(1L, p) AS v))")


class VariantIndex:
    """The links of distinct fingerprints; see the module's text for its steps."""

    def __init__(self, cell: int = CELL, max_bits: int = MAX_BITS):
        if max_bits not in (1, 2, 3):
            raise ValueError("with two segments, one differs by at most one bit for up to 3 bits")
        self.cell, self.max_bits = cell, max_bits

    def links(self, prints: DataFrame) -> DataFrame:
        """(a, b): links that connect what all links of the distinct ``prints`` (fp) connect."""
        rows = prints.select(F.lit(0).cast("long").alias("cell"), "fp", F.col("fp").alias("open"))
        found = None
        for k, bits in enumerate(CUTS):
            segments = rows.select("cell", "fp", "open", F.posexplode(_segments(F.col("open"), bits)).alias("s", "segment"))
            last = bits == CUTS[-1]
            # a cell holds the fingerprints of two values of its segment, so of more than ``cell`` one value has more than half
            crowded = segments.groupBy("cell", "s", "segment").agg(F.count("*").alias("n")).where(F.col("n") > self.cell // 2)
            wide = segments.withColumn("x", F.explode(_variants("segment", bits)))
            name = F.xxhash64("cell", "s", "x.p", "x.v") if k else F.shiftleft(F.col("s").cast("long") * bits + F.col("x.p"), bits).bitwiseOR(F.col("x.v"))
            cells = wide.select(name.alias("cell"), "fp", self._rest("x.p", bits).alias("open"))
            if last or not (large := stored(crowded, "crowded")).take(1):
                links = self._compared(cells)
                return links if found is None else found.unionAll(links)
            names = large.withColumn("x", F.explode(_variants("segment", bits))).select(name.alias("cell")).distinct()
            links = self._compared(cells.join(names, "cell", "left_anti"))
            found = links if found is None else found.unionAll(links)
            rows = stored(cells.join(names, "cell", "left_semi"), "cells")
        return found

    @staticmethod
    def _rest(place: str, bits: int) -> Column:
        """The bits of a row's other segment, which stay open in the cell."""
        other = F.when(F.col("s") == 0, F.shiftrightunsigned("open", bits)).otherwise(F.col("open"))
        return other.bitwiseAND(F.lit((1 << bits) - 1))

    def _compared(self, cells: DataFrame) -> DataFrame:
        most = self.max_bits

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[np.ndarray, np.ndarray] | None = None
            for batch in batches:
                cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                if held is not None:
                    cell, fp = np.concatenate([held[0], cell]), np.concatenate([held[1], fp])
                if not len(cell):
                    continue
                cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
                held = cell[cut:], fp[cut:]
                yield _linked(cell[:cut], fp[:cut], most)
            if held is not None:
                yield _linked(*held, most)
            release_memory()

        n_tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return cells.select("cell", "fp").repartition(n_tasks, "cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def _linked(cell: np.ndarray, fp: np.ndarray, most: int) -> pa.RecordBatch:
    """(a, b) with a's root b for every fingerprint linked to a smaller place of its cell; cells are runs of equal values."""
    n = len(cell)
    root, at, k = np.arange(n), np.arange(n), 1
    bits = fp.view(np.uint64)
    while len(at := at[at + k < n]) and len(at := at[cell[at] == cell[at + k]]):
        near = at[np.bitwise_count(bits[at] ^ bits[at + k]) <= most]
        _unite(root, near, near + k)
        k += 1
    below = np.flatnonzero(root != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(fp[below]), pa.array(fp[root[below]])], names=["a", "b"])


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put the links between places a and b into ``root``, which points every place to the least of its part."""
    while len(a):
        top_a, top_b = root[a], root[b]
        apart = top_a != top_b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(top_a, top_b)[apart], np.minimum(top_a, top_b)[apart])
        while not np.array_equal(root[root], root):
            root[:] = root[root]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    root = components(VariantIndex(cell, max_bits).links(distinct.select("fp")))
    of_root = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    of_root = stored(of_root, "roots")
    least = of_root.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = joined_spread(of_root, least, "root", "fp").select("fp", "component_id")
    found = joined_spread(prints, of_print, "fp", "doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
