"""Mixing sources to target weights by Pfair scheduling of blocks.

The rows of a source, in a seeded random order, form blocks of ``block_rows``.
With weight w = p / q (q the sum of all weights) the source's block i, counted
from 0, is released at slot floor(i / w) and due before slot ceil((i + 1) / w).
Each slot takes the released block with the earliest deadline. The weights add up
to one, so every deadline is met, and after any slot every source is less than
one block away from its share.

The schedule repeats after q slots, which are worked out once; block i's slot
then follows from i / p and i % p. When a source runs out, a new phase begins in
which the others share its weight in proportion; the bound of one block holds
within each phase. All rows are kept.

Rows are ranked within their source without bringing a source together: they are
dealt to chunks by the leading bits of their order hash, ranked in their chunk,
and the chunks' sizes are added up. The hash covers the id and the other columns
(maps aside), so that an id that stands on many rows fills no chunk; rows
without an id are told apart by their place in a Parquet file, where they have
one. Rows that are equal throughout, with an id, share a hash.

The driver handles one count per source (``max_sources`` at most, else a
ValueError) and the slots of one period per phase (weights are scaled down to a
period of ``max_period``).

Defined cases: rows without a source form a source of their own; a source
without a stated weight gets ``default_weight``, and one of weight 0 or less
follows after all others, by default weight; repeated rows are all kept, as are
rows with a null id; result columns replace input columns of the same name; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import file_system, groups_in_order, scratch_dir, write_once

BLOCK_ROWS = 64
CHUNK_ROWS = 8192
#: Rows of an input file whose positions stand in one file.
SEGMENT = 1 << 20

_HASH, _NAME, _FILE, _ROW = "__hash", "__name", "__file", "__row"


def period(weights: list[int]) -> list[int]:
    """For each slot of a period, the index of the source whose block it takes."""
    q = sum(weights)
    due: list[tuple[int, int]] = []
    later = [(0, s, 0) for s in range(len(weights))]  # release, source, block
    heapq.heapify(later)
    out = []
    for slot in range(q):
        while later and later[0][0] <= slot:
            _, s, i = heapq.heappop(later)
            heapq.heappush(due, (-(-(i + 1) * q // weights[s]), s, i))
        _, s, i = heapq.heappop(due)
        out.append(s)
        if i + 1 < weights[s]:
            heapq.heappush(later, ((i + 1) * q // weights[s], s, i + 1))
    return out


@dataclass
class Plan:
    """Slots of all blocks: per source, where its phases begin and what repeats in them."""

    sources: dict[str | None, int]
    block_rows: int
    #: per source: (first block, first slot, blocks in a period, slots of a period, slot of each of these blocks)
    phases: list[list[tuple[int, int, int, int, np.ndarray]]] = field(default_factory=list)
    short_slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    short_rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def place(self, source: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, release, deadline) of a source's blocks."""
        out = np.zeros((3, len(blocks)), np.int64)
        starts = np.array([p[0] for p in self.phases[source]])
        which = np.searchsorted(starts, blocks, side="right") - 1
        for k in np.unique(which):
            first, at, p, q, slots = self.phases[source][k]
            rows = which == k
            i = blocks[rows] - first
            out[:, rows] = at + i // p * q + slots[i % p], at + i * q // p, at - (-(i + 1) * q // p)
        return out[0], out[1], out[2]

    def rows_before(self, slots: np.ndarray) -> np.ndarray:
        """Rows in all blocks of earlier slots."""
        missing = np.concatenate([[0], np.cumsum(self.block_rows - self.short_rows)])
        return slots * self.block_rows - missing[np.searchsorted(self.short_slots, slots)]


def plan(rows: dict[str | None, int], weights: dict[str | None, float], default_weight: float = 1.0, block_rows: int = BLOCK_ROWS, max_period: int = 10_000) -> Plan:
    """The schedule for sources with so many rows each."""
    names = sorted(rows, key=lambda s: (s is None, s or ""))
    out = Plan({s: k for k, s in enumerate(names)}, block_rows, [[] for _ in names])
    blocks = [-(-rows[s] // block_rows) for s in names]
    wanted = [float(weights.get(s, default_weight)) for s in names]
    used, slot = [0] * len(names), 0
    for rank in (True, False):  # sources of positive weight first
        live = [k for k, w in enumerate(wanted) if (w > 0) == rank and blocks[k]]
        while live:
            shares = [wanted[k] if rank else default_weight or 1.0 for k in live]
            whole = _whole(shares, max_period)
            order = np.array(period(whole))
            q = len(order)
            at = {k: np.flatnonzero(order == j) for j, k in enumerate(live)}
            left = {k: blocks[k] - used[k] for k in live}
            length = min((left[k] - 1) // p * q + int(at[k][(left[k] - 1) % p]) for k, p in zip(live, whole)) + 1
            for k, p in zip(live, whole):
                out.phases[k].append((used[k], slot, p, q, at[k]))
                used[k] += length // q * p + int(np.searchsorted(at[k], length % q))
            slot += length
            live = [k for k in live if used[k] < blocks[k]]
    last = []
    for k, s in enumerate(names):
        if rows[s] % block_rows:
            last.append((int(out.place(k, np.array([blocks[k] - 1]))[0][0]), rows[s] % block_rows))
    last.sort()
    out.short_slots, out.short_rows = (np.array([x[j] for x in last], np.int64) for j in (0, 1))
    return out


def _whole(shares: list[float], max_period: int) -> list[int]:
    """Whole weights in the given proportions, as small as these allow, with a sum of about ``max_period`` at most."""
    if all(float(s).is_integer() for s in shares) and sum(shares) <= max_period:
        whole = [int(s) for s in shares]
    else:
        total = sum(shares)
        whole = [max(1, round(s / total * max_period)) for s in shares]
    common = math.gcd(*whole)
    return [w // common for w in whole]


def _keyed(docs: DataFrame, source_col: str, id_col: str, seed: int) -> DataFrame:
    """The rows with their order hash, their source as a key without nulls, and their place in a file (null if they are not read from Parquet)."""
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    read = _from_parquet(docs)
    docs = docs.withColumns({_FILE: F.col("_metadata.file_path") if read else F.lit(None).cast("string"), _ROW: F.col("_metadata.row_index") if read else F.lit(None).cast("long")})
    place = F.when(F.col(id_col).isNull(), F.xxhash64(F.substring_index(_FILE, "/", -1), _ROW))
    name = F.concat(F.when(F.col(source_col).isNull(), "-").otherwise("+"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    others = [F.col(c) for c in sorted(plain) if c != id_col]
    return docs.withColumns({_HASH: F.xxhash64(F.lit(seed), F.col(id_col), *others, place), _NAME: name})


def _placed(
    keyed: DataFrame, weights: dict[str | None, float], source_col: str, default_weight: float, block_rows: int, chunk_rows: int, max_sources: int
) -> DataFrame:
    """Keyed rows with block, slot, release, deadline and position. One shuffle, by source and chunk."""
    sizes = keyed.groupBy(source_col).agg(F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(sizes) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found = plan({r[0]: r[1] for r in sizes}, weights, default_weight, block_rows)
    bits = max(0, math.ceil(math.log2(max(1, sum(r[1] for r in sizes) / chunk_rows))))
    chunk, rank = "__chunk", "__rank"
    keyed = keyed.withColumn(chunk, F.shiftrightunsigned(_HASH, 64 - bits).cast("int") if bits else F.lit(0))
    counts = keyed.groupBy(_NAME, chunk).agg(F.count("*").alias("n"))
    before = Window.partitionBy(_NAME).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_NAME, chunk, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy(_NAME, chunk).orderBy(F.shiftrightunsigned(_HASH, 1), _HASH, _FILE, _ROW)
    ranked = keyed.withColumn(rank, F.row_number().over(own) - 1).join(offsets, [_NAME, chunk])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col("__before")).drop("__before", chunk)

    @F.arrow_udf("struct<block:bigint, slot:bigint, release:bigint, deadline:bigint, position:bigint>")
    def placed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sources, ranks in batches:
            rank_of, coded = ranks.to_numpy(zero_copy_only=False), sources.dictionary_encode(null_encoding="encode")
            block = rank_of // block_rows
            slot, release, deadline = (np.zeros(len(block), np.int64) for _ in range(3))
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for code, name in enumerate(coded.dictionary.to_pylist()):
                own = np.flatnonzero(codes == code)
                if len(own):
                    slot[own], release[own], deadline[own] = found.place(found.sources[name], block[own])
            position = found.rows_before(slot) + rank_of % block_rows
            yield pa.StructArray.from_arrays([pa.array(c) for c in (block, slot, release, deadline, position)], names=["block", "slot", "release", "deadline", "position"])

    mark, fields = "__placed", ("block", "slot", "release", "deadline", "position")
    return ranked.withColumn(mark, placed(source_col, rank)).withColumns({f: F.col(f"{mark}.{f}") for f in fields}).drop(mark, rank)


def mix(
    docs: DataFrame, weights: dict[str | None, float], source_col: str = "source", id_col: str = "doc_id", default_weight: float = 1.0,
    block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS, seed: int = 17, max_sources: int = 1000,
) -> DataFrame:
    """The rows with block, slot, release, deadline and position (from 0) in the mixture.

    One shuffle of the rows, by source and chunk; ``in_order`` sorts them.
    """
    keyed = _keyed(docs, source_col, id_col, seed)
    return _placed(keyed, weights, source_col, default_weight, block_rows, chunk_rows, max_sources).drop(_HASH, _NAME, _FILE, _ROW)


def mixed_in_order(
    docs: DataFrame, weights: dict[str | None, float], source_col: str = "source", id_col: str = "doc_id", default_weight: float = 1.0,
    block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS, seed: int = 17, max_sources: int = 1000, rows_per_task: int = 200_000,
) -> DataFrame:
    """The rows of a Parquet table sorted by their position in the mixture, which is added.

    Rows are shuffled once. They are placed by source, hash and place in their
    file alone; the positions are written to the shared folder, one file of eight
    bytes a row for each ``SEGMENT`` rows of an input file, and looked up while the
    table is read. A frame that isn't read from Parquet is shuffled twice.
    """
    keyed = _keyed(docs, source_col, id_col, seed)
    how = (weights, source_col, default_weight, block_rows, chunk_rows, max_sources)
    if not _from_parquet(docs):
        placed = _placed(keyed, *how)
        return in_order(placed, docs.count(), rows_per_task).drop(_HASH, _NAME, _FILE, _ROW, "block", "slot", "release", "deadline")
    uri = scratch_dir(docs.sparkSession, "positions")
    rows = _placed(keyed.select(source_col, _HASH, _NAME, _FILE, _ROW), *how)
    n_rows = _write_positions(rows.select(_FILE, F.floor(F.col(_ROW) / SEGMENT).cast("int").alias("segment"), _ROW, "position"), uri)

    @F.arrow_udf("bigint")
    def looked_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for files, rows_of in batches:
            coded, rows = files.dictionary_encode(), rows_of.to_numpy(zero_copy_only=False)
            codes, segment = coded.indices.to_numpy(zero_copy_only=False), rows // SEGMENT
            out = np.zeros(len(rows), np.int64)
            for code, name in enumerate(coded.dictionary.to_pylist()):
                for number in np.unique(segment[codes == code]):
                    own = np.flatnonzero((codes == code) & (segment == number))
                    out[own] = _read_positions(uri, name, int(number), rows[own] % SEGMENT)
            yield pa.array(out)

    located = docs.withColumn("position", looked_up(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    return in_order(located, n_rows, rows_per_task)


def _from_parquet(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _segment_file(uri: str, name: str, segment: int) -> str:
    return f"{uri}/{hashlib.md5(name.encode()).hexdigest()}-{segment}"


def _write_positions(rows: DataFrame, uri: str) -> int:
    """Positions (file, segment, row, position) as files; the number of rows."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for table, bounds in groups_in_order(batches, 2):
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                own = table.slice(int(lo), int(hi - lo))
                at = own.column(2).to_numpy() % SEGMENT
                if (at[1:] == at[:-1]).any():
                    raise ValueError("rows with one place in a file; mix the table before rows are multiplied")
                positions = np.full(int(at[-1]) + 1, -1, "<i8")
                positions[at] = own.column(3).to_numpy()
                write_once(_segment_file(uri, own.column(0)[0].as_py(), own.column(1)[0].as_py()), positions.tobytes())
                done += len(at)
        yield pa.RecordBatch.from_arrays([pa.array([done])], names=["n"])

    n_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartition(n_tasks, _FILE, "segment").sortWithinPartitions(_FILE, "segment", _ROW)
    return sorted_rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def _read_positions(uri: str, name: str, segment: int, rows: np.ndarray) -> np.ndarray:
    first, last = int(rows.min()), int(rows.max())
    filesystem, path = file_system(_segment_file(uri, name, segment))
    with filesystem.open_input_file(path) as source:
        return np.frombuffer(source.read_at(8 * (last - first + 1), 8 * first), "<i8")[rows - first]


def in_order(mixed: DataFrame, n_rows: int, rows_per_task: int = 200_000) -> DataFrame:
    """Mixed rows sorted by position; each task holds a run of positions, known without sampling."""
    n_tasks = max(1, -(-n_rows // rows_per_task))
    part = F.floor(F.col("position") / F.lit(rows_per_task)).cast("int")
    return mixed.withColumn("__part", part).repartitionById(n_tasks, "__part").sortWithinPartitions("position").drop("__part")
