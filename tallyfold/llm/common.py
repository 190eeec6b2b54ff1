"""What the operators share: the cluster's scratch folder and files in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the shared folder that the session names.

    Where ``spark.checkpoint.dir`` is unset, a local temporary folder is chosen
    and set if all of Spark runs in this process; on a cluster, whose machines
    would not see it, that is a ValueError.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"{CHECKPOINT_DIR} has to name a folder that all machines of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bounds of the Arrow batches that go to Python.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to ``BATCH_BYTES`` and ``BATCH_ROWS``, for executors with little memory.

    An application's choice (the registered queries make it); operators leave the
    session as it is, and work through a batch in runs of bounded size.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release_memory() -> None:
    """Give back what a finished task no longer uses; its Python worker may idle while others need the memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again.

    Cuts the lineage: what follows reads the files, also when an executor is
    lost.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """The pyarrow file system of a URI and the path in it, for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, data: bytes) -> None:
    """A file with content that every attempt of a task makes alike; it is there whole or not at all."""
    filesystem, path = file_system(uri)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(own) as out:
        out.write(data)
    try:
        filesystem.move(own, path)
    except OSError:
        if not filesystem.get_file_info(path).is_file:
            raise
        filesystem.delete_file(own)  # another attempt was first, on a file system that does not replace


def groups_in_order(batches, n_keys: int):
    """Tables of whole groups from Arrow batches sorted by their first ``n_keys`` columns.

    Yields (table, bounds): the table holds one or more complete groups and
    bounds their first rows and the end. Only the group that a batch breaks off
    is held back for the next one.
    """
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        new = np.zeros(len(table), bool)
        for k in range(n_keys):
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new)])
        held = table.slice(int(starts[-1]))
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts
    if held is not None:
        yield held, np.array([0, len(held)])


#: Tasks that the rows of one key may be spread over in ``joined_spread``.
SPREAD = 64


def joined_spread(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` joined with a table that has one row per key, the rows of a frequent key spread over tasks by the column ``by``.

    Each key is first paired with the parts that its rows fall in, ``SPREAD`` at
    most; only these pairs meet in the join by key.
    """
    from pyspark.sql import functions as F

    part = F.pmod(F.xxhash64(by, F.lit(11)), F.lit(SPREAD)).cast("int")
    parts = rows.select(key, part.alias("__part")).distinct().join(table, key)
    return rows.withColumn("__part", part).join(parts, [key, "__part"]).drop("__part")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of the edges (a, b); root is the least node.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, and only its edge count and checksum reach the driver. The
    neighbours of one node are spread over tasks.
    """
    from pyspark.sql import functions as F

    def ordered(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))")).first())

    now = stored(ordered(edges), "edges")
    seen = state(now)
    while seen[0]:
        both = now.select(F.col("v").alias("x"), F.col("u").alias("y")).unionAll(now.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = ordered(joined_spread(both, least, "x", "y").where("y > x").select(F.col("y").alias("a"), F.col("m").alias("b")))
        first = large.groupBy("v").agg(F.min("u").alias("m"))
        small = joined_spread(large, first, "v", "u").select(F.col("u").alias("a"), F.col("m").alias("b")).unionAll(first.select(F.col("v").alias("a"), F.col("m").alias("b")))
        now = stored(ordered(small), "edges")
        before, seen = seen, state(now)
        if before == seen:
            break
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def text_runs(texts, characters: int = 1_000_000):
    """Slices of an Arrow array of texts, of about so many bytes each (one text at least)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.cumulative_sum(pc.binary_length(texts).fill_null(0).cast(pa.int64())).to_numpy()
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + characters)))
        yield texts.slice(start, end - start)
        start = end
