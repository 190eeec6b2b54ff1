"""Tables that are changed by key, in plain Parquet: an upsert reads and writes only the buckets that it touches.

A table is a folder. ``rows/`` holds versions, each with a folder per bucket of the
keys' hash; ``ledger/`` holds one small file per commit, with the version that each
touched bucket has from then on, and the name and number of the batch that made
it. The current rows are those of every bucket's last version.

A commit is the ledger's file: what a failed job has written before it is never
read. A batch whose name and number are in the ledger changes nothing when it is
given again, so a stream's sink may be run again after a failure. Readers keep the
version that they started with. One writer at a time is assumed, as in a store
that locks for writing.

Defined cases: null keys are equal to each other; of several rows of a key the
first in ``order`` counts, without one the first by all columns; a table without
rows has its columns; columns that the table lacks are left out, missing ones null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.operators.upsert import upsert

LEDGER = "version long, stream string, batch long, bucket int, folder string"
BUCKET = "__bucket"


class KeyedTable:
    """One table; ``schema`` is a DDL string, ``buckets`` has to stay what it was when the table was begun."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.schema = spark.createDataFrame([], schema).schema
        if BUCKET in self.schema.names:
            raise ValueError(f"{BUCKET} is a column of the store's own")

    def _commits(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/ledger")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(LEDGER).json(f"{self.path}/ledger") if there else self.spark.createDataFrame([], LEDGER)

    def folders(self) -> dict[int, str]:
        """The current folder of each bucket that has rows: ``buckets`` entries at most."""
        last = self._commits().where("bucket is not null").groupBy("bucket").agg(F.max(F.struct("version", "folder")).alias("last"))
        return {r.bucket: r["last"].folder for r in last.collect() if r["last"].folder}

    def version(self) -> int:
        """The number of the last commit; 0 before any."""
        return self._commits().agg(F.max("version")).first()[0] or 0

    def has(self, stream: str, batch: int) -> bool:
        return not self._commits().where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()

    def rows(self, buckets: set[int] | None = None) -> DataFrame:
        """The current rows, of all buckets or of some; only their folders are read."""
        paths = [f for b, f in sorted(self.folders().items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, incoming: DataFrame, stream: str, batch: int, keep: list[str] | None = None, order: list[Column] | None = None, only_if: Column | None = None, gone: Column | None = None) -> set[int]:
        """Put rows in by key as one commit; returns the touched buckets, none if the batch is in the ledger already.

        ``keep``, ``order`` and ``only_if`` are those of ``operators.upsert.upsert``;
        rows for which ``gone`` holds afterwards are taken out.
        """
        if self.has(stream, batch):
            return set()
        missing = [c for c in self.schema.names if c not in incoming.columns]
        new = incoming.withColumns({c: F.lit(None).cast(self.schema[c].dataType) for c in missing}).withColumn(BUCKET, self.bucket())
        touched = {r[0] for r in new.select(BUCKET).distinct().collect()}
        version = self.version() + 1
        folder = f"rows/v{version}-{stream}-{batch}"
        if touched:
            merged = upsert(self.rows(touched).withColumn(BUCKET, self.bucket()), new, self.keys, keep, order, only_if)
            merged = merged.where(~F.coalesce(gone, F.lit(False))) if gone is not None else merged
            merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        written = {b: f"{folder}/{BUCKET}={b}" for b in touched}
        self._commit(version, stream, batch, written)
        return touched

    def _commit(self, version: int, stream: str, batch: int, written: dict[int, str]) -> None:
        """One file in the ledger; a bucket that has lost all its rows has a folder that is not there, and gets none."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()

        def there(folder: str) -> bool:
            path = fs_path(f"{self.path}/{folder}")
            return path.getFileSystem(conf).exists(path)

        rows = [(version, stream, batch, b, f if there(f) else None) for b, f in sorted(written.items())] or [(version, stream, batch, None, None)]
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").json(f"{self.path}/ledger")


def upsert_stream(table: KeyedTable, stream: DataFrame, name: str, checkpoint: str, **how) -> None:
    """Put all that a stream holds now into the table and stop; ``how`` goes to ``upsert``.

    A batch that was committed before its checkpoint was written comes again after a
    restart, and is known by the ledger.
    """
    sink = stream.writeStream.foreachBatch(lambda rows, batch: table.upsert(rows, name, batch, **how))
    sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
