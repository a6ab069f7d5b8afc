"""Incremental ingest: what is new since the last run, each key once, with an index of the keys that are known."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.graph import written
from quern.sources.manifest import Versions

#: Parts of the key index; a batch reads those of its own keys.
BUCKETS = 64
#: Batches after which the index is written anew as one, and the list of folders begins anew.
COMPACT = 50
#: Column in which ``process`` gives the reason why a row failed, or null.
FAILED = "__failed"
#: The reason of a row that is to be tried again when its key comes again.
AGAIN = "again"


class KeyedTable:
    """A table that each batch adds its unseen keys to, and the index that tells which those are.

    A batch writes folders that nobody else writes: its rows, its failed keys, and its keys by hash (``bucket=b``). It counts once its
    version is published (``sources.manifest``), which names them; what a writer left that died before is never read, of two
    writers at a time one gets a ``Conflict``, and a batch of a stream that is run again adds nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: str | Sequence[str], schema: str, buckets: int = BUCKETS, compact: int = COMPACT):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.buckets, self.compact = buckets, compact
        self.versions = Versions(spark, folder)

    def _bucket(self) -> Column:
        nulls = [F.col(f"`{k}`").isNull() for k in self.keys]
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys], *nulls), F.lit(self.buckets)).cast("int")

    def _key_schema(self):
        return self.spark.createDataFrame([], self.schema).select(*[F.col(f"`{k}`") for k in self.keys]).schema

    def _folders(self, name: str) -> list[str]:
        """The folders of all versions: a version lists those since the index was last compacted, and the version before."""
        out, at = [], self.versions.head()
        while at:
            out += at[name]
            at = self.versions.version(at["older"]) if at["older"] is not None else None
        return out

    def _read(self, schema, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{f}" for f in folders])

    def rows(self) -> DataFrame:
        """The rows of all batches that count."""
        return self._read(self.schema, self._folders("rows"))

    def failures(self) -> DataFrame:
        """(keys, reason): what failed and is not tried again."""
        return self._read(self._key_schema().add("reason", T.StringType()), self._folders("failed"))

    def known(self, head: dict | None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The keys in ``buckets`` of the index; only their folders are read."""
        schema = self._key_schema()
        out = self.spark.createDataFrame([], schema)
        for at in head["index"] if head else []:
            part = self.spark.read.schema(self._key_schema().add("bucket", T.IntegerType())).parquet(f"{self.folder}/{at}")
            part = part if buckets is None else part.filter(F.col("bucket").isin(list(buckets)))
            out = out.unionByName(part.drop("bucket"))
        return out

    def unseen(self, rows: DataFrame, head: dict | None) -> DataFrame:
        """One row of ``rows`` for each key that the index doesn't have; nulls are compared like values."""
        once = written(rows.dropDuplicates(self.keys).withColumn("__bucket", self._bucket()), "batch")
        touched = [r[0] for r in once.select("__bucket").distinct().collect()]  # no more than there are buckets
        known = self.known(head, touched).toDF(*[f"__of_{i}" for i in range(len(self.keys))])
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__of_{i}"))
        return once.join(known, same, "left_anti").drop("__bucket")

    def add(self, rows: DataFrame, batch: int, stream: str = "", process: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> bool:
        """Process and keep the unseen keys of ``rows``; false if this batch of this stream, or a later one, counts already.

        ``process`` may drop rows, add rows, and give a reason in ``FAILED``: such a row isn't kept, but its key is, with the reason, and is
        not tried again, unless the reason is ``AGAIN``. All other keys that it was given are known from then on, whatever became of them.
        """
        head = self.versions.head()
        done = dict(head["streams"]) if head else {}
        if batch <= done.get(stream, -1):
            return False
        new = written(self.unseen(rows, head), "unseen")
        made, failed, keys = process(new), [], new.select(*self.keys)
        at = self.versions.new_folder()
        if FAILED in made.columns:
            made = written(made, "made")
            bad = made.filter(F.col(FAILED).isNotNull()).select(*self.keys, F.col(FAILED).alias("reason"))
            bad.filter(F.col("reason") != AGAIN).write.parquet(f"{self.folder}/{at}/failed")
            failed = [f"{at}/failed"]
            again = bad.filter(F.col("reason") == AGAIN).select(*self.keys).toDF(*[f"__of_{i}" for i in range(len(self.keys))])
            same = F.lit(True)
            for i, k in enumerate(self.keys):
                same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__of_{i}"))
            keys = keys.join(again, same, "left_anti")
            made = made.filter(F.col(FAILED).isNull()).drop(FAILED)
        made.write.parquet(f"{self.folder}/{at}/rows")
        whole = head is None or len(head["index"]) >= self.compact
        if whole:
            keys = self.known(head).unionByName(keys)
        keys.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{at}/keys")
        before = head if head and not whole else {"index": [], "rows": [], "failed": [], "older": head and head["number"]}
        self.versions.publish(
            head, streams=done | {stream: batch}, older=before["older"], index=[*before["index"], f"{at}/keys"], rows=[*before["rows"], f"{at}/rows"], failed=before["failed"] + failed
        )
        return True


def ingest(spark: SparkSession, source: str, schema: str, target: str, key: str | Sequence[str], checkpoint: str, process: Callable[[DataFrame], DataFrame] = lambda rows: rows, result: str | None = None, **how) -> KeyedTable:
    """Read files that came since the last run, and add the processed rows of unseen keys to the keyed table ``target``.

    The stream remembers files, the key index keys, so no state grows in the stream and no batch reads the target. A batch that is run
    again after a failure adds nothing twice. ``result`` is the schema of what ``process`` makes, where that is another.
    """
    table = KeyedTable(spark, target, key, result or schema, **how)

    def batch(rows: DataFrame, number: int) -> None:
        table.add(rows, number, checkpoint, process)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table


def running_edges(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, **how) -> KeyedTable:
    """Add each batch's distinct rows that ``target`` lacks; an edge with a null is an edge like any other."""
    columns = spark.createDataFrame([], schema).columns
    return ingest(spark, source, schema, target, columns, checkpoint, **how)
