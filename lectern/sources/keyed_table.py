"""Parquet tables in which a key is there once, laid out so that a batch reads only the keys that it can meet."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.operators.keyed import one_per_key, only_new
from lectern.operators.tables import kept

#: Columns of the layout: the number of buckets, the bucket of the key, and the batch that wrote a row.
OF, BUCKET, BATCH = "of", "key_bucket", "batch"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below `path`; none if there is no such path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory()) if files.exists(target) else []


@dataclass(frozen=True)
class KeyedTable:
    """A table of rows with the columns `keys`, in folders of=<buckets>/key_bucket=<n>/batch=<name>.

    A key's rows lie in the bucket of its hash, so an insert reads the keys of the buckets that its batch
    touches, and the scan of the others is pruned. A batch writes folders of its own: written again under the same name, it
    replaces what it wrote, so a job that failed at any point can be run again. How many buckets
    there are is fixed when the table is first written, and read from its folders from then on.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 256

    def _of(self, spark: SparkSession) -> int | None:
        found = [f.split("=")[1] for f in folders(spark, self.path) if f.startswith(f"{OF}=")]
        if not found and any("=" not in f for f in folders(spark, self.path) if f[:1] not in "_."):
            raise ValueError(f"{self.path} is no keyed table")
        return int(found[0]) if found else None

    def placed(self, rows: DataFrame) -> DataFrame:
        of = self._of(rows.sparkSession) or self.buckets
        return rows.withColumns({OF: F.lit(of), BUCKET: F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(of)).cast("int")})

    def read(self, spark: SparkSession) -> DataFrame:
        """The table's own columns."""
        return spark.read.parquet(self.path).drop(OF, BUCKET, BATCH)

    def possible(self, spark: SparkSession, touched: Sequence[int], batch: str) -> DataFrame:
        """Keys of the buckets named, but for those that the batch itself has written; other columns and buckets aren't read."""
        rows = spark.read.parquet(self.path).filter(F.col(BUCKET).isin(*touched) & (F.col(BATCH).cast("string") != batch))
        return rows.select(*self.keys)

    def append_absent(self, new: DataFrame, order: Sequence[str], batch: str | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Append the first row, in `order`, of each key that the table lacks; the number of rows.

        Rows with a null key always count as new. A batch that comes again under its name replaces what it wrote. `finish` makes the table's rows,
        row by row, of those that are appended, so that what only these need isn't computed for the others; it keeps the keys.
        """
        spark, batch = new.sparkSession, batch or f"b{uuid.uuid4().hex}"
        first = one_per_key(new, self.keys, [F.col(o).asc_nulls_last() for o in order])
        first = kept(self.placed(first), "batch-rows")  # read for its buckets and for the insert
        touched = sorted(r[0] for r in first.select(BUCKET).distinct().collect())  # as many as there are buckets, at most
        if not touched:
            return 0
        fresh, seen = first, Observation()
        if exists(spark, self.path):
            fresh = only_new(first, self.possible(spark, touched, batch), self.keys)
        if finish:
            fresh = self.placed(finish(fresh.drop(OF, BUCKET)))
        dealt = fresh.withColumn(BATCH, F.lit(batch)).hint("rebalance", BUCKET).observe(seen, F.count("*").alias("n"))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(OF, BUCKET, BATCH).parquet(self.path)
        return seen.get.get("n", 0)

    def compacted(self, spark: SparkSession, path: str, buckets: int | None = None) -> KeyedTable:
        """The table written anew at `path` with one batch, and other buckets if asked for; readers of the old one aren't disturbed."""
        after = KeyedTable(path, self.keys, buckets or self._of(spark) or self.buckets)
        after.placed(self.read(spark)).withColumn(BATCH, F.lit("b0")).hint("rebalance", BUCKET).write.partitionBy(OF, BUCKET, BATCH).parquet(path)
        return after


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a stream's batch: the same whenever it is run again, and of no other stream, nor of one whose checkpoint was lost."""
    own = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
    return f"s{own.replace('-', '')}_{batch_id}"
