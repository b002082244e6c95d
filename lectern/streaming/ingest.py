"""Incremental ingest of log and snapshot files as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.state import refresh_state
from lectern.operators.tables import kept
from lectern.sources.keyed_table import KeyedTable, batch_name
from lectern.sources.logs import as_events, first_records, keyed_rows, log_files, log_rows, records, snapshot_rows
from lectern.sources.sinks import append_absent

FILE = "path string, modificationTime timestamp, length long, content binary"


def _new_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)


def _named(batch: DataFrame) -> DataFrame:
    return batch.withColumn("name", F.element_at(F.split("path", "/"), -1))


def stream_logs(
    spark: SparkSession, root: str, table: str, checkpoint: str, buckets: int | None = None, log_timezone: str | None = None, after: Callable[[int], None] | None = None
) -> StreamingQuery:
    """Append the records of log files not seen yet to the Parquet table `table` (schemas.RAW_EVENT), each record once.

    A batch keeps the first of equal records and appends those that the table lacks, so a replayed batch adds
    nothing. Stops when all files that are there have been taken. With `buckets` the table is a KeyedTable: a batch reads the keys of its
    own buckets only, and writes folders named after the stream and the batch, so that a batch that failed in the middle of its
    write, or after it and before the checkpoint, replaces what it left when it comes again. `after` is called with the
    number of rows that a batch added. Without `log_timezone` only keys are worked out for all records, and times, course numbers
    and the like for those that are appended.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        events = lambda: first_records(log_rows(_named(batch), F.current_timestamp(), log_timezone))
        if buckets is None:
            n = append_absent(events(), table, ["row_key"], ["source_file", "course"])
        elif log_timezone:  # a time depends on its file's other rows
            n = KeyedTable(table, ("row_key",), buckets).append_absent(events(), ["source_file", "course"], batch_name(spark, checkpoint, batch_id))
        else:
            rows, finish = keyed_rows(records(log_files(_named(batch)), ("name", "course"))), lambda new: as_events(new, F.current_timestamp()).drop("line_no")
            n = KeyedTable(table, ("row_key",), buckets).append_absent(rows, ["source_file", "line_no", "course"], batch_name(spark, checkpoint, batch_id), finish)
        if after:
            after(n)

    return _new_files(spark, root, "*.csv").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_snapshots(
    spark: SparkSession, root: str, table: str, checkpoint: str, read: Callable[[DataFrame], DataFrame], recompute: Callable[[DataFrame], None], buckets: int | None = None
) -> StreamingQuery:
    """Append new snapshot rows (by row_key) to `table`, then call `recompute` with the courses that the batch touched.

    `read` turns a batch of files (path, name, modificationTime, content) into snapshot rows. With `buckets` the table is a
    KeyedTable, see `stream_logs`. A batch that comes again recomputes its courses again.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = kept(read(_named(batch)), "snapshot-rows")
        if buckets is None:
            append_absent(rows, table, ["row_key"], ["source_file"])
        else:
            KeyedTable(table, ("row_key",), buckets).append_absent(rows, ["source_file"], batch_name(spark, checkpoint, batch_id))
        recompute(rows.select("course_code").distinct())

    return _new_files(spark, root, "*.csv").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_state(spark: SparkSession, root: str, table: str, events: Callable[[], DataFrame], state: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keep the state of activities up to date with new snapshot files: of each batch only the buckets of its courses are computed again.

    events: gives the canonical events as they are then.
    """

    def recompute(courses: DataFrame) -> None:
        refresh_state(KeyedTable(table, ("row_key",)).read(spark), events(), courses, state, buckets)

    return stream_snapshots(spark, root, table, checkpoint, snapshot_rows, recompute, buckets)
