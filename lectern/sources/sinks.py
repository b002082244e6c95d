"""Writes: course exports, partitioned tables, period replacement, report packs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.keyed import insert_absent
from lectern.operators.reports import ACTIVITY, COURSE


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def merge_parquet(frames: Mapping[str, DataFrame] | Sequence[DataFrame], path: str, dedup_per_file: bool = False) -> None:
    """All frames as one Parquet table, columns by name, missing ones null; equal rows of one frame once if asked.

    Frames that are given by the names of their files get these as _source_file.
    """
    named = [f.withColumn("_source_file", F.lit(n)) for n, f in frames.items()] if isinstance(frames, Mapping) else list(frames)
    if dedup_per_file:
        named = [f.dropDuplicates() for f in named]
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).write.mode("overwrite").parquet(path)


def _in_order(rows: DataFrame, *by: str | Column) -> DataFrame:
    """Rows dealt to tasks by ranges of `by` and sorted so in each; rows that are read twice, once for the bounds."""
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def export_courses(events: DataFrame, path: str, kind: str = "csv") -> None:
    """One folder per course, rows by time descending, those without time last; quoted text with ; for csv.

    A large course is dealt over several tasks by time, so its folder holds several files; their names sort as their rows do.
    """
    flat = events.withColumn("payload", F.to_json("payload")) if "payload" in events.columns and kind == "csv" else events
    ordered = _in_order(flat, "course", *[F.col(c).desc_nulls_last() for c in ("time_ts", "inserted_at")])
    writer = ordered.write.mode("overwrite").partitionBy("course")
    writer.option("sep", ";").option("header", "true").option("quoteAll", "true").csv(path) if kind == "csv" else writer.parquet(path)


def replace_periods(df: DataFrame, path: str, full: bool = False) -> None:
    """Replace the (ay, term) partitions that `df` holds, or all of the table if `full`."""
    mode = "static" if full else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("ay", "term").parquet(path)


def append_absent(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Append the rows of `new` whose key the table at `path` lacks; the number of them."""
    spark = new.sparkSession
    first = [F.col(o).asc_nulls_last() for o in order]
    old = spark.read.parquet(path) if _exists(spark, path) else spark.createDataFrame([], new.schema)
    fresh = insert_absent(new, old, keys, first).persist()
    try:
        n = fresh.count()
        if n:
            fresh.write.mode("append").parquet(path)
        return n
    finally:
        fresh.unpersist()


def replace_all(df: DataFrame, path: str) -> None:
    """Replace a table that `df` doesn't read, such as the state of activities."""
    df.write.mode("overwrite").parquet(path)


#: Columns of findings, by either of their names.
FINDING = {"qa_type": "type", "teacher_id": "teacher_id", "course_code": "course_code", "tech_key": "tech_key", "details": "description"}


def append_findings(findings: DataFrame, path: str) -> None:
    """Append findings as text columns by name, whichever of the two names a column has; raises if one is missing."""
    names = {n: next((c for c in (n, other) if c in findings.columns), None) for n, other in FINDING.items()}
    if missing := [n for n, c in names.items() if c is None]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    append(findings.select(*[F.col(c).cast("string").alias(n) for n, c in names.items()]), path)


def append(df: DataFrame, path: str) -> None:
    """Append rows; raises if the table at `path` has other columns."""
    spark = df.sparkSession
    if _exists(spark, path) and (there := spark.read.parquet(path).columns) != df.columns:
        raise ValueError(f"the table has columns {there}, the rows {df.columns}")
    df.write.mode("append").parquet(path)


def report_packs(rows: DataFrame, status: DataFrame, path: str) -> None:
    """One folder per report file of a teacher whose status is OK, rows by course and activity; a large one holds several files, whose names sort as their rows do."""
    ready = rows.join(status.filter("status = 'OK'").select("teacher_id", "report_file"), "teacher_id")
    first = lambda names: next(n for n in names if n in rows.columns)
    by = [first(COURSE), first(ACTIVITY)]
    _in_order(ready, "report_file", *by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("report_file").parquet(path)
