"""The composed steps from log files to metrics, each a call of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.functions.course import CONTEXT as CONTEXT_FORM
from lectern.functions.course import FIELDS, code_from_file, parse_code
from lectern.functions.text import at_zone, extract, parse_epoch, parse_time
from lectern.operators import filters, keyed, reports, rules, stats, zones
from lectern.operators.tables import kept
from lectern.sources import logs, sinks, split_logs
from lectern.sources.keyed_table import KeyedTable

# Payload keys of context, description and time.
CONTEXT, DESCRIPTION, TIMES = "Kontekst zdarzenia", "Opis", ("Czas", "Time", "Date")


@dataclass(frozen=True)
class ParseOptions:
    allow_sources: Sequence[str] = ()
    block_sources: Sequence[str] = ()
    student_domain: str = filters.STUDENT_DOMAIN
    date_from: str | None = None
    date_to: str | None = None
    allow_keys: Sequence[str] = ()
    block_keys: Sequence[str] = ()
    one_period: bool = True
    log_timezone: str | None = None


@dataclass(frozen=True)
class Parsed:
    events: DataFrame
    conflicts: DataFrame
    rejected: DataFrame = field(repr=False)


@dataclass(frozen=True)
class Merged:
    """What a merge of log files came to: OK, SKIPPED if there was no file, or ERROR if some couldn't be read; the others are merged.

    results: (path, name, length, problem) of each file.
    """

    status: str
    courses: int
    files: int
    records: int
    inserted: int
    failed: int = 0
    results: DataFrame | None = field(default=None, compare=False, repr=False)


@dataclass(frozen=True)
class Loaded:
    """What a load of snapshot files came to, and the latest time that one of its rows was taken at."""

    status: str
    files: int
    failed: int
    scanned: int
    inserted: int
    latest: datetime | None
    results: DataFrame | None = field(default=None, compare=False, repr=False)


def _readable(found: DataFrame, needed: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, int]:
    """The files that can be read, the results of all, and the number of those that can't."""
    results = kept(logs.file_results(found, needed), "file-results")
    failed = results.filter("problem is not null").count()
    return found.join(results.filter("problem is not null").select("path"), "path", "left_anti") if failed else found, results, failed


def _append(rows: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], buckets: int | None) -> int:
    return sinks.append_absent(rows, table, keys, order) if buckets is None else KeyedTable(table, tuple(keys), buckets).append_absent(rows, order)


def merge_logs(spark: SparkSession, root: str, table: str, export: str | None = None, scope: str = "all", buckets: int | None = None, log_timezone: str | None = None, split: bool = False) -> Merged:
    """Append the records of all log files below `root` that `table` lacks; export courses if asked.

    With `buckets` the table is a KeyedTable, of which a merge reads the keys of its own buckets only. Files that can't be
    read are listed in the results and left out. Records are counted as they are written, files and courses in the results.
    `split` is for folders with files of gigabytes: many tasks read each file (see split_logs), and files aren't tested beforehand.
    """
    found = logs.log_files(logs.files(spark, root))
    if split:
        results, failed = found.select("path", "name", "length", F.lit(None).cast("string").alias("problem")), 0
    else:
        readable, results, failed = _readable(found)
    courses, files = logs.log_files(results).agg(F.countDistinct("course"), F.count("*")).first()
    if not files:
        return Merged("SKIPPED", 0, 0, 0, 0)
    seen = Observation()
    rows = split_logs.log_rows(spark, root, F.current_timestamp(), log_timezone) if split else logs.log_rows(readable, F.current_timestamp(), log_timezone)
    rows = kept(rows.observe(seen, F.count("*").alias("n")), "log-rows")  # files are parsed once
    inserted = _append(logs.first_records(rows, scope), table, ["row_key"] + (["course"] if scope == "course" else []), ["source_file"], buckets)
    if export:
        sinks.export_courses(spark.read.parquet(table) if buckets is None else KeyedTable(table, ("row_key",)).read(spark), export)
    return Merged("ERROR" if failed else "OK", courses, files, seen.get.get("n", 0), inserted, failed, results)


def load_snapshots(spark: SparkSession, root: str, table: str, glob: str = "*.csv", buckets: int | None = None) -> Loaded:
    """Append the activity snapshots below `root` that `table` lacks by row_key; what was scanned is counted as it is written."""
    found = logs.files(spark, root, glob)
    readable, results, failed = _readable(found, logs.SNAPSHOT_COLUMNS)
    files = results.count()
    if not files:
        return Loaded("SKIPPED", 0, 0, 0, 0, None)
    seen = Observation()
    rows = kept(logs.snapshot_rows(readable).observe(seen, F.count("*").alias("n"), F.max("captured_at").alias("latest")), "snapshot-rows")
    inserted = _append(rows, table, ["row_key"], ["source_file"], buckets)
    return Loaded("ERROR" if failed else "OK", files, failed, seen.get.get("n", 0), inserted, seen.get.get("latest"), results)


def parse_events(raw: DataFrame, table: DataFrame, options: ParseOptions = ParseOptions(), existing: DataFrame | None = None) -> Parsed:
    """Canonical events of the raw ones that `existing` (row_key) lacks, rule conflicts, and the count of rejects by reason.

    Checks in order: source, student, time, date, context, rule, key. The course comes from the context, else from
    the smallest code that the course's other records have, else from the file's course. A winner NIE rejects.
    Raises MixedPeriods, before anything is written, if the events belong to more than one period. With log_timezone, times
    in the payload that say no zone are wall clock times of it; time_ts is an instant already.
    """
    new = raw if existing is None else keyed.only_new(raw, existing, ["row_key"])
    value = lambda k: F.try_element_at("payload", F.lit(k))
    own = extract(value(CONTEXT), CONTEXT_FORM)
    named = raw.select(F.col("course").alias("_course"), own.alias("_code")).groupBy("_course").agg(F.min("_code").alias("_code"))
    known = named.select("_course", F.coalesce("_code", code_from_file(F.col("_course"))).alias("_known"))
    texts = F.array(*[value(k) for k in TIMES], F.col("time_text"))
    zone = options.log_timezone
    wall = lambda x: F.when(F.trim(x).rlike(r"^\d+$") | at_zone(x), parse_epoch(x)).otherwise(zones.earlier(parse_time(x), zone))
    at = F.coalesce("time_ts", F.get(F.array_compact(F.transform(texts, wall if zone else parse_epoch)), F.lit(0)))
    rows = new.join(known, new["course"].eqNullSafe(F.col("_course")), "left").select(
        *new.columns, F.coalesce(F.trim(own), F.col("_known")).alias("_code"), at.alias("ts_utc"), value(DESCRIPTION).alias("_text")
    )
    matched = rules.match_rules(rows, table, "_text", keep_unmatched=True)
    checked = filters.with_reject_reason(
        matched,
        [
            ("source", filters.source_allowed(filters.source_of(F.col("payload")), options.allow_sources, options.block_sources)),
            ("student", ~filters.is_student(F.col("payload"), options.student_domain)),
            ("time", F.col("ts_utc").isNotNull()),
            ("date", filters.date_allowed(F.col("ts_utc"), options.date_from, options.date_to)),
            ("context", F.col("_code").isNotNull()),
            ("rule", F.col("rule_no").isNotNull() & (F.col("count_mode") != "NIE")),
            ("key", filters.key_allowed(F.col("tech_key"), options.allow_keys, options.block_keys)),
        ],
    )
    # Events, conflicts, rejects and the check of the period read one written pass of the rules.
    wanted = ["_code", "ts_utc", "teacher_id", "operation", "tech_key", "activity_label", "object_id", "count_mode", "rule_no", "priority", "n_best", "best_rules", "row_key", "source_file", "reject_reason"]
    checked = kept(checked.select(*wanted), "parse-checked")
    good = checked.filter("reject_reason is null").withColumn("_place", parse_code(F.col("_code")))
    events = good.select(
        *[F.col(f"_place.{f}").alias(f) for f in FIELDS], "ts_utc", F.col("teacher_id").cast("string").alias("teacher_id"), "operation", "tech_key", "activity_label",
        F.col("object_id").cast("string").alias("object_id"), "count_mode", "rule_no", "priority", "row_key", "source_file",
    )
    if options.one_period:
        keyed.require_one_period(events)
    return Parsed(events, rules.conflicts(good, ["row_key"]), filters.reject_counts(checked))


def finalize(new: DataFrame, existing: DataFrame | None = None, scope: str = "all") -> DataFrame:
    """New canonical events with counted; invalid pairs are looked for in all events, or with scope "batch" in the new ones."""
    columns = ["course_code", "teacher_id", "tech_key", "object_id", "count_mode"]
    if existing is None or scope == "batch":
        return stats.invalidate(new)
    both = new.withColumn("_new", F.lit(True)).unionByName(existing.select(*columns).withColumn("_new", F.lit(False)), allowMissingColumns=True)
    return stats.invalidate(both).filter("_new").drop("_new")


@dataclass(frozen=True)
class Summary:
    """The frames of the summary report's sheets."""

    main: DataFrame
    qa: DataFrame
    info: DataFrame


def summary_report(long: DataFrame, qa: DataFrame, ay: str, term: str, generated: str, max_rows: int = 1_000_000, policy: str = "error", zero_counts: bool = False) -> Summary:
    """Metrics in report order under the overflow policy (see reports.overflow), findings, and the counts of what is shown.

    Columns go by their names in the metrics or in the sheet; a table that lacks one is refused before any job.
    """
    shown = reports.report_columns(reports.shown(long, zero_counts))
    whole = reports.report_columns(reports.shown(long, True))
    main = reports.overflow(shown, [*reports.REPORT_ORDER, "teacher_id"], max_rows, policy, whole)
    ordered = [c for c in ("sheet_no", "row_no", *reports.REPORT_ORDER) if c in main.columns] or ["full_name"]
    return Summary(main.orderBy(*reports.nulls_last(ordered)), reports.qa_rows(qa), reports.info(shown, ay, term, generated))


@dataclass(frozen=True)
class Packs:
    """The frames of the individual reports: rows and persons by teacher, and each teacher's file and status."""

    rows: DataFrame
    persons: DataFrame
    status: DataFrame


def individual_packs(long: DataFrame, path: str | None = None, active: Column | None = None, needs_number: bool = True, status_path: str | None = None, zero_counts: bool = False) -> Packs:
    """One pack for each teacher: active rows with a count (all active rows if `zero_counts`), the person's record as lines, the status; rows are written to `path` if given.

    `active` says which rows are, in place of visible_active or confidence_flag. A teacher whose rows can't be read,
    or whose file another one has too, gets ERROR and no pack; all others come out. What is written is counted again, and
    the statuses (with n_written) are appended to `status_path` if that is given.
    """
    chosen = reports.active(long, zero_counts) if active is None else long.filter(active if zero_counts else active & (F.col("count_value") > 0))
    rows, persons = reports.pack_rows(chosen), reports.person_record(long)
    if path:
        rows = kept(rows, "pack-rows")  # read for the statuses and for the packs
    status = reports.pack_results(persons, rows, needs_number)
    if path:
        status = kept(status, "pack-status")
        sinks.report_packs(rows.drop("problem"), status, path)
        written = long.sparkSession.read.schema("course_name string, report_file string").parquet(path)
        status = kept(reports.checked_against(status, written), "pack-status")
        if status_path:
            sinks.append(status, status_path)
    return Packs(rows.filter("problem is null").drop("problem"), reports.person_pairs(persons), status)
