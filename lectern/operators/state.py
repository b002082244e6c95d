"""Life cycle of course activities, from events and periodic snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

KEY = ["course_code", "activity_id"]
META = ["ay", "term", "wydzial_code", "kierunek_code", "track_code", "semester_code"]


@dataclass(frozen=True)
class StateOptions:
    grace_days: int = 14
    least_missing: int = 2
    policy: str = "first_missing"  # or last_seen
    delete_operations: Sequence[str] = ("DELETE",)


def universe(snapshots: DataFrame, events: DataFrame) -> DataFrame:
    """Every activity that a snapshot or an event names."""
    named = events.filter("object_id is not null").select("course_code", F.col("object_id").cast("string").alias("activity_id"))
    return snapshots.select(*KEY).union(named).distinct()


def _course_snapshots(snapshots: DataFrame) -> DataFrame:
    """(course_code, last_seen, missing_count, first_missing_at, last_course_at): of each snapshot of a course what came after it."""
    course = W.partitionBy("course_code")
    ordered = course.orderBy("captured_at")
    return snapshots.select("course_code", "captured_at").distinct().select(
        "course_code",
        F.col("captured_at").alias("last_seen"),
        (F.count("*").over(course) - F.row_number().over(ordered)).alias("missing_count"),
        F.lead("captured_at").over(ordered).alias("first_missing_at"),
        F.max("captured_at").over(course).alias("last_course_at"),
    )


def _is_lost(options: StateOptions) -> Column:
    return (F.col("missing_count") >= options.least_missing) & (F.col("last_course_at") >= F.col("first_missing_at") + F.make_dt_interval(F.lit(options.grace_days)))


def _lost_at(options: StateOptions, last_seen: str) -> Column:
    return F.col("first_missing_at") if options.policy == "first_missing" else F.col(last_seen)


def disappearances(snapshots: DataFrame, options: StateOptions = StateOptions()) -> DataFrame:
    """(KEY, deleted_at_snap, first_missing_at, last_course_at, missing_count) of activities that later snapshots lack.

    An activity's last sighting is itself a snapshot of its course, so with the course's snapshots numbered, what
    it misses is their number less the rank of that one, and the first missing is the next: one
    equi-join in place of pairing every activity with all later snapshots.
    """
    seen = snapshots.groupBy(*KEY).agg(F.max("captured_at").alias("last_seen"))
    lost = seen.join(_course_snapshots(snapshots), ["course_code", "last_seen"]).filter(_is_lost(options))
    return lost.select(*KEY, _lost_at(options, "last_seen").alias("deleted_at_snap"), "first_missing_at", "last_course_at", "missing_count")


def activities_state(snapshots: DataFrame, events: DataFrame, options: StateOptions = StateOptions()) -> DataFrame:
    """One row per activity: when it was seen, whether and on what evidence it was deleted, and its final status.

    Snapshots and events are each aggregated once by activity, and meet in one join that needs no further shuffle; the course's
    snapshots and its codes are small tables joined to that.
    """
    named = events.filter("object_id is not null").withColumn("activity_id", F.col("object_id").cast("string"))
    gone = F.upper("operation").isin(*[o.upper() for o in options.delete_operations])
    at = lambda holds: F.when(holds, F.col("ts_utc"))
    of_events = named.groupBy(*KEY).agg(
        F.min(at(F.col("counted"))).alias("first_evt"), F.max(at(F.col("counted"))).alias("last_event_at"), F.min(at(F.col("counted") & gone)).alias("deleted_at_log")
    )
    # The latest row, ties by the smallest row_key; a row without time or key comes after those that have one.
    last_first = F.struct(F.coalesce(-F.unix_micros(F.col("captured_at").cast("timestamp")), F.lit(2**63 - 1)), F.col("row_key").isNull(), "row_key")
    of_snapshots = snapshots.groupBy(*KEY).agg(
        F.min_by(F.struct("type", F.col("name").alias("name_last"), F.col("visible_to_students").alias("visible_last")), last_first).alias("_last"),
        F.min("captured_at").alias("first_snap"), F.max("captured_at").alias("last_snapshot_at"),
    )
    meta = events.groupBy("course_code").agg(*[F.min(c).alias(c) for c in META])
    seen = _course_snapshots(snapshots).filter(_is_lost(options)).withColumnRenamed("last_seen", "last_snapshot_at")
    log, snap = F.col("deleted_at_log"), F.col("deleted_at_snap")
    by = lambda both, one, other, none: F.when(log.isNotNull() & snap.isNotNull(), both).when(log.isNotNull(), one).when(snap.isNotNull(), other).otherwise(none)
    full = (
        of_snapshots.join(of_events, KEY, "full")
        .join(seen, ["course_code", "last_snapshot_at"], "left")
        .join(meta, "course_code", "left")
        .withColumn("deleted_at_snap", F.when(F.col("missing_count").isNotNull(), _lost_at(options, "last_snapshot_at")))
        .withColumn("deleted_at", F.least(log, snap))
        .select("*", "_last.*")
    )
    status = (
        F.when(F.col("deleted_at").isNotNull(), "visible_deleted").when(F.col("visible_last"), "visible_active")
        .when(~F.col("visible_last"), "hidden").otherwise("unknown")
    )
    return full.select(
        "course_code", *META, "activity_id", "type", "name_last",
        F.least("first_snap", "first_evt").alias("first_seen_at"), F.greatest("last_snapshot_at", "last_event_at").alias("last_seen_at"),
        "last_snapshot_at", "last_event_at", "visible_last", "deleted_at_log", "deleted_at_snap", "deleted_at",
        status.alias("status_final"),
        by("both", "log_delete_event", "snapshot_disappearance", "none").alias("evidence_deleted"),
        by(0.95, 0.80, 0.70, 0.0).alias("confidence_deleted"),
    )


#: Column that course tables are dealt by.
COURSE_BUCKET = "course_bucket"


def with_course_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` with the bucket of their course; tables written by it are read in part where only some courses matter."""
    return rows.withColumn(COURSE_BUCKET, F.pmod(F.xxhash64(F.col("course_code").cast("string")), F.lit(buckets)).cast("int"))


def refresh_state(
    snapshots: DataFrame, events: DataFrame, touched: DataFrame, path: str, buckets: int = 64, options: StateOptions = StateOptions()
) -> list[int]:
    """Bring the state table at `path` up to date after a batch that touched some courses (course_code); the buckets written.

    What activities_state says of a course comes from the course's own snapshots and events, so the buckets of these courses are computed
    again from all of their rows and overwritten, and all other folders stay as they are. Snapshots and events that are
    partitioned by course_bucket, with the same number of buckets, are read in these folders only. A table is always refreshed with
    the same number of buckets.
    """
    hit = sorted(r[0] for r in with_course_bucket(touched.select("course_code"), buckets).select(COURSE_BUCKET).distinct().collect())  # `buckets` at most
    if not hit:
        return []

    def of_hit(rows: DataFrame) -> DataFrame:
        placed = rows if COURSE_BUCKET in rows.columns else with_course_bucket(rows, buckets)
        return placed.filter(F.col(COURSE_BUCKET).isin(*hit)).drop(COURSE_BUCKET)

    state = with_course_bucket(activities_state(of_hit(snapshots), of_hit(events), options), buckets)
    state.hint("rebalance", COURSE_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(COURSE_BUCKET).parquet(path)
    return hit


def state_findings(state: DataFrame, snapshots: DataFrame, events: DataFrame) -> DataFrame:
    """(qa_id, qa_type, course_code, activity_id, details): deleted in the log but seen visible later; never named by an event."""
    late = state.filter("deleted_at_log < last_snapshot_at and visible_last").select(
        F.lit("conflict_log_delete_but_visible_in_snapshot").alias("qa_type"), *KEY,
        F.to_json(F.struct(F.col("deleted_at_log").cast("string").alias("deleted_at_log"), F.col("last_snapshot_at").cast("string").alias("last_snapshot_at"))).alias("details"),
    )
    named = events.filter("object_id is not null").select("course_code", F.col("object_id").cast("string").alias("activity_id")).distinct()
    unmapped = snapshots.select(*KEY).distinct().join(named, KEY, "left_anti").select(
        F.lit("activity_without_object_id_mapping").alias("qa_type"), *KEY, F.lit("{}").alias("details")
    )
    found = late.union(unmapped)
    return found.select(F.sha2(F.concat_ws("\u001f", "qa_type", *KEY, "details"), 256).alias("qa_id"), *found.columns)
