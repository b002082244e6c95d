"""Counts per teacher, course and activity key, their shares at four levels, and quality findings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from lectern.functions.text import safe_column
from lectern.operators.contract import Field, check
from lectern.operators.filters import STUDENT_DOMAIN, visible
from lectern.operators.tables import kept

GROUP = ["ay", "term", "teacher_id", "course_code", "tech_key"]
LEVELS = {"pct_course": ["course_code"], "pct_kierunek": ["kierunek_code"], "pct_wydzial": ["wydzial_code"], "pct_uczelnia": []}
#: Columns of the metrics that reports read.
METRICS = [
    *[Field(c, "string") for c in ("ay", "term", "teacher_id", "full_name", "email", "wydzial", "jednostka", "id_bazus", "course_code", "tech_key", "activity_label")],
    *[Field(c, "bigint") for c in ("count_value", "deleted_count", "hidden_count", "unknown_count")], *[Field(c, "double") for c in LEVELS], Field("confidence_flag", "boolean"),
]


@dataclass(frozen=True)
class StatsOptions:
    ay: str | None = None
    term: str | None = None
    decimals: int = 4
    student_domain: str = STUDENT_DOMAIN


def mode_count(mode: str = "count_mode", item: str = "object_id") -> Column:
    """Distinct items if the group's greatest mode is object-based, else rows."""
    return F.when(F.max(mode) == "object-based", F.countDistinct(item)).otherwise(F.count("*"))


def mixed_mode(mode: str = "count_mode") -> Column:
    return F.coalesce(F.min(mode) != F.max(mode), F.lit(False))


def level_sums(counts: DataFrame, value: str, within: Sequence[str], levels: dict[str, Sequence[str]]) -> tuple[DataFrame, dict[str, int]]:
    """The sums of all levels in one table (all keys, _sum, _level), and each level's mark in it.

    One aggregate by grouping sets: each task adds up its rows for every level first, so one shuffle of sums serves all levels.
    """
    keys = list(dict.fromkeys([*within, *[c for columns in levels.values() for c in columns]]))
    left_out = lambda columns: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in (*within, *columns))
    marks = {name: left_out(columns) for name, columns in levels.items()}
    sets = {marks[name]: [F.col(k) for k in keys if k in (*within, *columns)] for name, columns in levels.items()}  # levels of equal columns are one
    sums = counts.groupingSets(list(sets.values()), *[F.col(k) for k in keys]).agg(F.sum(value).alias("_sum"), F.grouping_id(*keys).alias("_level"))
    return sums, marks


def shares(counts: DataFrame, value: str, within: Sequence[str], levels: dict[str, Sequence[str]], decimals: int | None = 4) -> DataFrame:
    """Add each level's share of the count in the sum over the rows of equal `within` and level columns.

    Sums come from the already small counts by one aggregate (`level_sums`), are written, and each level's are joined back, so a level
    with one value is no window in a single task.
    """
    sums, marks = level_sums(counts, value, within, levels)
    sums, out = kept(sums, "level-sums"), counts
    for name, columns in levels.items():
        keys = list(dict.fromkeys([*columns, *within]))
        own = sums.filter(F.col("_level") == marks[name]).select(*[F.col(k).alias(f"_{k}") for k in keys], "_sum")
        out = out.join(own, [out[k].eqNullSafe(own[f"_{k}"]) for k in keys]).withColumn(name, F.col(value) / F.nullif(F.col("_sum"), F.lit(0))).drop("_sum", *[f"_{k}" for k in keys])
        if decimals is not None:
            out = out.withColumn(name, F.round(name, decimals))
    return out


def invalidate(events: DataFrame) -> DataFrame:
    """Add counted: TAK, unless the same course, teacher, key and object also has TAK_FLAG; without object TAK alone decides.

    A null among course, teacher and key leaves TAK valid.
    """
    keys = ["course_code", "teacher_id", "tech_key", "object_id"]
    flags = events.groupBy(*keys).agg(
        (F.max(F.when(F.col("count_mode") == "TAK", 1)).isNotNull() & F.max(F.when(F.col("count_mode") == "TAK_FLAG", 1)).isNotNull()).alias("_void")
    )
    void = F.coalesce(F.col("_void"), F.lit(False))
    return events.join(flags, keys, "left").withColumn("counted", F.coalesce(F.col("count_mode") == "TAK", F.lit(False)) & ~void).drop("_void").select(*events.columns, "counted")


def enrich(events: DataFrame, state: DataFrame, emails: DataFrame, people: DataFrame, options: StatsOptions = StatsOptions()) -> DataFrame:
    """Countable events of the period with activity state, e-mail and person; flags for what is missing.

    state: course_code, activity_id, status_final, confidence_deleted; emails: teacher_id, email; people: email, full_name,
    wydzial, jednostka, id_bazus. Ids compare as text; of several e-mails of an id the smallest counts.
    """
    wanted = F.col("counted") | (F.col("count_mode") == "object-based")
    if options.ay is not None:
        wanted = wanted & (F.col("ay") == options.ay) & (F.col("term") == options.term)
    own = state.select("course_code", F.col("activity_id").cast("string").alias("_object"), "status_final", "confidence_deleted", F.lit(True).alias("_known"))
    one = emails.groupBy(F.col("teacher_id").cast("string").alias("teacher_id")).agg(F.min("email").alias("email"))
    hr = people.select("email", "full_name", F.col("wydzial").alias("hr_wydzial"), F.col("jednostka").alias("hr_jednostka"), "id_bazus", F.lit(True).alias("_hr"))
    e = events.filter(wanted).withColumn("_object", F.col("object_id").cast("string")).withColumn("teacher_id", F.col("teacher_id").cast("string"))
    student = F.coalesce(F.lower("email").contains(options.student_domain.lower()), F.lit(False))
    return (
        e.join(own, ["course_code", "_object"], "left").join(one, "teacher_id", "left").join(hr, "email", "left")
        .withColumns({
            "missing_state": F.col("_known").isNull(), "is_student": student, "missing_email": F.col("email").isNull(),
            "missing_hr": F.col("email").isNotNull() & F.col("_hr").isNull(),
        }).drop("_known", "_hr", "_object")
    )


def findings(enriched: DataFrame) -> DataFrame:
    """(ay, term, qa_type, teacher_id, course_code, tech_key, object_id, details), several for one event, in one pass."""
    finding = lambda holds, kind, details: F.when(holds, F.struct(F.lit(kind).alias("qa_type"), details.alias("details")))
    email = F.concat(F.lit("email="), F.coalesce("email", F.lit("")))
    student = F.col("is_student")
    found = F.array_compact(F.array(
        finding(student, "STUDENT_IGNORED", email),
        finding(~student & F.col("missing_email"), "MISSING_EMAIL_MAPPING", F.lit("teacher_id has no email mapping")),
        finding(~student & F.col("missing_hr"), "MISSING_HR_MAPPING", email),
        finding(F.col("missing_state"), "EVENT_WITHOUT_ACTIVITY_STATE", F.lit("no activities_state row for object_id")),
        finding(F.col("confidence_deleted") < 1, "CONFIDENCE_LT_1", F.concat(F.lit("confidence_deleted="), F.col("confidence_deleted").cast("string"))),
    ))
    return enriched.select("ay", "term", F.explode(found).alias("f"), "teacher_id", "course_code", "tech_key", F.col("object_id").cast("string").alias("object_id")).select(
        "ay", "term", "f.qa_type", "teacher_id", "course_code", "tech_key", "object_id", "f.details"
    )


def status_counters(eligible: DataFrame) -> DataFrame:
    """Per GROUP: deleted, hidden and unknown events, and whether some deletion is less than sure."""
    status = F.col("status_final")
    return eligible.groupBy(*GROUP).agg(
        F.count_if(status.isin("deleted", "visible_deleted")).alias("deleted_count"),
        F.count_if(status == "hidden").alias("hidden_count"),
        F.count_if(status.isNull() | (status == "unknown")).alias("unknown_count"),
        F.bool_or(F.coalesce(F.col("confidence_deleted") < 1, F.lit(False))).alias("confidence_flag"),
    )


def compute_stats(
    events: DataFrame, state: DataFrame, emails: DataFrame, people: DataFrame, options: StatsOptions = StatsOptions()
) -> tuple[DataFrame, DataFrame]:
    """(metrics_long, metrics_qa) of the period, or of all periods if none is named.

    state also has type. Counts are of visible events of eligible teachers (no students, with e-mail); they are written
    to the shared folder, since each level's sums and the rows themselves read them.
    """
    state = kept(state.select("course_code", "activity_id", "type", "status_final", "confidence_deleted"), "stats-state")  # read for each event and for chapters
    enriched = kept(enrich(events, state, emails, people, options), "stats-enriched")  # read for counts, counters and findings
    eligible = enriched.filter(~F.col("is_student") & ~F.col("missing_email"))
    counts = visible(eligible, state).groupBy(*GROUP, "wydzial_code", "kierunek_code").agg(
        F.min("activity_label").alias("activity_label"), mode_count().alias("count_value"), mixed_mode().alias("mixed"),
        *[F.min(c).alias(c) for c in ("full_name", "email", "hr_wydzial", "hr_jednostka", "id_bazus")],
    )
    counts = kept(counts, "stats-counts")  # small, and read once for every level
    shared = shares(counts, "count_value", ["ay", "term", "tech_key"], LEVELS, options.decimals)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    text = lambda c, name: F.coalesce(F.col(c), F.lit("")).alias(name)
    long = shared.join(status_counters(eligible), GROUP, "left").select(
        "ay", "term", "teacher_id", text("full_name", "full_name"), text("email", "email"), text("hr_wydzial", "wydzial"),
        text("hr_jednostka", "jednostka"), text("id_bazus", "id_bazus"), "course_code", "tech_key", "activity_label", "count_value",
        *LEVELS, zero("deleted_count"), zero("hidden_count"), zero("unknown_count"), F.coalesce("confidence_flag", F.lit(False)).alias("confidence_flag"),
    )
    check(long, METRICS)
    mixed = counts.filter("mixed").select(
        "ay", "term", F.lit("MIXED_COUNT_MODE").alias("qa_type"), "teacher_id", "course_code", "tech_key",
        F.lit(None).cast("string").alias("object_id"), F.lit("min!=max count_mode in group").alias("details"),
    )
    return long, findings(enriched).union(mixed)


def widen(long: DataFrame, keys: Sequence[str] | None = None, measures: Sequence[str] = ("count_value", *LEVELS), group: Sequence[str] = ("ay", "term", "teacher_id", "course_code")) -> DataFrame:
    """One row per group, for each activity key the columns count_<KEY>, pct_course_<KEY> and so on.

    Without `keys` they are read from the rows, one small distinct; raises if two make one column name.
    """
    if keys is None:
        keys = [r[0] for r in long.select("tech_key").filter("tech_key is not null").distinct().orderBy("tech_key").collect()]
    named = {k: safe_column(k) for k in keys}
    if len(set(named.values())) < len(named):
        raise ValueError("two activity keys make one column name")
    cells = [
        F.max(F.when(F.col("tech_key") == k, F.col(m))).alias(f"{'count' if m == 'count_value' else m}_{c}") for k, c in named.items() for m in measures
    ]
    return long.groupBy(*group).agg(*cells) if cells else long.select(*group).distinct()
