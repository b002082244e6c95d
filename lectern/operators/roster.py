"""Course rosters and the merge of id and e-mail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import blank_to_null, email_key, joined_key, lenient_int, pick_column
from lectern.operators.keyed import lookup_last, upsert

# Roster columns and their headers.
TEXTS = {"course_id": ("ID kursu", "course_id"), "course_name": ("Nazwa kursu", "course_name")}
COUNTS = {
    "users": ("Użytkownicy",),
    "students": ("Studenci",),
    "teachers": ("Nauczyciele",),
    "teachers_no_edit": ("Nauczyciele bez praw edycji",),
    "teachers_responsible": ("Nauczyciele odpowiedzialny", "Nauczyciele odpowiedzialni"),
    "students_enrolled": ("Studenci zapisani",),
    "students_done": ("Studenci po ukończeniu",),
    "students_in_progress": ("Studenci w trakcie",),
    "students_before_start": ("Studenci przed rozpocząciem", "Studenci przed rozpoczęciem"),
}


def read_roster(raw: DataFrame, loaded_at: str, strict: bool = False) -> DataFrame:
    """Roster rows of a sheet of text columns; unreadable numbers are 0, rows without course id go.

    A sheet without course id is an error. Numbers of other columns that it lacks are 0; if `strict`, these are an error too.
    """
    found = {n: pick_column(raw.columns, list(h)) for n, h in (TEXTS | COUNTS).items()}
    if missing := [n for n, c in found.items() if c is None and (n == "course_id" or strict)]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    col = lambda n: F.col(f"`{c}`") if (c := found[n]) else F.lit(None).cast("string")
    rows = raw.select(*[blank_to_null(col(n)).alias(n) for n in TEXTS], *[lenient_int(col(n)).alias(n) for n in COUNTS])
    key = joined_key([F.col(c) for c in ("course_id", "course_name", "students_enrolled", "teachers")])
    return rows.filter("course_id is not null").withColumns({"row_key": key, "loaded_at": F.lit(loaded_at).cast("timestamp")})


def import_roster(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ["course_id"], "loaded_at", ["row_key"])


def course_facts(roster: DataFrame, courses: DataFrame, active_rows: DataFrame) -> DataFrame:
    """Roster with course code, names by number as text, and the number of teachers with a positive active count.

    courses: course_id, course_code; active_rows: course_code, teacher_id, count_value.
    """
    named = courses.select(F.col("course_id").cast("string").alias("_id"), "course_code")
    teachers = active_rows.filter("count_value > 0").groupBy("course_code").agg(F.countDistinct("teacher_id").alias("active_teachers"))
    return (
        roster.join(named, F.col("course_id").cast("string") == F.col("_id"), "left").drop("_id")
        .join(teachers, "course_code", "left").withColumn("active_teachers", F.coalesce("active_teachers", F.lit(0)))
    )


def merge_ids(people: DataFrame, ids: DataFrame, people_email: str, ids_email: str, id_column: str, position: str) -> tuple[DataFrame, DataFrame]:
    """(people with the id first, one row with the number unmatched): ids by e-mail key, the last duplicate wins."""
    left = people.withColumn("_key", email_key(F.col(people_email)))
    right = ids.select(email_key(F.col(ids_email)).alias("_key"), id_column, position)
    merged = lookup_last(left, right, "_key", id_column, position).drop("_key")
    return merged, merged.agg(F.count_if(F.col(id_column).isNull()).alias("unmatched"))
