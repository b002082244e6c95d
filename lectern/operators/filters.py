"""Predicates of the event pipeline, and the count of what each of them rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import any_value_contains, blank_to_null

# The keys that a source stands under, and what student addresses hold.
SOURCE_KEYS = ("Źródło", "Zrodlo", "Source")
STUDENT_DOMAIN = "@student."


def source_of(payload: Column) -> Column:
    return F.coalesce(*[blank_to_null(F.try_element_at(payload, F.lit(k))) for k in SOURCE_KEYS], F.lit(""))


def source_allowed(source: Column, allow: Sequence[str] = (), block: Sequence[str] = ()) -> Column:
    """Parts of the source in any case; the block list comes first, an empty allow list allows all."""
    low = F.lower(F.coalesce(source, F.lit("")))
    some = lambda parts: F.greatest(*[low.contains(p.lower()) for p in parts], F.lit(False)) if parts else F.lit(False)
    return ~some(block) & (some(allow) if allow else F.lit(True))


def is_student(payload: Column, domain: str = STUDENT_DOMAIN) -> Column:
    return any_value_contains(payload, domain)


def key_allowed(key: Column, allow: Sequence[str] = (), block: Sequence[str] = ()) -> Column:
    blocked = key.isin(*block) if block else F.lit(False)
    return F.coalesce(~blocked & (key.isin(*allow) if allow else F.lit(True)), F.lit(not allow))


def date_allowed(ts: Column, low: str | None = None, high: str | None = None) -> Column:
    """Both ends inclusive; an end that isn't a date doesn't count."""
    ends = [F.coalesce(ts >= F.lit(low).try_cast("timestamp"), F.lit(True)), F.coalesce(ts <= F.lit(high).try_cast("timestamp"), F.lit(True))]
    return ends[0] & ends[1]


def with_reject_reason(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add reject_reason: the name of the first check (name, must hold) that doesn't, null if all do."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(checks)):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def reject_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(F.count("*").alias("n"))


# Activity keys by what they need to be visible.
ALWAYS_VISIBLE = (
    "ASSIGNMENT_GRADED", "CHAT_MESSAGE", "CHOICE_CREATE", "DB_FIELD_CREATE", "DB_RECORD_CREATE", "FEEDBACK_CREATE",
    "FORUM_DISCUSSION_CREATE", "FORUM_DISCUSSION_DELETE", "FORUM_POST_CREATE", "FORUM_POST_DELETE",
    "GLOSSARY_ENTRY_CREATE", "H5P_CREATE", "QUESTION_CREATE", "WIKI_PAGE_CREATE",
)
VISIBLE_MODULES = (
    "FILE_RESOURCE_CREATE", "FILE_RESOURCE_DELETE", "FOLDER_UPDATED", "LABEL_CREATE", "LABEL_DELETE", "RESOURCE_PAGE_CREATE",
    "RESOURCE_PAGE_DELETE", "TEAMS_MEETING_CREATE", "TEAMS_MEETING_DELETE", "URL_CREATE", "URL_DELETE",
)
CHAPTERS = {"book": ("BOOK_CHAPTER_CREATE", "BOOK_CHAPTER_DELETE"), "lesson": ("LESSON_PAGE_CREATE", "LESSON_PAGE_DELETE")}


def visible(events: DataFrame, state: DataFrame) -> DataFrame:
    """Events (course_code, tech_key, status_final) that count as visible, given the state (course_code, type, status_final).

    Some keys always are; module keys need an active or unknown state; chapter keys an active book or lesson
    in their course.
    """
    key = F.col("tech_key")
    active = (
        state.filter(F.col("status_final") == "visible_active").groupBy("course_code")
        .agg(*[F.bool_or(F.col("type") == kind).alias(f"_has_{kind}") for kind in CHAPTERS])
    )
    shown = key.isin(*ALWAYS_VISIBLE) | (key.isin(*VISIBLE_MODULES) & F.col("status_final").isin("visible_active", "unknown"))
    for kind, keys in CHAPTERS.items():
        shown = shown | (key.isin(*keys) & F.col(f"_has_{kind}"))
    return events.join(active, "course_code", "left").filter(shown).select(*[events[c] for c in events.columns])
