"""Course names: context strings, file names, class types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import extract

# Class type codes and their names.
CLASS_TYPES = {
    "WY": "Wykład",
    "SE": "Seminarium",
    "CA": "Ćwiczenia audytoryjne",
    "CN": "Ćwiczenia kierunkowe",
    "CS": "Ćwiczenia w warunkach symulowanych",
    "CL": "Ćwiczenia laboratoryjne",
    "CK": "Ćwiczenia kliniczne",
    "PP": "Zajęcia praktyczne przy pacjencie",
    "CM": "Ćwiczenia specjalistyczne",
    "LE": "Lektorat",
    "EL": "E-learning",
    "WF": "Wychowanie fizyczne",
    "PZ": "Praktyka zawodowa",
    "SK": "Samokształcenie kierowane",
}
# The forms of a course in the logs' context, of a course in a file's name (the tracks by name), and of its beginning.
CONTEXT = r"(?id)kurs:\s*([A-Z0-9]{1,3}/[A-Z0-9]{1,6}/[A-Z0-9_]+/(\d+sem)-(.+?)-(\d{4}/\d{2})([zl]))"
FILE = r"^([A-Z]{2,4}[A-Za-z0-9\-]{1,8}?)(st[12j]|ns[12j]|nst|st|ns)(\d+sem)-(.+?)-(\d{4})(\d{2})(l|z)$"
PREFIX = r"^([A-Z]{2,3})([A-Za-z]{2}(?:-[A-Z]{2})?)$"
FIELDS = ["course_code", "wydzial_code", "kierunek_code", "track_code", "semester_code", "course_name", "ay", "term"]


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a column that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def expand_class_type(name: Column) -> Column:
    """Replace the first known class type code between dashes, or at the end after a dash, by its name."""

    def expanded(n: Column) -> Column:
        out = n
        for code, full in reversed(list(CLASS_TYPES.items())):
            inner = F.when(n.contains(f"-{code}-"), F.replace(n, F.lit(f"-{code}-"), F.lit(f"-{full}-")))
            last = F.when(n.endswith(f"-{code}"), F.concat(F.substring(n, F.lit(1), F.length(n) - len(code)), F.lit(full)))
            out = F.coalesce(inner, last, out)
        return out

    return _once(name, expanded)


def parse_context(text: Column) -> Column:
    """Struct of FIELDS from the first `Kurs: W/K/T/5sem-Name-2025/26z` anywhere in the text, the name as short as it can be; null if there is none."""
    code = extract(text, CONTEXT, 1)
    part = F.split(code, "/")
    return F.when(
        code.isNotNull(),
        F.struct(
            F.trim(code).alias("course_code"),
            F.get(part, F.lit(0)).alias("wydzial_code"),
            F.get(part, F.lit(1)).alias("kierunek_code"),
            F.get(part, F.lit(2)).alias("track_code"),
            extract(text, CONTEXT, 2).alias("semester_code"),
            F.trim(extract(text, CONTEXT, 3)).alias("course_name"),
            extract(text, CONTEXT, 4).alias("ay"),
            F.lower(extract(text, CONTEXT, 5)).alias("term"),
        ),
    )


def code_from_file(course: Column) -> Column:
    """Course code of a compact file name such as WFAnstj5sem-Name-WY-202526z, else null."""

    def code(found: Column) -> Column:
        prefix, track, semester, name, year, next_year, term = (F.get(found, F.lit(i)) for i in range(7))
        tail = F.concat_ws("-", semester, expand_class_type(name), F.concat(year, F.lit("/"), next_year, term))
        parts = _once(F.array(*[F.regexp_extract(prefix, PREFIX, i) for i in (1, 2)]), lambda p: F.when(F.get(p, F.lit(0)) != "", F.concat_ws("/", F.get(p, F.lit(0)), F.get(p, F.lit(1)), track, tail)))
        return F.when(prefix != "", parts)

    return _once(F.array(*[F.regexp_extract(course, FILE, i) for i in range(1, 8)]), code)


def parse_code(code: Column) -> Column:
    """Struct of FIELDS from a course code W/K/T/5sem-Name-2025/26z."""

    def fields(code: Column) -> Column:
        part = F.split(code, "/")
        rest = F.coalesce(extract(code, r"^[^/]*/[^/]*/[^/]*/(.*)$"), F.lit(""))
        semester = F.split_part(rest, F.lit("-"), F.lit(1))
        return F.when(
            code.isNotNull(),
            F.struct(
                code.alias("course_code"),
                F.get(part, F.lit(0)).alias("wydzial_code"),
                F.get(part, F.lit(1)).alias("kierunek_code"),
                F.get(part, F.lit(2)).alias("track_code"),
                semester.alias("semester_code"),
                F.trim(F.regexp_replace(F.regexp_replace(rest, r"^[^-]*-?", ""), r"-\d{4}/\d{2}[zl]$", "")).alias("course_name"),
                F.coalesce(extract(code, r"(\d{4}/\d{2})[zl]$"), F.lit("")).alias("ay"),
                F.coalesce(extract(code, r"\d{4}/\d{2}([zl])$"), F.lit("")).alias("term"),
            ),
        )

    return _once(code, fields)


def parse_context_by(text: Column, course_rx: str, period_rx: str) -> Column:
    """Struct (course, period) by two configured patterns with one group each."""
    return F.struct(extract(text, course_rx).alias("course"), extract(text, period_rx).alias("period"))


# Fields that name a course by number, and the spellings of the number in order of choice.
ID_FIELDS = ("Opis", "Description", "Event description", "Nazwa zdarzenia", "Kontekst zdarzenia")
ID_SPELLINGS = (r"course with id\s+'(\d+)'", r"course with id\s+(\d+)", r"\bcourse id\b\s*[:=]?\s*(\d+)", r"\bid kursu\b\s*[:=]?\s*(\d+)")


def course_id(payload: Column) -> Column:
    """Course number in the fields that usually name it; in all values only where these are all empty."""
    usual = F.concat_ws("\n", *[F.nullif(F.try_element_at(payload, F.lit(f)), F.lit("")) for f in ID_FIELDS])
    text = F.when(usual != "", usual).otherwise(F.concat_ws("|", F.map_values(payload)))
    return F.coalesce(*[extract(text, "(?i)" + spelling) for spelling in ID_SPELLINGS])
