"""Scalar functions on text: keys, numbers, times, file names. All are Column to Column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Polish letters and what they fold to.
POLISH, FOLDED = "ąćęłńóśżź", "acelnoszz"
NBSP = " "


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """regexp_extract with null in place of '' for no match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def row_fingerprint(fields: Sequence[Column]) -> Column:
    """SHA-256 of the trimmed fields joined by the unit separator; null counts as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.trim(f.cast("string")), F.lit("")) for f in fields]), 256)


def array_fingerprint(fields: Column) -> Column:
    """The same of an array of fields."""
    return F.sha2(F.array_join(F.transform(fields, lambda x: F.coalesce(F.trim(x), F.lit(""))), "\u001f"), 256)


def json_key(**fields: Column) -> Column:
    """SHA-1 of the compact JSON object of the fields."""
    return F.sha1(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}))


def joined_key(fields: Sequence[Column]) -> Column:
    return F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def parse_time(c: Column) -> Column:
    """Timestamp of a log time: ISO with T or space and optional zone, or day-month-year in the usual spellings; else null.

    Two-digit years above 68 are of the last century.
    """
    t = F.trim(c)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), t.try_cast("timestamp"))
    # The other accepted formats.
    formats = [
        "d.M.yyyy H:mm:ss", "d.M.yyyy H:mm", "d.M.yyyy", "d-M-yyyy H:mm:ss", "d-M-yyyy H:mm",
        "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm",
    ]
    short = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("d-M-yy, H:mm:ss", "d-M-yy, H:mm")])
    short = F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{2}, "), F.when(F.year(short) > 2068, short - F.expr("interval 100 years")).otherwise(short))
    shape = t.rlike(r"^\d{1,4}[./-]\d{1,2}[./-]\d{1,4}( \d{1,2}:\d{2}(:\d{2})?)?$")
    return F.coalesce(iso, F.when(shape, F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])), short)


def at_zone(c: Column) -> Column:
    """Whether a log time says its zone."""
    return F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}[ T].*(Z|[+-]\d{2}:?\d{2})$")


def parse_epoch(c: Column) -> Column:
    """Timestamp of epoch seconds, or milliseconds above 10**10, or of any spelling that parse_time knows."""
    number = F.when(F.trim(c).rlike(r"^\d{1,15}$"), F.trim(c).try_cast("long"))
    return F.coalesce(F.timestamp_seconds(F.when(number > 10**10, F.floor(number / 1000)).otherwise(number)), parse_time(c))


def lenient_int(c: Column) -> Column:
    """Whole number of a text with blanks or a decimal point; anything else is 0."""
    plain = F.regexp_replace(c, f"[ {NBSP}]", "").try_cast("double")
    return F.coalesce(F.when(F.abs(plain) < 9e18, F.floor(F.abs(plain)) * F.signum(plain)).cast("long"), F.lit(0).cast("long"))


def fuzzy_key(c: Column) -> Column:
    """Lower case, one blank between words, Polish letters folded."""
    return F.translate(F.lower(F.trim(F.regexp_replace(c, rf"[\s{NBSP}]+", " "))), POLISH, FOLDED)


def compact_key(c: Column) -> Column:
    """fuzzy_key without blanks and the signs _ - / : . ,"""
    return F.regexp_replace(F.translate(F.lower(F.trim(c)), POLISH, FOLDED), rf"[\s{NBSP}_\-/:.,]+", "")


def email_key(c: Column) -> Column:
    return F.lower(F.trim(F.translate(c, NBSP, " ")))


def percent(c: Column) -> Column:
    """Share of a text with %, no-break blank or decimal comma; above 1 it counts as per cent; else null."""
    x = F.regexp_replace(F.regexp_replace(c, rf"[\s%{NBSP}]", ""), ",", ".").try_cast("double")
    return F.when(x > 1, x / 100).otherwise(x)


def file_name(c: Column, longest: int = 120, mark: str = "_") -> Column:
    """File name without illegal signs, doubled blanks or outer dots."""
    clean = F.regexp_replace(F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', mark), r"\s+", " ")
    return F.substring(F.regexp_replace(clean, r"^[ .]+|[ .]+$", ""), 1, longest)


def report_file(name: Column, number: Column) -> Column:
    part = lambda c, default: file_name(F.coalesce(blank_to_null(c), F.lit(default)))
    return F.concat(part(name, "UNKNOWN"), F.lit("_"), part(number, "BRAK_BAZUS"), F.lit(".xlsx"))


def first_present(*cs: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cs])


def any_value_contains(payload: Column, part: str) -> Column:
    """Whether some value of the map holds `part`, in any case; an empty part never does."""
    wanted = part.strip().lower()
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(F.map_values(payload), lambda v: F.coalesce(F.lower(v).contains(wanted), F.lit(False))), F.lit(False))


def count_mode(c: Column) -> Column:
    return F.upper(F.trim(c))


def truthy(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)).isin("TAK", "1", "TRUE", "YES"), F.lit(False))


# Names of columns are matched on the driver.


def header_key(name: str) -> str:
    """A header in lower case without byte order mark, quotes and outer blanks, with blanks and dashes as _."""
    return re.sub(r"[\s\-]+", "_", name.replace("﻿", "").strip().strip("\"'").strip().lower())


def compact_header(name: str) -> str:
    return re.sub(rf"[\s{NBSP}_\-/:.,]+", "", name.replace("﻿", "").lower().translate(str.maketrans(POLISH, FOLDED)))


def safe_column(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def pick_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate among the columns, exactly, then by header_key, then by compact_header."""
    for key in (str, header_key, compact_header):
        named = {key(c): c for c in reversed(columns)}
        for candidate in candidates:
            if key(candidate) in named:
                return named[key(candidate)]
    return None


def require_columns(columns: Sequence[str], wanted: Sequence[str]) -> dict[str, str]:
    """Each wanted name's column; raises ValueError naming those that are missing."""
    found = {w: pick_column(columns, [w]) for w in wanted}
    if missing := [w for w, c in found.items() if c is None]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return found
