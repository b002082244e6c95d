"""Frames of the summary report, the per-person packs and the course grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from lectern.functions.text import blank_to_null, fuzzy_key, report_file
from lectern.operators.contract import Field, check, project

REPORT_ORDER = ["full_name", "course_code", "tech_key"]
#: Shares as the sheets have them, and as the metrics do.
SHARES = [
    Field("pct_course", "double", needed=False),
    Field("pct_program", "double", ("pct_program", "pct_kierunek"), needed=False),
    Field("pct_faculty", "double", ("pct_faculty", "pct_wydzial"), needed=False),
    Field("pct_university", "double", ("pct_university", "pct_uczelnia"), needed=False),
]
PERCENTS = [f.name for f in SHARES]
COURSE, ACTIVITY = ("course_name", "course_code"), ("activity_label", "tech_key")
#: What a pack takes from the metrics.
PACK = [Field("teacher_id", "string"), Field("course_name", "string", COURSE), Field("activity_label", "string", ACTIVITY), Field("count_value", "bigint"), *SHARES]
# Labels of person fields, and of further staff fields.
PERSON_LABELS = {"ID": "teacher_id", "Imię i nazwisko": "full_name", "E-mail": "email", "ID bazus": "id_bazus", "Wydział": "hr_wydzial", "Jednostka": "hr_jednostka"}
STAFF_LABELS = {"hr_katedra": "Katedra", "hr_zaklad": "Zakład", "hr_stanowisko": "Stanowisko", "hr_tytul": "Tytuł / Stopień", "hr_umowa": "Rodzaj umowy"}
#: Names without hr_ that a staff field goes by in the metrics.
STAFF_NAMES = {"hr_wydzial": "wydzial", "hr_jednostka": "jednostka"}


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def report_columns(long: DataFrame, label: Sequence[str] = ACTIVITY, course: Sequence[str] = COURSE) -> DataFrame:
    """The summary's columns by their names in the metrics or in the sheet, and all hr_ columns; shares that aren't there are null.

    Raises ContractError, before any job, if the table has no column for one of the others.
    """
    fields = [
        Field("full_name", "string"), Field("teacher_id", "string"), Field("course", "string", tuple(course)), Field("activity", "string", tuple(label)),
        Field("tech_key", "string", ("tech_key", *label)), Field("course_code", "string", ("course_code", *course)), Field("count_value", "bigint"), *SHARES,
    ]
    return long.select(*project(long, fields), *[c for c in long.columns if c.lower().startswith("hr_")])


def shown(long: DataFrame, zero_counts: bool = False) -> DataFrame:
    """Rows of the summary: those with visible_active, where there is such a column, and without zero counts unless asked for."""
    check(long, [Field("count_value", "bigint")])
    rows = long.filter(F.coalesce(F.col("visible_active").cast("string").try_cast("boolean"), F.lit(False))) if "visible_active" in long.columns else long
    return rows if zero_counts else rows.filter(F.col("count_value").try_cast("bigint") != 0)


def active(long: DataFrame, zero_counts: bool = False) -> DataFrame:
    """Rows that are active by visible_active, else by confidence_flag (bool, or text that may also be visible_active), else all; zero counts go unless asked for."""
    if "visible_active" in long.columns:
        keep = F.coalesce(F.col("visible_active").cast("string").try_cast("boolean"), F.lit(False))
    elif "confidence_flag" in long.columns:
        flag = F.col("confidence_flag").cast("string")
        keep = F.coalesce(flag.try_cast("boolean"), F.lit(False)) | F.coalesce(F.lower(F.trim(flag)) == "visible_active", F.lit(False))
    else:
        keep = F.lit(True)
    return long.filter(keep if zero_counts else keep & (F.col("count_value") > 0))


def sheet_split(rows: DataFrame, order: Sequence[str], max_rows: int) -> DataFrame:
    """Add row_no and sheet_no (from 1): consecutive pieces of `max_rows` rows in report order.

    Rows are written, since the bounds of ranges are found by reading them once more, range-partitioned and sorted; a small count per partition gives each its offset, so that the
    global number needs no single-task window. Equal order values should be broken by the caller's last column.
    """
    from lectern.operators.tables import kept

    rows = kept(rows, "sheet-input")
    sorted_ = rows.repartitionByRange(*nulls_last(order)).sortWithinPartitions(*nulls_last(order))
    placed = kept(sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "sheet-rows")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    offsets = sizes.select("_part", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("row_no", F.col("_before") + F.col("_at") - F.col("_from") + 1)
    return numbered.withColumn("sheet_no", (F.floor((F.col("row_no") - 1) / max_rows) + 1).cast("long")).drop("_part", "_at", "_from", "_before")


class TooManyRows(ValueError):
    """The report has more rows than one sheet takes."""


def overflow(rows: DataFrame, order: Sequence[str], max_rows: int, policy: str, whole: DataFrame | None = None) -> DataFrame:
    """What the main sheet holds under `policy`: error (raises), split (sheets) or skip (one row per teacher and activity, of `whole` if given)."""
    if policy == "split":
        return sheet_split(rows, order, max_rows)
    if rows.limit(max_rows + 1).count() <= max_rows:
        return rows
    if policy == "error":
        raise TooManyRows(f"more than {max_rows} rows")
    return collapse(rows if whole is None else whole)


def collapse(rows: DataFrame) -> DataFrame:
    """One row per teacher and activity: counts summed, course and percentages null."""
    return rows.groupBy("full_name", "teacher_id", "activity").agg(F.sum("count_value").alias("count_value")).select(
        "full_name", "teacher_id", F.lit(None).cast("string").alias("course"), "activity", "count_value",
        *[F.lit(None).cast("double").alias(p) for p in PERCENTS],
    )


def info(rows: DataFrame, ay: str, term: str, generated: str) -> DataFrame:
    """(key, value) of the INFO sheet."""
    counts = rows.agg(F.count("*").alias("rows"), F.countDistinct("teacher_id").alias("teachers"), F.countDistinct("course_code").alias("courses"))
    pairs = {"ay": F.lit(ay), "term": F.lit(term), "generated_at": F.lit(generated)} | {c: F.col(c).cast("string") for c in ("rows", "teachers", "courses")}
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs.items()])).alias("p")).select("p.*")


def qa_rows(qa: DataFrame) -> DataFrame:
    """Findings as the QA sheet has them, by the producer's or the sheet's own column names, in order."""
    name = lambda a, b: F.col(a if a in qa.columns else b)
    out = qa.select(name("type", "qa_type").alias("type"), "teacher_id", "course_code", "tech_key", name("description", "details").alias("description"))
    return out.orderBy(*nulls_last(["type", "teacher_id", "course_code", "tech_key"]))


def person_record(rows: DataFrame, key: str = "teacher_id", fields: Sequence[str] | None = None) -> DataFrame:
    """One row per person: the greatest non-blank value of each field.

    By default name, e-mail, number and all hr_ columns; faculty and unit also where they go by their names without hr_.
    """
    own = {c: c for c in fields or [c for c in rows.columns if c in ("full_name", "email", "id_bazus") or c.startswith("hr_")]}
    if fields is None:
        own |= {hr: name for hr, name in STAFF_NAMES.items() if hr not in rows.columns and name in rows.columns}
    return rows.groupBy(key).agg(*[F.max(blank_to_null(F.col(c))).alias(name) for name, c in own.items()])


def person_pairs(people: DataFrame, labels: dict[str, str] = PERSON_LABELS) -> DataFrame:
    """(teacher_id, position, label, value): a person's record as lines; further hr_ columns last, by their label or their name."""
    here = {k: v for k, v in labels.items() if v in people.columns}
    here |= {STAFF_LABELS.get(c, c): c for c in people.columns if c.startswith("hr_") and c not in here.values()}
    lines = [F.struct(F.lit(i).alias("position"), F.lit(k).alias("label"), F.col(v).cast("string").alias("value")) for i, (k, v) in enumerate(here.items(), 1)]
    return people.select("teacher_id", F.explode(F.array(*lines)).alias("l")).select("teacher_id", "l.*")


def pack_status(teachers: DataFrame, rows: DataFrame) -> DataFrame:
    """(teacher_id, report_file, n_rows, status) of each teacher's pack.

    teachers: teacher_id, full_name, email, id_bazus. SKIPPED_NO_ID without number, SKIPPED_NO_EMAIL without
    e-mail, SKIPPED_NO_DATA without active rows, else OK.
    """
    n = rows.groupBy("teacher_id").agg(F.count("*").alias("n_rows"))
    status = (
        F.when(blank_to_null(F.col("id_bazus")).isNull(), "SKIPPED_NO_ID").when(blank_to_null(F.col("email")).isNull(), "SKIPPED_NO_EMAIL")
        .when(F.coalesce("n_rows", F.lit(0)) == 0, "SKIPPED_NO_DATA").otherwise("OK")
    )
    return teachers.join(n, "teacher_id", "left").select(
        "teacher_id", report_file(F.col("full_name"), F.col("id_bazus")).alias("report_file"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status")
    )


def pack_rows(rows: DataFrame) -> DataFrame:
    """Rows of the packs (PACK) with `problem`: what of the row can't be put into a pack, else null. Nothing is raised for a single row."""
    text = lambda f: F.col(f"`{f.source(rows.columns)}`").cast("string")
    problems = []
    for f in PACK[3:]:
        if (source := f.source(rows.columns)) is not None:
            value = F.col(f"`{source}`").try_cast(f.kind)
            wrong = value.isNull() & text(f).isNotNull()
            if f.kind == "double":
                wrong = wrong | F.isnan(value) | (value < 0) | (value > 1)
            problems.append(F.when(wrong, F.concat(F.lit(f"{f.name} is no {'share' if f.kind == 'double' else 'whole number'}: "), text(f))))
    return rows.select(*project(rows, PACK, lenient=True), F.coalesce(*problems).alias("problem"))


def pack_results(teachers: DataFrame, rows: DataFrame, needs_number: bool = True) -> DataFrame:
    """(teacher_id, report_file, n_rows, status, message) of each teacher's pack; one that can't be made is ERROR, the others come out.

    teachers: teacher_id, full_name, email, id_bazus; rows: see `pack_rows`. SKIPPED_NO_ID without teacher, or without number
    if that is needed, SKIPPED_NO_EMAIL without e-mail, SKIPPED_NO_DATA without rows. ERROR if a row can't be read, or if several
    packs would have the same file, which only one of them could keep.
    """
    own = rows.groupBy("teacher_id").agg(F.count("*").alias("n_rows"), F.min("problem").alias("problem"))
    blank = lambda c: blank_to_null(F.col(c)).isNull()
    no_id = blank("teacher_id") | (blank("id_bazus") if needs_number else F.lit(False))
    status = (
        F.when(no_id, "SKIPPED_NO_ID").when(blank("email"), "SKIPPED_NO_EMAIL").when(F.col("n_rows").isNull(), "SKIPPED_NO_DATA")
        .when(F.col("problem").isNotNull(), "ERROR").otherwise("OK")
    )
    file = report_file(F.col("full_name"), F.col("id_bazus")).alias("report_file")
    found = teachers.withColumn("teacher_id", F.col("teacher_id").cast("string")).join(own, "teacher_id", "left")
    found = found.select("teacher_id", file, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status"), "problem")
    shared = found.filter("status in ('OK', 'ERROR')").groupBy("report_file").agg(F.count("*").alias("_packs")).filter("_packs > 1")
    clash = F.col("_packs").isNotNull() & F.col("status").isin("OK", "ERROR")
    message = (
        F.when(F.col("problem").isNotNull() & (F.col("status") == "ERROR"), F.col("problem")).when(clash, F.concat(F.col("_packs").cast("string"), F.lit(" packs have this file")))
        .when(F.col("status") == "SKIPPED_NO_ID", "no id").when(F.col("status") == "SKIPPED_NO_EMAIL", "no e-mail").when(F.col("status") == "SKIPPED_NO_DATA", "no rows with a count")
    )
    return found.join(shared, "report_file", "left").select(
        "teacher_id", "report_file", "n_rows", F.when(clash, "ERROR").otherwise(F.col("status")).alias("status"), message.alias("message")
    )


def checked_against(status: DataFrame, written: DataFrame) -> DataFrame:
    """`status` with n_written, the rows that `written` (report_file) holds; a pack that isn't there whole is ERROR."""
    there = written.groupBy(F.col("report_file").cast("string").alias("report_file")).agg(F.count("*").alias("_there"))
    n = F.when(F.col("status") == "OK", F.coalesce("_there", F.lit(0))).otherwise(0)
    short = (F.col("status") == "OK") & (n != F.col("n_rows"))
    message = F.when(short, F.concat(n.cast("string"), F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" rows are written"))).otherwise(F.col("message"))
    return status.join(there, "report_file", "left").select(
        "teacher_id", "report_file", "n_rows", n.alias("n_written"), F.when(short, "ERROR").otherwise(F.col("status")).alias("status"), message.alias("message")
    )


def status_counts(status: DataFrame) -> DataFrame:
    """(status, n, n_rows): how many entities came to what, and their rows."""
    return status.groupBy("status").agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"))


def course_blocks(rows: DataFrame, entity: str, course: str, position: str, most: int = 16) -> DataFrame:
    """(entity, course, block_no): an entity's courses in order of first appearance, the first `most` of them."""
    firsts = rows.groupBy(entity, course).agg(F.min(position).alias("_first"))
    number = F.row_number().over(W.partitionBy(entity).orderBy("_first", course))
    return firsts.withColumn("block_no", number).filter(F.col("block_no") <= most).drop("_first")


def grid(rows: DataFrame, labels: Sequence[str], entity: str, course: str, label: str, values: Sequence[str], position: str, most: int = 16) -> DataFrame:
    """(entity, block_no, course, label_no, label, values): every label in every course block, null where there is none.

    Labels meet rows by fuzzy key; of several rows of one cell the last in position counts.
    """
    cells = rows.withColumn("_key", fuzzy_key(F.col(label))).groupBy(entity, course, "_key").agg(
        *[F.max_by(v, position).alias(v) for v in values]
    )
    lines = F.posexplode(F.array(*[F.lit(x) for x in labels]))
    blank = course_blocks(rows, entity, course, position, most).select(entity, course, "block_no", lines.alias("label_no", "label"))
    filled = blank.withColumn("_key", fuzzy_key(F.col("label"))).join(cells, [entity, course, "_key"], "left")
    return filled.select(entity, "block_no", course, (F.col("label_no") + 1).alias("label_no"), "label", *values)
