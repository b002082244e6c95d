"""Log, snapshot and dimension files of any encoding, delimiter and header."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.course import course_id
from lectern.functions.text import at_zone, blank_to_null, extract, json_key, parse_time, pick_column, require_columns
from lectern.operators.keyed import one_per_key
from lectern.operators.zones import in_zone

#: Columns that a file of snapshots must have.
SNAPSHOT_COLUMNS = ("ID kursu", "ID aktywności")
LOG_FILE = r"(?i)^logs_(.+)_(\d{8}-\d{4})\.csv$"
# Headers of the time column in order of choice, and what other columns are called.
TIME_COLUMNS = ("czas", "time", "date", "timecreated")
TEACHER_ID, EMAIL = ("teacher_id", "id", "userid"), ("email", "mail", "e-mail")
HR = {
    "email": ("email", "mail", "e-mail", "adres e-mail"),
    "full_name": ("full_name", "imie_nazwisko", "name", "nazwiskoimie", "pełna nazwa", "imię i nazwisko", "nazwisko i imię"),
    "wydzial": ("wydzial", "wydział", "wydział jednostki zatrudnienia"),
    "jednostka": ("jednostka", "unit", "katedra", "jednostka podlegajaca rozliczeniu", "jednostka organizacyjna"),
    "id_bazus": ("id_bazus", "id bazus", "bazus"),
}
# What the names of input files have in them.
INPUT_KINDS = {
    "hr": r"(?i)(nauczyciel|teachers|hr|dane_do_raportu|pracowni)",
    "roster": r"(?i)(uczestni|roster|enrol|zapisani|lista_kurs)",
    "snapshot": r"(?i)(zawartosc|snapshot)",
}


def files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Files below `root`: path, name, modificationTime, length, content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return found.withColumn("name", F.element_at(F.split("path", "/"), -1))


def log_files(found: DataFrame) -> DataFrame:
    """Log files only, with course and export time of their names."""
    return found.withColumns({"course": extract(F.col("name"), LOG_FILE), "exported": extract(F.col("name"), LOG_FILE, 2)}).filter("course is not null")


def decoded(content: Column) -> Column:
    """Text of the whole content: UTF-8, without byte order mark, if valid, else windows-1250."""
    body = F.when(F.substring(content, 1, 3) == F.unhex(F.lit("EFBBBF")), F.substring(content, F.lit(4), F.greatest(F.length(content) - 3, F.lit(0)))).otherwise(content)
    return F.when(F.is_valid_utf8(body.cast("string")), body.cast("string")).otherwise(F.decode(body, "windows-1250"))


def file_results(found: DataFrame, needed: Sequence[str] = ()) -> DataFrame:
    """(path, name, length, problem) of each file: why it can't be read as a table with the columns `needed`, or null.

    A file with a zero byte is no text in an encoding of one byte; one without any line holds nothing.
    """
    text = decoded(F.col("content"))
    head = F.regexp_extract(text, r"^\s*+([^\r\n]++)", 1)
    fields = F.transform(F.split(head, delimiter(text)), lambda x: F.trim(F.translate(x, '"', "")))
    lacks = F.array_except(F.array(*[F.lit(c) for c in needed]), fields) if needed else F.array().cast("array<string>")
    problem = (
        F.when(F.contains("content", F.unhex(F.lit("00"))), "no text file").when(F.trim(head) == "", "no lines")
        .when(F.size(lacks) > 0, F.concat(F.lit("no column "), F.array_join(lacks, ", ")))
    )
    return found.select("path", "name", "length", problem.alias("problem"))


def delimiter(text: Column) -> Column:
    """The most frequent of tab, ; and , in the first 20 non-blank lines; ties in this order; ; if there is none."""
    lines = F.split(text, r"\r?\n(?:\x20*+\r?\n)*+", 22)  # blank lines go with the break before them; one may come first, and the last is the rest
    head = F.array_join(F.slice(F.filter(lines, lambda x: F.trim(x) != ""), 1, 20), "\n")
    n = {d: F.length(head) - F.length(F.replace(head, F.lit(d), F.lit(""))) for d in ("\t", ";", ",")}
    most = F.greatest(*n.values())
    return F.when(most == 0, ";").when(n["\t"] == most, "\t").when(n[";"] == most, ";").otherwise(",")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (path, text, sep, others) one row per record: path, line_no, fields, payload, others. Texts are decoded a few KB at a time, straight from the batch."""
    csv.field_size_limit(sys.maxsize)
    for batch in batches:
        own = [batch.column(k) for k in (0, *range(3, batch.num_columns))]
        names = ["path", "line_no", "fields", "payload", *batch.schema.names[3:]]
        for r, (text, sep) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
            header, no, fields, ends, values = None, [], [], [0], []
            lines = io.TextIOWrapper(pa.BufferReader(text.as_buffer() or pa.py_buffer(b"")), encoding="utf-8", newline="")

            def made():
                at = pa.array(range(0, len(values) + 1, len(keys)), pa.int32())
                payload = pa.MapArray.from_arrays(at, pa.array(keys * len(no), pa.string()), pa.array(values, pa.string()))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(fields, pa.string()))
                path, *others = [pa.repeat(c[r], len(no)) for c in own]  # noqa: B023
                return pa.RecordBatch.from_arrays([path, pa.array(no, pa.int64()), lists, payload, *others], names)

            for at, record in enumerate(csv.reader(lines, delimiter=sep)):
                record = [x.strip() for x in record]
                if not any(record):
                    continue
                if header is None:
                    header = [h or f"col_{i}" for i, h in enumerate(record, 1)]
                    last = sorted({h: i for i, h in enumerate(header)}.values())
                    keys = [header[i] for i in last]
                    continue
                if len(record) < len(header):
                    record += [""] * (len(header) - len(record))
                no.append(at)
                fields += record
                ends.append(len(fields))
                values += record[: len(header)] if len(last) == len(header) else [record[i] for i in last]
                if len(no) == 5000:
                    yield made()
                    no, fields, ends, values = [], [], [0], []
            if no:
                yield made()


def records(found: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(path, line_no, fields, payload, carry): the records of quoted, ragged delimited files, each by its own header.

    Fields are trimmed, blank records dropped, missing tail fields empty; the payload maps header to field, an
    empty header is col_<n>, and of equal headers the last counts. A quote that is never closed takes what is
    left of its file into one field, of whatever length. A file is read by one task, so
    files should be of a size that a task can hold. Each record also has the columns `carry` of its file.
    """
    text = found.withColumn("text", decoded(F.col("content"))).select("path", "text", delimiter(F.col("text")).alias("sep"), *carry)
    others = "".join(f", {c} {found.schema[c].dataType.simpleString()}" for c in carry)
    return text.mapInArrow(_rows, f"path string, line_no long, fields array<string>, payload map<string,string>{others}")


def with_payload(rows: DataFrame) -> DataFrame:
    """(path, line_no, fields, payload) of records with their header."""
    named = F.transform(F.col("header"), lambda h, i: F.when(h == "", F.concat(F.lit("col_"), (i + 1).cast("string"))).otherwise(h))
    pairs = F.arrays_zip(named.alias("k"), F.slice("fields", F.lit(1), F.size("header")).alias("v"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(named, i + 2, F.size("header")), lambda later: later == p["k"]))
    return rows.select("path", "line_no", "fields", F.map_from_entries(last).alias("payload"))


def time_text(payload: Column) -> Column:
    """The value of the first time column, whatever its case."""
    low = F.map_from_entries(F.array_distinct(F.transform(F.map_entries(payload), lambda e: F.struct(F.lower(e["key"]), e["value"]))))
    return F.coalesce(*[blank_to_null(F.try_element_at(low, F.lit(t))) for t in TIME_COLUMNS])


def log_rows(found: DataFrame, inserted_at: Column, log_timezone: str | None = None) -> DataFrame:
    """Every record of log files (path, name, content) as a raw event (schemas.RAW_EVENT), with line_no.

    Times count as UTC, or as wall clock times of `log_timezone` (see zones.in_zone).
    """
    return raw_rows(records(log_files(found), ("name", "course")), inserted_at, log_timezone)


def keyed_rows(rows: DataFrame) -> DataFrame:
    """Records (name, course, line_no, fields, payload) with their key: what tells equal ones apart and which of them is the first."""
    return rows.select("course", F.sha2(F.array_join("fields", "\u001f"), 256).alias("row_key"), "payload", F.col("name").alias("source_file"), "line_no")


def as_events(rows: DataFrame, inserted_at: Column) -> DataFrame:
    """Rows of `keyed_rows` as raw events (schemas.RAW_EVENT), with line_no; times count as UTC."""
    timed = rows.withColumn("time_text", time_text(F.col("payload")))
    return timed.select(
        "course", "time_text", parse_time(F.col("time_text")).alias("time_ts"), "row_key", "payload", "source_file", course_id(F.col("payload")).alias("course_id"),
        inserted_at.cast("timestamp").alias("inserted_at"), "line_no",
    )


def raw_rows(rows: DataFrame, inserted_at: Column, log_timezone: str | None = None) -> DataFrame:
    """Records (name, course, line_no, fields, payload) as raw events."""
    raw = as_events(keyed_rows(rows), inserted_at)
    if not log_timezone:
        return raw
    zoned = F.coalesce(at_zone(F.col("time_text")), F.lit(False))  # such a time is an instant as it stands
    split = raw.withColumn("_instant", F.when(zoned, F.col("time_ts"))).withColumn("time_ts", F.when(~zoned, F.col("time_ts")))
    local = in_zone(split, log_timezone, "time_ts", ["course", "source_file"], "line_no")
    return local.withColumn("time_ts", F.coalesce("_instant", "time_ts")).select(*raw.columns)


def first_records(rows: DataFrame, scope: str = "all") -> DataFrame:
    """Of equal records the first by file, line and course; scope "course": of each course."""
    return one_per_key(rows, ["row_key"] + (["course"] if scope == "course" else []), [F.col("source_file"), F.col("line_no"), F.col("course")]).drop("line_no")


def raw_events(spark: SparkSession, root: str, scope: str = "all", inserted_at: str = "1970-01-01", log_timezone: str | None = None) -> DataFrame:
    """Raw events of all log files below `root` (schemas.RAW_EVENT); a record counts once, in its first file by name.

    scope "course": once in each course.
    """
    return first_records(log_rows(files(spark, root), F.lit(inserted_at), log_timezone), scope)


def snapshot_rows(found: DataFrame) -> DataFrame:
    """Activity snapshots of files (path, name, modificationTime, content), see `read_snapshots`."""
    rows = records(found, ("name", "modificationTime"))
    field = lambda h: blank_to_null(F.try_element_at("payload", F.lit(h)))
    taken = F.coalesce(F.try_to_timestamp(extract(F.col("name"), r"(\d{8}-\d{4})"), F.lit("yyyyMMdd-HHmm")), F.col("modificationTime"))
    out = rows.select(
        field("ID kursu").alias("course_code"), field("ID aktywności").alias("activity_id"), field("Nazwa aktywności").alias("name"), field("Format aktywności").alias("type"),
        F.lit(True).alias("visible_to_students"), taken.alias("captured_at"), F.col("name").alias("source_file"),
    )
    out = out.filter("course_code is not null and activity_id is not null")
    return out.withColumn("row_key", json_key(**{c: F.col(c) for c in ("course_code", "activity_id", "name", "type", "captured_at")}))


def read_snapshots(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Activity snapshots below `root`: course, activity, name, type; taken at the time in the file name, else when it was changed.

    Rows without course or activity go; all activities count as visible.
    """
    return snapshot_rows(files(spark, root, glob))


def read_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A delimited text table with header; all columns are text."""
    return spark.read.csv(path, header=True, sep=sep, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def id_emails(raw: DataFrame) -> DataFrame:
    """(teacher_id, email) by header aliases: ids without .0, e-mails in lower case, distinct, blanks dropped."""
    i, e = pick_column(raw.columns, TEACHER_ID), pick_column(raw.columns, EMAIL)
    if not i or not e:
        raise ValueError("no id or e-mail column")
    pairs = raw.select(blank_to_null(F.regexp_replace(F.trim(F.col(f"`{i}`").cast("string")), r"\.0$", "")).alias("teacher_id"), blank_to_null(F.lower(F.trim(F.col(f"`{e}`")))).alias("email"))
    return pairs.filter("teacher_id is not null and email is not null").distinct()


def people(raw: DataFrame, position: str | None = None, columns: dict[str, str] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(email, full_name, wydzial, jednostka, id_bazus, carry): the first row of each e-mail.

    Columns by alias, or as `columns` names them (a missing one is an error then). `position` orders the rows;
    without it the first row is the smallest by its other columns, so that the outcome doesn't depend on partitions.
    """
    if columns:
        require_columns(raw.columns, list(columns.values()))
    chosen = {f: (columns or {}).get(f) or pick_column(raw.columns, a) for f, a in HR.items()}
    if not chosen["email"]:
        raise ValueError("no e-mail column")
    text = lambda c: blank_to_null(F.col(f"`{c}`").cast("string")) if c else F.lit(None).cast("string")
    rows = raw.select(*[(F.lower(text(c)) if f == "email" else text(c)).alias(f) for f, c in chosen.items()], *carry, (F.col(position) if position else F.lit(0)).alias("_position"))
    order = ["_position", *[c for c in rows.columns if c not in ("email", "_position")]]
    return one_per_key(rows.filter("email is not null"), ["email"], [F.col(f"`{c}`").asc_nulls_last() for c in order]).drop("_position")


def latest_inputs(found: DataFrame, kinds: dict[str, str] = INPUT_KINDS) -> DataFrame:
    """(kind, path): of each kind of input, told by its name, the file changed last."""
    kind = F.lit(None).cast("string")
    for k, pattern in reversed(list(kinds.items())):
        kind = F.when(F.col("name").rlike(pattern), k).otherwise(kind)
    return found.withColumn("kind", kind).filter("kind is not null").groupBy("kind").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
