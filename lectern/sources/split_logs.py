"""Large log files read by many tasks: lines of regular files are records, whatever each file's encoding, delimiter and header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from lectern.operators.tables import kept
from lectern.sources import logs

SEPARATORS = ("\t", ";", ",")


def lines(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path, at, raw): the lines of all files below `root` as bytes; `at` rises with a line's place in its file.

    Files are split at line ends, so one is read by as many tasks as it has blocks. at: the block's start, and
    in it the line's number, which is less than the block's bytes.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    own = text.select(
        _plain(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))).alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.col("value").cast("binary").alias("raw"), number.alias("_number")
    )
    return own.select("path", F.struct(F.col("_start").alias("start"), F.col("_number").alias("number")).alias("at"), "raw")


def _blank(raw: Column) -> Column:
    return F.trim(F.translate(raw.cast("string"), "\t", " ")) == ""


def _regular(text: Column, sep: str) -> Column:
    """Whether quotes stand around whole fields only, doubled inside: such a line is a record by itself."""
    field = rf'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{sep}]*+)'
    return ~text.contains('"') | text.rlike(rf"^{field}(?:{sep}{field})*+$")


def _text(raw: Column) -> Column:
    return F.when(F.col("utf8"), raw.cast("string")).otherwise(F.decode(raw, "windows-1250"))


def file_traits(found: DataFrame) -> DataFrame:
    """(path, utf8, sep, header, head_at, regular): how each file of `lines` is to be read; regular is false for one that only a reader of whole files can.

    Encoding and delimiter as `logs.decoded` and `logs.delimiter` have them, header the fields of the first line that has one that isn't
    empty. Passes over the lines, in which a file's lines are tested where they are and never gathered, but for its first 20.
    """
    utf8 = found.groupBy("path").agg(F.bool_and(F.is_valid_utf8(F.col("raw").cast("string"))).alias("utf8"))
    first = found.filter(~_blank(F.col("raw"))).withColumn("_n", F.row_number().over(W.partitionBy("path").orderBy("at"))).filter("_n <= 20")  # limited before the shuffle too
    tops = first.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("tops"))
    known = utf8.join(tops, "path").withColumn("texts", F.transform("tops", lambda t: _text(t["raw"])))
    known = known.withColumn("sep", logs.delimiter(F.array_join("texts", "\n")))
    named = F.transform("texts", lambda t, i: F.struct(_fields(t).alias("header"), i.alias("place")))
    known = known.withColumn("top", F.get(F.filter(named, lambda h: F.exists(h["header"], lambda x: x != "")), F.lit(0)))
    known = kept(known.select("path", "utf8", "sep", F.col("top.header").alias("header"), F.get("tops", F.col("top.place"))["at"].alias("head_at")), "file-traits")
    fits = F.lit(True)
    for sep in SEPARATORS:
        fits = F.when(F.col("sep") == sep, _regular(F.col("_text"), sep)).otherwise(fits)
    ok = found.join(known, "path").withColumn("_text", _text(F.col("raw"))).groupBy("path").agg(F.bool_and(fits).alias("_fits"))
    return known.join(ok, "path").withColumn("regular", F.col("_fits") & F.col("header").isNotNull()).drop("_fits")


def _fields(text: Column) -> Column:
    """The trimmed fields of a regular line."""
    out = None
    for sep in SEPARATORS:
        quoted = F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(rf'{sep}("[^"]*+(?:""[^"]*+)*+"|[^"{sep}]*+)'), F.lit(1))
        bare = F.transform(quoted, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
        own = F.when(text.contains('"'), bare).otherwise(F.split(text, sep, -1))
        out = own if out is None else F.when(F.col("sep") == sep, own).otherwise(out)
    return F.transform(out, lambda x: F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]++|[\s\x1c-\x1f]++$", ""))


def split_records(found: DataFrame, traits: DataFrame) -> DataFrame:
    """(path, line_no, fields, payload) of the regular files, as `logs.records` gives them; line_no rises in a file without being the line's number.

    Each line is decoded, split and put under its file's header where it was read; headers come by a join on the path.
    """
    own = found.filter(~_blank(F.col("raw"))).join(traits.filter("regular"), "path").filter(F.col("at") > F.col("head_at"))
    parsed = own.select("path", (F.col("at.start") + F.col("at.number")).alias("line_no"), "header", _fields(_text(F.col("raw"))).alias("found"))
    parsed = parsed.filter(F.exists("found", lambda x: x != ""))
    missing = F.array_repeat(F.lit(""), F.greatest(F.size("header") - F.size("found"), F.lit(0)))
    return logs.with_payload(parsed.select("path", "line_no", "header", F.concat("found", missing).alias("fields")))


def log_rows(spark: SparkSession, root: str, inserted_at: Column, log_timezone: str | None = None) -> DataFrame:
    """Raw events (schemas.RAW_EVENT, with line_no) of all log files below `root`, each record as `logs.log_rows` has it.

    Regular files are split over tasks, however large they are; only files with line ends inside quotes or quotes inside
    fields are read whole, each by one task.
    """
    found = lines(spark, root).filter(_name(F.col("path")).rlike(logs.LOG_FILE))
    traits = kept(file_traits(found), "file-traits")
    rows, odd = split_records(found, traits), traits.filter("not regular").select("path")
    if odd.limit(1).count():
        whole = logs.files(spark, root).withColumn("path", _plain(F.col("path")))
        rows = rows.unionByName(logs.records(whole.join(odd, "path", "left_semi")))
    return logs.raw_rows(logs.log_files(rows.withColumn("name", _name(F.col("path")))), inserted_at, log_timezone)


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
