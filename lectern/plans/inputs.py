"""The pipeline's tables as derived from the driver's: by Spark, and the same as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events: user is teacher, 20 courses in 6 programmes of 3 faculties, props.k the object."""
    e, user = table(spark, sf_dir, "events"), F.col("user_id")
    course = user % 20
    text = lambda c: c.cast("string")
    keys = {"click": "RESOURCE_PAGE_CREATE", "error": "FORUM_POST_DELETE", "purchase": "BOOK_CHAPTER_CREATE", "signup": "URL_CREATE"}
    key = F.lit("QUESTION_CREATE")
    for kind, k in keys.items():
        key = F.when(F.col("event_type") == kind, k).otherwise(key)
    return e.select(
        F.concat(F.lit("C"), text(course)).alias("course_code"), F.lit("2023/24").alias("ay"),
        F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "z").otherwise("l").alias("term"),
        F.concat(F.lit("W"), text(course % 3)).alias("wydzial_code"), F.concat(F.lit("K"), text(course % 6)).alias("kierunek_code"),
        F.lit("st").alias("track_code"), F.lit("1sem").alias("semester_code"), F.col("ts").alias("ts_utc"), text(user).alias("teacher_id"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("CREATE").alias("operation"), key.alias("tech_key"), F.col("event_type").alias("activity_label"),
        F.nullif(F.get_json_object("props", "$.k"), F.lit("13")).alias("object_id"),
        F.when(user % 3 == 1, "object-based").when((user % 3 == 2) & (F.col("event_id") % 5 == 0), "TAK_FLAG").otherwise("TAK").alias("count_mode"),
        text(F.col("event_id")).alias("row_key"),
    )


CANONICAL = """
c0 AS (
  SELECT 'C' || (user_id % 20) AS course_code, '2023/24' AS ay, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'z' ELSE 'l' END AS term,
    'W' || (user_id % 20 % 3) AS wydzial_code, 'K' || (user_id % 20 % 6) AS kierunek_code, 'st' AS track_code, '1sem' AS semester_code,
    ts AS ts_utc, user_id::VARCHAR AS teacher_id, CASE event_type WHEN 'error' THEN 'DELETE' ELSE 'CREATE' END AS operation,
    CASE event_type WHEN 'click' THEN 'RESOURCE_PAGE_CREATE' WHEN 'error' THEN 'FORUM_POST_DELETE' WHEN 'purchase' THEN 'BOOK_CHAPTER_CREATE'
      WHEN 'signup' THEN 'URL_CREATE' ELSE 'QUESTION_CREATE' END AS tech_key,
    event_type AS activity_label, nullif(json_extract_string(props, '$.k'), '13') AS object_id,
    CASE WHEN user_id % 3 = 1 THEN 'object-based' WHEN user_id % 3 = 2 AND event_id % 5 = 0 THEN 'TAK_FLAG' ELSE 'TAK' END AS count_mode,
    event_id::VARCHAR AS row_key
  FROM events)"""
COUNTED = CANONICAL + """,
flags AS (
  SELECT course_code, teacher_id, tech_key, object_id FROM c0 GROUP BY ALL
  HAVING bool_or(count_mode = 'TAK') AND bool_or(count_mode = 'TAK_FLAG')),
ev AS (
  SELECT c0.*, CASE WHEN object_id IS NULL THEN count_mode = 'TAK' ELSE count_mode = 'TAK' AND NOT EXISTS (
    SELECT 1 FROM flags f WHERE f.course_code = c0.course_code AND f.teacher_id = c0.teacher_id AND f.tech_key = c0.tech_key AND f.object_id = c0.object_id) END AS counted
  FROM c0)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots: what a course's views of a day named was there that day."""
    e = table(spark, sf_dir, "events").filter("event_type = 'view'")
    k, day = F.get_json_object("props", "$.k"), F.date_trunc("day", F.col("ts"))
    kind = F.when(k.cast("int") % 5 == 0, "book").when(k.cast("int") % 5 == 1, "lesson").otherwise("page")
    rows = e.select(
        F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string")).alias("course_code"), k.alias("activity_id"), F.concat(F.lit("A"), k).alias("name"),
        kind.alias("type"), (k.cast("int") % 7 != 0).alias("visible_to_students"), day.alias("captured_at"),
    ).distinct()
    return rows.withColumn("row_key", F.concat_ws("|", "course_code", "activity_id"))


SNAPSHOTS = """
sn AS (
  SELECT DISTINCT 'C' || (user_id % 20) AS course_code, json_extract_string(props, '$.k') AS activity_id, 'A' || json_extract_string(props, '$.k') AS name,
    CASE json_extract_string(props, '$.k')::INT % 5 WHEN 0 THEN 'book' WHEN 1 THEN 'lesson' ELSE 'page' END AS type,
    json_extract_string(props, '$.k')::INT % 7 <> 0 AS visible_to_students, date_trunc('day', ts)::TIMESTAMP AS captured_at
  FROM events WHERE event_type = 'view')"""
STATE = COUNTED + "," + SNAPSHOTS + """,
u AS (SELECT course_code, activity_id FROM sn UNION SELECT course_code, object_id FROM ev WHERE object_id IS NOT NULL),
sl AS (SELECT * FROM sn QUALIFY row_number() OVER (PARTITION BY course_code, activity_id ORDER BY captured_at DESC) = 1),
sb AS (SELECT course_code, activity_id, min(captured_at) AS first_snap, max(captured_at) AS last_snap FROM sn GROUP BY 1, 2),
eb AS (SELECT course_code, object_id AS activity_id, min(ts_utc) AS first_evt, max(ts_utc) AS last_evt FROM ev WHERE counted AND object_id IS NOT NULL GROUP BY 1, 2),
dl AS (SELECT course_code, object_id AS activity_id, min(ts_utc) AS log_at FROM ev WHERE counted AND object_id IS NOT NULL AND operation = 'DELETE' GROUP BY 1, 2),
cs AS (SELECT DISTINCT course_code, captured_at FROM sn),
ds AS (
  SELECT sb.course_code, sb.activity_id, min(cs.captured_at) AS first_missing, max(cs.captured_at) AS last_course, count(*) AS missing_count
  FROM sb JOIN cs ON cs.course_code = sb.course_code AND cs.captured_at > sb.last_snap GROUP BY 1, 2
  HAVING count(*) >= 2 AND max(cs.captured_at) >= min(cs.captured_at) + INTERVAL 14 DAY),
st AS (
  SELECT u.course_code, u.activity_id, sl.type, sl.visible_to_students AS visible_last, least(sb.first_snap, eb.first_evt) AS first_seen_at,
    greatest(sb.last_snap, eb.last_evt) AS last_seen_at, sb.last_snap, dl.log_at, ds.first_missing AS snap_at, least(dl.log_at, ds.first_missing) AS deleted_at,
    CASE WHEN least(dl.log_at, ds.first_missing) IS NOT NULL THEN 'visible_deleted' WHEN sl.visible_to_students THEN 'visible_active'
      WHEN NOT sl.visible_to_students THEN 'hidden' ELSE 'unknown' END AS status_final,
    CASE WHEN dl.log_at IS NOT NULL AND ds.first_missing IS NOT NULL THEN 'both' WHEN dl.log_at IS NOT NULL THEN 'log_delete_event'
      WHEN ds.first_missing IS NOT NULL THEN 'snapshot_disappearance' ELSE 'none' END AS evidence_deleted,
    CASE WHEN dl.log_at IS NOT NULL AND ds.first_missing IS NOT NULL THEN 0.95::DOUBLE WHEN dl.log_at IS NOT NULL THEN 0.8::DOUBLE
      WHEN ds.first_missing IS NOT NULL THEN 0.7::DOUBLE ELSE 0::DOUBLE END AS confidence_deleted
  FROM u LEFT JOIN sl USING (course_code, activity_id) LEFT JOIN sb USING (course_code, activity_id) LEFT JOIN eb USING (course_code, activity_id)
  LEFT JOIN dl USING (course_code, activity_id) LEFT JOIN ds USING (course_code, activity_id))"""


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "events").select("user_id").distinct().filter("user_id % 11 <> 0")
    domain = F.when(F.col("user_id") % 7 == 0, "@student.uni.example").otherwise("@uni.example")
    return u.select(F.col("user_id").cast("string").alias("teacher_id"), F.concat(F.lit("u"), F.col("user_id").cast("string"), domain).alias("email"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = emails(spark, sf_dir), F.col("teacher_id").cast("int")
    text = lambda s: F.concat(F.lit(s), F.col("teacher_id"))
    return e.filter(i % 5 != 0).select("email", text("Name ").alias("full_name"), F.concat(F.lit("F"), (i % 3).cast("string")).alias("wydzial"), F.concat(F.lit("U"), (i % 4).cast("string")).alias("jednostka"), text("B").alias("id_bazus"))


DIMENSIONS = """
em AS (
  SELECT DISTINCT user_id::VARCHAR AS teacher_id, 'u' || user_id || CASE WHEN user_id % 7 = 0 THEN '@student.uni.example' ELSE '@uni.example' END AS email
  FROM events WHERE user_id % 11 <> 0),
hr AS (
  SELECT email, 'Name ' || teacher_id AS full_name, 'F' || (teacher_id::INT % 3) AS wydzial, 'U' || (teacher_id::INT % 4) AS jednostka, 'B' || teacher_id AS id_bazus
  FROM em WHERE teacher_id::INT % 5 <> 0)"""
ENRICHED = STATE + "," + DIMENSIONS + """,
te AS (
  SELECT e.*, st.status_final, st.confidence_deleted, st.activity_id IS NULL AS missing_state, em.email, hr.full_name, hr.wydzial, hr.jednostka, hr.id_bazus,
    coalesce(em.email LIKE '%@student.%', false) AS is_student, em.email IS NULL AS missing_email, em.email IS NOT NULL AND hr.email IS NULL AS missing_hr
  FROM ev e LEFT JOIN st ON st.course_code = e.course_code AND st.activity_id = e.object_id
  LEFT JOIN em ON em.teacher_id = e.teacher_id LEFT JOIN hr ON hr.email = em.email
  WHERE (e.counted OR e.count_mode = 'object-based') AND e.ay = '2023/24' AND e.term = 'z'),
ok AS (SELECT * FROM te WHERE NOT is_student AND NOT missing_email),
vis AS (
  SELECT * FROM ok t WHERE tech_key IN ('QUESTION_CREATE', 'FORUM_POST_DELETE')
    OR (tech_key IN ('RESOURCE_PAGE_CREATE', 'URL_CREATE') AND status_final IN ('visible_active', 'unknown'))
    OR (tech_key = 'BOOK_CHAPTER_CREATE' AND EXISTS (SELECT 1 FROM st s WHERE s.course_code = t.course_code AND s.type = 'book' AND s.status_final = 'visible_active'))),
cnt AS (
  SELECT ay, term, teacher_id, course_code, wydzial_code, kierunek_code, tech_key, min(activity_label) AS activity_label,
    CASE WHEN max(count_mode) = 'object-based' THEN count(DISTINCT object_id) ELSE count(*) END AS count_value, min(count_mode) <> max(count_mode) AS mixed,
    min(full_name) AS full_name, min(email) AS email, min(wydzial) AS wydzial, min(jednostka) AS jednostka, min(id_bazus) AS id_bazus
  FROM vis GROUP BY 1, 2, 3, 4, 5, 6, 7),
ml AS (
  SELECT *, round(count_value / nullif(sum(count_value) OVER (PARTITION BY ay, term, course_code, tech_key), 0), 4) AS pct_course,
    round(count_value / nullif(sum(count_value) OVER (PARTITION BY ay, term, kierunek_code, tech_key), 0), 4) AS pct_kierunek,
    round(count_value / nullif(sum(count_value) OVER (PARTITION BY ay, term, wydzial_code, tech_key), 0), 4) AS pct_wydzial,
    round(count_value / nullif(sum(count_value) OVER (PARTITION BY ay, term, tech_key), 0), 4) AS pct_uczelnia
  FROM cnt)"""


def as_files(lines: DataFrame, header: Column, encode: Column) -> DataFrame:
    """Rows (name, line) as files of a folder: path, name, modificationTime, length, content."""
    text = F.concat_ws("\n", header, F.array_join(F.array_sort(F.collect_list("line")), "\n"), F.lit(""))
    content = lines.groupBy("name").agg(text.alias("text")).withColumn("content", encode)
    return content.select(F.concat(F.lit("/in/"), "name").alias("path"), "name", F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.length("content").cast("long").alias("length"), "content")


def log_files(spark: SparkSession, sf_dir: str, records: int | None = None) -> DataFrame:
    """Log files of 15 courses and every day: some in windows-1250 with tabs, some with byte order mark and ;, others with commas.

    A record for each event, or `records` of them, events coming again as often as it takes.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # windows-1250
    e = table(spark, sf_dir, "events")
    if records is not None:
        times = -(-records // max(1, e.count()))
        e = e.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(times)))).orderBy("again", "event_id").limit(records)
    course = F.concat(F.lit("K"), (F.col("user_id") % 15).cast("string"))
    name = F.concat(F.lit("logs_"), course, F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit("-0000.csv"))
    note = F.concat(F.lit("Zażółć "), "event_type", F.lit(" in the course with id '"), F.col("user_id").cast("string"), F.lit("'"))
    kind = lambda tab, mark, comma: F.when(F.col("name").rlike("_K[0-4]_"), tab).when(F.col("name").rlike("_K[5-9]_"), mark).otherwise(comma)
    sep = kind(F.lit("\t"), F.lit(";"), F.lit(","))
    lines = e.select(name.alias("name"), stamp("ts").alias("at"), note.alias("note"))
    lines = lines.select("name", F.concat(F.col("at"), sep, F.lit('" K"'), sep, F.lit('"'), F.col("note"), F.lit('"')).alias("line"))
    header = F.concat(F.lit("Czas"), F.max(sep), F.lit("Kontekst zdarzenia"), F.max(sep), F.lit("Opis"))
    utf8 = F.encode("text", "utf-8")
    return as_files(lines, header, kind(F.encode("text", "windows-1250"), F.concat(F.unhex(F.lit("EFBBBF")), utf8), utf8))


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of course contents for every day."""
    e, user = table(spark, sf_dir, "events"), F.col("user_id").cast("string")
    course = F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string"))
    name = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("-0800_zawartosc_kursow.csv"))
    lines = e.select(name.alias("name"), F.concat_ws(",", F.lit("Kurs"), course, F.lit("Nazwa"), "event_type", user).alias("line"))
    return as_files(lines, F.lit("Nazwa kursu,ID kursu,Nazwa aktywności,Format aktywności,ID aktywności"), F.encode("text", "utf-8"))


def as_folder(files: DataFrame, root: str, more: bool = False) -> str:
    """Files (name, content) in a real folder: each is written by a task, with a line end behind it, and moved to its name. more: to a folder that is there."""
    spark, fs = files.sparkSession, files.sparkSession._jvm.org.apache.hadoop.fs
    parts = f"{root}-parts{'-more' if more else ''}"
    files.select("name", F.col("content").cast("string")).repartition("name").write.partitionBy("name").text(parts)
    base = fs.Path(parts)
    disk = base.getFileSystem(spark._jsc.hadoopConfiguration())
    disk.mkdirs(fs.Path(root))
    for folder in disk.listStatus(base):
        if folder.isDirectory():
            part = next(f.getPath() for f in disk.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            disk.rename(part, fs.Path(root, folder.getPath().getName().split("=", 1)[1]))
    return root
