"""Files of all encodings, delimiters and headers; sinks; streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lectern.functions.text import parse_time
from lectern.operators import keyed
from lectern.sources import logs, sinks
from lectern.streaming import ingest


@pytest.fixture()
def folder(tmp_path):
    def put(name, data):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        return f"file://{tmp_path}/in"

    return put


def test_encodings_and_delimiters(spark, folder):
    folder("a/logs_KURS1_20260218-1000.csv", "﻿Czas;Akcja;Opis\n2026-02-18 10:00:00;ADD;Zażółć gęślą\n".encode())
    folder("b/logs_KURS2_20260218-1000.csv", "Time\tAkcja\tOpis\n6-11-25, 15:34:53\tADD\tŚliwka w kompot\n".encode("cp1250"))
    folder("logs_KURS3_20260218-1000.csv", b'Date,A,B,,A\n"06.11.2025 15:34",1,"x, ""y""\nz",n,2\n\n , ,\nbad,3\n')
    root = folder("other.csv", b"a;b\n1;2\n")
    got = {(r.course, r.payload.get("Opis") or r.payload.get("B")): r for r in logs.raw_events(spark, root).collect()}
    assert set(got) == {("KURS1", "Zażółć gęślą"), ("KURS2", "Śliwka w kompot"), ("KURS3", 'x, "y"\nz'), ("KURS3", None)} or ("KURS3", "") in got
    one = got["KURS1", "Zażółć gęślą"]
    assert one.time_text == "2026-02-18 10:00:00" and one.time_ts == dt.datetime(2026, 2, 18, 10) and set(one.payload) == {"Czas", "Akcja", "Opis"}
    assert got["KURS2", "Śliwka w kompot"].time_ts == dt.datetime(2025, 11, 6, 15, 34, 53)
    three = got["KURS3", 'x, "y"\nz']
    assert three.payload["A"] == "2" and three.payload["col_4"] == "n" and three.time_ts == dt.datetime(2025, 11, 6, 15, 34)


def test_duplicates_across_files(spark, folder):
    folder("logs_A_20260101-0000.csv", b"Czas;Opis\n2026-01-01;  Duplikat  \n")
    root = folder("logs_B_20260101-0000.csv", b"Czas;Opis\n2026-01-01;Duplikat\n")
    assert [r.course for r in logs.raw_events(spark, root).collect()] == ["A"]
    assert {r.course for r in logs.raw_events(spark, root, scope="course").collect()} == {"A", "B"}


@pytest.mark.parametrize("text, want", [
    ("6-11-25, 15:34:53", "2025-11-06 15:34:53"), ("06.11.2025 15:34", "2025-11-06 15:34:00"), ("2026-02-18T10:00", "2026-02-18 10:00:00"), ("2026-02-18", "2026-02-18 00:00:00"),
    ("1-1-99, 0:00", "1999-01-01 00:00:00"), ("2026", None), ("soon", None), ("", None), (None, None), ("31.02.2025 10:00", None),
])
def test_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(F.date_format(parse_time(F.col("t")), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert got == want


def test_snapshots_and_dimensions(spark, folder):
    root = folder("20260206-0826_2526z_zawartosc_kursow.csv", "Nazwa kursu,ID kursu,Nazwa aktywności,Format aktywności,ID aktywności\nK,C1,Strona,page,7\nK,,x,page,8\n".encode())
    row = logs.read_snapshots(spark, root).collect()
    assert [(r.course_code, r.activity_id, r.type, r.visible_to_students, r.captured_at) for r in row] == [("C1", "7", "page", True, dt.datetime(2026, 2, 6, 8, 26))]
    ids = spark.createDataFrame([("7.0", " A@x.PL "), ("7", "a@x.pl"), ("", "b"), (None, None)], "`UserID` string, `E-mail` string")
    assert [tuple(r) for r in logs.id_emails(ids).collect()] == [("7", "a@x.pl")]
    hr = spark.createDataFrame([("a@x.pl", "First", 1), ("A@x.pl", "Second", 2), (None, "N", 3)], "`E-mail` string, `Pełna nazwa` string, no int")
    assert [(r.email, r.full_name, r.wydzial) for r in logs.people(hr, "no").collect()] == [("a@x.pl", "First", None)]
    with pytest.raises(ValueError):
        logs.people(hr, columns={"email": "Adres"})


def test_inputs_by_name(spark, folder):
    folder("teachers_hr.csv", b"x")
    root = folder("20260101-0000_zawartosc.csv", b"x")
    assert {r.kind for r in logs.latest_inputs(logs.files(spark, root)).collect()} == {"hr", "snapshot"}


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([("2025/26", "z", 1), ("2025/26", "l", 2)], "ay string, term string, n int")
    sinks.replace_periods(df, path)
    sinks.replace_periods(df.filter("term = 'l'").withColumn("n", F.lit(9)), path)
    assert {(r.term, r.n) for r in spark.read.parquet(path).collect()} == {("z", 1), ("l", 9)}
    sinks.replace_periods(df.filter("term = 'l'"), path, full=True)
    assert [(r.term, r.n) for r in spark.read.parquet(path).collect()] == [("l", 2)]
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, at int")
    assert sinks.append_absent(rows, f"{path}2", ["k"], ["at"]) == 2
    assert sinks.append_absent(rows, f"{path}2", ["k"], ["at"]) == 0
    assert {tuple(r) for r in spark.read.parquet(f"{path}2").collect()} == {("a", 1), ("b", 1)}
    events = spark.createDataFrame([("A", dt.datetime(2026, 1, 1, h) if h else None, dt.datetime(2026, 1, 1), str(h)) for h in (9, 10, 0)], "course string, time_ts timestamp, inserted_at timestamp, note string")
    sinks.export_courses(events, f"{path}3")
    lines = [x for f in (tmp_path / "t3" / "course=A").glob("*.csv") for x in f.read_text().splitlines()[1:]]
    assert [x.rsplit(";", 1)[1] for x in lines] == ['"10"', '"9"', '"0"']
    sinks.merge_parquet([rows, rows.withColumn("more", F.lit(1))], f"{path}4", dedup_per_file=True)
    assert spark.read.parquet(f"{path}4").count() == 6


def test_large_course_over_several_files(spark, tmp_path):
    path = f"file://{tmp_path}/hot"
    events = spark.range(2000).select(
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("course"), F.when(F.col("id") % 7 > 0, F.timestamp_seconds(F.hash("id") % 100000)).alias("time_ts"),
        F.timestamp_seconds("id").alias("inserted_at"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.export_courses(events, path, "parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted((tmp_path / "hot" / "course=A").glob("*.parquet"))
    got = [(r.time_ts, r.inserted_at) for f in found for r in spark.read.parquet(f"file://{f}").collect()]
    key = lambda r: (r[0] is None, -r[0].timestamp() if r[0] else 0, -r[1].timestamp())
    assert len(found) > 1 and len(got) == 1800 and got == sorted(got, key=key)


def test_delimiter_looks_at_twenty_lines(spark):
    texts = ["\n \n\r\na;b\r\n  \r\n\r\n1,2;3;4\r\n", "a\tb\n" + "1;2\n" * 19 + ",,,,,,,,,,\n" * 9, "  \n" + "a,b\n \n" * 20 + ";;;;;;;;;;;;;;;;;;;;;;;;\n" * 3, "one", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "no int, text string")
    got = [r.d for r in rows.select("no", logs.delimiter(F.col("text")).alias("d")).orderBy("no").collect()]
    assert got == [";", ";", ",", ";", ";", ","]


def test_stream_adds_new_records_once(spark, folder, tmp_path):
    root = folder("logs_A_20260101-0000.csv", b"Czas;Opis\n2026-01-01;x\n2026-01-01;x\n2026-01-02;y\n")
    table, check = f"file://{tmp_path}/table", f"file://{tmp_path}/check"
    run = lambda c: ingest.stream_logs(spark, root, table, c).awaitTermination()
    run(check)
    assert spark.read.parquet(table).count() == 2
    folder("logs_B_20260102-0000.csv", b"Czas;Opis\n2026-01-02;y\n2026-01-03;z\n")
    run(check)
    assert spark.read.parquet(table).count() == 3
    run(f"{check}2")  # all files once more, as after a lost checkpoint
    assert spark.read.parquet(table).count() == 3


def test_stream_of_snapshots(spark, folder, tmp_path):
    root = folder("20260206-0826_x.csv", "ID kursu,Nazwa aktywności,Format aktywności,ID aktywności\nC1,S,page,7\n".encode())
    seen = []
    ingest.stream_snapshots(spark, root, f"file://{tmp_path}/s", f"file://{tmp_path}/c", logs.snapshot_rows, lambda courses: seen.extend(r[0] for r in courses.collect())).awaitTermination()
    assert seen == ["C1"] and spark.read.parquet(f"file://{tmp_path}/s").count() == 1


def test_mixed_periods(spark):
    df = spark.createDataFrame([("2025/26", "z"), ("2025/26", "l")], "ay string, term string")
    assert keyed.require_one_period(df.filter("term = 'z'")).count() == 1
    with pytest.raises(keyed.MixedPeriods):
        keyed.require_one_period(df)


def test_long_fields_and_open_quotes(spark, folder):
    root = folder("logs_A_20260101-0000.csv", ('Czas;Opis\n2026-01-01;"' + "x" * 300_000 + '"\n2026-01-02;"open\nto the end;').encode())
    assert sorted(len(r.payload["Opis"]) for r in logs.raw_events(spark, root).collect()) == [len("open\nto the end;"), 300_000]


def test_merge_says_what_it_did(spark, folder, tmp_path):
    from lectern import schemas
    from lectern.plans import pipeline

    table = f"file://{tmp_path}/raw"
    assert pipeline.merge_logs(spark, folder("other.csv", b"a;b\n1;2\n"), table).status == "SKIPPED"
    folder("logs_A_20260101-0000.csv", b"Czas;Opis\n2026-01-01;x\n2026-01-01;x\n2026-01-02;y\n")
    root = folder("logs_B_20260101-0000.csv", b"Czas;Opis\n2026-01-02;y\n2026-01-03;course with id '5'\n")
    assert pipeline.merge_logs(spark, root, table) == pipeline.Merged("OK", 2, 2, 5, 3)
    assert pipeline.merge_logs(spark, root, table).inserted == 0
    got = spark.read.parquet(table)
    assert [f.split()[0] for f in schemas.RAW_EVENT.split(", ")] == got.columns and got.filter("course_id = '5'").count() == 1
    ingest.stream_logs(spark, root, table, f"file://{tmp_path}/check").awaitTermination()
    assert spark.read.parquet(table).columns == got.columns and spark.read.parquet(table).count() == 3


def test_tables_that_appends_refuse(spark, tmp_path):
    path = f"file://{tmp_path}/qa"
    rows = spark.createDataFrame([("T", "1", "C", "K", "d")], "qa_type string, teacher_id string, course_code string, tech_key string, details string")
    sinks.append_findings(rows, path)
    with pytest.raises(ValueError):
        sinks.append_findings(rows.drop("details"), path)
    with pytest.raises(ValueError):
        sinks.append(rows.withColumnRenamed("details", "more"), path)
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("payload, want", [
    ({"Opis": "the course with id '12'."}, "12"), ({"Description": "Course with ID 7"}, "7"), ({"Kontekst zdarzenia": "x", "Opis": "course id: 8"}, "8"),
    ({"Nazwa zdarzenia": "ID kursu = 9"}, "9"), ({"Inne": "course id 3"}, "3"), ({"Opis": "none", "Inne": "course id 3"}, None), ({}, None),
])
def test_course_numbers(spark, payload, want):
    from lectern.functions.course import course_id

    assert spark.createDataFrame([(payload,)], "p map<string,string>").select(course_id(F.col("p"))).first()[0] == want


@pytest.mark.parametrize("name, want", [
    ("WFAnstj5sem-Nazwa-WY-202526z", "WF/An/stj/5sem-Nazwa-Wykład-2025/26z"), ("WFAnnst5sem-Nazwa-202526l", "WF/An/nst/5sem-Nazwa-2025/26l"), ("WLLe-EDnst1sem-N-202526z", "WL/Le-ED/nst/1sem-N-2025/26z"),
    ("WLLe-EDns11sem-N-202526z", "WL/Le-ED/ns1/1sem-N-2025/26z"), ("WLLe-EDst1sem-N-202526z", "WL/Le-ED/st/1sem-N-2025/26z"), ("other", None),
])
def test_courses_by_file_name(spark, name, want):
    from lectern.functions.course import code_from_file

    assert spark.createDataFrame([(name,)], "c string").select(code_from_file(F.col("c"))).first()[0] == want


def test_other_headers(spark, folder):
    from lectern.operators import roster

    hr = spark.createDataFrame([("A@x.pl", "N", "K")], "mail string, NazwiskoImie string, katedra string")
    assert [tuple(r)[:4] for r in logs.people(hr).collect()] == [("a@x.pl", "N", None, "K")]
    sheet = spark.createDataFrame([("1", "5")], "course_id string, `Studenci przed rozpocząciem` string")
    with pytest.raises(ValueError):
        roster.read_roster(sheet, "2026-01-01", strict=True)
    assert roster.read_roster(sheet, "2026-01-01").first().students_before_start == 5
    with pytest.raises(ValueError):
        roster.read_roster(sheet.drop("course_id"), "2026-01-01")
    for name in ("dane_do_raportu.csv", "enrol.csv"):
        root = folder(name, b"x")
    assert {r.kind for r in logs.latest_inputs(logs.files(spark, root)).collect()} == {"hr", "roster"}


def test_files_of_a_batch_are_not_decoded_at_once():
    """Python's peak for 12 MB of files in one batch is a small part of it, and records are as before."""
    import tracemalloc

    import pyarrow as pa

    from lectern.sources.logs import _rows

    text = "Czas;Opis\r\n" + '2024-01-01;"Zażółć\r\n""gęślą"" jaźń"\r\n' * 200 + (" " * 1000 + "\n") * 900
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c", *"defghijklmnop"]), pa.array([None, "", "x\r1\n2", *[text] * 13]), pa.array([";"] * 16)], ["path", "text", "sep"])
    tracemalloc.start()
    found, first = {}, {}
    for part in _rows(iter([batch])):
        path = part.column(0)[0].as_py()
        found[path] = found.get(path, 0) + part.num_rows
        first.setdefault(path, part.slice(0, 2).to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {"c": 2} | dict.fromkeys("defghijklmnop", 200)
    assert [r["fields"] for r in first["c"]] == [["1"], ["2"]] and first["d"][0]["fields"] == ["2024-01-01", 'Zażółć\r\n"gęślą" jaźń']
    assert peak < batch.nbytes / 2, (peak, batch.nbytes)
