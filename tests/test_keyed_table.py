"""Inserts into keyed tables, batches that fail and come again, and state by touched courses."""

import glob
import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lectern.operators import state
from lectern.plans import pipeline
from lectern.sources import keyed_table, logs
from lectern.sources.keyed_table import KeyedTable
from lectern.streaming import ingest


def rows(spark, ids, note="x"):
    return spark.createDataFrame([(f"k{i}" if i is not None else None, note, n) for n, i in enumerate(ids)], "k string, note string, at long")


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    table = KeyedTable(f"file://{tmp_path}/t", ("k",), 64)
    assert table.append_absent(rows(spark, range(2000)), ["at"]) == 2000
    assert table.append_absent(rows(spark, [5, 5, 1999, 2000, 2001, 2001], "new"), ["at"]) == 2
    assert table.append_absent(rows(spark, []), ["at"]) == 0
    assert sorted(r.k for r in table.read(spark).filter("note = 'new'").collect()) == ["k2000", "k2001"]
    files = len(glob.glob(f"{tmp_path}/t/*/*/*/*.parquet"))
    for n in (1, 3, 40):
        touched = sorted({r[0] for r in table.placed(rows(spark, range(n))).select("key_bucket").collect()})
        found = table.possible(spark, touched, "none")
        read = found.select(F.input_file_name()).distinct().count()
        assert len(touched) <= n and read <= 2 * len(touched) < files
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "key_bucket" in plan and "ReadSchema: struct<k:string>" in plan


def test_null_keys_are_always_new_and_several_keys_count_together(spark, tmp_path):
    table = KeyedTable(f"file://{tmp_path}/t", ("k", "note"), 4)
    assert table.append_absent(rows(spark, [1, 1, None]), ["at"]) == 2
    assert table.append_absent(rows(spark, [1, None]), ["at"]) == 1
    assert table.append_absent(rows(spark, [1], "other"), ["at"]) == 1


def test_a_batch_replaces_what_it_wrote(spark, tmp_path):
    table = KeyedTable(f"file://{tmp_path}/t", ("k",), 8)
    table.append_absent(rows(spark, range(10)), ["at"], "a")
    for _ in range(3):
        assert table.append_absent(rows(spark, range(5, 40)), ["at"], "b") == 30
    for folder in glob.glob(f"{tmp_path}/t/of=8/key_bucket=[0-3]/batch=b"):
        shutil.rmtree(folder)  # as a write that was cut off leaves it
    assert table.read(spark).count() < 40
    assert table.append_absent(rows(spark, range(5, 40)), ["at"], "b") == 30
    assert sorted(r.k for r in table.read(spark).collect()) == sorted(f"k{i}" for i in range(40))


def test_bucket_number_is_the_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    KeyedTable(path, ("k",), 4).append_absent(rows(spark, range(20)), ["at"])
    assert KeyedTable(path, ("k",), 32).append_absent(rows(spark, range(25)), ["at"]) == 5
    assert keyed_table.folders(spark, path) == ["of=4"]
    compact = KeyedTable(path, ("k",)).compacted(spark, f"{path}2", 2)
    assert compact.read(spark).count() == 25 and compact.append_absent(rows(spark, range(26)), ["at"]) == 1
    rows(spark, [1]).write.partitionBy("note").parquet(f"file://{tmp_path}/plain/x")
    with pytest.raises(ValueError, match="no keyed table"):
        KeyedTable(f"file://{tmp_path}/plain", ("k",)).append_absent(rows(spark, [1]), ["at"])


def put(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text(text)
    return f"file://{tmp_path}/in"


def test_a_stream_that_fails_after_its_append(spark, tmp_path):
    """The append is done and the checkpoint isn't: the batch comes again and changes nothing. Then with half of its folders gone."""
    root = put(tmp_path, "logs_A_20260101-0000.csv", "Czas;Opis\n" + "".join(f"2026-01-01;n{i}\n" for i in range(50)))
    table, check = f"file://{tmp_path}/t", f"file://{tmp_path}/c"
    added = []

    def fail(n):
        added.append(n)
        raise RuntimeError("stopped between append and checkpoint")

    read = lambda: sorted(r.payload["Opis"] for r in KeyedTable(table, ("row_key",)).read(spark).collect())
    for cut in (False, True):
        with pytest.raises(StreamingQueryException):
            ingest.stream_logs(spark, root, table, check, buckets=8, after=fail).awaitTermination()
        assert read() == sorted(f"n{i}" for i in range(50))
        if cut:
            for folder in glob.glob(f"{tmp_path}/t/of=8/key_bucket=[0-3]/batch=*"):
                shutil.rmtree(folder)
    ingest.stream_logs(spark, root, table, check, buckets=8, after=added.append).awaitTermination()
    assert read() == sorted(f"n{i}" for i in range(50)) and added == [50, 50, 50]
    put(tmp_path, "logs_B_20260102-0000.csv", "Czas;Opis\n2026-01-01;n7\n2026-01-02;n50\n")
    ingest.stream_logs(spark, root, table, check, buckets=8, after=added.append).awaitTermination()
    ingest.stream_logs(spark, root, table, f"{check}2", buckets=8, after=added.append).awaitTermination()  # all files by another stream
    assert read() == sorted(f"n{i}" for i in range(51)) and added[3:] == [1, 0]


def test_a_stream_reads_files_once_and_finishes_only_new_rows(spark, tmp_path, monkeypatch):
    """No join brings a file's name back to its records, times and the like are made of appended rows only, and these are as read without a stream."""
    put(tmp_path, "logs_A_20260101-0000.csv", "\ufeffCzas;;Opis;Opis\n" + "".join(f" 2026-01-0{1 + i % 9} 1{i % 10}:00;k{i};old;course with id '{i}' \n" for i in range(50)))
    root = put(tmp_path, "logs_B_20260102-0000.csv", "Opis,DATE\nx\n\"a\n,b\",01.02.2026,more,\nx\n")
    found, finished, make = spark.read.format("binaryFile").load(f"{root}/*.csv").withColumn("name", F.element_at(F.split("path", "/"), -1)), [], ingest.as_events
    assert "Join" not in logs.log_rows(found, F.lit("1970-01-01"))._jdf.queryExecution().optimizedPlan().toString()

    def counted(rows, at):
        finished.append(rows.count())
        return make(rows, at)

    monkeypatch.setattr(ingest, "as_events", counted)
    for check in ("c", "c2"):  # the second stream takes all files once more
        ingest.stream_logs(spark, root, f"file://{tmp_path}/t", f"file://{tmp_path}/{check}", buckets=8).awaitTermination()
    assert finished == [52, 0]
    read = lambda rows: sorted((r.row_key, r.course, r.time_text, r.time_ts, sorted(r.payload.items()), r.source_file, r.course_id) for r in rows.collect())
    got, want = (read(x) for x in (KeyedTable(f"file://{tmp_path}/t", ("row_key",)).read(spark), logs.raw_events(spark, root)))
    assert repr(got) == repr(want) and len(got) == 52
    assert [("Czas", "2026-01-08 17:00"), ("Opis", "course with id '7'"), ("col_2", "k7")] in [r[4] for r in got]
    assert sum(r[4] == [("DATE", "01.02.2026"), ("Opis", "a\n,b")] for r in got) == 1


def test_merge_into_a_keyed_table(spark, tmp_path):
    put(tmp_path, "logs_A_20260101-0000.csv", "Czas;Opis\n2026-01-01;x\n2026-01-02;y\n")
    root = put(tmp_path, "logs_B_20260101-0000.csv", "Czas;Opis\n2026-01-02;y\n2026-01-03;z\n")
    (tmp_path / "in" / "logs_C_20260101-0000.csv").write_bytes("Czas;Opis\n2026-01-02;y\n".encode("utf-16"))
    (tmp_path / "in" / "logs_D_20260101-0000.csv").write_text(" \n\n")
    made = pipeline.merge_logs(spark, root, f"file://{tmp_path}/t", buckets=4)
    assert made == pipeline.Merged("ERROR", 4, 4, 4, 3, 2)
    assert {r.name: r.problem for r in made.results.collect()} == {
        "logs_A_20260101-0000.csv": None, "logs_B_20260101-0000.csv": None, "logs_C_20260101-0000.csv": "no text file", "logs_D_20260101-0000.csv": "no lines",
    }
    assert pipeline.merge_logs(spark, root, f"file://{tmp_path}/t", buckets=4).inserted == 0


def test_snapshot_load_says_what_it_did(spark, tmp_path):
    head = "ID kursu,Nazwa aktywności,Format aktywności,ID aktywności\n"
    root = put(tmp_path, "20260206-0826_x.csv", head + "C1,S,page,7\nC1,S,page,7\nC2,T,page,\n")
    put(tmp_path, "20260207-0826_x.csv", head + "C1,S,page,8\n")
    put(tmp_path, "20260208-0826_x.csv", "Kurs;Nr\nC1;8\n")
    table = f"file://{tmp_path}/t"
    made = pipeline.load_snapshots(spark, root, table)
    assert (made.status, made.files, made.failed, made.scanned, made.inserted, made.latest.strftime("%d %H:%M")) == ("ERROR", 3, 1, 3, 2, "07 08:26")
    assert [(r.name, r.problem) for r in made.results.filter("problem is not null").collect()] == [("20260208-0826_x.csv", "no column ID kursu, ID aktywności")]
    again = pipeline.load_snapshots(spark, root, table)
    assert (again.scanned, again.inserted) == (3, 0)
    assert pipeline.load_snapshots(spark, root, table, glob="*.txt") == pipeline.Loaded("SKIPPED", 0, 0, 0, 0, None)


def test_state_of_touched_courses_only(spark, tmp_path):
    head = "ID kursu,Nazwa aktywności,Format aktywności,ID aktywności\n"
    courses = [f"C{i}" for i in range(12)]
    root = put(tmp_path, "20260101-0800_x.csv", head + "".join(f"{c},S,page,1\n{c},T,page,2\n" for c in courses))
    schema = "course_code string, ay string, term string, wydzial_code string, kierunek_code string, track_code string, semester_code string, ts_utc timestamp, object_id string, operation string, counted boolean"
    events = spark.createDataFrame([], schema)
    table, path, check = (f"file://{tmp_path}/{x}" for x in ("t", "state", "c"))
    run = lambda: ingest.stream_state(spark, root, table, lambda: events, path, check, 8).awaitTermination()
    run()
    listed = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/state/*/*.parquet")}
    before = listed()
    put(tmp_path, "20260201-0800_x.csv", head + "C3,S,page,1\n")
    run()
    put(tmp_path, "20260301-0800_x.csv", head + "C3,S,page,1\nC5,T,page,2\n")
    run()
    bucket = {r.course_code: r.course_bucket for r in state.with_course_bucket(spark.createDataFrame([(c,) for c in courses], "course_code string"), 8).collect()}
    after, hit = listed(), {f"course_bucket={bucket[c]}" for c in ("C3", "C5")}
    same = {f for f in before if f.split("/")[-2] not in hit}
    assert same and all(after.get(f) == before[f] for f in same)
    assert not any(f in after for f in before if f.split("/")[-2] in hit)
    got = spark.read.parquet(path).drop("course_bucket")
    want = state.activities_state(KeyedTable(table, ("row_key",)).read(spark), events).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.filter("status_final = 'visible_deleted'").count() == 1
    assert state.refresh_state(want, events, want.filter("false"), path, 8) == []
