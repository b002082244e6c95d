"""Golden cases of rules, courses, state, statistics, reports and roster."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lectern.functions import course, text
from lectern.operators import reports, roster, rules, state, stats
from lectern.schemas import SNAPSHOT

SHEET = "AKTYWNOSC string, KLUCZ_TECHNICZNY string, OPERACJA string, LICZYC_DO_RAPORTU string, TRYB_LICZENIA string, `REGEX_DOPASOWANIA_(Opis)` string, `REGEX_USER_ID_(Opis)` string, `REGEX_OBIEKT_ID_(z dopasowania)` string, PRIORYTET string, no int"


def sheet(spark):
    who = "user with id '(?P<id>\\d+)'"
    return spark.createDataFrame([
        ("Strona", "PAGE", "CREATE", "TAK", None, "created the 'page' .*module id '(\\d+)'", who, "module id '(\\d+)'", "10", 1),
        ("Strona 2", "PAGE2", "create", "tak", "object-based", "CREATED the 'page'", who, "module", "10", 2),
        ("Nie", "NO", "CREATE", "NIE", None, "hidden", None, None, "99", 3), ("Low", "LOW", "CREATE", "TAK", None, "created", "(x)?user with id '(?P<id>\\w+)'", None, "x", 4),
        ("No regex", "NONE", "CREATE", "TAK", None, " ", None, None, "1", 5),
    ], SHEET)


def test_rules(spark):
    compiled = rules.compile_rules(sheet(spark), "no")
    assert {(r.rule_no, r.priority, r.count_mode, r.user_group, r.object_group) for r in compiled.collect()} == {
        (1, 10, "TAK", 1, 1), (2, 10, "object-based", 1, None), (3, 99, "NIE", None, None), (4, 0, "TAK", 2, None),
    }
    events = spark.createDataFrame([
        (1, "The user with id '12' created the 'page' activity with course module id '345'."), (2, "user with id '12' created hidden"),
        (3, "nothing"), (4, None), (5, "user with id 'abc' created x"),
    ], "i int, opis string")
    got = {r.i: r for r in rules.match_rules(events, compiled, "opis").collect()}
    assert set(got) == {1, 2, 5}
    assert (got[1].rule_no, got[1].teacher_id, got[1].object_id, got[1].n_best, got[1].n_matches) == (1, 12, 345, 2, 3)
    assert got[5].teacher_id is None and got[5].rule_no == 4
    assert [r.i for r in rules.countable(rules.match_rules(events, compiled, "opis")).orderBy("i").collect()] == [1, 5]
    assert [(r.i, r.best_rules) for r in rules.conflicts(rules.match_rules(events, compiled, "opis"), ["i"]).collect()] == [(1, [1, 2])]
    kept = {r.i: r.rule_no for r in rules.match_rules(events, compiled, "opis", case_sensitive=True, string_ids=True, keep_unmatched=True).collect()}
    assert kept == {1: 1, 2: 3, 3: None, 4: None, 5: 4}
    joined = {r.i: (r.rule_no, r.n_best) for r in rules.match_rules_joined(events, compiled, "opis", ["i"]).collect()}
    assert joined == {1: (1, 2), 2: (3, 1), 5: (4, 1)}
    assert rules.match_rules(events, compiled.filter("false"), "opis").count() == 0


def test_courses(spark):
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t")).alias("c")).first().c
    got = one(course.parse_context, "Kurs: WF/An/stj/5sem-Farmakologia-WY-2025/26z")
    assert tuple(got) == ("WF/An/stj/5sem-Farmakologia-WY-2025/26z", "WF", "An", "stj", "5sem", "Farmakologia-WY", "2025/26", "z")
    assert one(course.parse_context, "Strona główna") is None
    code = one(course.code_from_file, "WFAnstj5sem-Nazwa-WY-202526z")
    assert code == "WF/An/stj/5sem-Nazwa-Wykład-2025/26z"
    assert one(course.parse_code, code).course_name == "Nazwa-Wykład"
    le = one(lambda c: course.parse_code(course.code_from_file(c)), "WLLe-EDstj1sem-Nazwa-202526z")
    assert (le.wydzial_code, le.kierunek_code, le.track_code) == ("WL", "Le-ED", "stj")


@pytest.mark.parametrize("t, n", [("1 234", 1234), ("12.0", 12), ("x", 0), ("", 0), (None, 0), ("1 5", 15), ("-3.9", -3)])
def test_lenient_int(spark, t, n):
    assert spark.createDataFrame([(t,)], "t string").select(text.lenient_int(F.col("t"))).first()[0] == n


def test_names(spark):
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t"))).first()[0]
    assert one(text.file_name, "Nowak/Anna:*?") == "Nowak_Anna___"
    assert one(text.percent, "12,5 %") == 0.125 and one(text.percent, "0.5") == 0.5 and one(text.percent, "-") is None
    assert text.pick_column(["﻿Pełna nazwa", "E-mail"], ["email", "e_mail"]) == "E-mail"
    with pytest.raises(ValueError):
        text.require_columns(["a"], ["a", "b"])


def snaps(spark, rows):
    return spark.createDataFrame([(c, a, "n", "page", v, dt.datetime(2026, 2, d), "f", f"{c}{a}{d}") for c, a, v, d in rows], SNAPSHOT)


def log(spark, rows):
    kind = "course_code string, ay string, term string, wydzial_code string, kierunek_code string, track_code string, semester_code string, ts_utc timestamp, operation string, object_id string, counted boolean"
    return spark.createDataFrame([(c, "2025/26", "z", "W", "K", "st", "1", dt.datetime(2026, 2, d), op, o, True) for c, o, op, d in rows], kind)


def test_activity_state(spark):
    s = snaps(spark, [("C1", "101", True, 1), ("C1", "101", True, 10), ("C2", "200", True, 1), ("C2", "201", True, 8), ("C2", "201", True, 20), ("C3", "300", False, 1), ("C4", "400", True, 1)])
    e = log(spark, [("C1", "101", "DELETE", 5), ("C5", "500", "CREATE", 3)])
    got = {r.activity_id: r for r in state.activities_state(s, e, state.StateOptions(grace_days=7)).collect()}
    assert (got["101"].status_final, got["101"].evidence_deleted, got["101"].deleted_at, got["101"].confidence_deleted) == ("visible_deleted", "log_delete_event", dt.datetime(2026, 2, 5), 0.8)
    assert (got["200"].status_final, got["200"].evidence_deleted, got["200"].deleted_at) == ("visible_deleted", "snapshot_disappearance", dt.datetime(2026, 2, 8))
    assert got["300"].status_final == "hidden" and got["400"].status_final == "visible_active" and got["500"].status_final == "unknown"
    last = {r.activity_id: r for r in state.activities_state(s, e, state.StateOptions(grace_days=7, policy="last_seen")).collect()}
    assert last["200"].deleted_at == dt.datetime(2026, 2, 1)
    long = {r.activity_id: r for r in state.activities_state(s, e, state.StateOptions(grace_days=14)).collect()}
    assert long["200"].status_final == "visible_active"
    found = state.state_findings(state.activities_state(s, e), s, e).collect()
    assert {(r.qa_type[:8], r.activity_id) for r in found} == {("conflict", "101"), *(("activity", a) for a in ("200", "201", "300", "400"))}


def canonical(spark, rows):
    kind = "course_code string, ay string, term string, wydzial_code string, kierunek_code string, ts_utc timestamp, teacher_id string, operation string, tech_key string, activity_label string, object_id string, count_mode string, counted boolean"
    return spark.createDataFrame([(c, "2025/26", "z", "W", "K", dt.datetime(2026, 1, 1), t, "CREATE", k, "label", o, m, m == "TAK") for c, t, k, o, m in rows], kind)


def test_counted_flag(spark):
    e = canonical(spark, [("C", "1", "K", "9", "TAK"), ("C", "1", "K", "9", "TAK_FLAG"), ("C", "1", "K", "8", "TAK"), ("C", "1", "K", None, "TAK"), ("C", None, "K", "9", "TAK"), ("C", None, "K", "9", "TAK_FLAG"), ("C", "1", "K", "7", "object-based")]).drop("counted")
    got = sorted((r.teacher_id or "", r.object_id or "", r.count_mode, r.counted) for r in stats.invalidate(e).collect())
    assert got == [("", "9", "TAK", True), ("", "9", "TAK_FLAG", False), ("1", "", "TAK", True), ("1", "7", "object-based", False), ("1", "8", "TAK", True), ("1", "9", "TAK", False), ("1", "9", "TAK_FLAG", False)]


def test_stats(spark):
    page = "RESOURCE_PAGE_CREATE"
    e = canonical(spark, [
        ("C", "A", page, "10", "TAK"), ("C", "B", page, "11", "TAK"), ("C", "A", "QUESTION_CREATE", "1", "object-based"), ("C", "A", "QUESTION_CREATE", "1", "object-based"),
        ("C", "A", page, "99", "TAK"), ("C", "A", "BOOK_CHAPTER_CREATE", "5", "TAK"), ("C", "S", page, "10", "TAK"), ("C", "N", page, "10", "TAK"), ("C", "B", "WIKI_PAGE_CREATE", "1", "TAK"), ("C", "B", "WIKI_PAGE_CREATE", "2", "object-based"),
    ])
    st = spark.createDataFrame([("C", "10", "visible_active", 0.0, "page"), ("C", "11", "visible_active", 0.0, "page")], "course_code string, activity_id string, status_final string, confidence_deleted double, type string")
    emails = spark.createDataFrame([("A", "a@x"), ("A", "b@x"), ("B", "b@x"), ("S", "s@student.uni.example")], "teacher_id string, email string")
    people = spark.createDataFrame([("a@x", "Anna", "W", "J", "1")], "email string, full_name string, wydzial string, jednostka string, id_bazus string")
    long, qa = stats.compute_stats(e, st, emails, people, stats.StatsOptions("2025/26", "z"))
    got = {(r.teacher_id, r.tech_key): (r.count_value, r.pct_course, r.pct_uczelnia) for r in long.collect()}
    assert got == {("A", page): (1, 0.5, 0.5), ("B", page): (1, 0.5, 0.5), ("A", "QUESTION_CREATE"): (1, 1.0, 1.0), ("B", "WIKI_PAGE_CREATE"): (2, 1.0, 1.0)}
    kinds = {(r.qa_type, r.teacher_id) for r in qa.collect()}
    assert {("STUDENT_IGNORED", "S"), ("MISSING_EMAIL_MAPPING", "N"), ("MISSING_HR_MAPPING", "B"), ("EVENT_WITHOUT_ACTIVITY_STATE", "A"), ("MIXED_COUNT_MODE", "B")} <= kinds
    wide = stats.widen(long).collect()
    assert {r.teacher_id: r[f"count_{page}"] for r in wide} == {"A": 1, "B": 1}
    with pytest.raises(ValueError):
        stats.widen(long, ["a-b", "a b"])


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([(f"C{i % 5}", f"K{i % 3}", i % 7 + 1) for i in range(60)], "course string, key string, n int")
    got = stats.shares(df, "n", ["key"], {"pct": ["course"], "all": []}, None).groupBy("course", "key").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("rows, most, sheets", [(25, 10, [10, 10, 5]), (10, 10, [10]), (0, 10, [])])
def test_sheets(spark, rows, most, sheets):
    df = spark.range(rows).select(F.lit("n").alias("full_name"), F.concat(F.lit("C"), (F.lit(rows) - F.col("id")).cast("string")).alias("course_code"), F.lit("k").alias("tech_key"), "id")
    got = reports.sheet_split(df, ["full_name", "course_code", "id"], most).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, rows + 1)) and [r.course_code for r in got] == sorted(r.course_code for r in got)
    assert [sum(r.sheet_no == s + 1 for r in got) for s in range(len(sheets))] == sheets


def test_overflow(spark):
    df = spark.createDataFrame([("n", "1", "c", "a", i) for i in range(11)], "full_name string, teacher_id string, course string, activity string, count_value int")
    with pytest.raises(reports.TooManyRows):
        reports.overflow(df, ["course"], 10, "error")
    assert [(r.count_value, r.course) for r in reports.overflow(df, ["course"], 10, "skip").collect()] == [(55, None)]
    assert reports.overflow(df, ["course"], 11, "error").count() == 11


def test_roster(spark):
    raw = spark.createDataFrame([("1", "A", "1 234", "12.0"), (" ", "B", "x", "")], "`ID kursu` string, `Nazwa kursu` string, `Użytkownicy` string, `Nauczyciele` string")
    old, new = roster.read_roster(raw, "2026-01-01"), roster.read_roster(raw.withColumn("Nazwa kursu", F.lit("Z")), "2026-01-02")
    assert [(r.course_id, r.users, r.teachers, r.students) for r in old.collect()] == [("1", 1234, 12, 0)]
    assert [r.course_name for r in roster.import_roster(old, new).collect()] == ["Z"]


def test_parse_events(spark):
    from lectern.operators.keyed import MixedPeriods
    from lectern.plans import pipeline

    table = rules.compile_rules(sheet(spark), "no")
    place, what = "Kurs: WF/An/stj/5sem-Nazwa-2025/26z", "user with id '12' created the 'page' with module id '3'"
    rows = [
        ("k", {"Opis": what, "Kontekst zdarzenia": place, "Czas": "2026-01-02 10:00"}), ("k", {"Opis": what, "Kontekst zdarzenia": "Strona", "Time": "1767348000"}),
        ("WFAnstj5sem-Inny-202526z", {"Opis": what, "Czas": "2026-01-02"}), ("q", {"Opis": what, "Czas": "2026-01-02"}), ("k", {"Opis": what, "Kontekst zdarzenia": place}),
        ("k", {"Opis": "hidden", "Czas": "2026-01-02"}), ("k", {"Opis": what, "Czas": "2026-01-02", "x": "a@STUDENT.y"}), ("k", {"Opis": "?", "Czas": "2026-01-02"}), ("k", {"Opis": what, "Źródło": "web robot", "Czas": "2026-01-02"}),
    ]
    raw = spark.createDataFrame([(c, None, None, str(i), p, "f") for i, (c, p) in enumerate(rows)], "course string, time_text string, time_ts timestamp, row_key string, payload map<string,string>, source_file string")
    got = pipeline.parse_events(raw, table, pipeline.ParseOptions(block_sources=["ROBOT"]))
    assert {r.row_key: (r.course_code, r.course_name, r.teacher_id, r.object_id) for r in got.events.collect()} == {
        "0": (place[6:], "Nazwa", "12", "3"), "1": (place[6:], "Nazwa", "12", "3"), "2": ("WF/An/stj/5sem-Inny-2025/26z", "Inny", "12", "3"),
    }
    assert {r.reject_reason: r.n for r in got.rejected.collect()} == {"accepted": 3, "context": 1, "time": 1, "rule": 2, "student": 1, "source": 1}
    assert got.conflicts.count() == 3
    seen = raw.filter("row_key in ('0', '1')").select("row_key")
    assert [r.row_key for r in pipeline.parse_events(raw, table, pipeline.ParseOptions(block_sources=["ROBOT"]), seen).events.collect()] == ["2"]
    other = raw.limit(1).withColumn("payload", F.create_map(F.lit("Opis"), F.lit(what), F.lit("Kontekst zdarzenia"), F.lit(place[:-1] + "l"), F.lit("Czas"), F.lit("2026-01-02")))
    with pytest.raises(MixedPeriods):
        pipeline.parse_events(raw.union(other), table)


def test_finalize_looks_at_earlier_events(spark):
    from lectern.plans import pipeline

    e = canonical(spark, [("C", "1", "K", "9", "TAK"), ("C", "1", "K", "9", "TAK_FLAG")]).drop("counted")
    new, old = e.filter("count_mode = 'TAK'"), e.filter("count_mode = 'TAK_FLAG'")
    assert [r.counted for r in pipeline.finalize(new, old).collect()] == [False]
    assert [r.counted for r in pipeline.finalize(new, old, "batch").collect()] == [True]


LONG = (
    "teacher_id string, full_name string, email string, id_bazus string, course_name string, course_code string, tech_key string, activity_label string, "
    "count_value long, visible_active boolean, hr_wydzial string, hr_jednostka string"
)


def test_individual_packs(spark, tmp_path):
    from lectern.plans import pipeline

    ten = ("10", "Kowalski Jan", "j@x.pl", "B123")
    rows = [
        (*ten, "Kurs B", "B", "URL", "Adres URL", 2, True, "WL", "Katedra X"), (*ten, "Kurs A", "A", "PAGE", "Strona", 3, True, "WL", "Katedra X"), (*ten, "Kurs A", "A", "WIKI", "Wiki", 0, True, "WL", "Katedra X"),
        ("11", "Zero", "z@x.pl", "B1", "Kurs A", "A", "PAGE", "Strona", 0, True, None, None), ("12", "Bez", None, "B2", "Kurs A", "A", "PAGE", "Strona", 1, True, None, None),
        ("13", "Nowak/Anna:*?", "n@x.pl", None, "Kurs A", "A", "PAGE", "Strona", 1, True, None, None),
    ]
    packs = pipeline.individual_packs(spark.createDataFrame(rows, LONG), f"file://{tmp_path}/packs")
    status = {r.teacher_id: (r.status, r.n_rows) for r in packs.status.collect()}
    assert status == {"10": ("OK", 2), "11": ("SKIPPED_NO_DATA", 0), "12": ("SKIPPED_NO_EMAIL", 1), "13": ("SKIPPED_NO_ID", 1)}
    assert len(list((tmp_path / "packs").glob("report_file=*"))) == 1
    written = spark.read.parquet(f"file://{tmp_path}/packs").collect()
    assert [(r.course_name, r.activity_label, r.count_value) for r in written] == [("Kurs A", "Strona", 3), ("Kurs B", "Adres URL", 2)]
    assert {(r.label, r.value) for r in packs.persons.filter("teacher_id = '10'").collect()} >= {("ID", "10"), ("ID bazus", "B123"), ("Wydział", "WL"), ("Jednostka", "Katedra X")}


@pytest.mark.parametrize("policy", ["error", "split", "skip"])
def test_summary_report(spark, policy):
    from lectern.operators import reports
    from lectern.plans import pipeline

    rows = [(str(i), name, "e", "b", "K", course, "T", "L", n, True, None, None) for i, (name, course, n) in enumerate([("B", "ZZ", 1), ("A", "BB", 2), ("A", "AA", 3), ("A", "CC", 0)])]
    long = spark.createDataFrame(rows, LONG)
    qa = spark.createDataFrame([("T", "1", "C", "K", "d")], "qa_type string, teacher_id string, course_code string, tech_key string, details string")
    if policy == "error":
        with pytest.raises(reports.TooManyRows):
            pipeline.summary_report(long, qa, "2025/26", "z", "now", max_rows=2)
        main = pipeline.summary_report(long, qa, "2025/26", "z", "now", max_rows=3).main.collect()
        assert [(r.full_name, r.course_code) for r in main] == [("A", "AA"), ("A", "BB"), ("B", "ZZ")]
        return
    made = pipeline.summary_report(long, qa, "2025/26", "z", "now", max_rows=2, policy=policy)
    main = made.main.collect()
    if policy == "split":
        assert [(r.sheet_no, r.full_name, r.course_code) for r in main] == [(1, "A", "AA"), (1, "A", "BB"), (2, "B", "ZZ")]
    else:
        assert all(r.course is None and r.pct_course is None for r in main) and sum(r.count_value for r in main) == 6
    assert {r.key: r.value for r in made.info.collect()} == {"ay": "2025/26", "term": "z", "generated_at": "now", "rows": "3", "teachers": "3", "courses": "3"}
    assert made.qa.count() == 1
