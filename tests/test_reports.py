"""Reports made of what compute_stats gives, and of tables that don't fit."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import reports, stats
from lectern.operators.contract import ContractError, Field, check, project
from lectern.plans import pipeline

EVENT = "course_code string, ay string, term string, wydzial_code string, kierunek_code string, tech_key string, activity_label string, teacher_id string, object_id string, count_mode string, counted boolean"


@pytest.fixture(scope="module")
def metrics(spark):
    """compute_stats of three teachers in two courses of two programmes; nothing in a state, so no row is flagged."""
    rows = [("A", "K1", "1"), ("A", "K1", "1"), ("A", "K1", "2"), ("B", "K2", "2"), ("B", "K2", "3"), ("B", "K2", "3"), ("B", "K2", "3")]
    events = spark.createDataFrame([(c, "2025/26", "z", "W", k, "QUESTION_CREATE", "Pytanie", t, None, "TAK", True) for c, k, t in rows], EVENT)
    state = spark.createDataFrame([], "course_code string, activity_id string, type string, status_final string, confidence_deleted double")
    emails = spark.createDataFrame([(str(i), f"t{i}@x.pl") for i in (1, 2, 3)], "teacher_id string, email string")
    people = spark.createDataFrame([(f"t{i}@x.pl", f"Name {i}", "W1", "U1", f"B{i}") for i in (1, 2, 3)], "email string, full_name string, wydzial string, jednostka string, id_bazus string")
    return stats.compute_stats(events, state, emails, people)


def test_summary_of_computed_metrics_has_four_shares(metrics):
    long, qa = metrics
    made = pipeline.summary_report(long, qa, "2025/26", "z", "now")
    got = [(r.full_name, r.course, r.activity, r.count_value, r.pct_course, r.pct_program, r.pct_faculty, r.pct_university) for r in made.main.collect()]
    assert got == [
        ("Name 1", "A", "Pytanie", 2, 0.6667, 0.6667, 0.2857, 0.2857), ("Name 2", "A", "Pytanie", 1, 0.3333, 0.3333, 0.1429, 0.1429),
        ("Name 2", "B", "Pytanie", 1, 0.25, 0.25, 0.1429, 0.1429), ("Name 3", "B", "Pytanie", 3, 0.75, 0.75, 0.4286, 0.4286),
    ]
    assert not long.filter("confidence_flag").count()  # the summary has them all the same
    assert pipeline.summary_report(long.withColumn("hr_katedra", F.lit("K")), qa, "a", "z", "now").main.first().hr_katedra == "K"


def test_collapsed_summary_keeps_teachers_whose_counts_are_zero(metrics):
    long = metrics[0].withColumn("count_value", F.when(F.col("teacher_id") == "1", 0).otherwise(F.col("count_value")))
    main = pipeline.summary_report(long, metrics[1], "a", "z", "now", max_rows=1, policy="skip").main.collect()
    assert [(r.full_name, r.count_value, r.course, r.pct_course) for r in main] == [("Name 1", 0, None, None), ("Name 2", 2, None, None), ("Name 3", 3, None, None)]


def test_tables_that_do_not_fit_are_refused_before_any_job(spark, metrics):
    long, qa = metrics
    with pytest.raises(ContractError, match=r"course \(none of course_name, course_code\)"):
        pipeline.summary_report(long.drop("course_code"), qa, "a", "z", "now")
    with pytest.raises(ContractError, match="count_value.*array<int>"):
        pipeline.summary_report(long.withColumn("count_value", F.array(F.lit(1))), qa, "a", "z", "now")
    with pytest.raises(ContractError, match="teacher_id"):
        pipeline.individual_packs(long.drop("teacher_id").withColumn("visible_active", F.lit(True)))
    check(long, stats.METRICS)
    shares = spark.createDataFrame([("0.5", 1)], "pct_kierunek string, pct_course int")
    fields = [Field("pct_program", "double", ("pct_program", "pct_kierunek")), Field("gone", "bigint", needed=False)]
    assert tuple(shares.select(*project(shares, fields)).first()) == (0.5, None)


def test_packs_of_computed_metrics(spark, metrics, tmp_path):
    long = metrics[0].withColumn("pct_wydzial", F.when(F.col("teacher_id") == "3", F.lit(42.0)).otherwise(F.col("pct_wydzial")))
    path, log = f"file://{tmp_path}/packs", f"file://{tmp_path}/status"
    for _ in range(2):  # writing again replaces the packs and adds to the statuses
        packs = pipeline.individual_packs(long, path, active=F.lit(True), status_path=log)
    got = {r.teacher_id: (r.status, r.n_rows, r.n_written, r.message) for r in packs.status.collect()}
    assert got == {"1": ("OK", 1, 1, None), "2": ("OK", 2, 2, None), "3": ("ERROR", 1, 0, "pct_faculty is no share: 42.0")}
    written = spark.read.parquet(path).collect()
    assert sorted((r.report_file, r.course_name, r.count_value, r.pct_faculty) for r in written) == [
        ("Name 1_B1.xlsx", "A", 2, 0.2857), ("Name 2_B2.xlsx", "A", 1, 0.1429), ("Name 2_B2.xlsx", "B", 1, 0.1429),
    ]
    assert spark.read.parquet(log).count() == 6
    lines = {(r.label, r.value) for r in packs.persons.filter("teacher_id = '2'").collect()}
    assert lines == {("ID", "2"), ("Imię i nazwisko", "Name 2"), ("E-mail", "t2@x.pl"), ("ID bazus", "B2"), ("Wydział", "W1"), ("Jednostka", "U1")}
    assert [tuple(r) for r in reports.status_counts(packs.status).orderBy("status").collect()] == [("ERROR", 1, 1), ("OK", 2, 3)]
    unflagged = pipeline.individual_packs(metrics[0]).status.collect()
    assert {r.status for r in unflagged} == {"SKIPPED_NO_DATA"}  # by default rows need the flag


def test_packs_with_one_file_and_without_number(metrics):
    long = metrics[0].withColumn("full_name", F.when(F.col("teacher_id") == "3", " ").otherwise("Same")).withColumn("id_bazus", F.lit(None).cast("string"))
    got = lambda needed: {r.teacher_id: (r.status, r.report_file, r.message) for r in pipeline.individual_packs(long, active=F.lit(True), needs_number=needed).status.collect()}
    assert {s for s, *_ in got(True).values()} == {"SKIPPED_NO_ID"}
    same = ("ERROR", "Same_BRAK_BAZUS.xlsx", "2 packs have this file")
    assert got(False) == {"1": same, "2": same, "3": ("OK", "UNKNOWN_BRAK_BAZUS.xlsx", None)}


def test_packs_of_rows_that_cannot_be_read(spark, metrics):
    text = metrics[0].withColumn("count_value", F.when(F.col("teacher_id") == "1", "many").otherwise(F.col("count_value").cast("string")))
    rows = reports.pack_rows(text)
    assert {(r.teacher_id, r.problem) for r in rows.collect()} == {("1", "count_value is no whole number: many"), ("2", None), ("3", None)}
    status = reports.pack_results(reports.person_record(text), rows).collect()
    assert {r.teacher_id: r.status for r in status} == {"1": "ERROR", "2": "OK", "3": "OK"}


def test_a_pack_that_is_not_whole_is_an_error(spark):
    status = spark.createDataFrame([("1", "a", 2, "OK", None), ("2", "b", 1, "OK", None), ("3", "c", 1, "SKIPPED_NO_EMAIL", "no e-mail")], "teacher_id string, report_file string, n_rows long, status string, message string")
    written = spark.createDataFrame([("a",), ("b",)], "report_file string")
    got = {r.teacher_id: (r.status, r.n_written, r.message) for r in reports.checked_against(status, written).collect()}
    assert got == {"1": ("ERROR", 1, "1 of 2 rows are written"), "2": ("OK", 1, None), "3": ("SKIPPED_NO_EMAIL", 0, "no e-mail")}


def test_active_flags(spark):
    rows = spark.createDataFrame([("true", 1), (" VISIBLE_ACTIVE", 1), ("false", 1), ("x", 1), (None, 1), ("yes", 0)], "confidence_flag string, count_value int")
    assert [r.confidence_flag for r in reports.active(rows).collect()] == ["true", " VISIBLE_ACTIVE"]


def test_one_aggregate_for_all_levels(spark):
    rows = [("a", "x", "k", 1), ("a", "y", "k", 2), ("b", "x", None, 3), (None, "x", "k", 4), (None, None, "k", 5), ("a", "x", "k", 6)]
    counts = spark.createDataFrame(rows, "course string, faculty string, key string, n long")
    levels = {"pct_course": ["course"], "pct_both": ["course", "faculty"], "pct_again": ["course"], "pct_all": []}
    sums, marks = stats.level_sums(counts, "n", ["key"], levels)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1 and marks["pct_course"] == marks["pct_again"]
    got = stats.shares(counts, "n", ["key"], levels, None).collect()
    total = lambda r, *columns: sum(x[3] for x in rows if x[2] == r.key and all(x[("course", "faculty").index(c)] == r[c] for c in columns))
    assert len(got) == len(rows)
    for r in got:
        assert (r.pct_course, r.pct_both, r.pct_again, r.pct_all) == (r.n / total(r, "course"), r.n / total(r, "course", "faculty"), r.n / total(r, "course"), r.n / total(r))
