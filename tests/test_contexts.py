"""Course contexts anywhere in a text."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import course

PLAIN = "WF/An/stj/5sem-Anatomia-2025/26z"


@pytest.mark.parametrize(
    "text,code,name",
    [
        (f"Kurs: {PLAIN}", PLAIN, "Anatomia"),
        (f"Kurs: {PLAIN} (kopia)", PLAIN, "Anatomia"),
        (f"Forum w kursie, kurs:{PLAIN}, strona 2", PLAIN, "Anatomia"),
        ("Kurs: WF/An/stj/5sem-A-2024/25l-2025/26z", "WF/An/stj/5sem-A-2024/25l", "A"),
        (f"Kurs: brak Kurs: {PLAIN}", PLAIN, "Anatomia"),
        (f"Kurs: {PLAIN}\nKurs: WL/Le/st/1sem-B-2025/26z", PLAIN, "Anatomia"),
        ("kurs: wf/an/st_2/5SEM- Ćwiczenia z anatomii -2025/26Z", "wf/an/st_2/5SEM- Ćwiczenia z anatomii -2025/26Z", "Ćwiczenia z anatomii"),
        ("Kurs: WLLX/Le/st/1sem-B-2025/26z", None, None), ("Kurs: WL/Le-ED/st/1sem-B-2025/26z", None, None), ("Kurs: WL/Le/st/1sem-\n-2025/26z", None, None),
        ("Kurs: WL/Le/st/1sem--2025/26z", None, None), ("", None, None), (None, None, None),
    ],
)
def test_context(spark, text, code, name):
    got = spark.createDataFrame([(text,)], "t string").select(course.parse_context(F.col("t")).alias("c")).first().c
    assert (got and (got.course_code, got.course_name)) == (code and (code, name))
    if got:
        assert got.ay in ("2025/26", "2024/25") and got.term in "zl" and got.semester_code.lower().endswith("sem")


def test_codes_of_files_are_worked_out_once(spark):
    """The pattern of file names stands once for each of its groups in the plan, however many fields are made of the code."""
    from lectern.functions.course import FILE, code_from_file, parse_code

    rows = spark.createDataFrame([("WFAnstj5sem-Name-CL-202526z",), ("x",), (None,)], "name string")
    found = rows.select(parse_code(code_from_file(F.col("name"))).alias("c"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count(FILE[:20]) <= 7
    assert [r.c and r.c.course_name for r in found.collect()] == ["Name-Ćwiczenia laboratoryjne", None, None]
