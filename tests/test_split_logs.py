"""Lines read by many tasks give the records that readers of whole files give."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.plans import pipeline
from lectern.sources import logs, split_logs


def same(spark, root):
    columns = ["course", "time_text", "time_ts", "row_key", "payload", "source_file", "course_id"]
    at = F.lit("1970-01-01")
    rows = lambda df: [[str(r[c]) for c in columns] for r in df.orderBy("source_file", "line_no").collect()]
    whole, split = rows(logs.log_rows(logs.files(spark, root), at)), rows(split_logs.log_rows(spark, root, at))
    assert split == whole
    return whole


FILES = {
    "A": "Czas;Opis;Nr\n2026-01-01;Zażółć;1\n \n2026-01-02;\"q;u\"\"o\";2\n;;\n2026-01-03;short\n2026-01-04;long;1;2;3\n".encode(),
    "B": "﻿Czas,Opis\r\n2026-01-01,bom\r\n".encode(),
    "C": "Time\tOpis\n2026-01-01\tŚliwka\n".encode("cp1250"),
    "D": b"Czas,Opis\r2026-01-01,carriage\r2026-01-02, trim \xc2\xa0\r",
    "E": b'Czas;Opis\n2026-01-01;"two\nlines"\n',
    "F": b'Czas;Opis\n2026-01-01;in"side\n2026-01-02; "x"\n',
    "G": b'Czas;Opis\n2026-01-01;open "quote\n2026-01-02;"never closed\nmore\n',
    "H": b";;\n \n\"\";\"\"\nCzas;;Czas\n2026-01-01;a;b\n",
    "I": b"", "J": b"\n\n", "K": b"Czas;Opis\n", "L": b";;\n;;\n", "M": b"Czas\n2026-01-01\n",
    "N o+%": b"Czas;Opis\n2026-01-01;name\n", "O": b"Czas;Opis\nCzas;Opis\n2026-01-01;same head\n",
    "P": b"a b,c;Opis;x\n2026-01-01,1;\"a,b\";\x1f u \x1c\n",
}


def test_odd_and_regular_files(spark, tmp_path):
    for k, data in FILES.items():
        (tmp_path / f"logs_{k}_20260101-0000.csv").write_bytes(data)
    (tmp_path / "other.csv").write_bytes(b"Czas;Opis\n2026-01-01;no log\n")
    assert len(same(spark, f"file://{tmp_path}")) > 15
    found = split_logs.lines(spark, f"file://{tmp_path}")
    regular = {r.path.split("/")[-1].split("_")[1]: r.regular for r in split_logs.file_traits(found).collect() if "logs_" in r.path}
    assert {k for k, v in regular.items() if not v} == {"E", "F", "G", "L"} and "N o+%" in regular


@pytest.mark.parametrize("seed", range(3))
def test_random_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    bits = ["a", "ż", " ", ";", ",", '"', '""', "\n", "\r\n", "2026-01-01", "x y", ";;", "\t"]
    for k in range(40):
        text = rng.choice(["Czas;Opis\n", "Czas,Opis,\n", ""]) + "".join(rng.choice(bits) for _ in range(rng.randrange(60)))
        (tmp_path / f"logs_R{k}_20260101-0000.csv").write_bytes(text.encode(rng.choice(["utf-8", "cp1250"])))
    same(spark, f"file://{tmp_path}")


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    lines = [f'2026-01-01 10:{i % 60:02}:00;"note; {i}";{"x" * (i % 50)}' for i in range(30_000)]
    (tmp_path / "logs_BIG_20260101-0000.csv").write_bytes(("Czas;Opis;x\n" + "\n".join(lines)).encode())
    (tmp_path / "logs_SMALL_20260101-0000.csv").write_bytes(b"Time\tOpis\n2026-01-01\tsmall\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        found = split_logs.lines(spark, f"file://{tmp_path}")
        assert found.rdd.getNumPartitions() > 15
        assert len({r[0] for r in found.filter("path like '%BIG%'").select(F.spark_partition_id()).distinct().collect()}) > 15
        got = split_logs.log_rows(spark, f"file://{tmp_path}", F.lit("1970-01-01"))
        assert got.count() == 30_001 and got.filter("course = 'BIG'").select("line_no").distinct().count() == 30_000
        made = pipeline.merge_logs(spark, f"file://{tmp_path}", f"file://{tmp_path}/table", split=True)
        assert made == pipeline.Merged("OK", 2, 2, 30_001, 30_001)
        numbers = [int(r.payload["Opis"].split()[1]) for r in got.filter("course = 'BIG'").orderBy("line_no").collect()]
        assert numbers == list(range(30_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
