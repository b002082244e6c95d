"""Wall clock times over both clock changes."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from lectern.operators.zones import in_zone
from lectern.sources import logs

AUTUMN = ["01:59", "02:00", "02:30", "02:59", "02:00", "02:30", "03:00"]  # the 26th of October 2025 in Warsaw
UTC = ["23:59", "00:00", "00:30", "00:59", "01:00", "01:30", "02:00"]


def instants(spark, files, zone="Europe/Warsaw", day="2025-10-26"):
    rows = [(f, n, dt.datetime.fromisoformat(f"{day} {t}") if t else None) for f, times in files.items() for n, t in enumerate(times)]
    df = spark.createDataFrame(rows, "file string, line long, at timestamp").repartition(3)
    got = {}
    for r in in_zone(df, zone, "at", ["file"], "line").collect():
        got.setdefault(r.file, {})[r.line] = r.at and r.at.strftime("%H:%M")
    return {f: [x[n] for n in range(len(x))] for f, x in got.items()}


def test_doubled_hour_goes_by_the_files_order(spark):
    files = {"up": AUTUMN, "down": AUTUMN[::-1], "one pass": ["01:00", "02:10", "02:20", "03:10"], "late only": ["02:50", "02:10"], "gaps": ["01:30", None, "02:40", None, "02:40", "02:10", "02:50", "04:00"], None: ["02:30", "02:20", "03:00"]}
    got = instants(spark, files)
    assert got["up"] == UTC and got["down"] == UTC[::-1]
    assert got["one pass"] == ["23:00", "00:10", "00:20", "02:10"]
    assert got["late only"] == ["00:50", "00:10"]  # it falls, so in its order there is no jump back
    assert got["gaps"] == ["23:30", None, "00:40", None, "00:40", "01:10", "01:50", "03:00"]
    assert got[None] == ["00:30", "01:20", "02:00"]


def test_missing_hour_counts_by_the_offset_before(spark):
    assert instants(spark, {"a": ["01:59", "02:00", "02:30", "03:00", "03:30"]}, day="2026-03-29")["a"] == ["00:59", "01:00", "01:30", "01:00", "01:30"]


@pytest.mark.parametrize("zone,day,times", [("Australia/Lord_Howe", "2026-04-05", ["01:20", "01:45", "01:40", "02:10"]), ("America/New_York", "2025-11-02", ["01:10", "01:50", "01:05", "02:00"]), ("UTC", "2025-10-26", ["02:00", "02:30", "02:10"]), ("Asia/Kolkata", "2025-10-26", ["02:00", "02:10"])])
def test_other_zones(spark, zone, day, times):
    wall = [dt.datetime.fromisoformat(f"{day} {t}") for t in times]
    fold, want = 0, []
    for k, w in enumerate(wall):
        twice = w.replace(tzinfo=ZoneInfo(zone), fold=0).utcoffset() != w.replace(tzinfo=ZoneInfo(zone), fold=1).utcoffset()
        fold = int(twice and (fold or (k > 0 and w < wall[k - 1])))
        want.append(w.replace(tzinfo=ZoneInfo(zone), fold=fold).astimezone(dt.UTC).strftime("%H:%M"))
    assert instants(spark, {"a": times}, zone, day)["a"] == want


def test_log_files_of_a_zone(spark, tmp_path):
    lines = "".join(f"2025-10-26 {t};n{k}\n" for k, t in enumerate(AUTUMN))
    (tmp_path / "logs_A_20251027-0000.csv").write_bytes(f"Czas;Opis\n{lines}soon;x\n".encode())
    root = f"file://{tmp_path}"
    got = {r.payload["Opis"]: r.time_ts for r in logs.raw_events(spark, root, log_timezone="Europe/Warsaw").collect()}
    assert [got[f"n{k}"].strftime("%H:%M") for k in range(len(AUTUMN))] == UTC and got["x"] is None
    plain = {r.payload["Opis"]: r.time_ts for r in logs.raw_events(spark, root).collect()}
    assert [plain[f"n{k}"].strftime("%H:%M") for k in range(len(AUTUMN))] == AUTUMN
