import datetime as dt
import os

import pytest

from quayside.sinks.files import archive_files, retire_files
from quayside.sources.files import (classify_files, discover_files, latest_by_name, latest_by_time,
                                    plan_file_actions, route_files)
from helpers import rows


def manifest(spark):
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    data = [("/l/journal_2024a.csv", "journal_2024a.csv", t, 10), ("/l/journal_2024b.csv", "journal_2024b.csv", t, 5),
            ("/l/journal_doctor1.csv", "journal_doctor1.csv", t + dt.timedelta(seconds=30), 7),
            ("/l/junk.txt", "junk.txt", t, 1)]
    return spark.createDataFrame(data, "path string, name string, mtime timestamp, length long")


def test_classify(spark):
    out = classify_files(manifest(spark), "journal_*.csv", dt.datetime(2024, 1, 1, 12, 1, 0), 60)
    assert dict((r.name, r.state) for r in out.collect()) == {
        "journal_2024a.csv": "valid", "journal_2024b.csv": "valid", "journal_doctor1.csv": "young",
        "junk.txt": "invalid"}


def test_latest(spark):
    m = manifest(spark)
    assert latest_by_name(m).first().name == "junk.txt"
    assert latest_by_time(m, keep=["name"]).first().name == "journal_doctor1.csv"


def test_route_first_registered_wins(spark):
    m = manifest(spark)
    routes = [("talons", "journal_20*.csv", False), ("doctors", "journal_doctor*.csv", True),
              ("oms", "journal_20*.csv", True)]
    assert rows(route_files(m, routes).select("table_name", "name")) == [("doctors", "journal_doctor1.csv")]
    every = route_files(m, routes, all_matches=True).select("table_name", "name")
    assert rows(every) == [("doctors", "journal_doctor1.csv"), ("oms", "journal_2024b.csv")]


def test_plan_actions_reupload_is_new(spark):
    m = manifest(spark)
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    ledger = spark.createDataFrame(
        [("journal_2024a.csv", t, 10, "r1", "SUCCESS"), ("journal_2024b.csv", t, 4, "r2", "SUCCESS"),
         ("journal_doctor1.csv", t + dt.timedelta(seconds=30), 7, "r3", "FAILURE"), ("junk.txt", t, 1, "r4", None)],
        "name string, mtime timestamp, length long, run_key string, run_status string")
    out = dict((r.name, r.action) for r in plan_file_actions(m, ledger).collect())
    assert out == {"journal_2024a.csv": "retire", "journal_2024b.csv": "launch", "journal_doctor1.csv": "relaunch",
                   "junk.txt": "wait"}


def test_retire(spark):
    out = classify_files(manifest(spark), "journal_*.csv", dt.datetime(2024, 1, 1, 12, 1, 0), 60)
    assert dict((r.name, r.run_status) for r in retire_files(out).collect()) == {
        "journal_2024a.csv": "RETIRED", "journal_2024b.csv": "RETIRED", "junk.txt": "QUARANTINED"}


def test_discover_and_archive(spark, scratch):
    for n in ("Рецепты 1.csv", "b.csv"):
        with open(os.path.join(scratch, n), "w") as f:
            f.write("x\n1\n")
    m = discover_files(spark, scratch)
    assert sorted(r.name for r in m.collect()) == ["b.csv", "Рецепты 1.csv"]
    assert all(r.length == 4 for r in m.collect())
    empty = os.path.join(scratch, "empty")
    os.mkdir(empty)
    with pytest.raises(FileNotFoundError):
        discover_files(spark, empty)
    with pytest.raises(Exception):
        discover_files(spark, os.path.join(scratch, "missing"))
    moved = archive_files(spark, [r.path for r in m.where("name = 'b.csv'").collect()], os.path.join(scratch, "arch"))
    assert len(moved) == 1 and os.path.exists(os.path.join(scratch, "arch", "b.csv"))
