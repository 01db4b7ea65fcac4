import datetime as dt
import os

from pyspark.sql import functions as F

from quayside.landing import land, land_bytes
from quayside.plans.flows import run_claims, run_journal, run_routed_claims
from quayside.sinks.snapshot import VersionedTable
from quayside.spec import TableSpec, load_specs
from quayside.streaming.ingest import run_once
from helpers import rows

T1, T2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)

SPEC = TableSpec("load_data_reference", "Справки*", (("Серия и номер", "series_number"), ("ФИО", "full_name")),
                 ("series_number",), encoding="cp1251", delimiter=";")


def test_journal_last_row_wins_and_required(spark, scratch):
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО;Лишнее\n1;А;x\n2;Б;x\n1;В;x\n".encode("cp1251"),
               mtime="2024-01-01 00:00:00")
    land_bytes(spark, landing, "Справки_2.csv", "Серия и номер;ФИО\n2;Г\n3;NA\n".encode("cp1251"),
               mtime="2024-01-01 00:00:10")
    land_bytes(spark, landing, "Справки_3.csv", "Серия и номер;ФИО\n9;young\n".encode("cp1251"),
               mtime="2024-01-02 00:00:00")
    land_bytes(spark, landing, "other.csv", b"x\n", mtime="2024-01-01 00:00:00")
    target = VersionedTable(spark, "ref_t", root=os.path.join(scratch, "t"))
    res = run_journal(spark, SPEC, landing, target, as_of="2024-01-02 00:00:30", now="2024-02-01 00:00:00",
                      required=["series_number", "full_name", "errors"])
    assert rows(target.read(), "series_number", "full_name", "errors") == [("1", "В", "-"), ("2", "Г", "-"),
                                                                            ("3", "-", "-")]
    assert res.report.first().final_count == 3
    assert sorted(os.path.basename(p) for p in res.files) == ["Справки_1.csv", "Справки_2.csv"]


def test_run_once_skips_handled_files(spark, scratch):
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    target = VersionedTable(spark, "ref_o", root=os.path.join(scratch, "t"))
    ledger = VersionedTable(spark, "ref_l", root=os.path.join(scratch, "l"))
    r1 = run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[])
    assert len(r1.files) == 1
    r2 = run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-02 00:00:00", required=[])
    assert r2.files == []
    # a re-upload under the same name (new length) is processed again
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;Бэ\n".encode("cp1251"), mtime="2024-01-01")
    r3 = run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-03 00:00:00", required=[])
    assert len(r3.files) == 1
    assert rows(target.read(), "series_number", "full_name", "created_at") == [("1", "Бэ", dt.datetime(2024, 2, 1))]


def test_claims_split_loads(spark, scratch):
    b1 = spark.createDataFrame([("1", "a", "x"), ("1", "a", "y"), ("2", "a", "z"), ("3", None, "n1"),
                                ("3", None, "n2")], "talon string, source string, v string")
    normal = VersionedTable(spark, "cl_n", root=os.path.join(scratch, "n"), label="claims_normal")
    rep = VersionedTable(spark, "cl_r", root=os.path.join(scratch, "r"), label="claims_repeated")
    rep1 = run_claims(spark, b1, ["talon", "source"], normal, rep, now="2024-02-01 00:00:00")
    # null key parts: not repeated; filled to '-' they collide, last one wins
    assert rows(normal.read(), "talon", "source", "v") == [("2", "a", "z"), ("3", "-", "n2")] or \
        rows(normal.read(), "talon", "source", "v") == [("2", "a", "z"), ("3", "-", "n1")]
    assert {r.table_name: r.final_count for r in rep1.collect()} == {"claims_normal": 2, "claims_repeated": 2}
    b2 = spark.createDataFrame([("1", "a", "w"), ("2", "a", "q"), ("2", "a", "r")], "talon string, source string, v string")
    run_claims(spark, b2, ["talon", "source"], normal, rep, now="2024-02-02 00:00:00")
    # tables are independent (as in the reference): a key repeated yesterday and
    # normal today keeps its old repeated rows, and the reverse
    assert rows(rep.read(), "talon", "v", "created_at") == [("1", "x", T1), ("1", "y", T1), ("2", "q", T2),
                                                            ("2", "r", T2)]
    assert ("1", "a", "w", T2) in rows(normal.read(), "talon", "source", "v", "created_at")
    assert ("2", "a", "z", T1) in rows(normal.read(), "talon", "source", "v", "created_at")


def test_spec_loader_and_routed_claims(spark, scratch):
    specs = load_specs({"tables": {
        "talons": {"file": {"file_pattern": "journal_20*", "file_format": "csv"},
                   "mapping_fields": {"Талон": "talon", "Источник": "source", "Статус": "status"},
                   "column_check": ["talon", "source"], "encoding": "utf-8", "delimiter": ";"},
        "oms": {"file": {"file_pattern": "journal_20*", "file_format": "csv"},
                "mapping_fields": {"Талон": "talon", "Источник": "source"},
                "column_check": ["talon", "source"], "encoding": "utf-8", "delimiter": ";"}}})
    assert list(specs) == ["talons", "oms"] and specs["talons"].name_pattern == "journal_20*.csv"
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "journal_2024_1.csv", "Талон;Источник;Статус\n1;a;s\n".encode(), mtime="2024-01-01")
    land_bytes(spark, landing, "journal_2024_2.csv", "Талон;Источник;Статус\n1;a;s\n1;a;t\n2;b;u\n".encode(),
               mtime="2024-01-01")
    normal = VersionedTable(spark, "rc_n", root=os.path.join(scratch, "n"))
    rep = VersionedTable(spark, "rc_r", root=os.path.join(scratch, "r"))
    name, report = run_routed_claims(spark, list(specs.values()), ["oms", "talons"], landing, normal, rep,
                                     required=["talon", "source", "status", "goal", "is_complex"])
    assert name == "talons"
    assert rows(normal.read(), "talon", "status", "goal", "is_complex") == [("2", "u", "-", False)]
    assert rows(rep.read(), "talon", "status") == [("1", "s"), ("1", "t")]
    assert "created_at" not in normal.read().columns


def test_land_parts(spark, scratch):
    df = spark.range(10).select(F.col("id").cast("string").alias("Номер")).repartition(3)
    paths = land(df, os.path.join(scratch, "landing"), "Справки_x", mtime="2024-01-01", encoding="cp1251")
    assert len(paths) >= 1


def test_keep_stored_and_move_between(spark, scratch):
    landing = os.path.join(scratch, "landing")
    target = VersionedTable(spark, "ks_t", root=os.path.join(scratch, "t"))
    target.publish(spark.createDataFrame([("1", "old", "kept", T1, T1)],
                                         "series_number string, full_name string, errors string, "
                                         "created_at timestamp, updated_at timestamp"))
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;new\n2;two\n".encode("cp1251"),
               mtime="2024-01-01")
    run_journal(spark, SPEC, landing, target, as_of="2024-01-02", now="2024-02-01 00:00:00", required=["errors"],
                overwrite_missing=False)
    assert rows(target.read(), "series_number", "full_name", "errors") == [("1", "new", "kept"), ("2", "two", "-")]

    normal = VersionedTable(spark, "mb_n", root=os.path.join(scratch, "n"))
    rep = VersionedTable(spark, "mb_r", root=os.path.join(scratch, "r"))
    b1 = spark.createDataFrame([("1", "a"), ("2", "a"), ("2", "a")], "talon string, source string")
    run_claims(spark, b1, ["talon", "source"], normal, rep, now="2024-02-01 00:00:00", move_between=True)
    b2 = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a")], "talon string, source string")
    run_claims(spark, b2, ["talon", "source"], normal, rep, now="2024-02-02 00:00:00", move_between=True)
    assert rows(normal.read(), "talon") == [("2",)]
    assert rows(rep.read(), "talon") == [("1",), ("1",)]


def test_stale_runs_relaunch_only_when_asked(spark):
    import datetime as dt
    from quayside.sources.files import plan_file_actions

    t = dt.datetime(2024, 1, 1)
    m = spark.createDataFrame([("a.csv", t, 1), ("b.csv", t, 1)], "name string, mtime timestamp, length long")
    led = spark.createDataFrame([("a.csv", t, 1, "r", "RUNNING", t), ("b.csv", t, 1, "r", None, t + dt.timedelta(days=2))],
                                "name string, mtime timestamp, length long, run_key string, run_status string, "
                                "started_at timestamp")
    assert {r.name: r.action for r in plan_file_actions(m, led).collect()} == {"a.csv": "wait", "b.csv": "wait"}
    got = plan_file_actions(m, led, stale_before="2024-01-02 00:00:00").collect()
    assert {r.name: r.action for r in got} == {"a.csv": "relaunch", "b.csv": "wait"}


def test_journal_with_dotted_cp1251_headers(spark, scratch):
    """A journal shaped like the EMD export: cp1251, dotted headers, a space in the pattern."""
    spec = load_specs({"tables": {"load_data_emd": {
        "file": {"file_pattern": "Журнал ЭМД*", "file_format": "csv"},
        "mapping_fields": {"ИД": "epmd_id", "Дата отправки в РИР.РЭМД": "sending_date",
                           "Статус отправки в РИР.РЭМД": "sending_status"},
        "column_check": ["epmd_id"], "encoding": "cp1251", "delimiter": ";"}}})["load_data_emd"]
    landing = os.path.join(scratch, "landing")
    body = ("ИД;Дата отправки в РИР.РЭМД;Статус отправки в РИР.РЭМД;Лишнее\n"
            "7;01.02.2024;\"Отправлен; «ок»\";x\n8;;NULL;y\n7;02.02.2024;Ошибка;z\n")
    land_bytes(spark, landing, "Журнал ЭМД 2024.csv", body.encode("cp1251"), mtime="2024-01-01")
    target = VersionedTable(spark, "emd_t", root=os.path.join(scratch, "t"))
    res = run_journal(spark, spec, landing, target, as_of="2024-01-02", now="2024-02-01 00:00:00",
                      required=["epmd_id", "sending_date", "sending_status", "doctor"])
    assert res.report.first().final_count == 2
    assert rows(target.read(), "epmd_id", "sending_date", "sending_status", "doctor") == [
        ("7", "02.02.2024", "Ошибка", "-"), ("8", "-", "-", "-")]


def test_run_once_archives_loaded_files_next_tick(spark, scratch):
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    land_bytes(spark, landing, "Справки_2.csv", "Серия и номер;ФИО\n2;Б\n".encode("cp1251"))  # young
    target = VersionedTable(spark, "ar_t", root=os.path.join(scratch, "t"))
    ledger = VersionedTable(spark, "ar_l", root=os.path.join(scratch, "l"))
    archive = os.path.join(scratch, "archive")
    r1 = run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[],
                  archive_dir=archive)
    assert [os.path.basename(p) for p in r1.files] == ["Справки_1.csv"]
    run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-02 00:00:00", required=[], archive_dir=archive)
    left = [n for n in os.listdir(landing) if not n.startswith(".")]
    assert left == ["Справки_2.csv"]          # the young file was never read, so it stays
    assert "Справки_1.csv" in os.listdir(archive)


def test_cli_journal_and_claims(spark, scratch):
    import json

    from quayside.plans.cli import main

    mapping = os.path.join(scratch, "mapping.json")
    with open(mapping, "w", encoding="utf-8") as f:
        json.dump({"tables": {
            "refs": {"file": {"file_pattern": "Справки*", "file_format": "csv"},
                     "mapping_fields": {"Серия и номер": "series_number", "ФИО": "full_name"},
                     "column_check": ["series_number"], "encoding": "cp1251", "delimiter": ";"},
            "talons": {"file": {"file_pattern": "journal_20*", "file_format": "csv"},
                       "mapping_fields": {"Талон": "talon", "Источник": "source", "Статус": "status"},
                       "column_check": ["talon", "source"], "encoding": "utf-8", "delimiter": ";"}}},
            f, ensure_ascii=False)
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    land_bytes(spark, landing, "journal_2024.csv", "Талон;Источник;Статус\n1;a;x\n1;a;y\n2;a;z\n".encode(),
               mtime="2024-01-01")
    root = os.path.join(scratch, "tables")
    assert main(["journal", "--mapping", mapping, "--table", "refs", "--landing", landing, "--root", root,
                 "--as-of", "2024-01-02 00:00:00", "--required"]) == 0
    assert rows(VersionedTable(spark, "refs", root=os.path.join(root, "refs")).read(), "series_number") == [("1",)]
    assert main(["claims", "--mapping", mapping, "--table", "talons", "--landing", landing, "--root", root,
                 "--as-of", "2024-01-02 00:00:00"]) == 0
    assert rows(VersionedTable(spark, "talons_complex", root=os.path.join(root, "talons_complex")).read(),
                "talon", "status") == [("1", "x"), ("1", "y")]


def test_cli_tick_twice(spark, scratch):
    import json

    from quayside.plans.cli import main

    mapping = os.path.join(scratch, "mapping.json")
    with open(mapping, "w", encoding="utf-8") as f:
        json.dump({"tables": {"ticks": {"file": {"file_pattern": "Справки*", "file_format": "csv"},
                                        "mapping_fields": {"Серия и номер": "series_number", "ФИО": "full_name"},
                                        "column_check": ["series_number"], "encoding": "cp1251",
                                        "delimiter": ";"}}}, f, ensure_ascii=False)
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    root, archive = os.path.join(scratch, "tables"), os.path.join(scratch, "archive")
    args = ["tick", "--mapping", mapping, "--table", "ticks", "--landing", landing, "--root", root,
            "--as-of", "2024-01-02 00:00:00", "--required", "--archive", archive]
    assert main(args) == 0 and main(args) == 0
    assert "Справки_1.csv" in os.listdir(archive)
    assert VersionedTable(spark, "ticks", root=os.path.join(root, "ticks")).versions() == [1]


def test_legacy_required_list_fills_routed_claims(spark, scratch):
    from quayside.functions.tokens import LEGACY_CLAIMS_REQUIRED

    assert len(LEGACY_CLAIMS_REQUIRED) == 45 and LEGACY_CLAIMS_REQUIRED[-1] == "is_complex"
    specs = load_specs({"tables": {"talons": {
        "file": {"file_pattern": "journal_20*", "file_format": "csv"},
        "mapping_fields": {"Талон": "talon", "Источник": "source", "Статус": "status"},
        "column_check": ["talon", "source"], "encoding": "utf-8", "delimiter": ";"}}})
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "journal_2024.csv", "Талон;Источник;Статус\n1;a;s\n".encode(), mtime="2024-01-01")
    normal = VersionedTable(spark, "lg_n", root=os.path.join(scratch, "n"))
    rep = VersionedTable(spark, "lg_r", root=os.path.join(scratch, "r"))
    run_routed_claims(spark, list(specs.values()), ["talons"], landing, normal, rep, LEGACY_CLAIMS_REQUIRED)
    cols = normal.read().columns
    assert cols[:3] == ["talon", "source", "status"] and set(LEGACY_CLAIMS_REQUIRED) <= set(cols)
    assert normal.read().first()["uet"] == "-"


def test_journal_quarantines_bad_rows(spark, scratch):
    import pytest

    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n2;Б;лишнее\n3;В\n".encode("cp1251"),
               mtime="2024-01-01")
    target = VersionedTable(spark, "qr_t", root=os.path.join(scratch, "t"))
    with pytest.raises(Exception, match="more fields"):
        run_journal(spark, SPEC, landing, target, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[])
    quarantine = VersionedTable(spark, "qr_q", root=os.path.join(scratch, "q"))
    run_journal(spark, SPEC, landing, target, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[], on_bad="quarantine",
                quarantine=quarantine)
    assert rows(target.read(), "series_number") == [("1",), ("3",)]
    bad = quarantine.read().collect()
    assert len(bad) == 1 and bad[0].fields["Серия и номер"] == "2" and "Справки_1.csv" in bad[0].bad_reason
    assert bad[0].record == "2;Б;лишнее"


def test_file_lacking_a_mapped_column_fails_the_load(spark, scratch):
    import pytest

    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    land_bytes(spark, landing, "Справки_2.csv", "Серия и номер;Другое\n2;Б\n".encode("cp1251"), mtime="2024-01-01")
    target = VersionedTable(spark, "mc_t", root=os.path.join(scratch, "t"))
    with pytest.raises(ValueError, match="Справки_2.csv.*ФИО"):
        run_journal(spark, SPEC, landing, target, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[])
    assert not target.exists()


def test_run_once_records_failure_then_relaunches(spark, scratch):
    import pytest

    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А;лишнее\n".encode("cp1251"),
               mtime="2024-01-01")
    target = VersionedTable(spark, "rf_t", root=os.path.join(scratch, "t"))
    ledger = VersionedTable(spark, "rf_l", root=os.path.join(scratch, "l"))
    with pytest.raises(Exception):
        run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-01 00:00:00", required=[])
    assert [r.run_status for r in ledger.read().collect()] == ["FAILURE"]
    # the file is fixed and re-uploaded: a new identity, launched again; the old failure stays recorded
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;А\n".encode("cp1251"), mtime="2024-01-01")
    r = run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02", now="2024-02-02 00:00:00", required=[])
    assert len(r.files) == 1 and rows(target.read(), "series_number") == [("1",)]


CLAIM = TableSpec("claims", "j*", (("Талон", "talon"), ("Источник", "source"), ("v", "v")), ("talon", "source"),
                  delimiter=";")


def test_claims_files_apply_one_after_the_other(spark, scratch):
    from quayside.plans.flows import run_claims_files

    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "j1.csv", "Талон;Источник;v\n1;a;x\n2;a;y\n3;b;p\n3;b;q\n4;NA;m\n".encode(), mtime="2024-01-01")
    land_bytes(spark, landing, "j2.csv", "Талон;Источник;v\n1;a;day2\n3;b;r\n3;b;s\n4;-;n\n".encode(), mtime="2024-01-01")
    normal = VersionedTable(spark, "cf_n", root=os.path.join(scratch, "n"))
    rep = VersionedTable(spark, "cf_r", root=os.path.join(scratch, "r"))
    run_claims_files(spark, CLAIM, landing, normal, rep, as_of="2024-01-02", now="2024-02-01")
    assert rows(normal.read(), "talon", "source", "v") == [("1", "a", "day2"), ("2", "a", "y"), ("4", "-", "n")]
    assert rows(rep.read(), "talon", "v") == [("3", "r"), ("3", "s")]


def test_null_key_part_meets_a_literal_dash(spark, scratch):
    batch = spark.createDataFrame([("1", None, "x"), ("1", "-", "y")], "talon string, source string, v string")
    normal = VersionedTable(spark, "nd_n", root=os.path.join(scratch, "n"))
    rep = VersionedTable(spark, "nd_r", root=os.path.join(scratch, "r"))
    run_claims(spark, batch, ["talon", "source"], normal, rep, now="2024-02-01")
    assert normal.read().count() == 1


def test_replace_strategy(spark, scratch):
    import pytest

    spec = TableSpec("rs", "j*", (("k", "k"), ("v", "v")), ("k",), delimiter=";", strategy="replace")
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "j1.csv", b"k;v\n1;a\n1;b\n2;c\n", mtime="2024-01-01")
    land_bytes(spark, landing, "j2.csv", b"k;v\n1;d\n1;e\n", mtime="2024-01-01")
    target = VersionedTable(spark, "rs_t", root=os.path.join(scratch, "t"))
    run_journal(spark, spec, landing, target, as_of="2024-01-02", now="2024-02-01", required=[])
    assert rows(target.read(), "k", "v") == [("1", "d"), ("1", "e"), ("2", "c")]
    with pytest.raises(ValueError, match="two tables"):
        run_journal(spark, TableSpec("rs", "j*", (("k", "k"),), ("k",), strategy="split"), landing, target,
                    as_of="2024-01-02", now="2024-02-01")


def test_tick_fail_then_success_then_idle_then_empty_then_reupload(spark, scratch):
    import pytest

    landing, archive = os.path.join(scratch, "landing"), os.path.join(scratch, "archive")
    target = VersionedTable(spark, "tk_t", root=os.path.join(scratch, "t"))
    ledger = VersionedTable(spark, "tk_l", root=os.path.join(scratch, "l"))
    good, bad = "Серия и номер;ФИО\n1;А\n".encode("cp1251"), "Серия и номер;ФИО\n2;Б;лишнее\n".encode("cp1251")
    land_bytes(spark, landing, "Справки_1.csv", good, mtime="2024-01-01")
    land_bytes(spark, landing, "Справки_2.csv", bad, mtime="2024-01-01")
    land_bytes(spark, landing, "Справки_9.csv", good, mtime="2024-01-02 00:00:00")     # young
    land_bytes(spark, landing, "notes.txt", b"junk", mtime="2024-01-01")

    def tick(day):
        return run_once(spark, SPEC, landing, target, ledger, as_of="2024-01-02 00:00:30",
                        now=f"2024-02-0{day} 00:00:00", required=[], archive_dir=archive)

    with pytest.raises(Exception, match="more fields"):
        tick(1)
    states = rows(ledger.read(), "name", "run_status")
    assert states == [("notes.txt", "QUARANTINED"), ("Справки_1.csv", "FAILURE"), ("Справки_2.csv", "FAILURE")]
    land_bytes(spark, landing, "Справки_2.csv", "Серия и номер;ФИО\n2;Б\n".encode("cp1251"), mtime="2024-01-01")
    assert len(tick(2).files) == 2 and rows(target.read(), "series_number") == [("1",), ("2",)]
    assert tick(3).files == [] and sorted(os.listdir(landing)) == sorted(
        n for n in os.listdir(landing) if not n.startswith("Справки_1") and not n.startswith("Справки_2"))
    assert tick(4).files == []
    for name in ("Справки_9.csv", "notes.txt"):
        os.rename(os.path.join(landing, name), os.path.join(scratch, name))
    assert tick(5).files == [] and tick(5).report.first().status == "skipped"
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;Новый\n".encode("cp1251"), mtime="2024-01-01")
    assert len(tick(6).files) == 1
    tick(7)
    names = [n for n in os.listdir(archive) if n.startswith("Справки_1")]
    assert len([n for n in names if n.endswith(".csv")]) == 2      # both uploads of one name are kept


def test_required_columns_do_not_depend_on_the_catalog(spark, scratch):
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "t")
    stored = VersionedTable(spark, "rq_a", root=root)
    stored.publish(spark.createDataFrame([("1", "old", "kept", T1, T1)],
                                         "series_number string, full_name string, errors string, "
                                         "created_at timestamp, updated_at timestamp"))
    land_bytes(spark, landing, "Справки_1.csv", "Серия и номер;ФИО\n1;new\n".encode("cp1251"), mtime="2024-01-01")
    fresh = VersionedTable(spark, "rq_b", root=root)      # a name that the catalog has never seen
    run_journal(spark, SPEC, landing, fresh, as_of="2024-01-02", now="2024-02-01")
    assert rows(fresh.read(), "series_number", "full_name", "errors") == [("1", "new", "-")]


def test_exports_of_the_atomic_load_are_several_files(spark, monkeypatch):
    from quayside import queries
    from helpers import SF

    landed = []
    monkeypatch.setattr(queries, "_land_lines", lambda *a, land=queries._land_lines, **kw: landed.append(land(*a, **kw)) or landed[-1])
    out = queries.q_claims_atomic_rows(spark, SF).where("table_name = 'handled'").collect()
    assert landed == [4, 4]  # as many as a shuffle has partitions here
    assert [(r.n_rows, r.least) for r in out] == [(1, "claims_day1")]
