import datetime as dt

import pytest

from quayside.operators.mapping import (drop_audit, fill_missing_required, fill_sentinel, incremental_window,
                                        map_lenient, map_strict, missing_columns)
from helpers import rows


def test_map_strict_order_dots_and_passthrough(spark):
    df = spark.createDataFrame([("1", "a", "x", "e")], "`Т.Н.` string, `Имя` string, extra string, already string")
    out = map_strict(df, [("Имя", "name"), ("Т.Н.", "talon"), ("missing_src", "already")])
    assert out.columns == ["name", "talon", "already"]
    assert rows(out) == [("a", "1", "e")]


def test_map_strict_reports_all_missing(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError, match="b.*c"):
        map_strict(df, {"a": "x", "b": "y", "c": "z"})


def test_map_lenient_and_missing(spark):
    df = spark.createDataFrame([("1", "2")], "`a.b` string, keep string")
    out = map_lenient(df, {"a.b": "ab", "nope": "n"})
    assert out.columns == ["ab", "keep"]
    assert missing_columns(df, {"a.b": "ab", "nope": "n"}) == ["nope"]


def test_fill_required_and_sentinel(spark):
    df = spark.createDataFrame([("1", None, True, None)], "k string, v string, is_complex boolean, n int")
    out = fill_sentinel(fill_missing_required(df, ["k", "v", "w", "is_complex"]))
    assert out.columns == ["k", "v", "is_complex", "n", "w"]
    assert rows(out) == [("1", "-", True, None, "-")]


def test_drop_audit_case_insensitive(spark):
    df = spark.createDataFrame([("1", "x", "y")], "k string, Created_At string, UPDATED_AT string")
    assert drop_audit(df).columns == ["k"]


def test_incremental_window_pushdown(spark):
    df = spark.createDataFrame([(1, dt.datetime(2023, 12, 31), dt.datetime(2024, 3, 1)),
                                (2, dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 13)),
                                (3, dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 14))],
                               "id int, start timestamp, changed timestamp")
    out = incremental_window(df, "start", "changed", dt.date(2024, 3, 15))
    assert [r.id for r in out.collect()] == [3]


def test_table_columns_string_and_varchar(spark):
    from quayside.sources.catalog import table_columns

    spark.sql("DROP TABLE IF EXISTS tc_vc")
    spark.sql("CREATE TABLE tc_vc (a VARCHAR(10), b INT, c STRING, d CHAR(2)) USING parquet")
    assert table_columns(spark, "tc_vc") == ["a", "c", "d"]
    assert table_columns(spark, "tc_vc", kind="varchar") == ["a"]
    import pytest

    spark.sql("DROP TABLE IF EXISTS tc_int")
    spark.sql("CREATE TABLE tc_int (b INT) USING parquet")
    with pytest.raises(ValueError):
        table_columns(spark, "tc_int")
