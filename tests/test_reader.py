import contextlib
import os
import tempfile

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.sources.delimited import file_layout_report, null_tokens, read_delimited, read_delimited_split
from quayside.functions.tokens import PANDAS_NULL_TOKENS
from helpers import rows


def write(d, name, data: bytes):
    p = os.path.join(d, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def spark_vs_pandas(spark, path, sep=";", enc="utf-8"):
    got = null_tokens(read_delimited(spark, path, sep, enc, with_position=False))
    exp = pd.read_csv(path, sep=sep, dtype=str, encoding=enc)
    assert list(got.columns) == list(exp.columns)
    g = sorted([tuple(r) for r in got.collect()], key=repr)
    e = sorted([tuple(None if pd.isna(v) else v for v in r) for r in exp.itertuples(index=False)], key=repr)
    assert g == e


def test_quotes_newlines_tokens(spark, scratch):
    body = 'a;b;c\n1;"x;""y""\nz";\n2;NA;none\n3;Null;-\n4; NA;<NA>\n\n5;n/a;null\n'
    spark_vs_pandas(spark, write(scratch, "q.csv", body.encode()))


def test_all_null_tokens(spark, scratch):
    lines = ["k;v"] + [f"{i};{t}" for i, t in enumerate(PANDAS_NULL_TOKENS) if t]
    spark_vs_pandas(spark, write(scratch, "t.csv", ("\n".join(lines) + "\n").encode()))


def test_short_row_padded(spark, scratch):
    spark_vs_pandas(spark, write(scratch, "s.csv", b"a;b;c\n1;2\n3;4;5\n"))


def test_duplicate_header_and_bom(spark, scratch):
    spark_vs_pandas(spark, write(scratch, "d.csv", "﻿x;y;x;Ф.И.О.\n1;2;3;4\n".encode()))


def test_cp1251(spark, scratch):
    text = "Пациент;№ истории\nИванов;№ 5\nЁлкина;«б»\nА Б;ё\n"
    spark_vs_pandas(spark, write(scratch, "Справки 1.csv", text.encode("cp1251")), enc="cp1251")


def test_long_row_error(spark, scratch):
    p = write(scratch, "l.csv", b"x;y\n1;2;3\n4;5\n")
    with pytest.raises(Exception, match="more fields than the header"):
        read_delimited(spark, p, ";").collect()


def test_long_row_quarantine(spark, scratch):
    p = write(scratch, "l.csv", b"x;y\n1;2;3\n4;5\n")
    good, bad = read_delimited_split(spark, p, ";")
    assert rows(good.drop("_pos")) == [("4", "5")]
    assert bad.count() == 1


def test_every_overflow_is_seen_and_kept(spark, scratch):
    p = write(scratch, "o.csv", b'x;y\n1;2;;LOST\n3;4;\n5;;Z\n1;2;X3;Y4;Z5\n6\n7;\n8;"a;b"\n9;"c\nd"\n')
    with pytest.raises(Exception, match="more fields than the header"):
        read_delimited(spark, p, ";").collect()
    good, bad = read_delimited_split(spark, p, ";")
    assert rows(good.drop("_pos"))[:4] == [("6", None), ("7", None), ("8", "a;b"), ("9", "c\nd")] or \
        rows(good.drop("_pos"))[1][0] == "7"
    assert sorted(r["_record"] for r in bad.collect()) == ["1;2;;LOST", "1;2;X3;Y4;Z5", "3;4;", "5;;Z"]


STRAY = b'k;v;w;z\n1;5" pipe;"multi\nline";7" x\n2;b;c;d\n'


@contextlib.contextmanager
def splits_of(spark, size):
    """Files are cut into splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for n in names:
        spark.conf.set(n, str(size))
    try:
        yield
    finally:
        for n in names:
            spark.conf.unset(n)


@pytest.mark.parametrize("body", [STRAY, b"k;v\n1;a\n   \n2;b\n", b"k;v\n1;a\rb\n2;b\n", b"k;v\r\n1;a\r\n2;b\r\n",
                                  b"k;v\n1;a\n\t\n2;b", b'"k\nx";v\n1;"a\n\n\nb"\n\n2;c\n'])
def test_rows_do_not_depend_on_the_split_size(spark, scratch, body):
    p = write(scratch, "s.csv", body)
    parsed = rows(read_delimited(spark, p, ";", with_position=False))
    assert rows(read_delimited(spark, p, ";", with_position=False, multiline=True)) == parsed
    for size in (1, 4, 9):
        with splits_of(spark, size):
            assert rows(read_delimited(spark, p, ";", with_position=False)) == parsed


def test_line_ends_in_quotes_stay_as_pandas_keeps_them(spark, scratch):
    p = write(scratch, "s.csv", b'k;v\r\n1;"a\r\nb"\r\n2;"c\n"\r\n')
    for size in (3, 8, 1 << 20):
        with splits_of(spark, size):
            spark_vs_pandas(spark, p)


def test_blank_rows_of_tabs_stay(spark, scratch):
    p = write(scratch, "t.tsv", b"k\tv\tw\n1\ta\tb\n\t\t\n2\tc\td\n")
    for size in (3, 1 << 20):
        with splits_of(spark, size):
            for how in ("auto", True):
                got = read_delimited(spark, p, "\t", with_position=False, multiline=how).na.fill("")
                assert rows(got) == [("", "", ""), ("1", "a", "b"), ("2", "c", "d")]


PIECES = st.sampled_from(["a", "b c", "", '"x"', '"x;y"', '"p\nq"', '"\n"', '"d""e"', '"a\n\n""\nb"', '5" pipe', "\t", "\x01", "\x1c", " "])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(PIECES, min_size=1, max_size=3), min_size=1, max_size=9), st.sampled_from([";", "\t", ","]), st.sampled_from(["\n", "\r\n"]),
       st.integers(1, 40), st.booleans())
def test_any_split_equals_the_whole_parse(spark, table, sep, end, size, last):
    lines = [sep.join('"x%sy"' % sep if c == '"x;y"' else " " if c == sep else c for c in row) for row in table]
    body = end.join(["k" + sep + "l" + sep + "m", *lines]) + end * last
    folder = tempfile.mkdtemp(prefix="qs-test-")
    p = write(folder, "r.csv", body.encode())
    whole = rows(read_delimited(spark, p, sep, multiline=True, with_position=False))
    assert rows(read_delimited(spark, p, sep, with_position=False)) == whole
    with splits_of(spark, size):
        df = read_delimited(spark, p, sep)
        assert rows(df.drop("_pos")) == whole
        # file order: positions rise with the records
        assert [r[:-1] for r in df.orderBy("_pos").collect()] == [tuple(r) for r in read_delimited(spark, p, sep, multiline=True, with_position=False).collect()]


def test_a_quote_left_open_is_a_bad_row(spark, scratch):
    p = write(scratch, "u.csv", b'k;v\n1;a\n2;"b\n3;c\n4;d\n')
    for size in (5, 1 << 20):
        with splits_of(spark, size):
            with pytest.raises(Exception, match="a quote left open"):
                read_delimited(spark, p, ";").collect()
            good, bad = read_delimited_split(spark, p, ";")
            assert rows(good, "k", "v") == [("1", "a")] and bad.count() == 1


def test_quoted_newlines_are_read_by_several_tasks(spark, scratch):
    body = "k;v\n" + "".join(f'{i};"line {i}\nand ""more"" {"x" * (i % 50)}"\n' for i in range(3000))
    p = write(scratch, "big.csv", body.encode())
    whole = rows(read_delimited(spark, p, ";", multiline=True, with_position=False))
    with splits_of(spark, 4096):
        df = read_delimited(spark, p, ";")
        used = df.select(F.spark_partition_id().alias("p"), "k").groupBy("p").count().collect()
        assert len([u for u in used if u["count"] > 10]) > 10
        assert rows(df.drop("_pos")) == whole and len(whole) == 3000
        assert [int(r.k) for r in df.orderBy("_pos").select("k").collect()] == list(range(3000))


def test_layout_report_names_files_and_columns(spark, scratch):
    write(scratch, "a_1.csv", "\ufeffНомер;ФИО;Дата\n1;x;y\n".encode())
    write(scratch, "a_2.csv", "ФИО;Номер\n1;x\n".encode())
    write(scratch, "a_3.csv", "ФИО;Номер\n1;x\n".encode())
    write(scratch, "a_4.csv", b"")
    found = file_layout_report(spark, scratch, ["Номер", ("Дата", "date"), "ФИО"], ";")
    assert sorted((r.path.rpartition("/")[2], r.missing_column) for r in found.collect()) == [("a_2.csv", "Дата"), ("a_3.csv", "Дата")]


def test_long_header_is_read_whole(spark, scratch, monkeypatch):
    import quayside.sources.delimited as D

    names = [f"column_{i:06d}_{'x' * 60}" for i in range(16000)]
    p = write(scratch, "wide.csv", (";".join(names) + "\n").encode())
    assert D.read_header(spark, p, ";") == names
    monkeypatch.setattr(D, "HEADER_LIMIT_BYTES", 1000)
    with pytest.raises(ValueError, match="no header line"):
        D.read_header(spark, p, ";")


def test_one_scan_whatever_the_number_of_files(spark, scratch):
    paths = [write(scratch, f"n_{i:03d}.csv", b"k;v\n1;x\n") for i in range(300)]
    df = read_delimited(spark, paths, ";", with_position=False)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.replace("LocalRelation [", "").count("Relation [") == 1 and df.count() == 300


def test_header_only_and_empty(spark, scratch):
    p = write(scratch, "h.csv", b"x;y\n")
    assert read_delimited(spark, p, ";").count() == 0
    z = write(scratch, "z.csv", b"")
    with pytest.raises(ValueError):
        read_delimited(spark, z, ";")


def test_position_is_file_order(spark, scratch):
    a = write(scratch, "a_1.csv", b"k;v\n1;a\n1;b\n")
    b = write(scratch, "a_2.csv", b"k;v\n1;c\n2;d\n")
    df = read_delimited(spark, [a, b], ";")
    ordered = [r.v for r in df.orderBy("_pos").collect()]
    assert ordered == ["a", "b", "c", "d"]


def test_files_with_different_layouts_read_by_name(spark, scratch):
    a = write(scratch, "j_1.csv", b"k;v\n1;a\n")
    b = write(scratch, "j_2.csv", b"v;extra;k\nb;e;2\n")
    df = read_delimited(spark, [a, b], ";", with_position=False)
    assert sorted(df.columns) == ["extra", "k", "v"]
    assert rows(df, "k", "v", "extra") == [("1", "a", None), ("2", "b", "e")]


def test_cp1251_undefined_byte_is_an_error_or_quarantined(spark, scratch):
    p = write(scratch, "u2.csv", "a;b\n".encode("cp1251") + b"X\x98;1\nY;2\n")
    with pytest.raises(Exception, match="undefined"):
        read_delimited(spark, p, ";", "cp1251").collect()
    good, bad = read_delimited_split(spark, p, ";", "cp1251")
    assert rows(good, "a") == [("Y",)] and bad.count() == 1


def test_kinds_follow_from_what_stands_in_the_files(spark, scratch):
    import quayside.sources.delimited as D

    plain = write(scratch, "p.csv", ("k;v\n" + "".join(f"{i};\"a;{i}\"\n" for i in range(2000))).encode())
    spans = write(scratch, "s.csv", ("k;v\n" + "".join(f"{i};\"a\n{i}\"\n" for i in range(50))).encode())
    small = write(scratch, "t.csv", b"k;v\n1;x\n")
    lone = write(scratch, "u.csv", b"k;v\n1;x\ry\n")
    kinds = {r.uri.rpartition("/")[2]: r.kind for r in D.file_layouts(spark, [plain, spans, small, lone], ";").collect()}
    assert kinds == {"p.csv": D.LINES, "s.csv": D.RECORDS, "t.csv": D.LINES, "u.csv": D.WHOLE}
    with splits_of(spark, 4096):
        df = read_delimited(spark, [plain, spans, small], ";", with_position=False)
        assert df.rdd.getNumPartitions() > 3          # the big plain file was split
        exp = pd.concat([pd.read_csv(p, sep=";", dtype=str) for p in (plain, spans, small)])
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, exp.itertuples(index=False)))
        # last row wins still follows file order across splits
        ordered = read_delimited(spark, plain, ";").orderBy("_pos").select("k").collect()
        assert [int(r.k) for r in ordered] == list(range(2000))


def test_cp1251_whole_upper_half_matches_pandas(spark, scratch):
    # every character the code page defines above 0x7F (0x98 excluded: undefined)
    chars = [bytes([b]).decode("cp1251") for b in range(0x80, 0x100) if b != 0x98]
    cells = ["".join(chars[i:i + 8]).replace(";", ",").replace('"', "'") for i in range(0, len(chars), 8)]
    body = "k;text\n" + "".join(f'{i};"{c}"\n' for i, c in enumerate(cells))
    spark_vs_pandas(spark, write(scratch, "all.csv", body.encode("cp1251")), enc="cp1251")


def test_many_files_headers_probed(spark, scratch):
    paths = [write(scratch, f"m_{i:03d}.csv", f"k;v\n{i};x{i}\n".encode()) for i in range(40)]
    df = read_delimited(spark, paths, ";", with_position=False)
    assert df.count() == 40 and df.columns == ["k", "v"]


def test_quoted_newline_in_cp1251(spark, scratch):
    import quayside.sources.delimited as D

    body = "Номер;Текст\n" + "".join(f"{i};Ёлка №{i}\n" for i in range(200)) + '999;"строка\nвторая"\n'
    p = write(scratch, "cp.csv", body.encode("cp1251"))
    assert [r.kind for r in D.file_layouts(spark, [p], ";").collect()] == [D.RECORDS]
    for size in (100, 1 << 20):
        with splits_of(spark, size):
            spark_vs_pandas(spark, p, enc="cp1251")
