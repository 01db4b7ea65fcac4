import fnmatch

from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.functions.charsets import decode_text, encode_text
from quayside.functions.globs import glob_match, glob_to_regex
from quayside.sources.delimited import pandas_names

PATTERNS = ["journal_20*.csv", "Справки*.csv", "Рецепты *.csv", "a?c", "[ab]x", "[!ab]x", "x[a-c]*", "*.tmp",
            "file(1).csv", "a+b.csv", "[]x]"]
NAMES = ["journal_2024.csv", "journal_doctor.csv", "Справки_1.csv", "Рецепты 1.csv", "Рецепты1.csv", "abc",
         "bx", "cx", "xb_", "a.tmp", "file(1).csv", "a+b.csv", "]", "x", "aab.csv", "journal_20.csv\n"]


def test_glob_matches_fnmatch(spark):
    import re

    for p in PATTERNS:
        rx = re.compile(glob_to_regex(p).replace("\\z", "\\Z"))
        for n in NAMES:
            assert bool(rx.match(n)) == fnmatch.fnmatchcase(n, p), (p, n)


def test_glob_in_spark(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    for p in PATTERNS:
        got = {r.name for r in df.where(glob_match("name", p)).collect()}
        assert got == {n for n in NAMES if fnmatch.fnmatchcase(n, p)}, p


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ЁёАБВЯабвя№«» abc ;", max_size=30))
def test_cp1251_roundtrip(text):
    raw = text.encode("cp1251")
    assert decode_text(raw.decode("latin-1"), "cp1251") == text
    assert encode_text(text, "cp1251").encode("latin-1") == raw


def test_cp1251_undefined_byte():
    assert decode_text(b"\x98".decode("latin-1"), "cp1251") == "�"


def test_pandas_names():
    assert pandas_names(["﻿x", "y", "x", "x", ""]) == ["x", "y", "x.1", "x.2", "Unnamed: 4"]
