from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.operators.split import count_flagged, flag_repeated, split_counts, split_repeated
from helpers import rows


def test_flag_null_keys_never_repeated(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", None), ("1", None), ("2", "a"), (None, None)],
                               "talon string, source string")
    out = flag_repeated(df, ["talon", "source"])
    assert rows(out) == sorted([("1", "a", True), ("1", "a", True), ("1", None, False), ("1", None, False),
                                ("2", "a", False), (None, None, False)], key=repr)


def test_split_and_counts(spark):
    df = spark.createDataFrame([(k, "s") for k in [1, 1, 1, 2, 3, 3]], "k int, s string")
    normal, rep = split_repeated(df, ["k", "s"])
    assert normal.count() == 1 and rep.count() == 5
    assert split_counts(df, ["k", "s"]).first().asDict() == {"n_rows": 6, "n_normal": 1, "n_complex": 5}
    assert count_flagged(flag_repeated(df, ["k", "s"])).first().asDict() == {"n_rows": 6, "n_normal": 1,
                                                                             "n_complex": 5}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["a", "b", None])),
                max_size=40))
def test_split_adds_up(spark, data):
    df = spark.createDataFrame(data, "k int, s string")
    normal, rep = split_repeated(df, ["k", "s"])
    n, r = normal.count(), rep.count()
    assert n + r == len(data)
    from collections import Counter

    c = Counter(t for t in data if None not in t)
    assert r == sum(v for v in c.values() if v > 1)


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    plan = flag_repeated(df, ["k", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
