from quayside.operators.merge import dedupe_last, replace_by_key, upsert
from helpers import rows

T = "k string, v string, keep string, created_at string, updated_at string"


def target(spark):
    return spark.createDataFrame([("1", "a", "k1", "t0", "t0"), ("2", "b", "k2", "t0", "t0")], T)


def test_upsert_semantics(spark):
    batch = spark.createDataFrame([("2", None), ("3", "c")], "k string, v string")
    out = upsert(target(spark), batch, ["k"], now="t1")
    assert rows(out) == [("1", "a", "k1", "t0", "t0"), ("2", None, "k2", "t0", "t0"), ("3", "c", None, "t1", "t1")]


def test_upsert_touch_and_idempotent(spark):
    batch = spark.createDataFrame([("2", "z")], "k string, v string")
    once = upsert(target(spark), batch, ["k"], now="t1", touch_updated_at=True)
    twice = upsert(once, batch, ["k"], now="t1", touch_updated_at=True)
    assert rows(once) == rows(twice)
    assert ("2", "z", "k2", "t0", "t1") in rows(once)


def test_upsert_rejects_unknown_columns(spark):
    import pytest

    batch = spark.createDataFrame([("2", "z")], "k string, other string")
    with pytest.raises(ValueError):
        upsert(target(spark), batch, ["k"], now="t1")


def test_upsert_guard_keeps_newer(spark):
    t = spark.createDataFrame([("1", 5, "new")], "k string, o int, v string")
    old = spark.createDataFrame([("1", 3, "old")], "k string, o int, v string")
    assert rows(upsert(t, old, ["k"], now="x", guard_cols=["o"])) == [("1", 5, "new")]


def test_dedupe_last_by_position(spark):
    df = spark.createDataFrame([("1", "a", 0), ("1", "b", 2), ("1", "c", 1), ("2", "d", 0)], "k string, v string, _pos int")
    assert rows(dedupe_last(df, ["k"])) == [("1", "b", 2), ("2", "d", 0)]


def test_replace_by_key(spark):
    t = spark.createDataFrame([("1", "a", "x", "t0", "t0"), ("1", "b", "x", "t0", "t0"), ("2", "c", "x", "t0", "t0")], T)
    batch = spark.createDataFrame([("1", "n1"), ("1", "n2"), ("3", "n3")], "k string, v string")
    once = replace_by_key(t, batch, ["k"], now="t1")
    assert rows(once) == [("1", "n1", None, "t1", "t1"), ("1", "n2", None, "t1", "t1"), ("2", "c", "x", "t0", "t0"),
                          ("3", "n3", None, "t1", "t1")]
    assert rows(replace_by_key(once, batch, ["k"], now="t1")) == rows(once)


def test_upsert_by_bitmap_equals_the_plain_join(spark):
    from quayside.operators.merge import bitmap_bits, divide_by_bitmap, upsert

    target = spark.range(2000).selectExpr("nullif(id, 7) as k", "cast(id % 3 as string) as v", "'keep' as w", "if(id % 2 = 0, 't0', null) as created_at", "'t0' as updated_at")
    batch = spark.range(1500, 2600, 50).selectExpr("cast(id as int) as k", "'new' as v").union(spark.createDataFrame([(None, "null key")], "k int, v string"))
    plain = rows(upsert(target, batch, ["k"], now="t1"))
    for bits in (64, 1024, bitmap_bits(22)):
        assert rows(upsert(target, batch, ["k"], now="t1", bitmap=bits)) == plain
        assert rows(upsert(target, batch, ["k"], now="t1", bitmap=bits, guard_cols=["v"])) == rows(upsert(target, batch, ["k"], now="t1", guard_cols=["v"]))
        assert rows(upsert(target, batch, ["k"], now="t1", bitmap=bits, touch_updated_at=True)) == rows(upsert(target, batch, ["k"], now="t1", touch_updated_at=True))
    met, rest = divide_by_bitmap(target, batch, ["k"], 1 << 16)
    assert met.count() + rest.count() == 2000 and 10 <= met.count() <= 40
    assert bitmap_bits(1 << 40) is None and bitmap_bits(0) == 1024


def test_bitmap_keeps_stored_rows_out_of_the_shuffle(spark):
    from quayside.operators.merge import upsert

    target = spark.range(50_000).selectExpr("id as k", "'a' as v", "'t0' as created_at", "'t0' as updated_at")
    batch = spark.range(49_990, 50_010).selectExpr("id as k", "'b' as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert(target, batch, ["k"], now="t1", bitmap=1 << 16)
        assert out.count() == 50_010 and out.where("v = 'b'").count() == 20
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
        assert len(joins) == 1 and "FullOuter" in joins[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
