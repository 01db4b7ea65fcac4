"""Model-based checks: the set-based operators against row-at-a-time models."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.operators.merge import replace_by_key, upsert
from helpers import rows

keys = st.sampled_from(["a", "b", "c", "d"])
vals = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(keys, st.tuples(vals, vals), max_size=4), st.lists(st.tuples(keys, vals), max_size=8))
def test_upsert_matches_row_by_row_model(spark, target, batch):
    # model: apply batch rows one by one in file order (INSERT … ON CONFLICT DO UPDATE)
    model = {k: {"v": v, "keep": keep, "created_at": "t0", "updated_at": "t0"} for k, (v, keep) in target.items()}
    for k, v in batch:
        if k in model:
            model[k]["v"] = v
        else:
            model[k] = {"v": v, "keep": None, "created_at": "t1", "updated_at": "t1"}
    expect = sorted(((k, m["v"], m["keep"], m["created_at"], m["updated_at"]) for k, m in model.items()), key=repr)
    t = spark.createDataFrame([(k, v, keep, "t0", "t0") for k, (v, keep) in target.items()],
                              "k string, v string, keep string, created_at string, updated_at string")
    b = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "k string, v string, _pos int")
    got = rows(upsert(t, b, ["k"], now="t1"))
    assert got == expect
    assert len({r[0] for r in got}) == len(got)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(keys, vals), max_size=6), st.lists(st.tuples(keys, vals), max_size=6))
def test_replace_matches_delete_then_insert_model(spark, target, batch):
    bkeys = {k for k, _ in batch}
    expect = sorted([r for r in target if r[0] not in bkeys] + list(batch), key=repr)
    t = spark.createDataFrame(target, "k string, v string")
    b = spark.createDataFrame(batch, "k string, v string")
    assert rows(replace_by_key(t, b, ["k"])) == expect


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(keys, st.tuples(vals, vals), max_size=4), st.lists(st.tuples(keys, vals), max_size=8),
       st.booleans())
def test_broadcast_upsert_equals_full_outer(spark, target, batch, guard):
    t = spark.createDataFrame([(k, v, keep, "t0", "t0") for k, (v, keep) in target.items()],
                              "k string, v string, keep string, created_at string, updated_at string")
    b = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "k string, v string, _pos int")
    kw = {"guard_cols": ["v"]} if guard else {}
    full = rows(upsert(t, b, ["k"], now="t1", **kw))
    small = upsert(t, b, ["k"], now="t1", broadcast_batch=True, **kw)
    assert rows(small) == full


def test_broadcast_upsert_does_not_shuffle_target(spark):
    t = spark.range(1000).selectExpr("cast(id as string) k", "'a' v", "'t0' created_at", "'t0' updated_at")
    b = spark.createDataFrame([("5", "b"), ("5000", "c")], "k string, v string")
    out = upsert(t, b, ["k"], now="t1", broadcast_batch=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan_lines = [i for i, line in enumerate(plan.splitlines()) if "Range (0, 1000" in line]
    assert scan_lines and "SortMergeJoin" not in plan
    assert out.count() == 1001 and out.where("v = 'b'").count() == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(keys, vals), min_size=1, max_size=12), st.integers(1, 5))
def test_last_row_wins_ignores_physical_order(spark, batch, parts):
    from quayside.operators.merge import dedupe_last

    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "k string, v string, _pos int")
    expect = {}
    for i, (k, v) in enumerate(batch):
        expect[k] = (k, v, i)                      # the last row in file order
    shuffled = df.repartition(parts).sortWithinPartitions(df["_pos"].desc())
    assert rows(dedupe_last(shuffled, ["k"])) == sorted(expect.values(), key=repr)
