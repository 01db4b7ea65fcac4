import os

from pyspark.sql import functions as F

from quayside.sinks.snapshot import VersionedTable
import pytest
from helpers import rows


def test_versions_and_atomic_pointer(spark, scratch):
    t = VersionedTable(spark, "snap_a", root=os.path.join(scratch, "a"))
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert t.publish(df) == 1
    old = t.read()
    assert t.publish(df.where("k = 1")) == 2
    assert rows(t.read()) == [(1, "x")]
    assert rows(old) == [(1, "x"), (2, "y")]          # a reader of v1 is not disturbed
    os.makedirs(os.path.join(scratch, "a", "v=00000003"))  # a crashed write: never published
    assert t.versions() == [1, 2]
    assert t.publish(df) == 4                         # never reuses a crashed directory
    spark.sql("DROP TABLE snap_a")                    # a new session's catalog knows nothing
    t2 = VersionedTable(spark, "snap_a", root=os.path.join(scratch, "a"))
    assert rows(t2.read()) == [(1, "x"), (2, "y")]


def test_bucketed_target_join_reads_without_exchange(spark, scratch):
    from quayside.operators.merge import upsert

    t = VersionedTable(spark, "snap_b", root=os.path.join(scratch, "b"), keys=["k"], buckets=4)
    base = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"),
                                   F.lit("t0").alias("created_at"), F.lit("t0").alias("updated_at"))
    t.publish(base)
    batch = spark.range(90, 110).select(F.col("id").cast("string").alias("k"), F.lit("w").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert(t.read(), batch, ["k"], now="t1")
        plan = out._jdf.queryExecution().executedPlan().toString()
        scan_side = [line for line in plan.splitlines() if "FileScan" in line][0]
        assert "Bucketed: true" in scan_side
        assert out.count() == 110
        t.publish(out)
        assert t.read().where("v = 'w'").count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_merge_into_is_refused_for_plain_parquet(spark):
    import pytest

    from quayside.sinks.merge_table import merge_statement, merge_upsert

    sql = merge_statement("t", "s", ["k", "v"], ["k"], "2024-01-01 00:00:00")
    assert sql == ("MERGE INTO t t USING s s ON t.`k` = s.`k` WHEN MATCHED THEN UPDATE SET t.`v` = s.`v` "
                   "WHEN NOT MATCHED THEN INSERT (`k`, `v`, `created_at`, `updated_at`) VALUES (s.`k`, s.`v`, "
                   "CAST('2024-01-01 00:00:00' AS TIMESTAMP), CAST('2024-01-01 00:00:00' AS TIMESTAMP))")
    spark.sql("DROP TABLE IF EXISTS mt_plain")
    spark.sql("CREATE TABLE mt_plain (k STRING, v STRING, created_at TIMESTAMP, updated_at TIMESTAMP) USING parquet")
    batch = spark.createDataFrame([("1", "a")], "k string, v string")
    with pytest.raises(Exception):
        merge_upsert(batch, "mt_plain", ["k"], "2024-01-01 00:00:00")


def test_staged_but_unpublished_version_is_invisible(spark, scratch):
    t = VersionedTable(spark, "snap_c", root=os.path.join(scratch, "c"))
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    t.publish(df)
    t.stage(df.union(spark.createDataFrame([(2, "y")], "k int, v string")))   # a load that stopped here
    spark.sql("DROP TABLE snap_c")
    fresh = VersionedTable(spark, "snap_c", root=os.path.join(scratch, "c"))
    assert fresh.versions() == [1] and rows(fresh.read()) == [(1, "x")]


def test_layout_belongs_to_the_table(spark, scratch):
    import pytest

    root = os.path.join(scratch, "lay")
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    t8 = VersionedTable(spark, "lay_t", root=root, keys=["k"], buckets=8)
    t8.publish(df)
    t4 = VersionedTable(spark, "lay_t", root=root, keys=["k"], buckets=4)
    for _ in range(2):
        from quayside.operators.merge import upsert

        t4.publish(upsert(t4.read(), df.where("v < 1038"), ["k"], now="2024-01-01"))
    assert t4.read().count() == 2000 and t4.layout(3) == (["k"], 4)
    plain = VersionedTable(spark, "lay_u", root=os.path.join(scratch, "u"))
    plain.publish(df)
    spark.sql("DROP TABLE lay_u")
    bucketed = VersionedTable(spark, "lay_u", root=os.path.join(scratch, "u"), keys=["k"], buckets=4)
    assert bucketed.read().count() == 2000
    bucketed.publish(bucketed.read())
    assert bucketed.read().count() == 2000
    # a name that another root has in this catalog, and a view of that name
    other = VersionedTable(spark, "lay_t", root=os.path.join(scratch, "w"))
    other.publish(df.limit(3))
    assert other.read().count() == 3 and t4.read().count() == 2000
    df.createOrReplaceTempView("lay_t")
    try:
        with pytest.raises(ValueError, match="view"):
            t4.read()
    finally:
        spark.catalog.dropTempView("lay_t")


def test_retention_keeps_the_current_version(spark, scratch):
    t = VersionedTable(spark, "ret_t", root=os.path.join(scratch, "r"))
    for i in range(4):
        t.publish(spark.range(i + 1))
    assert t.drop_old_versions(keep=2) == [1, 2] and t.versions() == [3, 4]
    assert t.drop_old_versions(keep=0) == [3] and t.read().count() == 4


def test_a_load_rewrites_only_touched_partitions(spark, scratch):
    import datetime as dt

    import pytest

    from quayside.landing import land_bytes
    from quayside.plans.flows import run_claims, run_journal
    from quayside.sinks.partitioned import PartitionedTable
    from quayside.spec import TableSpec

    spec = TableSpec("refs", "j*", (("k", "k"), ("v", "v")), ("k",), delimiter=";")
    root = os.path.join(scratch, "p")
    t = PartitionedTable(spark, "refs", root, ["k"], partitions=16)
    for day, body in ((1, "".join(f"{i};a\n" for i in range(200))), (2, "7;b\n900;new\n")):
        landing = os.path.join(scratch, f"d{day}")
        land_bytes(spark, landing, "j1.csv", f"k;v\n{body}".encode(), mtime="2024-01-01")
        run_journal(spark, spec, landing, t, as_of="2024-01-02", now=f"2024-01-0{day}", required=[])
    got = {r.k: (r.v, r.created_at) for r in t.read().collect()}
    assert len(got) == 201 and got["7"] == ("b", dt.datetime(2024, 1, 1)) and got["900"] == ("new", dt.datetime(2024, 1, 2))
    first, second = t.manifest(1)["folders"], t.manifest(2)["folders"]
    changed = [p for p in second if first.get(p) != second[p]]
    assert 1 <= len(changed) <= 2 and len(second) == 16
    assert t.read(version=1).where("k = '7'").first().v == "a"
    # the count of partitions and the keys are the table's own
    assert PartitionedTable(spark, "refs", root, ["k"], partitions=4).partitions == 16
    with pytest.raises(ValueError, match="keyed by"):
        PartitionedTable(spark, "refs", root, ["v"]).read()
    assert t.drop_old_versions() == [1] and t.read().count() == 201 and t.versions() == [2]

    normal = PartitionedTable(spark, "pn", os.path.join(scratch, "n"), ["talon", "source"], partitions=8)
    rep = PartitionedTable(spark, "pr", os.path.join(scratch, "r"), ["talon", "source"], partitions=8)
    cols = "talon string, source string, v string"
    run_claims(spark, spark.createDataFrame([("1", "a", "x"), ("1", "a", "y"), ("2", "a", "z")], cols), ["talon", "source"], normal, rep,
               now="2024-01-01", move_between=True)
    run_claims(spark, spark.createDataFrame([("1", "a", "w"), ("2", "a", "q"), ("2", "a", "r")], cols), ["talon", "source"], normal, rep,
               now="2024-01-02", move_between=True)
    assert rows(normal.read(), "talon", "v") == [("1", "w")] and rows(rep.read(), "talon", "v") == [("2", "q"), ("2", "r")]


def test_read_as_of_a_time(spark, scratch):
    import datetime as dt

    t = VersionedTable(spark, "as_of_t", root=f"{scratch}/t", label="refs")
    t.publish(spark.range(1), at="2024-01-01 10:00:00")
    t.publish(spark.range(2), at=dt.datetime(2024, 1, 2))
    t.publish(spark.range(3))  # a version without a time
    t.publish(spark.range(4), at=dt.date(2024, 1, 5))
    assert t.snapshots() == {1: "refs_20240101_100000", 2: "refs_20240102_000000", 4: "refs_20240105_000000"}
    assert [t.read_at(x).count() for x in ("2024-01-01 10:00:00", "2024-01-01 23:00:00", "2024-01-04 00:00:00", "2025-01-01 00:00:00")] == [1, 1, 2, 4]
    with pytest.raises(FileNotFoundError):
        t.read_at("2023-12-31 00:00:00")
