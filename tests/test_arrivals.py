"""Settling files, second uploads, replays; one table for batch and stream;
commits of several tables; lost updates."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.landing import land_bytes
from quayside.operators.merge import upsert
from quayside.plans.flows import run_journal
from quayside.session import fs_for
from quayside.sinks.commits import CommitLog, LostUpdate, commit_together
from quayside.sinks.partitioned import PartitionedTable
from quayside.sinks.snapshot import VersionedTable
from quayside.spec import TableSpec
from quayside.streaming.arrivals import record_arrivals, stream_settled
from quayside.streaming.ingest import stream_journal
from helpers import rows

SPEC = TableSpec("refs", "Sp_*", (("k", "k"), ("v", "v")), ("k",), delimiter=";")
REPLACE = TableSpec("refs", "Sp_*", (("k", "k"), ("v", "v")), ("k",), delimiter=";", strategy="replace")


def put(spark, landing, name, body, mtime):
    land_bytes(spark, landing, name, body.encode(), mtime=f"2024-01-01 {mtime}")


def test_a_growing_file_is_loaded_once_in_its_last_form(spark, scratch):
    landing, log = f"{scratch}/landing", f"{scratch}/log"
    t = VersionedTable(spark, "arr_grow", root=f"{scratch}/t")
    step = lambda at: (record_arrivals(spark, landing, log, f"2024-01-01 {at}"), stream_settled(spark, SPEC, landing, log, t, now="2024-02-01"))
    step("00:00:00")  # nothing has landed
    put(spark, landing, "Sp_1.csv", "k;v\n1;a\n", "00:00:05")
    put(spark, landing, "other.txt", "x", "00:00:05")
    step("00:00:10")
    put(spark, landing, "Sp_1.csv", "k;v\n1;a\n2;b\n", "00:00:40")
    step("00:01:20")  # the first form would be old enough now
    assert not t.exists()
    step("00:01:41")
    assert rows(t.read(), "k", "v") == [("1", "a"), ("2", "b")] and len(t.versions()) == 1
    step("00:05:00")
    assert len(t.versions()) == 1
    # an old file that is moved in is loaded with the listing that sees it
    put(spark, landing, "Sp_0.csv", "k;v\n2;old\n3;c\n", "00:00:01")
    step("00:06:00")
    assert rows(t.read(), "k", "v") == [("1", "a"), ("2", "b"), ("3", "c")]  # a lesser name never overwrites
    # a second upload of one name
    put(spark, landing, "Sp_1.csv", "k;v\n1;again\n", "00:07:00")
    step("00:07:30")
    step("00:08:30")
    assert rows(t.read(), "k", "v") == [("1", "again"), ("2", "b"), ("3", "c")]


def test_a_key_that_moves_between_files_uploaded_again(spark, scratch):
    landing, log = f"{scratch}/landing", f"{scratch}/log"
    t = VersionedTable(spark, "arr_move", root=f"{scratch}/t")
    step = lambda at: (record_arrivals(spark, landing, log, f"2024-01-01 {at}"), stream_settled(spark, SPEC, landing, log, t, now="2024-02-01"))
    put(spark, landing, "Sp_1.csv", "k;v\n1;a\n", "00:00:00")
    put(spark, landing, "Sp_2.csv", "k;v\n2;a\n3;a\n", "00:00:00")
    put(spark, landing, "Sp_3.csv", "k;v\n4;a\n", "00:00:00")
    step("00:02:00")
    put(spark, landing, "Sp_1.csv", "k;v\n1;b\n2;b\n4;b\n", "00:03:00")
    put(spark, landing, "Sp_2.csv", "k;v\n3;b\n", "00:03:00")
    step("00:05:00")
    # 2 left the file it stood in; 4 is in Sp_3 still, whose name is greater
    assert rows(t.read(), "k", "v") == [("1", "b"), ("2", "b"), ("3", "b"), ("4", "a")]


def test_a_file_that_changes_after_it_settled_waits_for_its_next_arrival(spark, scratch):
    landing, log = f"{scratch}/landing", f"{scratch}/log"
    t = VersionedTable(spark, "arr_change", root=f"{scratch}/t")
    put(spark, landing, "Sp_1.csv", "k;v\n1;a\n", "00:00:00")
    record_arrivals(spark, landing, log, "2024-01-01 00:02:00")
    put(spark, landing, "Sp_1.csv", "k;v\n1;half", "00:02:30")
    stream_settled(spark, SPEC, landing, log, t, now="2024-02-01")
    assert not t.exists()
    put(spark, landing, "Sp_1.csv", "k;v\n1;whole\n", "00:03:00")
    record_arrivals(spark, landing, log, "2024-01-01 00:04:30")
    stream_settled(spark, SPEC, landing, log, t, now="2024-02-01")
    assert rows(t.read(), "k", "v") == [("1", "whole")]


def forget_last_commit(spark, checkpoint):
    fs, done = fs_for(spark, f"{checkpoint}/commits")
    last = max(int(s.getPath().getName()) for s in fs.listStatus(done) if s.getPath().getName().isdigit())
    for name in (str(last), f".{last}.crc"):
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(done, name), False)


@pytest.mark.parametrize("kind", ["versioned", "partitioned"])
def test_a_micro_batch_that_is_run_again_is_recognised(spark, scratch, kind):
    landing, checkpoint = f"{scratch}/landing", f"{scratch}/ck"
    t = VersionedTable(spark, "arr_replay", root=f"{scratch}/t") if kind == "versioned" else PartitionedTable(spark, "arr_replay_p", f"{scratch}/t", ["k"], partitions=3)
    put(spark, landing, "Sp_1.csv", "k;v\n1;a\n1;b\n2;c\n", "00:00:00")
    run = lambda: stream_journal(spark, REPLACE, landing, t, now="2024-02-01", checkpoint=checkpoint)
    run()
    put(spark, landing, "Sp_2.csv", "k;v\n1;z\n", "00:01:00")
    run()
    assert rows(t.read(), "k", "v") == [("1", "z"), ("2", "c")] and len(t.versions()) == 2
    forget_last_commit(spark, checkpoint)
    run()
    assert len(t.versions()) == 2
    # a batch load in between keeps what the streams have done
    put(spark, landing, "Sp_3.csv", "k;v\n3;x\n", "00:02:00")
    run_journal(spark, REPLACE, landing, t, as_of="2024-01-02", now="2024-02-02", required=[], latest_only=True)
    forget_last_commit(spark, checkpoint)
    run()
    assert rows(t.read(), "k", "v") == [("1", "z"), ("2", "c"), ("3", "x")]


def test_batch_and_stream_load_one_table(spark, scratch):
    bodies = [("Sp_1.csv", "k;v\n1;a\n2;a\n"), ("Sp_3.csv", "k;v\n1;c\n4;c\n"), ("Sp_4.csv", "k;v\n2;d\n4;d\n"), ("Sp_5.csv", "k;v\n1;e\n5;e\n")]
    alone, mixed = VersionedTable(spark, "bs_alone", root=f"{scratch}/a"), VersionedTable(spark, "bs_mixed", root=f"{scratch}/m")
    batch = lambda t, folder, **kw: run_journal(spark, SPEC, folder, t, as_of="2024-01-02", now="2024-02-01", **kw)
    for i, (name, body) in enumerate(bodies):
        put(spark, f"{scratch}/all", name, body, f"00:0{i}:00")
        put(spark, f"{scratch}/{['first', 'stream', 'stream', 'last'][i]}", name, body, f"00:0{i}:00")
    batch(alone, f"{scratch}/all")
    batch(mixed, f"{scratch}/first")
    stream_journal(spark, SPEC, f"{scratch}/stream", mixed, now="2024-02-01", checkpoint=f"{scratch}/ck")
    batch(mixed, f"{scratch}/last")
    assert rows(mixed.read()) == rows(alone.read())
    assert "_source_file" in mixed.read().columns and [r._source_file for r in mixed.read().where("k = '4'").collect()] == ["Sp_4.csv"]
    # the other way round: a late file of a lesser name does not overwrite what a batch load wrote
    put(spark, f"{scratch}/stream", "Sp_2.csv", "k;v\n1;late\n6;late\n", "00:09:00")
    stream_journal(spark, SPEC, f"{scratch}/stream", mixed, now="2024-02-01", checkpoint=f"{scratch}/ck")
    assert rows(mixed.read().where("k in ('1', '6')"), "k", "v") == [("1", "e"), ("6", "late")]


def test_a_table_without_the_bookkeeping_column_takes_it(spark):
    target = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    batch = spark.createDataFrame([("1", "x", "Sp_1.csv"), ("3", "y", "Sp_1.csv")], "k string, v string, _source_file string")
    for guard in ([], ["_source_file"]):
        out = upsert(target, batch, ["k"], now="2024-01-01", guard_cols=guard)
        assert rows(out) == [("1", "x", "Sp_1.csv"), ("2", "b", None), ("3", "y", "Sp_1.csv")]


def test_tables_of_one_log_are_committed_together(spark, scratch):
    log = CommitLog(spark, f"{scratch}/log")
    a, b = (VersionedTable(spark, f"ct_{n}", root=f"{scratch}/{n}", log=log) for n in "ab")
    df = spark.range(3)
    commit_together([(a, a.stage(df)), (b, b.stage(df))])
    assert a.read().count() == b.read().count() == 3
    a.stage(spark.range(9))  # a load that stops here
    c, d = (VersionedTable(spark, f"ct_{n}", root=f"{scratch}/{n}", log=CommitLog(spark, f"{scratch}/log")) for n in "ab")
    assert c.read().count() == 3 and c.versions() == [1] and d.versions() == [1]
    commit_together([(c, c.stage(spark.range(5))), (d, d.stage(spark.range(6)))])
    assert (c.read().count(), d.read().count()) == (5, 6)
    c.drop_old_versions()
    assert c.versions() == [3] and d.versions() == [1, 2] and c.read().count() == 5


@pytest.mark.parametrize("kind", ["marker", "log", "partitioned"])
def test_a_lost_update_is_refused(spark, scratch, kind):
    def table():
        if kind == "partitioned":
            return PartitionedTable(spark, "lu_p", f"{scratch}/t", ["id"], partitions=2)
        return VersionedTable(spark, f"lu_{kind}", root=f"{scratch}/t", log=CommitLog(spark, f"{scratch}/log") if kind == "log" else None)

    table().publish(spark.range(2))
    one, two = table(), table()
    mine = one.read().union(spark.range(10, 11))
    theirs = two.read().union(spark.range(20, 21))
    staged = one.stage(mine)
    two.publish(theirs)
    with pytest.raises(LostUpdate):
        one.commit(staged)
    assert rows(table().read()) == [(0,), (1,), (20,)]
    again = table()
    again.publish(again.read().union(spark.range(10, 11)))
    assert rows(table().read()) == [(0,), (1,), (10,), (20,)]


def test_a_hot_partition_is_written_by_several_tasks(spark, scratch):
    t = PartitionedTable(spark, "hot_p", f"{scratch}/t", ["k"], partitions=4)
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        t.publish(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert t.read().count() == 60_000
    folder = next(f for p, f in t.manifest()["folders"].items() if t.read(only=[int(p)]).where("k = -1").count())
    assert len([f for f in os.listdir(f"{scratch}/t/{folder}") if f.startswith("part-")]) > 1
