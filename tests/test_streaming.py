import os

from pyspark.sql import functions as F

from quayside.sinks.snapshot import VersionedTable
from quayside.streaming.ingest import stream_upsert
from helpers import SF, rows


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "event_type", "value")
    src = os.path.join(scratch, "src")
    ev.repartitionByRange(3, F.col("event_id").desc()).write.parquet(src)
    target = VersionedTable(spark, "ev_t", root=os.path.join(scratch, "t"))
    ckpt = os.path.join(scratch, "ckpt")
    stream_upsert(spark, src, ev.schema, target, ["user_id", "event_type"], ["event_id"], now="2024-02-01",
                  checkpoint=ckpt)
    from quayside.operators.merge import dedupe_last

    expect = dedupe_last(ev, ["user_id", "event_type"], ["event_id"])
    got = target.read().select(*expect.columns)
    assert rows(got) == rows(expect)
    v = target.current_version()
    stream_upsert(spark, src, ev.schema, target, ["user_id", "event_type"], ["event_id"], now="2024-02-01",
                  checkpoint=ckpt)
    assert target.current_version() == v


def test_stream_journal_equals_batch(spark, scratch):
    from quayside.landing import land_bytes
    from quayside.spec import TableSpec
    from quayside.streaming.ingest import stream_journal

    spec = TableSpec("refs", "Справки*", (("Номер", "number"), ("Имя", "name")), ("number",),
                     encoding="cp1251", delimiter=";")
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "Справки_1.csv", "Номер;Имя\n1;а\n2;б\n1;в\n".encode("cp1251"), mtime="2024-01-01")
    land_bytes(spark, landing, "Справки_2.csv", "Номер;Имя\n2;г\n".encode("cp1251"), mtime="2024-01-02")
    land_bytes(spark, landing, "junk.txt", b"x", mtime="2024-01-01")
    target = VersionedTable(spark, "sj_t", root=os.path.join(scratch, "t"))
    ckpt = os.path.join(scratch, "ckpt")
    stream_journal(spark, spec, landing, target, now="2024-02-01", required=["comment"], checkpoint=ckpt)
    assert rows(target.read(), "number", "name", "comment") == [("1", "в", "-"), ("2", "г", "-")]
    v = target.current_version()
    stream_journal(spark, spec, landing, target, now="2024-02-02", required=["comment"], checkpoint=ckpt)
    assert target.current_version() == v
