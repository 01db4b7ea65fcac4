"""A key (or a NULL key) holding a third of the batch must not land in one task."""

import pytest
from pyspark.sql import functions as F

from quayside.operators.split import flag_repeated, split_counts

SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.shuffle.partitions": "16"}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    ep = df._jdf.queryExecution().executedPlan()
    n = ep.execute().count()
    return n, ep.toString()


def test_hot_key_join_is_split(spark, skew_conf):
    n = 150000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("string").alias("k"),
        F.col("id").alias("v")).repartition(4)
    f = flag_repeated(df, ["k"])
    count, plan = final_plan(f)
    assert count == n
    assert "SortMergeJoin(skew=true)" in plan
    assert f.where("is_complex").count() == n // 3 + 1   # id 7 itself also has key "7"


def test_hot_null_key_is_spread(spark, skew_conf):
    n = 150000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1000).cast("string").alias("k"),
        F.col("id").alias("v")).repartition(4)
    f = flag_repeated(df, ["k"])
    plan = f._jdf.queryExecution().executedPlan().toString()
    left = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line][0]
    assert "__qs_spread" in left          # the NULL group is spread over the join's partitions
    assert f.where("is_complex").count() == n - n // 3
    assert split_counts(df, ["k"]).first().asDict() == {"n_rows": n, "n_normal": n // 3, "n_complex": n - n // 3}



def test_hot_stored_key_of_a_replace_is_split(spark, skew_conf):
    from quayside.operators.merge import replace_by_key

    n = 150000
    stored = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("string").alias("k"),
                                   F.xxhash64("id").alias("v")).repartition(4)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    batch = spark.range(1000, 2000).select(F.col("id").cast("string").alias("k"), (-F.col("id")).alias("v")).repartition(4)
    out = replace_by_key(stored, batch, ["k"])
    count, plan = final_plan(out)
    spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")
    assert "skew=true" in plan
    gone = sum(1 for i in range(1000, 2000) if i % 3)
    assert count == n - gone + 1000
