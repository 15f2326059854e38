"""A key holding a third of all rows: results stay whole and exact, the
plans combine map-side, and a hot hour is written by several tasks."""

import glob

from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.operators import counts, ranking
from loomlog.sinks import snapshots, tables


def skewed_log(spark, n=30000):
    """Event log where hour 5 of 2024-01-02 holds a third of all rows and
    actor 'hot' a third of those."""
    df = spark.range(n).select(
        F.col("id").alias("ev_id"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise((F.col("id") % 23).cast("int")).alias("h"),
        F.when(F.col("id") % 9 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("actor"))
    ts = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(2), F.col("h"), (F.col("ev_id") % 60).cast("int"),
                              F.lit(0))
    return df.select(F.date_format(F.to_date(ts), "yyyyMMdd'Z'").alias("date_utc"),
                     F.col("h").alias("hour_utc"), ts.alias("created_at"), "ev_id", "actor",
                     F.lit("PushEvent").alias("ev_type"), F.lit("r").alias("repo"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_count_is_combined_map_side(spark):
    log = skewed_log(spark)
    c = counts.count_by(log, "actor")
    assert {r.actor: r.cnt for r in c.where("actor = 'hot'").collect()} == {"hot": 30000 // 9 + 1}
    assert c.agg(F.sum("cnt")).collect()[0][0] == 30000
    p = plan(c)
    assert p.index("partial_count") > p.index("Exchange")          # partial below the exchange


def test_hot_hour_top_value(spark):
    top = ranking.top_per_hour(skewed_log(spark), "actor", dates="20240102Z")
    r = top.where("hour_utc = 5").collect()[0]
    assert (r.actor, r.cnt) == ("hot", 30000 // 9 + 1)
    assert top.count() == 24
    assert "Window" not in plan(top)


def test_hot_key_upsert_dedup(spark, workdir):
    dup = spark.range(20000).select(F.lit(7).cast("long").alias("id"), (F.col("id") % 5).cast("string").alias("v"))
    rest = spark.range(100, 10100).select(F.col("id"), F.lit("x").alias("v"))
    t = snapshots.upsert_table(spark, dup.unionByName(rest), f"{workdir}/hot", ["id"])
    assert t.count() == 10001
    assert t.where("id = 7").collect()[0].v == "4"                 # largest row wins, stably
    p = plan(tables.one_row_per_key(dup, ["id"]))
    assert "partial_max" in p


def test_hot_hour_written_by_several_tasks(spark, workdir):
    path = f"{workdir}/hourly" + S.HOURLY_SUFFIX
    t = tables.upsert_hourly(spark, skewed_log(spark), path)
    assert t.count() == 30000
    files = glob.glob(f"{path}/date_utc=20240102Z/hour_utc=5/*.parquet")
    assert len(files) >= 2                                          # range bounds cut the hot hour
    # each file is sorted by (created_at, ev_id)
    one = spark.read.parquet(files[0]).select("created_at", "ev_id").collect()
    assert one == sorted(one)
