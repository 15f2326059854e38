"""Interest-list joins (J2, J3) over the nested event view.

The list is usually short, but no side carries a broadcast hint: Spark
broadcasts it when its size estimate (exact for an in-memory list, the file
size for a table) or, with AQE, its measured size is within
``spark.sql.autoBroadcastJoinThreshold``, and otherwise plans a shuffle join.

* J2 ``interest LEFT JOIN events … WHERE events.type = t`` — the filter on
  the right side makes the outer join inner (Catalyst: EliminateOuterJoin);
  the broadcast list then filters events in the scan stage.
* J3 without the filter keeps unmatched names.  A left outer join can only
  build a hash table of its *right* side, which here is the big one, so
  the plan is split: inner join with the distinct names and aggregate
  (map-side partial aggregate: skew-proof), then a left join of the
  grouped list with the grouped result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def interest_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """In-memory list → one-column table ``name``."""
    return spark.createDataFrame([(n,) for n in names], "name string")


def nested_events(event_log: DataFrame) -> DataFrame:
    """The event log in GitHub shape, for SQL over struct paths
    (``pt.actor.login``): ``actor`` and ``repo`` become structs."""
    return event_log.select(
        F.col("ev_id").alias("id"), F.col("ev_type").alias("type"),
        F.struct(F.col("actor").alias("login")).alias("actor"),
        F.struct(F.col("repo").alias("name")).alias("repo"),
        "created_at", "date_utc", "hour_utc")


def interest_type_activity(spark: SparkSession, interest: DataFrame, events: DataFrame,
                           event_type: str) -> DataFrame:
    """J2/P9/F7/A5/T4 as SQL over temp views (S13).  ``events`` is in the
    nested shape of ``nested_events``."""
    tag = uuid.uuid4().hex[:8]                    # per-call names: no clash between callers
    wanted, log = f"wanted_{tag}", f"log_{tag}"
    interest.createOrReplaceTempView(wanted)
    events.createOrReplaceTempView(log)
    return spark.sql(f"""
        SELECT log.actor.login AS login, log.type AS type, count(*) AS cnt
        FROM {wanted} wanted LEFT OUTER JOIN {log} log ON log.actor.login = wanted.name
        WHERE log.type = :kind
        GROUP BY ALL
        ORDER BY cnt DESC, login, type
        """, args={"kind": event_type})


def interest_activity(interest: DataFrame, events: DataFrame) -> DataFrame:
    """Per (name, login, type) the number of joined rows ``cnt`` and
    ``matched`` = those with an event.  A name listed ``mult`` times joins
    every event ``mult`` times; a name without events counts its ``mult``
    null-extended rows, as ``count(*)`` over the outer join does.  The list
    is grouped first, so events meet each name once."""
    names = interest.groupBy("name").agg(F.count(F.lit(1)).alias("mult"))
    only = interest.select(F.col("name").alias("wanted")).distinct()
    hits = (events.select(F.col("actor.login").alias("login"), F.col("type"))
            .join(only, F.col("login") == F.col("wanted"), "inner")
            .groupBy("login", "type").agg(F.count(F.lit(1)).alias("n")))
    joined = names.join(hits, F.col("name") == F.col("login"), "left")
    return joined.select("name", "login", "type",
                         (F.coalesce("n", F.lit(1)) * F.col("mult")).cast("bigint").alias("cnt"),
                         (F.coalesce("n", F.lit(0)) * F.col("mult")).cast("bigint").alias("matched"))
