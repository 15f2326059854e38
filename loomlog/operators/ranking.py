"""Top-1 per hour and friends.

The reference runs one job per (field, date, hour) from the driver and
sorts each hour's counts.  Here a whole day (or every day) is one job:

1. count per (date, hour, value…)       – partial + final aggregate
2. pick the winner per (date, hour)     – ``min(struct(-cnt, value…))``,
   again an aggregate with a map-side partial (over strings Spark runs it
   as a sort aggregate), so no window; a hot hour never gathers its
   candidate list in one task
3. fill the day's empty hours           – per date, the winners of its hours
   as a map (24 entries at most) exploded over ``sequence(0, 23)``: no
   second scan, no join.  Given dates, or dates of another frame, are a
   dense grid left-joined with the winners (both bounded by dates × 24).

Ties are broken by the value, ascending, nulls last, so the answer is
deterministic (the reference leaves it to shuffle order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.operators.counts import count_by

HOUR_KEYS = ["date_utc", "hour_utc"]


def winner(counts: DataFrame, group: Sequence[str], fields: Sequence[str],
           name: str = "cnt") -> DataFrame:
    """Per ``group``: the value(s) with the highest count; ties → smallest
    value(s), nulls last."""
    order = [(-F.col(name)).alias("_neg")]
    for f in fields:
        order += [F.col(f).isNull().alias(f"_null_{f}"), F.col(f).alias(f)]
    best = F.min(F.struct(*order)).alias("_best")
    return counts.groupBy(*group).agg(best).select(
        *group, *[F.col(f"_best.{f}").alias(f) for f in fields],
        (-F.col("_best._neg")).alias(name))


def hour_grid(dates: DataFrame) -> DataFrame:
    """Every (date_utc, hour_utc) for hours 0..23 of the given dates."""
    return dates.select("date_utc", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_utc"))


def fill_hours(winners: DataFrame, values: Sequence[str], more_keys: Sequence[str] = ()) -> DataFrame:
    """Winners per (date, hour, more_keys…) with rows of nulls for the hours of
    each date (and further key) that have none."""
    keys = ["date_utc", *more_keys]
    by_hour = winners.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("hour_utc", F.struct(*values)))).alias("_hours"))
    return by_hour.select(*keys, "_hours", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_utc")).select(
        "date_utc", "hour_utc", *more_keys,
        *[F.try_element_at("_hours", F.col("hour_utc"))[v].alias(v) for v in values])


def _dates(spark: SparkSession, df: DataFrame, dates: Sequence[str] | str | None) -> DataFrame:
    if dates is None:
        return df.select("date_utc").distinct()
    if isinstance(dates, str):
        dates = [dates]
    return spark.createDataFrame([(d,) for d in dates], "date_utc string")


def top_at_hour(df: DataFrame, fields: str | Sequence[str], date: str, hour: int,
                name: str = "cnt") -> DataFrame:
    """Most frequent value(s) at one (date, hour); no row for an empty
    hour.  The equality on the partition columns prunes partitions (F1)."""
    fields = [fields] if isinstance(fields, str) else list(fields)
    hour_rows = df.where((F.col("date_utc") == date) & (F.col("hour_utc") == hour))
    counts = count_by(hour_rows, *HOUR_KEYS, *fields, name=name)
    return winner(counts, HOUR_KEYS, fields, name)


def top_per_hour(df: DataFrame, fields: str | Sequence[str],
                 dates: Sequence[str] | str | None = None,
                 all_dates_from: DataFrame | None = None, name: str = "cnt") -> DataFrame:
    """For each date, 24 rows (hour 0..23) with the most frequent
    value(s) of ``fields`` in that hour, or nulls when the hour is empty.

    ``dates`` restricts to given dates (literal list); by default every
    date present in ``all_dates_from`` (default ``df``) gets its 24 hours.
    """
    fields = [fields] if isinstance(fields, str) else list(fields)
    spark = df.sparkSession
    if dates is not None:
        df = df.where(F.col("date_utc").isin(list([dates] if isinstance(dates, str) else dates)))
    counts = count_by(df, *HOUR_KEYS, *fields, name=name)
    winners = winner(counts, HOUR_KEYS, fields, name)
    if dates is None and all_dates_from is None:
        return fill_hours(winners, [*fields, name])
    grid = hour_grid(_dates(spark, all_dates_from if all_dates_from is not None else df, dates))
    return grid.join(winners, HOUR_KEYS, "left")


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """T5: the first ``k`` rows under an explicit order (take(n) with an
    order, so the answer is defined).  Spark plans this as
    TakeOrderedAndProject: each task keeps its own k best, one merge."""
    return df.orderBy(*order).limit(k)
