"""Counting operators.

Every count is one grouped aggregate: Spark adds a map-side partial
aggregate before the shuffle, so a hot key (even one holding a third of
all rows) reaches the reducer as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    """A1/A2/A5: rows per key (``map((_,1)).reduceByKey(_+_)``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_all(df: DataFrame, name: str = "cnt") -> DataFrame:
    """A3: one-row global count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(spark: SparkSession, view: str, column: str, value, name: str = "cnt") -> DataFrame:
    """``count(*) … WHERE column = :v`` with a bound parameter, never a
    pasted literal.  ``view`` and ``column`` are identifiers checked by the
    parser through IDENTIFIER()."""
    return spark.sql(
        f"SELECT count(*) AS {name} FROM IDENTIFIER(:view) WHERE IDENTIFIER(:col) = :v",
        args={"view": view, "col": column, "v": value})


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """DISTINCT one column."""
    return df.select(column).distinct()


def counts_for_values(df: DataFrame, column: str, name: str = "cnt") -> DataFrame:
    """A4: 'distinct values, then a count for each value' in one pass.

    The loop of one COUNT query per value is a job per value scheduled from
    the driver; the grouped aggregate gives the same answer in one job.
    """
    return count_by(df, column, name=name)


def count_rows(df: DataFrame, name: str = "cnt") -> DataFrame:
    """A10: count by the whole row as key, for a frame of any width."""
    return count_by(df, *df.columns, name=name)


def duplicate_summary(df: DataFrame, exact_columns: list[str] | None = None,
                      digest_column: str | None = None) -> DataFrame:
    """``count - distinct count`` in one pass.

    Rows are grouped by their value (``exact_columns``, default all), the
    group sizes summed.  For wide text (``digest_column``) the grouping key
    is (sha-256, length) of the text, so the shuffle carries 40 bytes per
    row instead of the text itself.
    """
    if digest_column:
        key = [F.sha2(F.col(digest_column), 256).alias("_h"),
               F.length(digest_column).alias("_n")]
        groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"))
    else:
        groups = df.groupBy(*(exact_columns or df.columns)).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n_rows"),
                      F.count(F.lit(1)).alias("n_distinct"),
                      F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))
