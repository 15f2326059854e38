"""Catalog tables: namespaces, listing, existence by name.

Besides folders and stores, tables can be known to Spark's catalog: saved into
a namespace or registered there from a folder.  The catalog is metadata: its
listing is one small row per table, however large the tables are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "namespace string, name string"


def _named(*parts: str) -> str:
    for part in parts:
        if not re.fullmatch(r"\w+", part):
            raise ValueError(f"a namespace or table name is letters, digits and _: {part!r}")
    return ".".join(f"`{part}`" for part in parts)


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the namespace where it is absent; ``location``: the folder its tables go to."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_named(namespace)}{where}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    """Forget the namespace and drop its tables (registered folders keep their files)."""
    spark.sql(f"DROP NAMESPACE IF EXISTS {_named(namespace)} CASCADE")


def save_table(df: DataFrame, namespace: str, name: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> DataFrame:
    """K2/K5: save ``df`` as a table of the catalog; by default it must not exist."""
    df.write.mode(mode).partitionBy(*partition_by).saveAsTable(_named(namespace, name))
    return df.sparkSession.table(_named(namespace, name))


def register_folder(spark: SparkSession, namespace: str, name: str, path: str) -> DataFrame:
    """Make a Parquet folder known as a table; dropping the table leaves the files."""
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_named(namespace, name)} USING parquet LOCATION '{quoted}'")
    table = spark.table(_named(namespace, name))
    if any(row["partition"] for row in _partitioned(spark, namespace, name)):
        spark.sql(f"MSCK REPAIR TABLE {_named(namespace, name)}")
    return table


def _partitioned(spark: SparkSession, namespace: str, name: str) -> list[dict]:
    return [{"partition": c.isPartition} for c in spark.catalog.listColumns(_named(namespace, name))]


def listing(spark: SparkSession, namespaces: Sequence[str] | None = None) -> DataFrame:
    """(namespace, name) of the catalog's tables as of now; temporary views do not count."""
    if namespaces is None:
        namespaces = [r["namespace"] for r in spark.sql("SHOW NAMESPACES").collect()]
    known = [n for n in dict.fromkeys(namespaces) if spark.catalog.databaseExists(f"`{n}`")]
    parts = [spark.sql(f"SHOW TABLES IN `{n}`").where("NOT isTemporary").select("namespace", F.col("tableName").alias("name"))
             for n in known]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], LISTING)


def tables_present(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """F13/A8 for many names at once: ``wanted(namespace, name)`` with ``exists``.
    Names compare as the catalog keeps them, in lower case; null is no name."""
    spaces = [r["namespace"] for r in wanted.select("namespace").where("namespace IS NOT NULL").distinct().collect()]
    have = listing(spark, [s.lower() for s in spaces]).select(F.col("namespace").alias("__space"), F.col("name").alias("__name"))
    found = wanted.join(F.broadcast(have), (F.lower("namespace") == F.col("__space")) & (F.lower("name") == F.col("__name")), "left")
    return found.select(*[wanted[c] for c in wanted.columns], F.col("__name").isNotNull().alias("exists"))
