"""Small helpers shared by the operators: inputs, folds, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.session import scratch_path
from loomlog.session import ship_package as importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table under ``spark.checkpoint.dir``: lineage is cut, its
    size is known to the planner, and a lost executor costs a re-read.  The shuffle
    files behind it go with the job that wrote it.  Tasks commit their own files (the folder
    is fresh, and read after the job only), so no list of them passes through the driver."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run inside; afterwards it is what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run inside hand tasks at most ``rows`` rows at a time: texts, or pairs of
    them, then take a few MB on either side of the pipe to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    with setting(spark, key, str(min(rows, before) if before > 0 else rows)):
        yield
