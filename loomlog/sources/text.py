"""Text sources (S3-S6) and their writers for derived corpora.

S3  read_lines        text lines, ``\\n`` only
S4  read_lines(…)     many files in one scan: list, glob, ``path_glob``
S5  read_delimited    ``;``-separated file(s) with one header per file
S6  read_chunks       text cut at a custom delimiter (e.g. ``\\nC``); the
                      Hadoop line reader handles chunks crossing a split
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str | list[str], path_glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """One row per line (``value``).  Only ``\\n`` ends a line, so a stray
    ``\\r`` stays part of the text."""
    reader = spark.read.option("lineSep", "\n")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.text(path)


def read_chunks(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """One row per chunk between occurrences of ``delimiter``."""
    return spark.read.text(path, lineSep=delimiter)


def file_sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length) of the files of a source, from the listing alone."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                   sep: str = ";") -> DataFrame:
    """Header line dropped once per file (not every row equal to
    the header); declared schema, no inference pass."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema,
                          enforceSchema=False, mode="FAILFAST")


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("errorifexists").csv(path, sep=sep, header=True)


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).alias("value")).write.mode("errorifexists").text(path)


def explode_lines(df: DataFrame, text_column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lines of an in-table text column (split on ``\\n``), in order."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_column), "\n", -1))
                     .alias("line_no", "value"))
