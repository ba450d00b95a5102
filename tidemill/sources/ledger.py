"""Incremental load with a ledger of files already read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path) of all files below a folder that hold a byte. Only names are listed, no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold."""
    return listing.select("path").distinct().join(ledger.select("path"), "path", "left_anti")


def new_rows(rows: DataFrame, history: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows to append: those whose ``keys`` (or all columns) the history lacks, each key once."""
    keys = list(keys or rows.columns)
    known = history.select(*keys).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}"))
    return rows.dropDuplicates(keys).alias("r").join(known.alias("h"), same, "left_anti")


def load_folder(
    spark: SparkSession, folder: str, read: Callable[[list[str]], DataFrame], ledger: DataFrame, history: DataFrame,
    keys: Sequence[str] | None = None, pattern: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows to append to the history, files to append to the ledger).

    The folder is listed, files of the ledger are left out, and only the others are
    opened; files without rows are entered too. The names of the new files go
    through the driver, which has to name them to the reader anyway.
    """
    fresh = new_files(list_files(spark, folder, pattern), ledger)
    paths = [r["path"] for r in fresh.collect()]
    entered = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = read(paths) if paths else history.limit(0)
    return new_rows(rows, history, keys), entered
