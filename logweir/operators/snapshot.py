"""Pages over one state of a table: a manifest of its files, and reads of exactly those.

A cursor alone keeps its place when newer rows arrive, but rows with old times slip in before it.  The first page writes
a manifest of the files that its answer came from, with the rows of each; later pages carry a reference to it and
read these files only.  Files of a log table are written once, so the same files are the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logweir.operators.paging import cursor_of, page_after

#: The key under which a cursor carries its manifest.
REFERENCE = "snapshot"
_FILE = ("file_path", "file_size", "file_modification_time")


def _files(df: DataFrame) -> DataFrame:
    """One row for each file that gives rows: merged in every task, so one row a file and task is shuffled."""
    told = [F.col(f"_metadata.{c}").alias(c) for c in _FILE]
    return df.groupBy(*told).agg(F.count(F.lit(1)).alias("rows"))


def take(df: DataFrame, store: str) -> str:
    """Write the manifest of a filtered scan under ``store``, a shared folder; its path is the reference."""
    reference = f"{store.rstrip('/')}/manifest-{uuid.uuid4().hex}"
    _files(df).write.parquet(reference)
    return reference


def manifest(spark: SparkSession, reference: str) -> DataFrame:
    return spark.read.parquet(reference)


def at(df: DataFrame, reference: str) -> DataFrame:
    """The rows of a scan that come from the files of a manifest.

    Files changed after the newest of them are left out when files are listed; the rest by a semi join with the
    manifest, one row a file.
    """
    here, there = _free(df, "_here"), _free(df, "_there")
    files = manifest(df.sparkSession, reference).select(F.struct(*_FILE).alias(there))
    newest = files.agg(F.max(f"{there}.file_modification_time")).first()[0]
    told = df.withColumn(here, F.struct(*(F.col(f"_metadata.{c}") for c in _FILE))).where(F.col("_metadata.file_modification_time") <= F.lit(newest))
    return told.join(files, F.col(here) == F.col(there), "left_semi").drop(here)


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table does not use."""
    while name in df.columns:
        name += "_"
    return name


def total(spark: SparkSession, reference: str) -> DataFrame:
    """One row: how many rows matched when the manifest was taken; no log is read."""
    return manifest(spark, reference).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))


def first_page(df: DataFrame, store: str, limit: int = 100, time_column: str = "itime", ties: Sequence[str] = ("logid",)) -> tuple[DataFrame, str]:
    """The first page of a scan, and the reference that its cursor must carry."""
    reference = take(df, store)
    return page_after(at(df, reference), None, limit, time_column, ties), reference


def cursor(row: Row, reference: str, time_column: str = "itime", ties: Sequence[str] = ("logid",)) -> dict[str, object]:
    """The cursor behind the last row of a page."""
    return {**cursor_of(row, time_column, ties), REFERENCE: reference}


def next_page(df: DataFrame, cursor: Mapping[str, object], limit: int = 100, time_column: str = "itime", ties: Sequence[str] = ("logid",)) -> DataFrame:
    """The page behind a cursor, of the files that the first page was made from."""
    place = {k: v for k, v in cursor.items() if k != REFERENCE}
    return page_after(at(df, str(cursor[REFERENCE])), place, limit, time_column, ties)


def drift(df: DataFrame, reference: str) -> DataFrame:
    """One row: the same scan now held against the manifest, as files and rows gained and lost.

    ``complete`` tells whether all files of the manifest are still there; if not, later pages lack rows.
    """
    sides = [(manifest(df.sparkSession, reference), 0), (_files(df), 1)]
    both = sides[0][0].select(*_FILE, "rows", F.lit(0).alias("side")).unionByName(sides[1][0].select(*_FILE, "rows", F.lit(1).alias("side")))
    files = both.groupBy(*_FILE).agg(F.max("rows").alias("rows"), F.min("side").alias("first"), F.max("side").alias("last"))
    gone, come = F.col("last") == 0, F.col("first") == 1

    def rows(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("rows"))), F.lit(0))

    return files.agg(
        rows(~come).alias("total"),
        rows(~gone).alias("page_total"),
        F.count_if(come).alias("new_files"),
        F.count_if(gone).alias("lost_files"),
        rows(come).alias("new_rows"),
        rows(gone).alias("lost_rows"),
    ).select(
        "*",
        (F.col("page_total") - F.col("total")).alias("total_delta"),
        F.when((F.col("new_files") == 0) & (F.col("lost_files") == 0), "stable").otherwise("drifted").alias("stability"),
        (F.col("lost_files") == 0).alias("complete"),
    )
