"""Registered queries: a Spark function and, where SQL can say it, its twin."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweir.catalog.views import load, oracle, view
from logweir.plans.errors import PlanError

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The views and tables of one data folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return view(self.spark, self.sf_dir, name)

    def folder(self) -> str:
        """A folder of this run under the shared checkpoint folder.

        A local session that names none gets one, which holds for all its runs.  On a cluster a folder of one machine
        would lose rows, so it must be named there.
        """
        base = self.spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.match(r"local(\[|$)", self.spark.sparkContext.master):
                raise PlanError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="logweir-")
            self.spark.conf.set("spark.checkpoint.dir", base)
        return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows as a table of their own: built once, and of a known size for joins with it."""
        folder = self.folder()
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def raw(self, table: str) -> DataFrame:
        return load(self.spark, self.sf_dir, table)


def query(name: str, sql: str | None = None, *views: str) -> Callable:
    """Register ``fn(tables)`` under ``name``; ``sql`` reads the named views."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Event times are naive; zoned steps in between must not shift them.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql, *views)
        return fn

    return add
