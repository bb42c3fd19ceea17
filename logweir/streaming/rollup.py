"""Counts by window and key kept as a table by a stream, late rows told apart and counted exactly.

Every batch adds its own counts under its batch id, so a batch that is run again replaces what it wrote and nothing is
counted twice.  A window is late in a batch if it had closed longer than ``late`` before the newest time of all earlier
batches; its rows are counted as rows, not as groups, and stay in the table with that mark.  No state is kept in
executors: the newest time so far is one value a batch.  ``compact`` folds the batches into days and rewrites only days
that they touch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


@dataclass(frozen=True)
class Rollup:
    """Counts under ``folder``, a place that all executors share."""

    spark: SparkSession
    folder: str
    keys: Sequence[str] = ()
    time_column: str = "itime"
    width: str = "1 hour"
    late: str = "2 days"

    def follow(self, logs: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take all that has arrived, batch by batch, and stop."""
        writer = logs.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.foreachBatch(self.take).start()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One batch: counted once, written under its id, then the newest time so far beside it.

        Rows without a time are left out.  Brings one time to the driver.
        """
        closed = self._newest(before=batch_id) - F.expr(f"interval {self.late}")
        window = F.window(F.col(self.time_column).cast("timestamp"), self.width)
        counted = batch.where(F.col(self.time_column).isNotNull()).groupBy(window.alias("_w"), *self.keys)
        increments = counted.agg(F.count(F.lit(1)).alias("hits"), F.max(F.col(self.time_column).cast("timestamp")).alias("newest")).select(
            F.col("_w.start").cast("timestamp_ntz").alias("bucket"),
            *self.keys,
            "hits",
            "newest",
            F.coalesce(F.col("_w.end") <= closed, F.lit(False)).alias("late"),
        )
        path = f"{self.folder}/increments/batch={batch_id}"
        increments.write.mode("overwrite").parquet(path)
        here = self.spark.read.schema(increments.schema).parquet(path).agg(F.max("newest").alias("newest"))
        mark = here.select(F.greatest("newest", self._newest(before=batch_id)).alias("newest"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/marks/batch={batch_id}")

    def _newest(self, before: int) -> Column:
        """The newest time of all batches before one, as a literal; null where there are none."""
        start = self.spark.range(1).select(F.lit(None).cast("timestamp").alias("newest"))
        start.write.mode("ignore").parquet(f"{self.folder}/marks/batch=-1")
        marks = self.spark.read.schema("newest timestamp, batch long").parquet(f"{self.folder}/marks")
        found = marks.where(F.col("batch") < before).agg(F.max_by("newest", "batch").alias("newest")).first()["newest"]
        return F.lit(found).cast("timestamp")

    def _increments(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/increments").withColumn("day", F.to_date("bucket"))

    def _base(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/days")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.parquet(f"{self.folder}/days")

    def _fresh(self) -> DataFrame:
        """Increments that no day holds yet."""
        every, base = self._increments(), self._base()
        if base is None:
            return every
        held = base.groupBy("day").agg(F.max("upto").alias("upto"))
        return every.join(held, "day", "left").where(F.col("batch") > F.coalesce("upto", F.lit(-1))).drop("upto")

    def _summed(self, *more: Column) -> DataFrame:
        """Hits and late hits of days and fresh increments together."""
        names = ["day", "bucket", *self.keys]
        late = F.when(F.col("late"), F.col("hits")).otherwise(F.lit(0))
        rows = self._fresh().select(*names, "hits", late.cast("long").alias("late_hits"))
        base = self._base()
        if base is not None:
            rows = rows.unionByName(base.select(*rows.columns))
        return rows.groupBy(*names).agg(F.sum("hits").alias("hits"), F.sum("late_hits").alias("late_hits"), *more)

    def counts(self, with_late: bool = True) -> DataFrame:
        """Rows by window and key, late ones with the rest or left out."""
        hits = F.col("hits") if with_late else F.col("hits") - F.col("late_hits")
        return self._summed().select("bucket", *self.keys, hits.alias("hits")).where("hits > 0")

    def late_rows(self) -> DataFrame:
        """Rows that came after their window had closed, by window and key."""
        return self._summed().where("late_hits > 0").select("bucket", *self.keys, F.col("late_hits").alias("hits"))

    def compact(self) -> None:
        """Fold all increments into their days; only days with fresh increments are written.

        A day remembers the last batch it holds, so folding again adds nothing, nor does a batch that is repeated
        later.  Folded increments are deleted at last.
        """
        upto = self._increments().agg(F.max("batch")).first()[0]
        touched = self._fresh().select("day").distinct()
        staged = f"{self.folder}/staged"
        days = self._summed().join(touched, "day", "left_semi").withColumn("upto", F.lit(upto).cast("long"))
        days.write.mode("overwrite").parquet(staged)
        days = self.spark.read.schema(days.schema).parquet(staged)
        days.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.folder}/days")
        batches = [r["batch"] for r in self._increments().select("batch").distinct().collect()]
        for batch in (b for b in batches if b < upto):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/increments/batch={batch}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
