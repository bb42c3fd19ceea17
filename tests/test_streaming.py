"""Streams against the same counts in batch, and late rows."""

from conftest import values
from pyspark.sql import functions as F

from logweir.streaming import counts
from logweir.streaming.rollup import Rollup

SCHEMA = "itime timestamp_ntz, device string"


def put(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "t string, device string").select(F.col("t").cast("timestamp_ntz").alias("itime"), "device")
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql.types import StructType

    rows = [(f"2026-01-01 {h:02d}:{m:02d}:00", f"d{m % 3}") for h in range(5) for m in range(0, 60, 7)]
    put(spark, tmp_path / "in", "a", rows[:20])
    put(spark, tmp_path / "in", "b", rows[20:])
    stream = counts.read_stream(spark, str(tmp_path / "in/*"), StructType.fromDDL(SCHEMA), files_per_batch=1)
    counted = counts.hourly_counts(stream, ["device"])
    counts.write_once(counted, str(tmp_path / "state"), "complete", table="hourly").awaitTermination()
    batch = spark.read.parquet(str(tmp_path / "in/*")).groupBy(F.date_trunc("hour", "itime").cast("timestamp_ntz").alias("bucket"), "device").agg(F.count(F.lit(1)).alias("hits"))
    assert values(spark.table("hourly"), "bucket", "device", "hits") == values(batch, "bucket", "device", "hits")


def test_late_rows_are_left_out_of_windows(spark, tmp_path):
    from pyspark.sql.types import StructType

    stream_of = lambda: counts.hourly_counts(counts.read_stream(spark, str(tmp_path / "in/*"), StructType.fromDDL(SCHEMA)), late="1 hour")
    seen = []

    def keep(batch, _):
        seen.extend((str(r["bucket"]), r["hits"]) for r in batch.collect())

    put(spark, tmp_path / "in", "a", [("2026-01-01 10:00:00", "d"), ("2026-01-01 15:30:00", "d")])
    counts.upsert_counts(stream_of(), str(tmp_path / "state"), keep).awaitTermination()
    put(spark, tmp_path / "in", "b", [("2026-01-01 10:30:00", "d"), ("2026-01-01 15:40:00", "d")])
    counts.upsert_counts(stream_of(), str(tmp_path / "state"), keep).awaitTermination()
    assert sorted(seen) == [("2026-01-01 10:00:00", 1), ("2026-01-01 15:00:00", 1), ("2026-01-01 15:00:00", 2)]


def arrived(spark, folder):
    from pyspark.sql.types import StructType

    return counts.read_stream(spark, f"{folder}/*", StructType.fromDDL(SCHEMA))


def test_late_rows_are_counted_as_rows(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "rollup"), ["device"], late="1 hour")
    put(spark, tmp_path / "in", "a", [("2026-01-01 10:00:00", "d"), ("2026-01-01 15:30:00", "d"), (None, "d")])
    rollup.follow(arrived(spark, tmp_path / "in"), str(tmp_path / "state")).awaitTermination()
    assert rollup.late_rows().count() == 0
    # Fifty in a window long closed, some at its border, some just open still.
    late = [("2026-01-01 10:30:00", "d")] * 50 + [("2026-01-01 13:59:59", "e")] * 7 + [("2026-01-01 14:00:00", "e")] * 3 + [("2026-01-01 16:00:00", "d")]
    put(spark, tmp_path / "in", "b", late)
    rollup.follow(arrived(spark, tmp_path / "in"), str(tmp_path / "state")).awaitTermination()
    want = [("2026-01-01 10:00:00", "d", 50), ("2026-01-01 13:00:00", "e", 7)]
    assert sorted((str(r["bucket"]), r["device"], r["hits"]) for r in rollup.late_rows().collect()) == want
    assert rollup.counts().agg(F.sum("hits")).first()[0] == 63 and rollup.counts(with_late=False).agg(F.sum("hits")).first()[0] == 6


def test_repeated_batches_and_compaction_count_nothing_twice(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "rollup"), ["device"], late="1 hour")
    frames, rows = [], []
    for n, days in enumerate(([1, 2], [2, 3], [1, 4])):
        part = [(f"2026-01-{d:02d} {h:02d}:{m:02d}:00", f"d{m % 2}") for d in days for h in (1, 5) for m in range(0, 30, 7 + n)]
        rows += part
        frames.append(spark.createDataFrame(part, "t string, device string").select(F.col("t").cast("timestamp_ntz").alias("itime"), "device"))
    every = frames[0].unionByName(frames[1]).unionByName(frames[2])
    want = values(every.groupBy(F.date_trunc("hour", "itime").cast("timestamp_ntz").alias("bucket"), "device").agg(F.count(F.lit(1)).alias("hits")), "bucket", "device", "hits")
    rollup.take(frames[0], 0)
    rollup.take(frames[0], 0)
    rollup.take(frames[1], 1)
    first = values(rollup.late_rows())
    rollup.compact()
    untouched = sorted(str(p) for p in (tmp_path / "rollup/days/day=2026-01-03").glob("*.parquet"))
    rollup.take(frames[1], 1)
    assert values(rollup.late_rows()) == first
    rollup.take(frames[2], 2)
    late = values(rollup.late_rows())
    rollup.compact()
    rollup.compact()
    assert values(rollup.counts(), "bucket", "device", "hits") == want and values(rollup.late_rows()) == late
    # A day that the third batch does not touch keeps its files.
    assert sorted(str(p) for p in (tmp_path / "rollup/days/day=2026-01-03").glob("*.parquet")) == untouched
    assert {p.name for p in (tmp_path / "rollup/increments").glob("batch=*")} == {"batch=2"}


def test_batches_of_changed_windows_hold_the_last_state(spark, tmp_path):
    from pyspark.sql.types import StructType

    stream_of = lambda: counts.hourly_counts(counts.read_stream(spark, str(tmp_path / "in/*"), StructType.fromDDL(SCHEMA)), ["device"])
    for name, minute in (("a", 10), ("b", 20)):
        put(spark, tmp_path / "in", name, [(f"2026-01-01 10:{minute}:00", "d"), (f"2026-01-01 10:{minute}:30", "e")])
        counts.upsert_files(stream_of(), str(tmp_path / "state"), str(tmp_path / "out")).awaitTermination()
    assert [(d, n) for _, d, n in values(counts.latest_counts(spark, str(tmp_path / "out"), ["device"]), "bucket", "device", "hits")] == [("d", 2), ("e", 2)]
