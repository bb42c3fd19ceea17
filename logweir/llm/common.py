"""What the operators of this folder share: tables, the shared folder, ordinary text rules."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The split that learning operators use: rows with this remainder are never learned from.
FOLDS = 3
HELD_OUT_FOLD = 1

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local session that names none gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(frame: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors.

    A written table also has a known size, so Spark itself decides from it whether to broadcast.  Tables of hashes
    don't compress; written plain they need no codec, whose direct buffers add to an executor's memory.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.option("compression", compression).parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.written_to = path
    return found


def removed(frame: DataFrame) -> None:
    """Delete the table of a frame that ``written`` gave, once nothing reads it any more."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of an Arrow batch, instead of Spark's 10,000: texts may be long, and a batch is held whole on both sides.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def thinned(rows: DataFrame, by: str, hashed: str, most: int, copies: bool = False) -> DataFrame:
    """Rows of each value of ``by`` with the smallest hashes: somewhat more than ``most``, or all if there are fewer.

    A threshold follows from the rows of each value, so a sample is cut in every task and never gathered whole in
    one.  ``by`` has few values: their counts come to the driver.  With ``copies``, rows of one hash count once, and
    all of them stay or go.
    """
    counted = rows.select(by, hashed).distinct() if copies else rows
    counts = {r[by]: r["count"] for r in counted.groupBy(by).count().collect()}
    share = F.lit(0.0)
    for value, count in sorted(counts.items(), key=repr):
        share = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(min(1.0, (1.5 * most + 50) / count))).otherwise(share)
    return rows.where(F.col(hashed).cast("double") / 2.0**64 + 0.5 <= share)


_held: dict = {}


def worker_state(name: str, key: object = None, make: Callable[[], object] = lambda: None) -> object:
    """The state of operator ``name`` in this Python worker, made once for a ``key``.

    Spark hands a worker on from task to task; the state of another operator is let go, so what the operators of a
    pipeline hold does not add up.
    """
    if _held.get("of") != (name, key):
        _held.clear()
        release_memory()
        _held.update(of=(name, key), state=make())
    return _held["state"]


def release_memory() -> None:
    """Give unused memory of this worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_small_batches(frame: DataFrame) -> DataFrame:
    """``frame`` as it is, in a session whose Arrow batches are bounded for texts; a setting of the user's stays."""
    spark = frame.sparkSession
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return frame


def held_out(key: str | Column) -> Column:
    """True where crc32 of the id's text leaves the remainder that is kept for tests; false for null."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
