"""Log tables: one directory per log type, or one table with a ``logtype`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans import fixed_values as fv
from logweir.plans.errors import PlanError
from logweir.plans.timewindow import DAY
from logweir.plans.timewindow import TimeWindow


def log_type(name: str) -> str:
    """The catalogue name of a log type; aliases are resolved, strangers refused."""
    wanted = name.strip().lower()
    wanted = fv.LOG_TYPE_ALIASES.get(wanted, wanted)
    if wanted not in fv.LOG_TYPES:
        raise PlanError(f"unknown log type '{name}'; known: {', '.join(sorted(fv.LOG_TYPES))}")
    return wanted


def read_logs(
    spark: SparkSession,
    path: str,
    name: str,
    window: TimeWindow | None = None,
    time_column: str = "itime",
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    keys: bool = False,
) -> DataFrame:
    """One log type of a table partitioned by ``logtype`` and, if it has one, ``log_date``.

    With ``keys`` the folded pivots of ``write_logs`` are kept, for sweeps.

    A folder without ``logtype`` is one log type's own and must be named for it.  Both conditions are on partition columns, so whole directories are skipped; the
    window on event time then prunes row groups.
    """
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if "logtype" in df.columns:
        df = df.where(F.col("logtype") == log_type(name))
    elif path.rstrip("/").rsplit("/", 1)[-1].lower() not in (log_type(name), f"logtype={log_type(name)}", f"{log_type(name)}.{fmt}"):
        raise PlanError(f"'{path}' has no logtype column and is not the folder of '{name}'")
    if window is not None:
        if DAY in df.columns and isinstance(df.schema[DAY].dataType, T.DateType):
            df = df.where(F.col(DAY).between(F.lit(window.start.date()), F.lit(window.end.date())))
        df = window.filter(df, time_column)
    return df if keys else df.drop(*(c for c in df.columns if c.startswith(key_of(""))))


def key_of(column: str) -> str:
    """The column that holds a pivot's values in lower case."""
    return f"_key_{column}"


def write_logs(
    df: DataFrame,
    path: str,
    time_column: str = "itime",
    mode: str = "append",
    cluster: str | None = None,
    pivots: Sequence[str] = (),
    distinct_values: int = 100_000,
) -> None:
    """Write logs by ``logtype`` and ``log_date``, the day of their event time.

    Event times may be timestamps, dates, epoch seconds or epoch text.  Rows of a day are brought together for large files; adaptive execution splits a
    day that holds a third of all rows over many tasks and merges small ones.

    ``pivots`` that the logs have are kept in lower case as well, each under a bloom filter
    for about ``distinct_values`` in a row group, so that lookups compare them as they
    stand and skip row groups.  With ``cluster``, one of them, the rows of a large day are
    ranged by its values, and rows of one value by time: a value with a third of all rows
    still goes to many tasks.  Days are counted and ranges found over those columns alone,
    so the logs as a whole are read once.
    """
    moment, kind = F.col(f"`{time_column}`"), df.schema[time_column].dataType
    if isinstance(kind, T.StringType):
        seconds = F.when(moment.rlike(r"^\d+$"), moment.try_cast("bigint"))
        day = F.coalesce(_day_of(seconds), moment.try_cast("date"))
    else:
        day = _day_of(moment.cast("bigint")) if isinstance(kind, T.NumericType) else moment.cast("date")
    keyed = [c for c in pivots if c in df.columns]
    dated = df.withColumn(DAY, day).withColumns({key_of(c): F.lower(F.col(f"`{c}`").cast("string")) for c in keyed})
    if cluster is None:
        together = dated.hint("rebalance", F.col("logtype"), F.col(DAY))
    elif cluster not in keyed:
        raise PlanError(f"'{cluster}' is not a pivot of these logs")
    else:
        order = [F.col("logtype"), F.col(DAY), F.col(f"`{key_of(cluster)}`"), moment]
        sliced = _sliced(dated, key_of(cluster), time_column)
        together = sliced.repartition("logtype", DAY, "_slice").sortWithinPartitions(*order).drop("_slice")
    writer = together.write.mode(mode).partitionBy("logtype", DAY)
    for c in keyed:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key_of(c)}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key_of(c)}", str(distinct_values))
    writer.parquet(path)


#: Rows of a day that stay together, and rows looked at for each range of a larger one.
SLICE, LOOKED_AT = 100_000, 20


def _sliced(dated: DataFrame, key: str, time_column: str) -> DataFrame:
    """Rows with ``_slice``: the range of values and times within their day that they fall in.

    A day has as many ranges as it has ``SLICE`` rows, but no more than there are tasks.  To the driver come the
    large days and the cuts between their ranges, from rows taken at random.
    """
    spark, rank = dated.sparkSession, F.struct(F.col(key).alias("key"), F.col(f"`{time_column}`").alias("at"))
    narrow = dated.select("logtype", DAY, rank.alias("rank"))
    days = narrow.groupBy("logtype", DAY).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > SLICE)
    ranges = F.least(F.ceil(F.col("rows") / SLICE), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))).cast("int")
    large = days.withColumn("ranges", ranges)
    rows = large.collect()
    if not rows:
        return dated.withColumn("_slice", F.lit(0))
    # Both tables are on the driver already: a row for each large day.
    held = F.broadcast(spark.createDataFrame(rows, large.schema))
    same_day = narrow["logtype"].eqNullSafe(held["logtype"]) & narrow[DAY].eqNullSafe(held[DAY])
    taken = narrow.join(held, same_day).where(F.rand() < LOOKED_AT * F.col("ranges") / F.col("rows"))
    sorted_ranks = F.sort_array(F.collect_list("rank"))
    found = taken.groupBy(held["logtype"], held[DAY]).agg(F.first("ranges").alias("ranges"), sorted_ranks.alias("ranks"))
    place = lambda i: F.element_at("ranks", (F.floor(i * F.size("ranks") / F.col("ranges")) + 1).cast("int"))
    cuts = found.where("ranges > 1").select("logtype", DAY, F.transform(F.sequence(F.lit(1), F.col("ranges") - 1), place).alias("_cuts"))
    cuts = F.broadcast(spark.createDataFrame(cuts.collect(), cuts.schema))
    same_day = dated["logtype"].eqNullSafe(cuts["logtype"]) & dated[DAY].eqNullSafe(cuts[DAY])
    at = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= rank)), F.lit(0))
    joined = dated.join(cuts, same_day, "left").withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(at))
    return joined.select(*(dated[c] for c in dated.columns), "_slice")


def _day_of(seconds: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))


def union_logs(tables: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Several log types as one stream, labelled; a column a type lacks is NULL."""
    merged: DataFrame | None = None
    for name, df in tables.items():
        if columns is not None:
            df = df.select(*(F.col(f"`{c}`") for c in columns if c in df.columns))
        df = df.withColumn("logtype", F.lit(name))
        merged = df if merged is None else merged.unionByName(df, allowMissingColumns=True)
    if merged is None:
        raise PlanError("no log types to unite")
    return merged


def freshness(df: DataFrame, by: Sequence[str] = ("devid", "devname", "vd"), time_column: str = "itime") -> DataFrame:
    """Per device: first and last log, rows, and rows per second over that span."""
    present = [c for c in by if c in df.columns]
    stats = df.groupBy(*present).agg(
        F.min(time_column).alias("first_log_time"),
        F.max(time_column).alias("last_log_time"),
        F.count(F.lit(1)).alias("log_count"),
    )
    first, last = (F.unix_timestamp(F.col(c).cast("timestamp")) for c in ("first_log_time", "last_log_time"))
    return stats.withColumn("span_seconds", last - first + 1).withColumn(
        "log_rate", F.col("log_count") / F.col("span_seconds")
    )


def _flat(fields: Sequence[T.StructField], prefix: str = "") -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for f in fields:
        name, dtype = prefix + f.name, f.dataType
        out.append((name, dtype.simpleString()))
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if isinstance(inner, T.StructType):
            out += _flat(inner.fields, name + ".")
    return out


def field_catalogue(df: DataFrame, name_filter: str | None = None, filled: bool = False) -> DataFrame:
    """The fields of a table, nested ones dotted, with counts before and after the filter.

    A key that logs lack is a NULL column here, so ``filled`` adds in how many rows a
    field's column has a value.
    """
    names = _flat(df.schema.fields)
    needle = (name_filter or "").lower()
    kept = [(n, t) for n, t in names if needle in n.lower()]
    rows = [(n, t, len(kept), len(names)) for n, t in kept]
    schema = "name string, type string, field_count long, total_field_count long"
    if not filled or not rows:
        return df.sparkSession.createDataFrame(rows, schema)
    roots = sorted({n.split(".")[0] for n, _ in kept})
    counted = df.agg(*(F.count(F.col(f"`{r}`")).alias(f"_{i}") for i, r in enumerate(roots)))
    told = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(kind).alias("type"),
            F.lit(shown).cast("bigint").alias("field_count"),
            F.lit(total).cast("bigint").alias("total_field_count"),
            F.col(f"_{roots.index(name.split('.')[0])}").alias("filled_rows"),
        )
        for name, kind, shown, total in rows
    ]
    return counted.select(F.inline(F.array(*told)))


