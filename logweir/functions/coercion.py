"""Counters, scores and times that arrive in several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.derived import stripped


def as_int(column: Column, dtype: T.DataType | None = None) -> Column:
    """An int or a signed digit text as a long; booleans and the rest are NULL."""
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return column.cast("bigint")
    text = stripped(column)
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))


def as_float(column: Column, dtype: T.DataType | None = None) -> Column:
    """A number or numeric text as a double; the rest is NULL."""
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    return stripped(column).try_cast("double")


def as_finite(column: Column, dtype: T.DataType | None = None) -> Column:
    """Like ``as_float``, without infinities and not-a-number."""
    number = as_float(column, dtype)
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def event_order(column: Column) -> list[Column]:
    """Sort keys for a time given as epoch, epoch text or wall-clock text.

    ``(rank, epoch seconds, text)``: what cannot be read as a time sorts last, by text.
    """
    text = stripped(column)
    epoch = F.coalesce(
        F.when(text.rlike(r"^\d+$"), text.try_cast("double")),
        F.unix_timestamp(
            F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"), text))
        ).cast("double"),
    )
    rank = F.when(epoch.isNull(), F.lit(1)).otherwise(F.lit(0))
    return [
        rank.alias("time_rank"),
        F.coalesce(epoch, F.lit(0.0)).alias("time_epoch"),
        F.when(epoch.isNull(), text).otherwise(F.lit("")).alias("time_text"),
    ]


def first_truthy(*columns: Column) -> Column:
    """The first value that is neither NULL, empty text nor zero, as text."""
    kept = [F.when(~c.cast("string").isin("", "0"), c.cast("string")) for c in columns]
    return F.coalesce(*kept)
