"""Dimensions computed from other columns, and the labels of breakdown buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans import fixed_values as fv



def stripped(column: Column) -> Column:
    """Text without surrounding white space of any kind."""
    return F.btrim(column.cast("string"), F.lit(" \t\n\r\x0b\x0c"))


def port(proto: Column, dstport: Column) -> Column:
    """``proto/port``; NULL where the protocol has no ports."""
    number = stripped(dstport)
    usable = proto.isNotNull() & (number != "") & (number != "0")
    return F.when(usable, F.concat(stripped(proto), F.lit("/"), number))


def icmp_type_code(proto: Column, service: Column) -> Column:
    """The ICMP type and code that the service name carries; NULL unless ICMP.

    A service that is neither encoding is an application's name: it becomes
    ``type=unknown``, so that the buckets add up to the ICMP rows.
    """
    name = F.coalesce(stripped(service), F.lit(""))
    parts = F.split(name, "/")
    encoded = F.lower(name).startswith("icmp/") & (F.size(parts) == 3)
    label = (
        F.when(F.upper(name) == "PING", F.lit("type=8/code=0"))
        .when(
            encoded,
            F.concat(F.lit("type="), F.get(parts, F.lit(1)), F.lit("/code="), F.get(parts, F.lit(2))),
        )
        .otherwise(F.lit("type=unknown"))
    )
    return F.when(stripped(proto) == "1", label)


def _column(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


# Extensible: a name and a function from the table to a Column.
DERIVED: dict[str, Callable[[DataFrame], Column]] = {
    "port": lambda df: port(_column(df, "proto"), _column(df, "dstport")),
    "icmp_type_code": lambda df: icmp_type_code(_column(df, "proto"), _column(df, "service")),
}


def bucket(column: Column, dtype: T.DataType = T.StringType()) -> Column:
    """The bucket label of a stored value; NULL for nested, blank and absent words."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.lit(None).cast("string")
    text = stripped(column)
    if not isinstance(dtype, T.StringType):
        return text
    return F.when(~F.lower(text).isin(fv.ABSENT_WORDS), text)


def dimension(df: DataFrame, name: str) -> Column:
    """The bucket label of one row under one dimension, stored or derived."""
    if name in DERIVED:
        return DERIVED[name](df)
    if name not in df.columns:
        return F.lit(None).cast("string")
    return bucket(F.col(f"`{name}`"), df.schema[name].dataType)
