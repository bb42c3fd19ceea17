"""Conditions over one table, compiled to a single Column.

Text compares without regard to case.  ``lower()`` hides a column from the Parquet
scan, so it is applied only where the value has letters: an address, number or
time value compares on the raw column and is pushed down.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans.errors import PlanError
from logweir.plans.vocabulary import Vocabulary

ORDERINGS = {
    "gt": Column.__gt__,
    "gte": Column.__ge__,
    "lt": Column.__lt__,
    "lte": Column.__le__,
}
OPS = ("eq", "ne", *ORDERINGS, "contains", "not_contains", "in", "not_in")


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: Any


@dataclass(frozen=True)
class Predicate:
    column: Column
    warnings: tuple[str, ...] = ()

    def filter(self, df: DataFrame) -> DataFrame:
        return df.where(self.column)


def all_of(columns: Iterable[Column]) -> Column:
    return reduce(and_, columns, F.lit(True))


def any_of(columns: Iterable[Column]) -> Column:
    return reduce(or_, columns, F.lit(False))


def never_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def has_value(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) != ""


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _as_number(text: str) -> int | float | None:
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return None


def equals(column: Column, dtype: T.DataType, value, case_sensitive: bool = False) -> Column:
    """``column = value`` on the column's own type; NULL where the column is NULL."""
    if _is_number(dtype):
        number = value if not isinstance(value, str) else _as_number(value.strip())
        if number is None:
            return F.when(column.isNotNull(), F.lit(False))
        return column == F.lit(number)
    if isinstance(dtype, T.StringType):
        text = str(value)
        if case_sensitive or text.lower() == text.upper():
            return column == F.lit(text)
        return F.lower(column) == F.lit(text.lower())
    return column == F.lit(value).cast(dtype)


def one_of(column: Column, dtype: T.DataType, values: Sequence, case_sensitive: bool = False) -> Column:
    """``column IN values`` as one set test rather than a chain of ORs."""
    if _is_number(dtype):
        numbers = [v if not isinstance(v, str) else _as_number(v.strip()) for v in values]
        numbers = [n for n in numbers if n is not None]
        return column.isin(numbers) if numbers else F.when(column.isNotNull(), F.lit(False))
    texts = sorted({str(v) for v in values})
    if case_sensitive or all(t.lower() == t.upper() for t in texts):
        return column.isin(texts)
    return F.lower(column).isin(sorted({t.lower() for t in texts}))


def contains(column: Column, value) -> Column:
    """Literal substring, whatever the case."""
    return F.lower(column.cast("string")).contains(str(value).lower())


def _ordered(column: Column, dtype: T.DataType, op: str, value) -> Column:
    if isinstance(dtype, T.StringType):
        number = value if not isinstance(value, str) else _as_number(value)
        if number is not None:
            # Numbers stored as text compare as numbers: "9" is below "10".
            wide = "decimal(38,10)" if isinstance(number, int) else "double"
            return ORDERINGS[op](column.try_cast(wide), F.lit(number).cast(wide))
        return ORDERINGS[op](F.lower(column), F.lit(str(value).lower()))
    if _is_number(dtype):
        number = value if not isinstance(value, str) else _as_number(value.strip())
        if number is None:
            raise PlanError(f"'{value}' is not a number")
        return ORDERINGS[op](column, F.lit(number))
    return ORDERINGS[op](column, F.lit(value).cast(dtype))


def _checked(condition: Condition) -> list:
    value, many = condition.value, condition.op in ("in", "not_in")
    if condition.op not in OPS:
        raise PlanError(f"unknown op '{condition.op}'; known: {', '.join(OPS)}")
    if isinstance(value, (list, tuple)) != many:
        wants = "a list" if many else "one value"
        raise PlanError(f"'{condition.op}' on '{condition.field}' takes {wants}")
    values = list(value) if many else [value]
    if not values:
        raise PlanError(f"'{condition.op}' on '{condition.field}' has nothing to match")
    if any(isinstance(v, bool) for v in values):
        raise PlanError(f"'{condition.field}' cannot be compared with a boolean")
    return values


def _compiled(column: Column, dtype: T.DataType, op: str, values: list, case_sensitive: bool) -> Column:
    if op == "eq":
        return equals(column, dtype, values[0], case_sensitive)
    if op == "ne":
        return ~never_null(equals(column, dtype, values[0], case_sensitive))
    if op == "in":
        return one_of(column, dtype, values, case_sensitive)
    if op == "not_in":
        return ~never_null(one_of(column, dtype, values, case_sensitive))
    if op == "contains":
        return contains(column, values[0])
    if op == "not_contains":
        # The complement: rows that lack the field pass.
        return ~never_null(contains(column, values[0]))
    return _ordered(column, dtype, op, values[0])


def compile_conditions(
    conditions: Sequence[Condition],
    vocab: Vocabulary,
    df: DataFrame,
    case_sensitive: bool = False,
) -> Predicate:
    """All conditions ANDed, and one warning per name or value that looks wrong."""
    warnings: list[str] = []
    columns: list[Column] = []
    for condition in conditions:
        values = _checked(condition)
        name, warning = vocab.resolve(condition.field)
        warnings += [warning] if warning else []
        substring = condition.op in ("contains", "not_contains")
        if substring and name in vocab.codes:
            raise PlanError(
                f"'{name}' holds codes, so a substring of a name cannot match; "
                f"use eq or ne with one of {sorted(vocab.codes[name])}"
            )
        if not substring:
            found = (vocab.member_warning(name, v) for v in values)
            warnings += [w for w in found if w]
        values = [vocab.code(name, v) for v in values]
        if name in df.columns:
            column, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        else:
            warnings.append(f"'{name}' is not a column of this table")
            column, dtype = F.lit(None).cast("string"), T.StringType()
        columns.append(_compiled(column, dtype, condition.op, values, case_sensitive))
    return Predicate(all_of(columns), tuple(warnings))
