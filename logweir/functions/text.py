"""Replacing pattern matches by a function of the match, and redaction."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans import fixed_values as fv


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def replace_each(text: Column, pattern: Column | str, swap: Callable[[Column], Column]) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``swap(match)``.

    The pieces between matches and the matches themselves are cut by the same
    pattern and joined again, so nothing is matched twice and the text is whole.
    """
    sign = SIGNS.get(pattern) if isinstance(pattern, str) else None
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def rejoined(whole: Column, found: Column) -> Column:
        joined = F.transform(
            F.split(whole, pattern, -1),
            lambda piece, i: F.concat(piece, F.coalesce(let(F.get(found, i), swap), F.lit(""))),
        )
        return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(whole)

    def in_text(whole: Column) -> Column:
        swapped = let(F.regexp_extract_all(whole, pattern, F.lit(0)), lambda found: rejoined(whole, found))
        return swapped if sign is None else F.when(sign(whole), swapped).otherwise(whole)

    return let(text, in_text)


#: What a text must hold for a pattern to match at all: a plain search, far cheaper than the pattern.
SIGNS: dict[str, Callable[[Column], Column]] = {
    fv.IPV4_PATTERN: lambda t: t.rlike(r"[0-9]\.[0-9]"),
    fv.MAC_PATTERN: lambda t: t.rlike("[0-9A-Fa-f]{2}[:-]"),
    fv.EMAIL_PATTERN: lambda t: t.contains("@"),
}


def matches(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if pattern not in SIGNS:
        return found
    none = F.when(text.isNotNull(), F.array().cast("array<string>"))
    return F.when(SIGNS[pattern](text), found).otherwise(none)


def quoted(value: Column) -> Column:
    """A value as a pattern that matches only itself."""
    return F.regexp_replace(value, r"([\\.\[\]{}()*+?^$|/-])", r"\\$1")


def _secret_pattern() -> str:
    words = [w for w in fv.SENSITIVE_WORDS if w not in fv.TOO_GENERIC_FOR_TEXT]
    either = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return rf"(?i)\b({either})\b[\"']?\s*[=:]\s*[\"']?([^\s\"'&,;]+)"


SECRET_PATTERN = _secret_pattern()


def redact(text: Column) -> Column:
    """Secrets out of free text: ``key=value`` of sensitive keys and long hex runs."""
    keyed = F.regexp_replace(text, SECRET_PATTERN, "$1=" + fv.REDACTED)
    return F.regexp_replace(keyed, fv.HEX_RUN_PATTERN, fv.REDACTED)


def is_sensitive(name: str) -> bool:
    folded = name.lower().replace("-", "_").replace(" ", "_")
    return any(word in folded for word in fv.SENSITIVE_WORDS)


def _redacted(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        fields = [
            (F.lit(fv.REDACTED) if is_sensitive(f.name) else _redacted(column[f.name], f.dataType)).alias(f.name)
            for f in dtype.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: _redacted(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return _redacted_map(column, dtype)
    if isinstance(dtype, T.StringType):
        return F.when(column.rlike("^[a-fA-F0-9]{21,}$"), F.lit(fv.REDACTED)).otherwise(column)
    return column


def _redacted_map(column: Column, dtype: T.MapType) -> Column:
    if not isinstance(dtype.valueType, T.StringType):
        return F.transform_values(column, lambda _, value: _redacted(value, dtype.valueType))
    words = "|".join(fv.SENSITIVE_WORDS)

    def hidden(key: Column) -> Column:
        return F.lower(F.regexp_replace(key, "[- ]", "_")).rlike(words)

    return F.transform_values(
        column,
        lambda key, value: F.when(hidden(key), F.lit(fv.REDACTED)).otherwise(_redacted(value, dtype.valueType)),
    )


def redact_columns(df: DataFrame) -> DataFrame:
    """Columns and nested fields with a sensitive name hidden, at any depth; so are
    texts that are one long hex run."""
    return df.select(
        *(
            (F.lit(fv.REDACTED) if is_sensitive(f.name) else _redacted(F.col(f"`{f.name}`"), f.dataType)).alias(f.name)
            for f in df.schema.fields
        )
    )
