"""Field names: canonical spellings, aliases, enum codes and default columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.plans import fixed_values as fv
from logweir.plans.errors import PlanError, UnknownField

_NAME = re.compile(fv.FIELD_NAME_PATTERN)


@dataclass(frozen=True)
class Vocabulary:
    """What is known about the columns of one table."""

    name: str
    fields: frozenset[str]
    aliases: Mapping[str, str]
    default_columns: tuple[str, ...] = ()
    codes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    members: Mapping[str, Sequence[str]] = field(default_factory=dict)
    closed: bool = False

    def resolve(self, name: str, strict: bool = True) -> tuple[str, str | None]:
        """``(column name, warning)``; ``strict`` makes a closed table refuse strangers."""
        wanted = name.strip().lower()
        known = wanted if wanted in self.fields else self.aliases.get(wanted)
        if known:
            return known, None
        if self.closed and strict:
            raise UnknownField(f"'{name}' is not a {self.name} field; known: {sorted(self.fields)}")
        if not _NAME.match(wanted):
            raise PlanError(f"'{name}' is not shaped like a field name")
        return wanted, f"'{name}' is not a known {self.name} field; used as it stands"

    def code(self, column: str, value):
        """The stored code of an enum name; other values pass through."""
        table = self.codes.get(column)
        if table is None or not isinstance(value, str):
            return value
        try:
            return table[value.strip().lower()]
        except KeyError:
            raise PlanError(
                f"'{value}' is not a {column} value; known: {sorted(table)}"
            ) from None

    def member_warning(self, column: str, value) -> str | None:
        """A warning for a value outside a text enum, which is never refused."""
        known = self.members.get(column)
        if known is None or not isinstance(value, str) or value.strip().lower() in known:
            return None
        return f"'{value}' is not a known {self.name} {column} value ({', '.join(sorted(known))})"


def _log(name: str) -> Vocabulary:
    members = {
        "traffic": {"action": fv.TRAFFIC_ACTIONS},
        "attack": {"action": fv.IPS_ACTIONS},
        "event": {"level": fv.EVENT_LEVELS, "subtype": fv.EVENT_SUBTYPES},
    }
    return Vocabulary(
        name=name,
        fields=frozenset([*fv.COMMON_FIELDS, *fv.EXTRA_FIELDS.get(name, "").split()]),
        aliases=fv.LOG_ALIASES,
        default_columns=tuple(fv.DEFAULT_COLUMNS.get(name, "").split()),
        members=members.get(name, {}),
    )


def _entity(name: str) -> Vocabulary:
    codes = {
        "device": {"conn_status": fv.CONNECTION_CODES},
        "task": {"state": fv.TASK_CODES},
    }
    return Vocabulary(
        name=name,
        fields=frozenset(fv.ENTITY_FIELDS[name].split()),
        aliases=fv.ENTITY_ALIASES[name],
        default_columns=tuple(fv.DEFAULT_COLUMNS.get(name, "").split()),
        codes=codes.get(name, {}),
        closed=name in codes,
    )


VOCABULARIES: dict[str, Vocabulary] = {
    **{name: _log(name) for name in fv.EXTRA_FIELDS},
    **{name: _entity(name) for name in fv.ENTITY_FIELDS},
}


def vocabulary(name: str) -> Vocabulary:
    """The vocabulary of a table; log types without their own get the common one."""
    wanted = name.strip().lower()
    return VOCABULARIES.get(wanted) or _log("log")


@dataclass(frozen=True)
class Projection:
    df: DataFrame
    warnings: tuple[str, ...]

    @property
    def fields_returned(self) -> list[str]:
        return sorted(self.df.columns)


def project(df: DataFrame, vocab: Vocabulary, fields: Sequence[str] | None = None) -> Projection:
    """Select columns.  None: the default set; ``["*"]``: all; else the named ones.

    Top-level columns only, never renamed.  A known or well-shaped name the table
    lacks is left out with a warning, as the key would be absent from each row.
    """
    if fields is None:
        if not vocab.default_columns:
            return Projection(df, (f"no default columns for {vocab.name}; full rows returned",))
        return Projection(df.select(*_quoted(c for c in vocab.default_columns if c in df.columns)), ())
    if not fields:
        raise PlanError("fields is empty; leave it out for the default set")
    if "*" in fields:
        if len(fields) > 1:
            raise PlanError("'*' already means every field; name it alone")
        return Projection(df, ())
    warnings: list[str] = []
    names: dict[str, None] = {}
    for wanted in fields:
        name, warning = vocab.resolve(wanted, strict=False)
        if warning:
            warnings.append(warning)
        names.setdefault(name)
    missing = [n for n in names if n not in df.columns]
    warnings += [f"'{n}' is not a column of this table" for n in missing]
    return Projection(df.select(*_quoted(n for n in names if n in df.columns)), tuple(warnings))


def _quoted(names: Iterable[str]) -> list:
    return [F.col(f"`{n}`") for n in names]


def dimensions(vocab: Vocabulary, names: Sequence[str], derived: Iterable[str]) -> tuple[list[str], list[str]]:
    """Canonical dimension names in first-spelling order, and warnings."""
    seen: dict[str, None] = {}
    warnings: list[str] = []
    for name in names:
        wanted = name.strip().lower()
        if wanted not in derived:
            wanted, warning = vocab.resolve(name)
            if warning:
                warnings.append(warning)
        seen.setdefault(wanted)
    return list(seen), warnings
