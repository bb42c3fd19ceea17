"""Pseudonymised tables, the dictionary that reverses them, and leak checks."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import nested
from logweir.functions.text import let, matches, quoted, replace_each
from logweir.functions.tokens import PREFIXES, Tokenizer, is_kept, kept, url_parts
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import Condition, any_of
from logweir.plans.errors import PlanError
from logweir.plans.vocabulary import Vocabulary

COLUMN_TYPES: dict[str, str] = {
    column: kind for kind, columns in fv.MASKED_COLUMNS.items() for column in columns.split()
}
URL_COLUMNS = {"url": "url_full", "referralurl": "url_full", "link": "url_full", "http_url": "url_host"}
PREFIXED_COLUMNS = ("groupby1", "groupby2")
JSON_COLUMNS = ("grpby",)
# The types whose values a pattern finds in text; the others are told by their words.
PATTERNS = {"ip": fv.IPV4_PATTERN, "mac": fv.MAC_PATTERN, "email": fv.EMAIL_PATTERN}


@dataclass(frozen=True)
class Leaf:
    """A text field anywhere in a record: its name, and its text or texts.

    The fields of a map are known by its keys only; their leaf has the map's name, and a
    type of its own if it holds the values under the keys of one type.
    """

    name: str
    column: Column
    listed: bool
    kind: str | None = None

    def type_of(self, types: Mapping[str, str]) -> str | None:
        return self.kind or types.get(self.name.lower())

    def texts(self) -> Column:
        """All texts of the field, an empty array where there is none."""
        texts = self.column if self.listed else F.array(self.column)
        return F.coalesce(F.array_compact(texts), F.array().cast("array<string>"))


Groups = Mapping[str, Sequence[str]]


def leaves(df: DataFrame, keys: Groups | None = None) -> list[Leaf]:
    """The text fields of a table, also inside structs, lists and maps.

    A map gives all its values, or with ``keys`` (type -> names) those under the keys
    of each type.
    """
    return [leaf for f in df.schema.fields for leaf in _field_leaves(df, f, keys)]


def _field_leaves(df: DataFrame, field: T.StructField, keys: Groups | None) -> list[Leaf]:
    if f"{_WALK}{field.name}" in df.columns:
        return _keyed(field.name, F.col(f"`{_SAID}{field.name}`"), keys)
    return [] if field.name.startswith(_WALK) else _leaves(field.name, F.col(f"`{field.name}`"), field.dataType, keys)


def _is_by_key(df: DataFrame, field: T.StructField, leaf: Leaf) -> bool:
    """Whether ``_typed_by_key`` gives the values of this leaf already."""
    return f"{_WALK}{field.name}" in df.columns and leaf.kind not in (None, "text")


_WALK = "_walk_"
_SAID = "_walk_said_"
_SOUND = "_walk_:sound:"
_TEXT = "_walk_:text:"


def _is_json(name: str, dtype: T.DataType) -> bool:
    return isinstance(dtype, T.VariantType) or isinstance(dtype, T.StringType) and name.lower() in JSON_COLUMNS


def _json_text(column: Column, dtype: T.DataType) -> Column:
    return F.to_json(column) if isinstance(dtype, T.VariantType) else column


def walked_once(df: DataFrame, keyed: bool = True) -> DataFrame:
    """``df`` with the parts of each JSON column, and its string values, in columns beside it for ``leaves`` and the masker.

    Without ``keyed`` only string values are told, and none has a key.
    """
    held = [f for f in df.schema.fields if _is_json(f.name, f.dataType)]
    if not held:
        return df
    df = df.withColumns({f"{_TEXT}{f.name}": F.to_json(F.col(f"`{f.name}`")) for f in held if isinstance(f.dataType, T.VariantType)})
    df = df.withColumns({f"{_SOUND}{f.name}": nested.sound(_held_text(f)) for f in held})
    sound = {f.name: F.col(f"`{_SOUND}{f.name}`") for f in held}
    if not keyed:
        df = df.withColumns({f"{_WALK}{f.name}": sound[f.name] for f in held})
        return df.withColumns({f"{_SAID}{f.name}": nested.strings(_held_text(f), sound[f.name]) for f in held})
    walked = df.withColumns({f"{_WALK}{f.name}": F.when(nested.shaped(_held_text(f)), nested.parts_of(_held_text(f), sound[f.name])) for f in held})
    return walked.withColumns({f"{_SAID}{f.name}": nested.values(_held_text(f), F.col(f"`{_WALK}{f.name}`")) for f in held})


def _held_text(field: T.StructField) -> Column:
    """The text of a JSON column of a table that ``walked_once`` gave."""
    return F.col(f"`{_TEXT}{field.name}`") if isinstance(field.dataType, T.VariantType) else F.col(f"`{field.name}`")


def _kind_of_key(key: Column, types: Mapping[str, str]) -> Column:
    """The type of a field of this name; null where it has none or holds prose."""
    kind = F.lit(None).cast("string")
    for name, names in keys_by_type({n: t for n, t in types.items() if t != "text" and n not in URL_COLUMNS}).items():
        kind = F.when(key.isin(names), F.lit(name)).otherwise(kind)
    return kind


def _typed_by_key(df: DataFrame, name: str, types: Mapping[str, str]) -> Column:
    """``array<struct<kind, value>>`` of the string values of a walked column under keys of a type: its typed leaves in one."""
    said = F.transform(F.col(f"`{_SAID}{name}`"), lambda v: F.struct(_kind_of_key(v["key"], types).alias("kind"), v["value"].alias("value")))
    return F.coalesce(F.filter(said, lambda v: v["kind"].isNotNull()), F.array().cast("array<struct<kind:string,value:string>>"))


def _keyed(name: str, values: Column, keys: Groups | None) -> list[Leaf]:
    """The leaves of a JSON text from its string values: all of them, or those under the keys of each type.

    URLs have a leaf of their own; what has no type counts as text.
    """

    def under(names: Sequence[str]) -> Column:
        return _picked(F.filter(values, lambda v: v["key"].isin(list(names))), "value")

    if keys is None:
        return [Leaf(name, _picked(values, "value"), True)]
    typed = {kind: [n for n in names if n not in URL_COLUMNS] for kind, names in keys.items() if kind != "text"}
    found = [Leaf(name, under(names), True, kind) for kind, names in typed.items()]
    if "text" in keys:
        known = [n for names in typed.values() for n in names] + list(URL_COLUMNS)
        rest = _picked(F.filter(values, lambda v: ~v["key"].isin(known)), "value")
        found += [Leaf(url, under([url]), True) for url in URL_COLUMNS] + [Leaf(name, rest, True, "text")]
    return found


def keys_by_type(types: Mapping[str, str]) -> dict[str, list[str]]:
    """Type -> the field names of it."""
    return {kind: sorted(n for n, t in types.items() if t == kind) for kind in sorted(set(types.values()))}


def _leaves(name: str, column: Column, dtype: T.DataType, keys: Groups | None) -> list[Leaf]:
    if _is_json(name, dtype):
        return _keyed(name, nested.values(_json_text(column, dtype)), keys)
    if isinstance(dtype, T.StringType):
        return [Leaf(name, column, False)]
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f.name, column[f.name], f.dataType, keys)]
    if isinstance(dtype, T.MapType):
        return _mapped(name, F.map_entries(column), dtype, keys)
    return _listed(name, column, dtype.elementType, keys) if isinstance(dtype, T.ArrayType) else []


def _listed(name: str, column: Column, inner: T.DataType, keys: Groups | None) -> list[Leaf]:
    if _is_json(name, inner):
        return _keyed(name, F.flatten(F.transform(column, lambda c: nested.values(_json_text(c, inner)))), keys)
    if isinstance(inner, T.StringType):
        return [Leaf(name, column, True)]
    if isinstance(inner, T.ArrayType):
        return _listed(name, F.flatten(column), inner.elementType, keys)
    if isinstance(inner, T.MapType):
        return _mapped(name, F.flatten(F.transform(column, lambda m: F.map_entries(m))), inner, keys)
    if isinstance(inner, T.StructType):
        return [
            leaf
            for f in inner.fields
            for leaf in _listed(f.name, _picked(column, f.name), f.dataType, keys)
        ]
    return []


def _mapped(name: str, entries: Column, dtype: T.MapType, keys: Groups | None) -> list[Leaf]:
    """The leaves of a map from its entries: values under typed keys, and what lies deeper."""
    every = _listed(name, _picked(entries, "value"), dtype.valueType, keys)
    if keys is None or not _is_text(dtype.valueType):
        return every
    found = []
    for kind, names in keys.items():
        own = F.filter(entries, _has_key(names))
        found += [replace(leaf, kind=kind) for leaf in _listed(name, _picked(own, "value"), dtype.valueType, keys)]
    return found


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType) or isinstance(dtype, T.ArrayType) and _is_text(dtype.elementType)


def _has_key(names: Sequence[str]) -> Callable[[Column], Column]:
    return lambda entry: F.lower(entry["key"].cast("string")).isin(list(names))


def _picked(column: Column, name: str) -> Column:
    return F.transform(column, lambda item: item[name])


def type_table(df: DataFrame, mask_devices: bool = False, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Field name -> semantic type.  A column may name its own type in its metadata
    under ``pii``."""
    known = dict(COLUMN_TYPES)
    if mask_devices:
        known |= {c: "hostname" for c in fv.DEVICE_COLUMNS}
        if _is_device(df.columns):
            known["name"] = "hostname"
    known |= {f.name.lower(): f.metadata["pii"] for f in df.schema.fields if "pii" in f.metadata}
    return known | dict(extra or {})


def column_types(df: DataFrame, mask_devices: bool = False, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """The fields of this table that carry identifiers, and of which type."""
    known = type_table(df, mask_devices, extra)
    return {x.name: x.type_of(known) for x in leaves(df, {}) if x.type_of(known)}


def _is_device(columns: Sequence[str]) -> bool:
    return "name" in columns and any(c.lower() in fv.DEVICE_SHAPE_COLUMNS for c in columns)


def kept_values(df: DataFrame) -> Column | None:
    """The device names and serials a record shows, which stay readable everywhere
    in it; None where the table has no such field."""
    parts = []
    names = [*fv.DEVICE_COLUMNS, *(["name"] if _is_device(df.columns) else [])]
    for leaf in leaves(df, {"device": names, "domains": ["devvds"]}):
        if leaf.kind == "domains" or leaf.kind is None and leaf.name.lower() == "devvds":
            cut = F.flatten(F.transform(leaf.texts(), lambda v: F.split(v, ",")))
            parts.append(F.transform(cut, lambda p: F.trim(F.regexp_replace(p, r"\[[^\[\]]*\]$", ""))))
        elif leaf.kind == "device" or leaf.kind is None and leaf.name.lower() in names:
            # A list is already split; one text may hold several names.
            cut = leaf.texts() if leaf.listed else F.split(F.coalesce(leaf.column, F.lit("")), ",")
            parts.append(F.transform(cut, lambda p: F.trim(p)))
    return kept(F.filter(F.concat(*parts), lambda v: v != "")) if parts else None


def _devices_told(df: DataFrame, value: Column) -> Column | None:
    """Whether a value may be one that its record keeps: a cheap search in the device texts, before they are taken apart.

    None where devices are not told by plain text columns alone.
    """
    names = [*fv.DEVICE_COLUMNS, "devvds", *(["name"] if _is_device(df.columns) else [])]
    if any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) or f.name.startswith(_WALK) for f in df.schema.fields):
        return None
    told = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name.lower() in names]
    return F.lower(F.concat_ws(",", *told)).contains(F.lower(value)) | value.contains(",")


def prefixed(tokens: Tokenizer, value: Column, keep: Column | None = None, types: Mapping[str, str] = COLUMN_TYPES) -> Column:
    """``field:value`` with the value masked by its field's type."""
    name = F.lower(F.substring_index(value, ":", 1))
    raw = F.substring(value, F.length(name) + 2, F.length(value))
    masked = value
    for kind in sorted(set(types.values()) - {"text"}):
        fields = [c for c, t in types.items() if t == kind]
        made = F.concat(F.substring_index(value, ":", 1), F.lit(":"), tokens.mask(kind, raw, keep))
        masked = F.when(name.isin(fields) & value.contains(":") & (raw != ""), made).otherwise(masked)
    return masked


def targets(tokens: Tokenizer, items: Column, keep: Column | None = None) -> Column:
    """``target[]``: each ``value`` masked by the ``name`` beside it.

    A name outside the table may hold anything, so its value is burned.
    """

    def one(item: Column) -> Column:
        value = tokens.placeholder(item["value"])
        for kind in sorted(set(fv.TARGET_TYPES.values())):
            names = [n for n, t in fv.TARGET_TYPES.items() if t == kind]
            value = F.when(F.lower(item["name"]).isin(names), tokens.mask(kind, item["value"], keep)).otherwise(value)
        stays = F.trim(item["value"]).isin(fv.UNMASKED_VALUES)
        if keep is not None:
            stays = stays | F.coalesce(F.array_contains(keep["exact"], item["value"]), F.lit(False))
        return item.withField("value", F.when(stays, item["value"]).otherwise(value))

    return F.transform(items, one)


def device_domains(tokens: Tokenizer, value: Column) -> Column:
    """``device[domain],…``: the device masked, its domain readable."""

    def one(part: Column) -> Column:
        shaped = F.trim(part).rlike(r"^[^\[\]]+\[[^\[\]]*\]$")
        device = F.regexp_extract(F.trim(part), r"^([^\[\]]+)\[", 1)
        domain = F.regexp_extract(F.trim(part), r"(\[[^\[\]]*\])$", 1)
        return F.when(shaped, F.concat(tokens.element("hostname", device), domain)).otherwise(
            tokens.element("hostname", part)
        )

    return F.array_join(F.transform(F.split(value, ",", -1), one), ",")


def json_fields(tokens: Tokenizer, text: Column, fields: Sequence[str], types: Mapping[str, str] = COLUMN_TYPES, keep: Column | None = None) -> Column:
    """JSON text with its typed fields masked at any depth; other strings, and other text, are scrubbed."""
    known = {n: types[n] for n in fields if n in types}
    return _Masker(tokens, known, keep, None, False).json(text)


def indicator_value(tokens: Tokenizer, value: Column, kind: Column, keep: Column | None = None) -> Column:
    """An indicator masked by the type beside it; other types stay."""
    name = F.lower(F.trim(kind))
    return (
        F.when(name == "ip", tokens.mask("ip", value, keep))
        .when(name == "domain", tokens.mask("domain", value, keep))
        .when(name == "url", tokens.url_full(value, keep))
        .otherwise(value)
    )


def threat_pair(tokens: Tokenizer, threat: Column, escaped: Column) -> tuple[Column, Column]:
    """``threat`` and its ``[dot]``-escaped twin: both masked as one domain, or both
    left where the twin is empty."""
    browsable = F.coalesce(~F.trim(escaped).isin(fv.UNMASKED_VALUES), F.lit(False))
    plain = F.replace(escaped, F.lit("[dot]"), F.lit("."))
    twin = F.replace(tokens.mask("domain", plain), F.lit("."), F.lit("[dot]"))
    return (
        F.when(browsable, tokens.mask("domain", threat)).otherwise(threat),
        F.when(browsable, twin).otherwise(escaped),
    )


def _browsable(escaped: Column) -> Column:
    return F.coalesce(~F.trim(escaped).isin(fv.UNMASKED_VALUES), F.lit(False))


def _chosen(key: Column, table: Mapping[str, str], otherwise: Column | None = None) -> Column:
    found = F.lit(None).cast("string") if otherwise is None else otherwise
    for name, value in table.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def bucket_values(tokens: Tokenizer, dimension: Column, value: Column, types: Mapping[str, str] = COLUMN_TYPES) -> Column:
    """Breakdown values masked by the dimension they belong to."""
    masked = value
    for name, mode in URL_COLUMNS.items():
        masked = F.when(dimension == name, getattr(tokens, mode)(value)).otherwise(masked)
    for kind in sorted(set(types.values())):
        fields = [c for c, t in types.items() if t == kind and c not in URL_COLUMNS]
        masked = F.when(F.lower(dimension).isin(fields), tokens.mask(kind, value)).otherwise(masked)
    return masked


def masked_values(df: DataFrame, tokens: Tokenizer, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """``(key, raw, masked)`` of the distinct values of typed columns, for ``mask_table`` to join.

    Each value is hashed once however many rows show it.  Worth it for columns with few values; write the result as a
    table, so that its size is known.
    """
    known = type_table(df) if types is None else types
    pairs = F.array(*(F.struct(F.lit(known[c.lower()]).alias("kind"), F.col(f"`{c}`").alias("raw")) for c in columns))
    distinct = tokens.attach(df.select(F.inline(pairs)).where(F.col("raw").isNotNull()).distinct())
    return distinct.select(_value_key(F.col("kind"), F.col("raw")).alias("key"), "raw", tokens.mask_as(F.col("kind"), F.col("raw")).alias("masked"))


def _plainly_typed(name: str, known: Mapping[str, str]) -> bool:
    """Whether a column is masked by its type alone, not by its shape or a sibling."""
    shaped = name in URL_COLUMNS or name in PREFIXED_COLUMNS or name in JSON_COLUMNS or name in ("value", "threat", "obf_url", "incident_reporter", "devvds")
    return known.get(name, "text") != "text" and not shaped


def _value_key(kind: Column, raw: Column) -> Column:
    return F.concat(kind, F.lit(":"), raw)


def mask_table(
    df: DataFrame,
    tokens: Tokenizer,
    mask_devices: bool = False,
    extra: Mapping[str, str] | None = None,
    substitute: bool = True,
    values: DataFrame | None = None,
    few: Sequence[str] = (),
) -> DataFrame:
    """Every identifier masked, at any depth, and prose rewritten with the same tokens.

    One projection.  With ``substitute``, values masked in a record's own fields are
    replaced where its text mentions them.  The columns named in ``few`` take their tokens
    from ``values`` (see ``masked_values``), which all of them join by one key.
    """
    known = type_table(df, mask_devices, extra)
    walked = walked_once(df)
    staged = tokens.attach(walked)
    keep = None if mask_devices else kept_values(walked)
    if keep is not None:
        staged, keep = staged.withColumn("_keep", keep), F.col("_keep")
    found = leaves(walked, keys_by_type(known))
    sources = [x for x in found if (x.type_of(known) or "text") != "text"]
    prose = any(x.type_of(known) == "text" for x in found)
    pairs = None
    if substitute and sources and prose:
        staged = staged.withColumn("_pairs", _record_raws(walked, known, keep))
        pairs = F.col("_pairs")
    told = None if keep is None else walked
    record = _Masker(tokens, known, keep, pairs, mask_devices, told)
    columns = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    masked = record.fields(columns, kinds, {n for n in columns if f"{_WALK}{n}" in walked.columns})
    for f in df.schema.fields:
        name = f.name.lower()
        if isinstance(f.dataType, T.StringType) and _plainly_typed(name, known):
            masked[f.name] = record.typed(known[name], columns[f.name])
        if f"{_WALK}{f.name}" in walked.columns:
            text = record.json(_held_text(f), F.col(f"`{_WALK}{f.name}`"), F.col(f"`{_SOUND}{f.name}`"))
            masked[f.name] = F.parse_json(text) if isinstance(f.dataType, T.VariantType) else text
    for i, name in enumerate(few if values is not None else ()):
        kind, raw = known[name.lower()], columns[name]
        looked = values.select(F.col("key").alias(f"_key_{i}"), F.col("masked").alias(f"_found_{i}"))
        staged = staged.join(looked, _value_key(F.lit(kind), raw) == F.col(f"_key_{i}"), "left")
        masked[name] = record.typed(kind, raw, F.coalesce(F.col(f"_found_{i}"), tokens.mask(kind, raw)))
    # Inside a lambda Spark prefers a sibling alias over an input column of the same
    # name, so the masked columns get their names only afterwards.
    out = staged.select(*(masked[c].alias(f"_masked_{i}") for i, c in enumerate(df.columns)))
    return out.toDF(*df.columns)


@dataclass(frozen=True)
class _Masker:
    """How the fields of one record are masked."""

    tokens: Tokenizer
    types: Mapping[str, str]
    keep: Column | None
    pairs: Column | None
    mask_devices: bool
    # The table itself, where records keep device names.
    table: DataFrame | None = None

    def typed(self, kind: str, column: Column, plain: Column | None = None) -> Column:
        """A typed value masked; ``plain`` is what it becomes where its record keeps nothing.

        The kept values of a record are only gathered where its device texts hold the value.
        """
        k = self.tokens
        plain = k.mask(kind, column) if plain is None else plain
        told = None if self.table is None else _devices_told(self.table, column)
        if self.keep is None:
            return plain
        if told is None:
            return F.when(is_kept(kind, column, self.keep) | column.contains(","), k.mask(kind, column, self.keep)).otherwise(plain)
        return F.when(told, k.mask(kind, column, kept_values(self.table))).otherwise(plain)

    def fields(self, columns: Mapping[str, Column], kinds: Mapping[str, T.DataType], walked: Collection[str] = ()) -> dict[str, Column]:
        """The fields of one struct; those that a sibling types come first, those in ``walked`` are left out."""
        paired = self._paired(columns)
        return {
            name: paired[name] if name in paired else self.value(name, columns[name], kinds[name])
            for name in columns
            if name not in walked
        }

    def _paired(self, columns: Mapping[str, Column]) -> dict[str, Column]:
        k, out = self.tokens, {}
        if {"threat", "obf_url"} <= set(columns):
            out["threat"], out["obf_url"] = threat_pair(k, columns["threat"], columns["obf_url"])
        if {"value", "type"} <= set(columns):
            out["value"] = indicator_value(k, columns["value"], columns["type"], self.keep)
        if {"value", "dimension"} <= set(columns):
            out["value"] = bucket_values(k, columns["dimension"], columns["value"], self.types)
        if "incident_reporter" in columns:
            # An id on automatic incidents; a user only where a sibling says so.
            said, siblings = columns["incident_reporter"], [columns[n] for n in ("reporter", "lastuser") if n in columns]
            user = any_of(F.coalesce(said == s, F.lit(False)) for s in siblings)
            out["incident_reporter"] = F.when(user, k.mask("username", said, self.keep)).otherwise(said)
        return out

    def value(self, name: str, column: Column, dtype: T.DataType) -> Column:
        folded = name.lower()
        if isinstance(dtype, T.VariantType):
            return F.parse_json(self.json(F.to_json(column)))
        if isinstance(dtype, T.StringType):
            return self._text(folded, column)
        if isinstance(dtype, T.StructType):
            inner = self.fields({f.name: column[f.name] for f in dtype.fields}, {f.name: f.dataType for f in dtype.fields})
            return F.when(column.isNotNull(), F.struct(*(c.alias(n) for n, c in inner.items())))
        if isinstance(dtype, T.ArrayType):
            inner = dtype.elementType
            if folded == "target" and isinstance(inner, T.StructType):
                return targets(self.tokens, column, self.keep)
            if folded == "filter_applied" and isinstance(inner, T.ArrayType):
                return F.transform(column, self._condition)
            if isinstance(inner, (T.StringType, T.StructType, T.ArrayType, T.MapType, T.VariantType)):
                return F.transform(column, lambda item: self.value(name, item, inner))
        if isinstance(dtype, T.MapType):
            return F.transform_values(column, lambda key, item: self._under(F.lower(key.cast("string")), item, dtype.valueType, folded))
        return column

    def _under(self, key: Column, item: Column, dtype: T.DataType, holder: str) -> Column:
        """A map's value, masked as a field of its key's name; keys of no type leave it to the map's own name."""
        if not _is_text(dtype):
            return self.value(holder, item, dtype)
        shown = self.value(holder, item, dtype)
        for names in keys_by_type({n: t for n, t in self.types.items() if n not in URL_COLUMNS}).values():
            shown = F.when(key.isin(names), self.value(names[0], item, dtype)).otherwise(shown)
        for name in (*URL_COLUMNS, *JSON_COLUMNS):
            shown = F.when(key == name, self.value(name, item, dtype)).otherwise(shown)
        return shown

    def _text(self, name: str, column: Column) -> Column:
        k, kind = self.tokens, self.types.get(name)
        if name in URL_COLUMNS:
            return getattr(k, URL_COLUMNS[name])(column, self.keep)
        if name in PREFIXED_COLUMNS:
            return prefixed(k, column, self.keep)
        if name in JSON_COLUMNS:
            return self.json(column)
        if name == "devvds" and self.mask_devices:
            return device_domains(k, column)
        if kind == "text":
            return self._prose(column)
        return column if kind is None else k.mask(kind, column, self.keep)

    def json(self, text: Column, parts: Column | None = None, sound: Column | None = None) -> Column:
        """JSON text masked by its keys at any depth; other text is scrubbed.

        What begins as JSON and is none (cut off, say) is masked by its keys and scrubbed as well.  JSON inside a
        string of a JSON column's name is burned.
        """
        whole = F.when(nested.shaped(text), nested.rebuilt(text, self._swap, parts)).otherwise(text)
        parsed = nested.shaped(text) & F.try_parse_json(text).isNotNull()
        parsed = parsed if sound is None else F.coalesce(sound, F.lit(False)) | parsed
        return let(whole, lambda w: F.when(parsed, w).otherwise(self._prose(w)))

    def _swap(self, key: Column, owner: Column, value: Column, sibling: Callable[[str], Column]) -> Column:
        """A JSON string masked as its key, or what stands beside it, says."""
        k, keep = self.tokens, self.keep
        field = F.lower(F.substring_index(value, ":", 1))
        head = F.substring(value, F.lit(1), F.length(field) + 1)
        led_by = F.when(key.isin(list(PREFIXED_COLUMNS)) & value.contains(":") & (F.length(value) > F.length(field) + 1), _kind_of_key(field, self.types))
        user = any_of(F.coalesce(value == sibling(n), F.lit(False)) for n in ("reporter", "lastuser"))

        def beside_it(beside: Column, led: Column) -> Column:
            return (
                F.when((key == "value") & (owner == "target"), F.coalesce(_chosen(F.lower(sibling("name")), fv.TARGET_TYPES), F.lit("burned")))
                .when((key == "value") & beside.isin("ip", "domain"), beside)
                .when((key == "value") & (beside == "url"), F.lit("url_full"))
                .when((key == "incident_reporter") & user, F.lit("username"))
                .when((key == "threat") & _browsable(sibling("obf_url")), F.lit("domain"))
                .when((key == "obf_url") & sibling("threat").isNotNull() & _browsable(value), F.lit("escaped"))
                .when(key.isin(list(JSON_COLUMNS)) & nested.shaped(value), F.lit("burned"))
                .otherwise(led)
            )

        def by_kind(led: Column) -> Column:
            # Few keys need a look around; the types of others are known by their names.
            around = let(F.lower(F.trim(sibling("type"))), lambda beside: beside_it(beside, led))
            told = F.when(key.isin([*nested.BESIDE, *JSON_COLUMNS, *PREFIXED_COLUMNS]), around)
            return let(F.coalesce(told, _chosen(key, URL_COLUMNS, _kind_of_key(key, self.types))), lambda kind: shown(kind, led.isNotNull()))

        def shown(kind: Column, led: Column) -> Column:
            core = F.when(led, F.substring(value, F.length(head) + 1, F.length(value))).otherwise(value)
            core = F.when(kind == "escaped", F.replace(value, F.lit("[dot]"), F.lit("."))).otherwise(core)
            typed = k.mask_as(F.when(kind == "escaped", F.lit("domain")).otherwise(kind), core, keep)
            typed = F.when(kind == "escaped", F.replace(typed, F.lit("."), F.lit("[dot]"))).when(led, F.concat(head, typed)).otherwise(typed)
            stays = F.trim(value).isin(fv.UNMASKED_VALUES)
            if keep is not None:
                stays = stays | F.coalesce(F.array_contains(keep["exact"], value), F.lit(False))
            typed = F.when(kind == "burned", F.when(stays, value).otherwise(k.placeholder(value))).otherwise(typed)
            typed = F.when(kind == "url_full", k.url_full(value, keep)).when(kind == "url_host", k.url_host(value, keep)).otherwise(typed)
            return F.when(kind.isNull(), self._prose(value)).otherwise(typed)

        masked = let(led_by, by_kind)
        return F.when(key == "devvds", device_domains(k, value)).otherwise(masked) if self.mask_devices else masked

    def _prose(self, column: Column) -> Column:
        scrubbed = self.tokens.scrub(column)
        if self.pairs is None:
            return scrubbed
        return let(scrubbed, lambda t: substitute_known(self.tokens, t, self.pairs))

    def _condition(self, entry: Column) -> Column:
        """An echoed ``[field, op, value]``: the value by its field's type, else as text."""
        said = F.get(entry, F.lit(2))
        shown = self._prose(said)
        for kind in sorted(set(self.types.values()) - {"text"}):
            names = [n for n, t in self.types.items() if t == kind]
            typed = F.lower(F.get(entry, F.lit(0))).isin(names)
            shown = F.when(typed, self.tokens.mask(kind, said, self.keep)).otherwise(shown)
        whole = F.concat(F.slice(entry, 1, 2), F.array(shown))
        return F.when(F.size(entry) == 3, whole).otherwise(F.transform(entry, self._prose))


def _record_raws(df: DataFrame, types: Mapping[str, str], keep: Column | None) -> Column:
    """``array<struct<at, kind, raw, low>>`` of the values a record masks in its fields, ``low`` in lower case.

    ``at`` numbers the fields.  Tokens are made for those that a text mentions only.
    """
    keys = keys_by_type(types)
    found: list[Column] = []
    for f in df.schema.fields:
        if f"{_WALK}{f.name}" in df.columns:
            found.append(_typed_by_key(df, f.name, types))
        own = [x for x in _field_leaves(df, f, keys) if (x.type_of(types) or "text") != "text"]
        found += [_of_kind(x.texts(), x.type_of(types)) for x in own if not _is_by_key(df, f, x)]
    return F.filter(F.concat(*(F.flatten(F.transform(values, _raws_at(at))) for at, values in enumerate(found))), _is_masked(keep))


def _of_kind(texts: Column, kind: str) -> Column:
    return F.transform(texts, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def _raws_at(at: int) -> Callable[[Column], Column]:
    def raw(of: Column) -> Callable[[Column], Column]:
        return lambda v: F.struct(F.lit(at).alias("at"), of["kind"].alias("kind"), F.trim(v).alias("raw"), F.lower(F.trim(v)).alias("low"))

    return lambda of: F.transform(F.split(of["value"], ","), raw(of))


def _is_masked(keep: Column | None) -> Callable[[Column], Column]:
    def masked(p: Column) -> Column:
        stays = p["raw"].isin(fv.UNMASKED_VALUES)
        if keep is not None:
            stays = stays | F.when(p["kind"] == "username", is_kept("username", p["raw"], keep)).otherwise(is_kept("", p["raw"], keep))
        return ~stays

    return masked


def substitute_known(tokens: Tokenizer, text: Column, known: Column) -> Column:
    """``text`` with a record's own masked values (see ``_record_raws``) replaced wherever it mentions them.

    Longest first, whole identifiers, any ASCII case.  A spelling that several
    values share only up to case is burned, unless one of them is spelled so.
    """

    def mentioned(low: Column) -> Column:
        # A plain search before the pattern is built.  Outside ASCII lower case may depend on what follows.
        return F.exists(known, lambda p: low.contains(p["low"])) | (F.length(text) != F.octet_length(text))

    def pattern() -> Column:
        sized = F.transform(known, lambda p: F.struct(F.length(p["raw"]).alias("n"), p["raw"].alias("raw")))
        longest = F.reverse(F.array_sort(F.array_distinct(sized)))
        either = F.array_join(F.transform(longest, lambda r: quoted(r["raw"])), "|")
        return F.concat(F.lit(r"(?<![A-Za-z0-9._-])(?i:"), either, F.lit(r")(?![A-Za-z0-9._-])"))

    def token_of(found: Column) -> Column:
        # The first field's type holds where several have a value spelled so.
        exact = F.array_min(F.filter(known, lambda p: p["raw"] == found))
        same = F.filter(known, lambda p: p["low"] == F.lower(found))
        meant = let(exact, lambda first: F.when(first.isNotNull(), F.array(first)).otherwise(same))
        made = F.array_distinct(F.transform(meant, lambda p: tokens.mask_as(p["kind"], p["raw"])))
        token = let(made, lambda t: F.when(F.size(t) == 1, F.get(t, F.lit(0))))
        return F.when(found.isNotNull(), F.coalesce(token, tokens.placeholder(found)))

    by_pattern = let(pattern(), lambda p: replace_each(text, p, token_of))
    return F.when((F.size(known) > 0) & let(F.lower(text), mentioned), by_pattern).otherwise(text)


def dictionary(
    df: DataFrame, tokens: Tokenizer, types: Mapping[str, str] | None = None, mask_devices: bool = False
) -> DataFrame:
    """``(type, raw, token)`` of every identifier ``mask_table`` replaces in a table.

    Column values are made distinct first; taking lists apart, typing and hashing then
    run once per distinct value.  This table is the secret: write it to a place of its
    own.
    """
    types = dict(type_table(df, mask_devices) if types is None else {n.lower(): t for n, t in types.items()})
    df = walked_once(df)
    keep, staged = None if mask_devices else kept_values(df), df
    if keep is not None:
        staged, keep = df.withColumn("_keep", keep), F.col("_keep")
    values: list[Column] = []
    found: list[Column] = []
    keys = keys_by_type(types)
    found += [F.transform(_typed_by_key(df, f.name, types), _value_by_key(keep)) for f in df.schema.fields if f"{_WALK}{f.name}" in df.columns]
    for leaf in (x for f in df.schema.fields for x in _field_leaves(df, f, keys) if not _is_by_key(df, f, x)):
        kind = leaf.type_of(types)
        full = URL_COLUMNS.get(leaf.name.lower()) == "url_full"
        if leaf.name.lower() in URL_COLUMNS and not leaf.listed:
            values += _url_values(leaf.column, full, keep)
        elif leaf.name.lower() in URL_COLUMNS and leaf.kind is None:
            found.append(F.flatten(F.transform(leaf.texts(), _urls_of(full, keep))))
        elif kind == "text":
            texts = leaf.texts()
            found += [F.flatten(F.transform(texts, _matched(p, k))) for k, p in PATTERNS.items()]
        elif kind is not None and leaf.listed:
            found.append(F.transform(leaf.column, _value_of(kind, keep)))
        elif kind is not None:
            values.append(_value(kind, leaf.column, keep))
    pairs = F.array(*values) if values else F.array().cast(_VALUES)
    if found:
        pairs = F.concat(pairs, *(F.coalesce(f, F.array().cast(_VALUES)) for f in found))
    distinct = staged.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    element = F.explode(
        F.when(F.col("kind") == "url", F.array("value")).otherwise(F.split("value", ","))
    ).alias("value")
    elements = distinct.select("kind", "keep", element).where(
        ~F.trim("value").isin(fv.UNMASKED_VALUES)
        & ~F.coalesce(F.array_contains("keep.exact", F.col("value")), F.lit(False))
        & ~F.coalesce((F.col("kind") != "username") & F.array_contains("keep.folded", F.lower("value")), F.lit(False))
    )
    made, token = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind in sorted({*types.values(), *PATTERNS, "ip_or_host", "url"} - {"text"}):
        made = F.when(F.col("kind") == kind, tokens.kind_of(kind, F.col("value"))).otherwise(made)
    raw = F.when(made.isin("username", "url"), F.col("value")).otherwise(F.lower("value"))
    words = elements.select(made.alias("type"), raw.alias("raw")).where(F.col("type").isNotNull()).distinct()
    for kind in PREFIXES:
        token = F.when(F.col("type") == kind, tokens.token(kind, F.col("raw"))).otherwise(token)
    return tokens.attach(words).select("type", "raw", token.alias("token"))


_KEEP = "struct<exact:array<string>,folded:array<string>>"
_VALUES = f"array<struct<kind:string,value:string,keep:{_KEEP}>>"


def _value(kind: str, value: Column, keep: Column | None) -> Column:
    """A candidate of one record.  Only a list carries its record's keep set along."""
    if keep is None:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(None).cast(_KEEP).alias("keep"))
    listed = value.contains(",") & F.lit(kind != "url")
    return F.struct(
        F.lit(kind).alias("kind"),
        F.when(~is_kept(kind, value, keep), value).alias("value"),
        F.when(listed, keep).alias("keep"),
    )


def _value_of(kind: str, keep: Column | None) -> Callable[[Column], Column]:
    return lambda v: _value(kind, v, keep)


def _value_by_key(keep: Column | None) -> Callable[[Column], Column]:
    """``_value`` for a type that is known value by value only."""

    def one(v: Column) -> Column:
        if keep is None:
            return F.struct(v["kind"].alias("kind"), v["value"].alias("value"), F.lit(None).cast(_KEEP).alias("keep"))
        stays = F.when(v["kind"] == "username", is_kept("username", v["value"], keep)).otherwise(is_kept("", v["value"], keep))
        listed = v["value"].contains(",") & (v["kind"] != "url")
        return F.struct(v["kind"].alias("kind"), F.when(~stays, v["value"]).alias("value"), F.when(listed, keep).alias("keep"))

    return one


def _matched(pattern: str, kind: str) -> Callable[[Column], Column]:
    return lambda text: F.transform(matches(text, pattern), _found_as(kind))


def _found_as(kind: str) -> Callable[[Column], Column]:
    return lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("value"), F.lit(None).cast(_KEEP).alias("keep"))


def _url_values(url: Column, full: bool, keep: Column | None) -> list[Column]:
    text = F.trim(url)
    parts = url_parts(text)
    clean = ~parts["authority"].contains("@")
    hosted = clean & (parts["authority"] != "")
    host = F.lower(F.regexp_replace(parts["authority"], r":\d*$", ""))
    values = [_value("ip_or_host", F.when(hosted, host), keep)]
    if full:
        sealed = F.when(hosted, parts["tail"]).when(clean & ~text.isin(fv.UNMASKED_VALUES), text)
        values.append(_value("url", F.when(sealed != "", sealed), None))
    return values


def _urls_of(full: bool, keep: Column | None) -> Callable[[Column], Column]:
    return lambda url: F.array(*_url_values(url, full, keep))


def collisions(words: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value; must be empty before use."""
    return words.groupBy("token").agg(F.count_distinct("type", "raw").alias("meanings")).where(F.col("meanings") > 1)


def unmask_column(df: DataFrame, words: DataFrame, column: str) -> DataFrame:
    """One masked column turned back by an equi-join; what is no token stays."""
    lookup = words.select(F.col("token").alias("_token"), F.col("raw").alias("_raw"))
    joined = df.join(lookup, F.col(column) == F.col("_token"), "left")
    return joined.withColumn(column, F.coalesce("_raw", column)).select(*df.columns)


def unmask_columns(df: DataFrame, words: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Several masked columns turned back by one dictionary.

    All join it by the same key, so it is broadcast or exchanged once.  Write it as a table first, so that its size is
    known.
    """
    for column in columns:
        df = unmask_column(df, words, column)
    return df


def unmask_text(df: DataFrame, words: DataFrame, column: str, kid: str) -> DataFrame:
    """A column with tokens anywhere inside it (lists, URLs, prose) turned back.

    Distinct values are taken apart, their tokens joined with the dictionary and the
    values put together again; then rows pick up their value.  The tokens of one
    value are all that ever meet in a group.
    """
    either = "|".join(PREFIXES.values())
    pattern = rf"(?:/url|{either})-{kid}-[ghjkmnpqrstvwxyz]{{24}}"
    values = df.select(F.col(column).alias("_value")).where(F.col("_value").rlike(pattern)).distinct()
    found = values.select("_value", F.explode(F.array_distinct(matches(F.col("_value"), pattern))).alias("_found"))
    lookup = words.select(F.col("token").alias("_token"), "raw")
    known = found.join(lookup, F.regexp_replace("_found", "^/", "") == F.col("_token"))
    maps = known.groupBy("_value").agg(
        F.map_from_entries(F.collect_list(F.struct("_found", "raw"))).alias("_raws")
    )
    rebuilt = replace_each(
        F.col("_value"), pattern, lambda m: F.coalesce(F.element_at(F.col("_raws"), m), m)
    )
    restored = maps.select("_value", rebuilt.alias("_restored"))
    joined = df.join(restored, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(column, F.coalesce("_restored", column)).select(*df.columns)


def unmask_conditions(conditions: Sequence[Condition], words: DataFrame, vocab: Vocabulary) -> list[Condition]:
    """Conditions with tokens in their values resolved, before they are compiled.

    Brings to the driver one row per token the conditions mention.  ``%token%`` keeps
    its wildcards.
    """

    def texts(value) -> list[str]:
        return [v.strip("%") for v in (value if isinstance(value, (list, tuple)) else [value]) if isinstance(v, str)]

    wanted = sorted({t for c in conditions for t in texts(c.value)})
    if not wanted:
        return list(conditions)
    known = {r["token"]: r["raw"] for r in words.where(F.col("token").isin(wanted)).select("token", "raw").distinct().collect()}

    def resolved(value):
        if not isinstance(value, str):
            return value
        core = value.strip("%")
        return value.replace(core, known[core]) if core in known else value

    return [
        Condition(
            c.field,
            c.op,
            [resolved(v) for v in c.value] if isinstance(c.value, (list, tuple)) else resolved(c.value),
        )
        for c in conditions
    ]


_WORD = r"[^\s,;()\[\]{}<>\"'=|/.:!?](?:[^\s,;()\[\]{}<>\"'=|/]*[^\s,;()\[\]{}<>\"'=|/.:!?])?"


def _normal(text: Column) -> Column:
    """The words of a text, one blank between them."""
    return F.array_join(matches(F.lower(text), _WORD), " ")


def leaks(masked: DataFrame, words: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """``(column, type, raw)`` of raw identifiers that a masked table still shows.

    Whole values, and inside texts the addresses, MACs and e-mails, are joined by
    equality with the dictionary.  Texts are taken apart word by word only where the
    table has columns of names, which no pattern finds; raw values of several words are
    looked for as runs of as many words.  A map's values count under its name.  An
    empty result is a pass.
    """
    masked = walked_once(masked, keyed=False)
    held = [f for f in masked.schema.fields if f"{_WALK}{f.name}" in masked.columns and f.name not in skip]
    shown = [leaf for f in masked.schema.fields if f not in held for leaf in _field_leaves(masked, f, None) if leaf.name not in skip]
    if not shown and not held:
        raise PlanError("the table has no text to check")
    types = column_types(masked)
    mapped = any(f.name.startswith(_WALK) for f in masked.schema.fields) or any(isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)) for f in masked.schema.fields)
    named = mapped or bool(set(types.values()) - {"text", *PATTERNS}) or any(x.name in URL_COLUMNS for x in shown)
    patterns = [*PATTERNS.values(), *([_WORD] if named else [])]
    # How many words raw values have, where it is more than one: a handful of numbers.  And their greatest length: what
    # is longer equals none of them.
    counted = words.select(F.size(matches(F.lower("raw"), _WORD)).alias("n"), F.length(F.lower("raw")).alias("long"))
    sizes = counted.agg(F.struct(F.sort_array(F.collect_set(F.when(F.col("n") > 1, F.col("n")))).alias("runs"), F.max("long").alias("longest")).alias("sizes"))
    if named:
        masked = masked.withColumn("_sizes", sizes.scalar()).withColumns({"_runs": F.col("_sizes.runs"), "_longest": F.col("_sizes.longest")})

    def runs(text: Column) -> Column:
        def of(found: Column) -> Column:
            return F.flatten(
                F.transform(
                    F.filter("_runs", lambda n: n <= F.size(found)),
                    lambda n: F.transform(F.sequence(F.lit(1), F.size(found) - n + 1), lambda i: F.array_join(F.slice(found, i, n), " ")),
                )
            )

        return F.when(F.size("_runs") > 0, let(matches(text, _WORD), of)).otherwise(F.array().cast("array<string>"))

    def taken_apart(text: Column) -> Column:
        return F.concat(F.array(text), *(matches(text, p) for p in patterns), *([runs(text)] if named else []))

    def in_json(field: T.StructField) -> Column:
        """The text as it stands, and its strings; without escapes, all their pieces are pieces of the text."""
        text, values = _held_text(field), _picked(F.col(f"`{_SAID}{field.name}`"), "value")
        bare = F.col(f"`{_SOUND}{field.name}`") & ~text.contains("\\")
        strings = F.when(bare, F.transform(values, lambda v: F.lower(v))).otherwise(F.flatten(F.transform(values, lambda v: taken_apart(F.lower(v)))))
        return F.when(text.isNotNull(), F.concat(taken_apart(F.lower(text)), strings))

    def told(found: DataFrame) -> DataFrame:
        return (found.where(F.length("seen") <= F.col("_longest")) if named else found).select("column", "seen")

    kept_sizes = ["_runs", "_longest"] if named else []
    # Short columns are made distinct before they are taken apart; texts are not worth
    # shuffling whole, so only their pieces are.
    short = [x for x in shown if not x.listed and types.get(x.name, "text") != "text"]
    parts: list[DataFrame] = []
    if short:
        pairs = F.array(*(F.struct(F.lit(x.name).alias("column"), F.lower(x.column).alias("whole")) for x in short))
        # The sizes are one value for the whole table.
        distinct = masked.select(*kept_sizes, F.inline(pairs)).where(F.col("whole").isNotNull()).distinct()
        parts.append(told(distinct.select(*kept_sizes, "column", F.explode(taken_apart(F.col("whole"))).alias("seen"))))
    pieces = [(x.name, F.flatten(F.transform(x.texts(), lambda v: taken_apart(F.lower(v))))) for x in shown if x not in short]
    pieces += [(f.name, in_json(f)) for f in held]
    if pieces:
        empty = F.array().cast("array<string>")
        listed = F.array(*(F.struct(F.lit(name).alias("column"), F.array_distinct(F.coalesce(p, empty)).alias("pieces")) for name, p in pieces))
        parts.append(told(masked.select(*kept_sizes, F.inline(listed)).select(*kept_sizes, "column", F.explode("pieces").alias("seen"))))
    seen = (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).distinct()
    raws = words.select("type", "raw", F.lower("raw").alias("seen"))
    if named:
        raws = raws.unionByName(words.select("type", "raw", _normal(F.col("raw")).alias("seen")).where(F.col("seen").contains(" "))).distinct()
    return seen.join(raws, "seen").select("column", "type", "raw").distinct()
