"""Correlation as equi-joins: alerts, incidents, logs, endpoints, users, indicators."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.coercion import as_int
from logweir.functions.predicates import is_behavioural
from logweir.operators.paging import first_per_group, newest_first
from logweir.operators.stats import severity_histogram
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import any_of
from logweir.sources.logs import key_of

ATTACHED = "incident.attachments.alertevent"


def id_set(df: DataFrame, keys: Sequence[str]) -> Column:
    """The identifiers under the first of ``keys`` the table has, as an array of text.

    A list is taken as it is, comma text is split, anything else is one id.
    """
    key = link_key(df, keys)
    empty = F.array().cast("array<string>")
    if key is None:
        return empty
    column, dtype = F.col(f"`{key}`"), df.schema[key].dataType
    if isinstance(dtype, T.ArrayType):
        ids = F.array_distinct(column.cast("array<string>"))
    else:
        text = column.cast("string")
        parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
        split = F.array_distinct(F.filter(parts, lambda p: p != ""))
        ids = F.when(text.contains(","), split).otherwise(F.array(text))
    return F.when(column.isNull(), empty).otherwise(ids)


def link_key(df: DataFrame, keys: Sequence[str]) -> str | None:
    return next((k for k in keys if k in df.columns), None)


def entity_ids(df: DataFrame, keys: Sequence[str]) -> Column:
    """Whole-number ids from the first of ``keys`` that yields any, row by row."""
    found: list[Column] = []
    for key in keys:
        if key not in df.columns:
            continue
        dtype = df.schema[key].dataType
        listed = isinstance(dtype, T.ArrayType)
        inner = dtype.elementType if listed else dtype
        if isinstance(inner, T.BooleanType):
            continue
        column = F.col(f"`{key}`") if listed else F.array(F.col(f"`{key}`"))
        whole = F.transform(column, lambda v: F.when(v.cast("string").rlike(r"^\d+$"), as_int(v)))
        ids = F.array_compact(whole)
        found.append(F.when(F.size(ids) > 0, ids))
    none = F.array().cast("array<bigint>")
    return F.coalesce(*found, none) if found else none


def attached_alerts(attachments: DataFrame, snapshot: T.StructType | str) -> DataFrame:
    """``(incid, alertid, alert)`` from the alert attachments of incidents.

    ``data`` holds the alert as JSON; text that is no object gives an empty
    snapshot, whose id is the attachment's source.
    """
    if isinstance(snapshot, str):
        snapshot = T.StructType.fromDDL(snapshot)
    parsed = F.from_json("data", snapshot)
    empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in snapshot.fields))
    found = F.coalesce(parsed, empty)
    return (
        attachments.where(F.col("attachtype") == "alertevent")
        .select("incid", "attachsrcid", found.alias("alert"))
        .withColumn("alertid", F.coalesce(F.col("alert.alertid"), F.col("attachsrcid")))
        .select("incid", "alertid", F.col("alert").withField("alertid", F.col("alertid")).alias("alert"))
    )


def linked_pairs(incidents: DataFrame, alerts: DataFrame) -> DataFrame:
    """``(incid, alertid, basis)`` by linkage keys: ids the incident declares, or
    incidents the alert names.  One basis per pair, declared ids first.

    Each kind of link is an equality on exploded ids, never an OR.
    """
    declared_key = link_key(incidents, fv.INCIDENT_ALERT_KEYS)
    named_key = link_key(alerts, fv.ALERT_INCIDENT_KEYS)
    parts: list[DataFrame] = []
    if declared_key:
        declared = incidents.select("incid", F.explode(id_set(incidents, [declared_key])).alias("alertid"))
        known = alerts.select(F.col("alertid").cast("string").alias("alertid"))
        parts.append(declared.join(known, "alertid", "left_semi").select("incid", "alertid", F.lit(0).alias("rank")))
    if named_key:
        named = alerts.select(
            F.explode(id_set(alerts, [named_key])).alias("incid"), F.col("alertid").cast("string").alias("alertid")
        )
        known = incidents.select(F.col("incid").cast("string").alias("incid"))
        parts.append(named.join(known, "incid", "left_semi").select("incid", "alertid", F.lit(1).alias("rank")))
    if not parts:
        return incidents.sparkSession.createDataFrame([], "incid string, alertid string, basis string")
    merged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    basis = F.when(F.col("rank") == 0, f"incident.{declared_key}").otherwise(f"alert.{named_key}")
    strongest = merged.groupBy("incid", "alertid").agg(F.min("rank").alias("rank"))
    return strongest.select("incid", "alertid", basis.alias("basis"))


def correlate(incidents: DataFrame, alerts: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """``(incid, alertid, basis)``: attachments decide, linkage keys only where an
    incident has none.

    Joins on the incident are semi and anti joins against distinct incidents, so an
    incident with a third of all attachments multiplies nothing, and adaptive execution
    splits its partition.
    """
    if attachments is None:
        return linked_pairs(incidents, alerts)
    attached = (
        attachments.where(F.col("attachtype") == "alertevent")
        .select("incid", F.col("attachsrcid").alias("alertid"))
        .distinct()
        .join(incidents.select("incid"), "incid", "left_semi")
    )
    settled = attached.select("incid").distinct()
    linked = linked_pairs(incidents, alerts).join(settled, "incid", "left_anti")
    return attached.withColumn("basis", F.lit(ATTACHED)).unionByName(linked)


def incident_records(incidents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every incident with how many alerts it has and on what basis.

    The alerts stay rows of ``pairs``: an incident may have any number of them.
    """
    # Counted by basis first: the few rows of an incident then carry the text.
    by_basis = pairs.groupBy("incid", "basis").agg(F.count(F.lit(1)).alias("n"))
    summed = by_basis.groupBy("incid").agg(F.sum("n").alias("alert_count"), F.max("basis").alias("correlation_basis"))
    return incidents.join(summed, "incid", "left").withColumn(
        "alert_count", F.coalesce("alert_count", F.lit(0))
    )


def alert_logs(alerts: DataFrame, logs: DataFrame, per_alert: int | None = None, time_column: str = "itime") -> DataFrame:
    """The logs that triggered each alert, with ``per_alert`` the newest ones only.

    Logs of other alerts go before any ranking.
    """
    own = logs.join(alerts.select("alertid").where(F.col("alertid").isNotNull()).distinct(), "alertid", "left_semi")
    if per_alert is None:
        return own
    return first_per_group(own, ["alertid"], newest_first(logs, time_column), per_alert)


def flat_vulnerabilities(records: DataFrame, group: str = "vuln_group", single: str = "vuln") -> DataFrame:
    """One row per finding from the three ways a record may nest them.

    ``epid`` stays NULL on findings that name no endpoint.
    """
    names = ["vulnid", "severity"]

    def finding(source: Column) -> Column:
        return F.struct(*(source[n].cast("string").alias(n) for n in names))

    own = F.array(F.struct(*((F.col(n) if n in records.columns else F.lit(None)).cast("string").alias(n) for n in names)))
    nested = own
    if single in records.columns:
        nested = F.when(F.col(single).isNotNull(), F.transform(single, finding)).otherwise(nested)
    if group in records.columns:
        inside = F.flatten(
            F.transform(group, lambda g: F.coalesce(F.transform(g["vuln"], finding), F.array(finding(g))))
            if {"vulnid", "severity"} <= set(records.schema[group].dataType.elementType.names)
            else F.transform(group, lambda g: F.transform(g["vuln"], finding))
        )
        nested = F.when(F.col(group).isNotNull(), inside).otherwise(nested)
    carried = [c for c in records.columns if c not in (group, single, *names)]
    return records.select(*carried, F.inline(nested))


def endpoint_vulnerabilities(endpoints: DataFrame, findings: DataFrame) -> DataFrame:
    """``(epid, severity, hits)`` per endpoint; an endpoint without findings has one
    row with no severity.  Findings are counted before the join."""
    counted = severity_histogram(
        findings.where(F.col("epid").isNotNull()).withColumn("epid", F.col("epid").cast("string")), ["epid"]
    )
    return (
        endpoints.select(F.col("epid").cast("string").alias("epid"))
        .join(counted, "epid", "left")
        .select("epid", "severity", F.coalesce("hits", F.lit(0)).alias("hits"))
    )


def orphan_findings(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("epid").isNull())


def user_endpoints(users: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``(euid, epid)``: endpoints whose user list names the user's id, or the name
    in any case.  Two equi-joins instead of an OR."""
    listed = endpoints.select("epid", F.inline("user"))
    by_id = (
        users.select("euid", F.col("euid").cast("string").alias("key"))
        .join(listed.select("epid", F.col("euid").cast("string").alias("key")).distinct(), "key")
        .select("euid", "epid")
    )
    by_name = (
        users.where(F.coalesce("euname", F.lit("")) != "")
        .select("euid", F.lower("euname").alias("key"))
        .join(listed.select("epid", F.lower("euname").alias("key")).distinct(), "key")
        .select("euid", "epid")
    )
    return by_id.unionByName(by_name).distinct()


def value_counts(tables: Mapping[str, DataFrame], columns: Mapping[str, str], wanted: DataFrame) -> DataFrame:
    """``(logtype, kind, seen, hits)``: rows per value of several columns, in one scan
    of each table.  Values are folded to lower case.

    Only values in ``wanted`` (kind, seen) are counted: the others, nearly unique in
    logs, go before the shuffle, by a broadcast that Spark chooses by size or by its
    run-time bloom filter.  Where logs have folded keys (``write_logs`` with pivots) and
    at most ``PUSHED`` values are wanted, these are also a filter of the scan, which
    skips files, row groups and pages.
    """
    asked = _asked(wanted) if any(key_of(c) in df.columns for df in tables.values() for c in columns.values()) else None
    merged: DataFrame | None = None
    for name, df in tables.items():
        present = {k: c for k, c in columns.items() if c in df.columns}
        if not present:
            continue
        folded = {k: F.col(f"`{key_of(c)}`") if key_of(c) in df.columns else F.lower(F.col(f"`{c}`")) for k, c in present.items()}
        if asked is not None and all(key_of(c) in df.columns for c in present.values()):
            df = df.where(any_of(folded[k].isin(asked[k][i : i + 10]) for k in present for i in range(0, len(asked[k]), 10)))
        pairs = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("seen")) for k, v in folded.items()))
        part = df.select(F.lit(name).alias("logtype"), F.inline(pairs)).where(F.col("seen").isNotNull())
        merged = part if merged is None else merged.unionByName(part)
    if merged is None:
        return wanted.sparkSession.createDataFrame([], "logtype string, kind string, seen string, hits long")
    own = merged.join(wanted.distinct(), ["kind", "seen"], "left_semi")
    return own.groupBy("logtype", "kind", "seen").agg(F.count(F.lit(1)).alias("hits"))


#: Wanted values that become a filter of the scan, at most; more are left to the join.
PUSHED = 1_000


def _asked(wanted: DataFrame) -> dict[str, list[str]] | None:
    """Kind -> wanted values, if there are few enough to bring to the driver."""
    rows = wanted.distinct().limit(PUSHED + 1).collect()
    if len(rows) > PUSHED:
        return None
    found: dict[str, list[str]] = defaultdict(list)
    for r in rows:
        found[r["kind"]].append(r["seen"])
    return found


#: Letters of a gram by which checksums are looked through.
GRAM = 8
_GRAMS = "array<struct<size:int,at:int,gram:string>>"


def _grams(text: Column, size: Column) -> Column:
    """The grams of a text that start at multiples of their size, each with its place."""

    def cut(k: Column) -> Column:
        return F.struct(size.alias("size"), (k * size).alias("at"), F.substring(text, k * size + 1, size).alias("gram"))

    every = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / size).cast("int") - 1), cut)
    return F.when(F.length(text) >= size, every).otherwise(F.array().cast(_GRAMS))


def _checksum_counts(tables: Mapping[str, DataFrame], hashes: DataFrame) -> DataFrame:
    """Rows per wanted hash (column ``seen``) that stands anywhere inside a checksum.

    Wherever a hash stands, one of the grams that begin at every ``GRAM``-th place of the checksum lies inside it, at
    one of ``GRAM`` phases.  So a checksum gives an eighth of its letters as rows and a hash eight; what meets is
    verified.  Hashes too short to hold a whole gram at every phase use smaller ones, whose size is a subquery over the
    indicators.  Each row counts once for a hash: where the hash stands first.
    """
    column, merged = fv.INDICATOR_FIELDS["Hash"], None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("logtype"), F.lower(F.col(f"`{column}`")).alias("sum")).where(F.col("sum").isNotNull())
        merged = part if merged is None else merged.unionByName(part)
    long = F.length("seen") >= 2 * GRAM - 1
    half = F.floor((F.length("seen") + 1) / 2).cast("int")
    short = hashes.where((F.length("seen") > 0) & ~long).agg(F.min(half).alias("n"))
    sized = merged.withColumn("_short", short.scalar())
    smaller = F.coalesce(F.when(F.col("_short").isNotNull(), _grams(F.col("sum"), F.col("_short"))), F.array().cast(_GRAMS))
    seen = sized.select("logtype", "sum", F.inline(F.concat(_grams(F.col("sum"), F.lit(GRAM)), smaller)))
    wanted = hashes.where(F.length("seen") > 0).distinct().withColumn("_size", F.when(long, F.lit(GRAM)).otherwise(short.scalar()))

    def phase(o: Column) -> Column:
        return F.struct(F.col("_size").alias("size"), o.alias("phase"), F.substring(F.col("seen"), o + 1, F.col("_size")).alias("gram"))

    wanted = wanted.select("seen", F.inline(F.transform(F.sequence(F.lit(0), F.col("_size") - 1), phase)))
    # A place of zero means that the hash is not there.
    first = F.position(F.col("seen"), F.col("sum"))
    found = seen.join(wanted, ["size", "gram"]).where((first > 0) & (first == F.col("at") - F.col("phase") + 1))
    return found.groupBy("logtype", F.lit("Hash").alias("kind"), "seen").agg(F.count(F.lit(1)).alias("hits"))


def sweep(indicators: DataFrame, logs: Mapping[str, DataFrame]) -> DataFrame:
    """``(value, type, logtype, hits)``: rows per indicator and log type.

    Logs keep only values that some indicator has before anything is shuffled.
    """
    exact = {k: c for k, c in fv.INDICATOR_FIELDS.items() if k != "Hash"}
    wanted = indicators.select("value", "type").distinct()
    folded = wanted.select(F.col("type").alias("kind"), F.lower("value").alias("seen")).where(F.col("seen").isNotNull())
    seen = value_counts(logs, exact, folded.where(F.col("kind") != "Hash"))
    hashed = {n: df for n, df in logs.items() if fv.INDICATOR_FIELDS["Hash"] in df.columns}
    if hashed:
        seen = seen.unionByName(_checksum_counts(hashed, folded.where(F.col("kind") == "Hash").select("seen")))
    matched = (F.col("type") == F.col("kind")) & (F.lower("value") == F.col("seen"))
    return wanted.join(seen, matched).select("value", "type", "logtype", "hits")


def sweep_totals(matches: DataFrame) -> DataFrame:
    return matches.groupBy("value", "type").agg(F.sum("hits").alias("total_matches"))


def entity_pivots(endpoints: DataFrame | None = None, users: DataFrame | None = None, ips: DataFrame | None = None) -> DataFrame:
    """``(entity_type, entity_ref, field, value)``; ``value`` is NULL where an entity
    has nothing to search for, which is a gap rather than a guess."""
    parts: list[DataFrame] = []

    def add(df: DataFrame, kind: str, ref: str, name: str, source: str) -> None:
        value = F.when(F.coalesce(F.col(source), F.lit("")) != "", F.col(source))
        parts.append(
            df.select(
                F.lit(kind).alias("entity_type"),
                F.col(ref).cast("string").alias("entity_ref"),
                F.lit(name).alias("field"),
                value.alias("value"),
            )
        )

    if endpoints is not None:
        add(endpoints, "endpoint", "epid", "srcip", "epip")
    if users is not None:
        add(users, "enduser", "euid", "user", "euname")
    if ips is not None:
        add(ips, "ip", "ip", "srcip", "ip")
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def _sought(pivots: DataFrame) -> DataFrame:
    """``(kind, seen)`` of the values that pivots search for."""
    return pivots.select(F.col("field").alias("kind"), F.lower("value").alias("seen")).where(F.col("seen").isNotNull())


def lateral_counts(pivots: DataFrame, logs: Mapping[str, DataFrame], user_column: str = "user") -> DataFrame:
    """``(entity_type, entity_ref, logtype, hits)`` for every entity and log type."""
    counted = value_counts(logs, {"srcip": "srcip", "user": user_column}, _sought(pivots))
    matched = (F.col("field") == F.col("kind")) & (F.lower("value") == F.col("seen"))
    return pivots.join(counted, matched).select("entity_type", "entity_ref", "logtype", "hits")


def lateral_rows(
    pivots: DataFrame, logs: DataFrame, limit: int | None = None, name: str = "srcip", column: str = "srcip", time_column: str = "itime"
) -> DataFrame:
    """The rows per entity, with ``limit`` the newest ones of each value in any case."""
    wanted = pivots.where((F.col("field") == name) & F.col("value").isNotNull())
    wanted = wanted.select("entity_type", "entity_ref", F.lower("value").alias("_seen"))
    folded = logs.withColumn("_seen", F.lower(column))
    own = folded.join(wanted.select("_seen").distinct(), "_seen", "left_semi")
    if limit is not None:
        own = first_per_group(own, ["_seen"], newest_first(logs, time_column), limit)
    return wanted.join(own, "_seen").drop("_seen")


def pivot_gaps(pivots: DataFrame) -> DataFrame:
    return pivots.where(F.col("value").isNull()).select("entity_type", "entity_ref")


def canonical_indicators(rows: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """Indicators of the types that carry a reputation, first of each kept, and the
    rows skipped."""
    labels = F.create_map(*(F.lit(x) for pair in fv.INDICATOR_TYPES.items() for x in pair))
    typed = rows.withColumn("_kind", F.element_at(labels, F.lower(F.coalesce("type", F.lit("")))))
    usable = F.col("_kind").isNotNull() & (F.coalesce("value", F.lit("")) != "")
    kept = (
        typed.where(usable)
        .groupBy("value", F.col("_kind").alias("type"))
        .agg(F.min(ordinal).alias(ordinal))
    )
    return kept, typed.where(~usable).drop("_kind")


def enrich(indicators: DataFrame, stored: DataFrame) -> DataFrame:
    """Indicators with their stored reputation; unknown ones stay, without.

    A lookup is the rows stored under ``lookup``.  The row of the very value wins;
    else the lookup's first row stands in, as an aliased answer does.
    """
    carried = ["reputation", "confidence", "status"]
    exact = (F.col("value") == F.col("lookup")).cast("int")
    best = (
        stored.groupBy("lookup", "type")
        .agg(
            F.min_by(
                F.struct(*carried, F.col("value").alias("stored_value")),
                F.struct((1 - exact).alias("far"), F.col("ordinal"), *(F.col(c) for c in carried)),
            ).alias("_best")
        )
        .select(F.col("lookup").alias("value"), "type", "_best.*")
    )
    return indicators.join(best, ["value", "type"], "left")


def incidents_of_alerts(alerts: DataFrame, attachments: DataFrame, incidents: DataFrame) -> DataFrame:
    """Incidents with an attachment of one of these alerts."""
    hits = (
        attachments.where(F.col("attachtype") == "alertevent")
        .select("incid", F.col("attachsrcid").alias("alertid"))
        .join(alerts.select(F.col("alertid").cast("string").alias("alertid")).distinct(), "alertid", "left_semi")
    )
    return incidents.join(hits, "incid", "left_semi")


def behavioural_alerts(
    pivots: DataFrame, alerts: DataFrame, ip_column: str = "epip", user_column: str = "euname"
) -> DataFrame:
    """``(entity_type, entity_ref, detections)`` for entities with behavioural alerts."""
    rows = alerts.where(is_behavioural(alerts))
    counted = value_counts({"alert": rows}, {"srcip": ip_column, "user": user_column}, _sought(pivots))
    matched = (F.col("field") == F.col("kind")) & (F.lower("value") == F.col("seen"))
    return pivots.join(counted, matched).select(
        "entity_type", "entity_ref", F.col("hits").alias("detections")
    )


def overlapping(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Members of both sets."""
    return left.join(right.select(key).distinct(), key, "left_semi")
