"""Named predicates: scopes, IPS searches, pivots, behavioural alerts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.net import in_network
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import all_of, contains, equals, has_value, one_of
from logweir.plans.errors import PlanError

_SERIAL = re.compile(f"{fv.SERIAL_PATTERN}|{fv.VM_SERIAL_PATTERN}")
_WITH_DOMAIN = re.compile(r"^(?P<name>[^\[\]]+)\[(?P<vd>[^\[\]]*)\]$")


def _typed(df: DataFrame, name: str, value) -> Column:
    return equals(F.col(f"`{name}`"), df.schema[name].dataType, value)


def device_scope(device: str | None) -> Column:
    """A serial, a name, ``name[domain]``, or a group that restricts nothing."""
    if not device or device.startswith("All_"):
        return F.lit(True)
    if _SERIAL.match(device):
        return F.col("devid") == device
    named = _WITH_DOMAIN.match(device)
    if named:
        return (F.col("devname") == named["name"]) & (F.col("vd") == named["vd"])
    return F.col("devname") == device


def policy_scope(policy_ids: Sequence[int], action: str | None = None) -> Column:
    """Rows of some policies, optionally of one action."""
    if not policy_ids:
        raise PlanError("name at least one policy")
    if any(isinstance(p, bool) or not isinstance(p, int) or p <= 0 for p in policy_ids):
        raise PlanError("policy ids are positive integers")
    scope = F.col("policyid").isin([int(p) for p in policy_ids])
    if action is None:
        return scope
    wanted = action.strip().lower()
    if wanted not in fv.TRAFFIC_ACTIONS:
        raise PlanError(f"unknown action '{action}'; known: {', '.join(fv.TRAFFIC_ACTIONS)}")
    return scope & (F.lower("action") == wanted)


def ips_search(
    df: DataFrame,
    *,
    severity: Sequence[str] = (),
    attack: str | None = None,
    attack_contains: str | None = None,
    action: Sequence[str] = (),
    cve: str | None = None,
    has_cve: bool = False,
    srcip: str | None = None,
    dstip: str | None = None,
    srcport: int | None = None,
    dstport: int | None = None,
    session: int | None = None,
    has_pcap: bool = False,
) -> Column:
    """The IPS search: every part given is ANDed."""
    for given, known in ((severity, fv.SEVERITIES), (action, fv.IPS_ACTIONS)):
        strange = [v for v in given if v.strip().lower() not in known]
        if strange:
            raise PlanError(f"unknown value {strange[0]!r}; known: {', '.join(known)}")
    for number in (srcport, dstport):
        if number is not None and not 1 <= number <= 65535:
            raise PlanError(f"{number} is not a port")
    parts: list[Column] = []
    if severity:
        parts.append(one_of(F.col("severity"), df.schema["severity"].dataType, severity))
    if attack:
        parts.append(_typed(df, "attack", attack))
    elif attack_contains:
        parts.append(contains(F.col("attack"), attack_contains))
    if action:
        parts.append(one_of(F.col("action"), df.schema["action"].dataType, action))
    if cve:
        parts.append(_typed(df, "cve", cve))
    elif has_cve:
        parts.append(has_value(F.col("cve")))
    for name, network in (("srcip", srcip), ("dstip", dstip)):
        if network:
            parts.append(in_network(F.col(name), network))
    for name, number in (("srcport", srcport), ("dstport", dstport), ("sessionid", session)):
        if number:
            parts.append(_typed(df, name, number))
    if has_pcap:
        parts.append(has_value(F.col("pcapurl")))
    return all_of(parts)


def indicator_pivot(
    df: DataFrame,
    *,
    indicator: tuple[str, str] | None = None,
    condition: Column | None = None,
    ttp: str | None = None,
) -> Column | None:
    """What a sweep searches for: the caller's own condition, else a typed
    indicator ``(value, type)``, else a technique name; None where nothing is given.

    A table without the pivot column has no matching rows.
    """
    if condition is not None:
        return condition
    if indicator is not None:
        value, kind = indicator
        name = fv.INDICATOR_FIELDS.get(kind)
        if name is None:
            raise PlanError(f"unknown indicator type '{kind}'")
        if name not in df.columns:
            return F.lit(False)
        return contains(F.col(name), value) if kind == "Hash" else _typed(df, name, value)
    if ttp is not None:
        return contains(F.col("attack"), ttp) if "attack" in df.columns else F.lit(False)
    return None


def identity_activity(user: str | None = None) -> Column:
    """Failed sign-ins and VPN events, of one user or of everyone."""
    activity = (F.lower("action") == "failure") | (F.lower("subtype") == "vpn")
    return activity if user is None else activity & (F.lower("user") == user.lower())


def endpoint_match(hostname: str | None = None, ip: str | None = None) -> Column:
    """Part of the name in any case, and the exact address."""
    parts = []
    if hostname is not None:
        parts.append(contains(F.coalesce(F.col("epname"), F.lit("")), hostname))
    if ip is not None:
        parts.append(F.coalesce(F.col("epip"), F.lit("")) == ip)
    return all_of(parts)


def name_search(column: str, text: str) -> Column:
    """Part of a name in any case."""
    return contains(F.coalesce(F.col(column), F.lit("")), text)


def is_behavioural(df: DataFrame) -> Column:
    """Alerts whose rule names read as behavioural or compromise detections."""
    present = [F.col(f"`{c}`").cast("string") for c in fv.HANDLER_FIELDS if c in df.columns]
    return F.lower(F.concat_ws(" ", *present)).rlike("|".join(fv.BEHAVIOUR_MARKERS))
