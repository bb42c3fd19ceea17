"""Addresses and networks as Column arithmetic."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.plans.errors import PlanError

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"


def in_network(column: Column, network: str) -> Column:
    """Address equality, or membership of a network, for IPv4 and IPv6.

    IPv6 addresses are compared as 32 hexadecimal digits, however they are spelled.
    Octets a prefix fixes in full are a text prefix, which the scan can use on its
    statistics; only the octet it cuts through is read as a number.
    """
    text = network.strip()
    try:
        parsed = ipaddress.ip_network(text, strict=False)
    except ValueError:
        raise PlanError(f"'{network}' is not an address or network") from None
    if parsed.version == 6:
        low, high = (format(int(a), "032x") for a in (parsed.network_address, parsed.broadcast_address))
        digits = ipv6_digits(column)
        return digits == low if low == high else digits.between(low, high)
    if "/" not in text:
        return column == text
    first = str(parsed.network_address)
    if parsed.prefixlen == parsed.max_prefixlen:
        return column == first
    whole, rest = divmod(parsed.prefixlen, 8)
    octets = first.split(".")
    test = column.rlike(IPV4)
    if rest:
        low = int(octets[whole])
        cut = F.substring_index(F.substring_index(column, ".", whole + 1), ".", -1)
        test = cut.try_cast("int").between(low, low + 2 ** (8 - rest) - 1) & test
    return column.startswith(".".join(octets[:whole]) + ".") & test if whole else test


def ipv6_digits(column: Column) -> Column:
    """An IPv6 address as 32 hexadecimal digits; NULL for anything else.

    A zone after ``%`` is dropped, ``::`` is filled up, a last part in IPv4 form is
    taken as its four numbers.
    """
    text = F.lower(F.regexp_replace(F.trim(column), "%.*$", ""))
    quad = F.transform(F.split(F.regexp_extract(text, rf":({_OCTET}(\.{_OCTET}){{3}})$", 1), r"\."), lambda p: p.try_cast("int"))
    pair = [F.lpad(F.lower(F.hex(F.get(quad, F.lit(i)) * 256 + F.get(quad, F.lit(i + 1)))), 4, "0") for i in (0, 2)]
    dotted = F.concat(F.regexp_replace(text, r"[0-9.]+$", ""), pair[0], F.lit(":"), pair[1])
    plain = F.when(text.contains("."), dotted).otherwise(text)

    def groups(part: Column) -> Column:
        return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":"))

    gap = plain.contains("::")
    head = groups(F.when(gap, F.substring_index(plain, "::", 1)).otherwise(plain))
    tail = F.when(gap, groups(F.substring_index(plain, "::", -1))).otherwise(F.array().cast("array<string>"))
    missing = 8 - F.size(head) - F.size(tail)
    whole = F.concat(head, F.when(gap & (missing > 0), F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>")), tail)
    good = ~plain.rlike("::.*::") & (F.size(whole) == 8) & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$")) & (~gap | (missing > 0))
    return F.when(column.contains(":") & good, F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))
