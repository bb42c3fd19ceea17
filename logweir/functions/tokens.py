"""Keyed tokens for identifiers.

A token is a function of key, semantic type and value, so masking a table is a
projection: no join, no shuffle, and equal values still join and group.  Only
going back needs the dictionary of ``operators.masking``.

The key never becomes a literal of the plan.  It is a one-row frame that ``attach``
reads by scalar subquery into a column, so that neither ``explain`` nor the UI shows
it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.net import IPV4
from logweir.functions.text import let, replace_each
from logweir.plans import fixed_values as fv

# Hex digits become letters outside a-f: a token is never read as an address, a
# number or a run of hex.
_HEX, _LETTERS = "0123456789abcdef", "ghjkmnpqrstvwxyz"
TOKEN_LENGTH = 24
PREFIXES = {
    "ip": "ip",
    "mac": "mac",
    "hostname": "host",
    "username": "user",
    "domain": "dom",
    "email": "mail",
    "url": "url",
}


def subkey(key: bytes) -> bytes:
    """32 bytes for hashing, whatever the length of the key."""
    return hashlib.sha256(b"token key" + key).digest()


def key_id(key: bytes) -> str:
    """Four characters that tell one key from another."""
    return hashlib.sha256(b"key id" + key).hexdigest()[:4].translate(str.maketrans(_HEX, _LETTERS))


@dataclass(frozen=True)
class Tokenizer:
    """Token expressions under one key, over frames that went through ``attach``."""

    keys: DataFrame
    kid: str

    @classmethod
    def of(cls, spark: SparkSession, key: bytes) -> Tokenizer:
        if not key:
            raise ValueError("masking needs a key")
        frame = spark.createDataFrame([(bytearray(subkey(key)),)], "key binary")
        return cls(frame, key_id(key))

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the key beside each row; select it away again."""
        return df.withColumn("_key", self.keys.scalar())

    def digest(self, kind: str, value: Column) -> Column:
        """SHA-256 of key, type and value, in hex.  Only part of it is ever shown, so a
        token cannot be extended to another value's."""
        message = F.concat(F.lit(kind + ":"), value).cast("binary")
        return F.sha2(F.concat(F.col("_key"), message), 256)

    def normal(self, kind: str, value: Column) -> Column:
        """One spelling per identity: only user names keep their case."""
        return value if kind in ("username", "url") else F.lower(value)

    def token(self, kind: str, value: Column) -> Column:
        """The token of one value of a known type."""
        letters = F.translate(
            F.substring(self.digest(kind, self.normal(kind, value)), 1, TOKEN_LENGTH), _HEX, _LETTERS
        )
        return F.concat(F.lit(f"{PREFIXES[kind]}-{self.kid}-"), letters)

    def placeholder(self, value: Column) -> Column:
        """An irreversible stand-in for what cannot be masked."""
        return F.concat(
            F.lit(fv.UNREPRESENTABLE_MARK), F.substring(self.digest("unrepresentable", value), 1, TOKEN_LENGTH)
        )

    def typed(self, kind: str, value: Column) -> Column:
        """Token or placeholder: a value that is not what its type says is burned."""
        if kind == "ip_or_host":
            return F.when(_is_address(value), self.token("ip", value)).otherwise(self.token("hostname", value))
        if kind == "ip":
            return F.when(_is_address(value), self.token("ip", value)).otherwise(self.placeholder(value))
        if kind == "mac":
            shaped = value.rlike(_MAC_ONLY)
            return F.when(shaped, self.token("mac", value)).otherwise(self.placeholder(value))
        if kind == "email":
            # These columns hold plain names as well.
            return F.when(value.contains("@"), self.token("email", value)).otherwise(self.token("username", value))
        if kind in PREFIXES:
            return self.token(kind, value)
        return self.placeholder(value)

    def kind_of(self, kind: str, value: Column) -> Column:
        """The type under which ``typed`` makes its token; NULL for a placeholder."""
        if kind == "ip_or_host":
            return F.when(_is_address(value), F.lit("ip")).otherwise(F.lit("hostname"))
        if kind == "ip":
            return F.when(_is_address(value), F.lit("ip"))
        if kind == "mac":
            return F.when(value.rlike(_MAC_ONLY), F.lit("mac"))
        if kind == "email":
            return F.when(value.contains("@"), F.lit("email")).otherwise(F.lit("username"))
        return F.lit(kind)

    def element(self, kind: str, value: Column, keep: Column | None = None) -> Column:
        """One value; absent words and kept values stay as they are."""
        stays = F.trim(value).isin(fv.UNMASKED_VALUES)
        if keep is not None:
            stays = stays | is_kept(kind, value, keep)
        return F.when(stays, value).otherwise(self.typed(kind, value))

    def mask(self, kind: str, value: Column, keep: Column | None = None) -> Column:
        """One value, or a comma list value by value."""
        if kind == "text":
            return self.scrub(value)
        listed = F.array_join(
            F.transform(F.split(value, ",", -1), lambda part: self.element(kind, part, keep)), ","
        )
        several = value.contains(",")
        if keep is not None:
            several = several & ~is_kept(kind, value, keep)
        return F.when(several, listed).otherwise(self.element(kind, value, keep))

    def mask_as(self, kind: Column, value: Column, keep: Column | None = None) -> Column:
        """``mask`` for a type that is known row by row only."""

        def token(made: Column, part: Column) -> Column:
            normal = F.when(made.isin("username", "url"), part).otherwise(F.lower(part))
            digest = F.sha2(F.concat(F.col("_key"), F.concat(made, F.lit(":"), normal).cast("binary")), 256)
            letters = F.translate(F.substring(digest, 1, TOKEN_LENGTH), _HEX, _LETTERS)
            prefix = F.lit(None).cast("string")
            for name, short in PREFIXES.items():
                prefix = F.when(made == name, F.lit(f"{short}-{self.kid}-")).otherwise(prefix)
            return F.concat(prefix, letters)

        def made_of(part: Column) -> Column:
            made = F.when(kind.isin(*PREFIXES), kind)
            for name in ("ip", "mac", "email", "ip_or_host"):
                made = F.when(kind == name, self.kind_of(name, part)).otherwise(made)
            return made

        def is_shown(part: Column) -> Column:
            stays = F.trim(part).isin(fv.UNMASKED_VALUES)
            if keep is None:
                return stays
            return stays | F.when(kind == "username", is_kept("username", part, keep)).otherwise(is_kept("", part, keep))

        def one(part: Column) -> Column:
            typed = let(made_of(part), lambda made: F.when(made.isNotNull(), token(made, part)).otherwise(self.placeholder(part)))
            return F.when(is_shown(part), part).otherwise(typed)

        # A kept value stays whole, commas and all; any other value is a list, often of one.
        whole = F.lit(False) if keep is None else is_shown(value)
        return F.when(whole, value).otherwise(F.array_join(F.transform(F.split(value, ",", -1), one), ","))

    def scrub(self, text: Column) -> Column:
        """Free text with its addresses, MACs and e-mails replaced, in that order."""
        out = replace_each(
            text,
            fv.IPV4_PATTERN,
            lambda m: F.when(_is_address(m), self.token("ip", m)).otherwise(m),
        )
        out = replace_each(out, fv.MAC_PATTERN, lambda m: self.token("mac", m))
        return replace_each(out, fv.EMAIL_PATTERN, lambda m: self.token("email", m))

    def url_host(self, url: Column, keep: Column | None = None) -> Column:
        """A URL with only its host masked."""
        return self._url(url, seal_tail=False, keep=keep)

    def url_full(self, url: Column, keep: Column | None = None) -> Column:
        """A URL with its host masked and all that follows sealed as one token."""
        return self._url(url, seal_tail=True, keep=keep)

    def _url(self, url: Column, seal_tail: bool, keep: Column | None) -> Column:
        def host_and_port(authority: Column) -> Column:
            port = F.regexp_extract(authority, r"(:\d+)$", 1)
            host = F.lower(F.regexp_replace(authority, r":\d*$", ""))
            return F.concat(let(host, lambda h: self.element("ip_or_host", h, keep)), port)

        def rebuilt(parts: Column) -> Column:
            front = F.concat(parts["scheme"], host_and_port(parts["authority"]))
            if seal_tail:
                sealed = F.concat(front, F.lit("/"), self.token("url", parts["tail"]))
                whole = F.when(parts["tail"] == "", front).otherwise(sealed)
                text = F.trim(url)
                bare = F.when(text.isin(fv.UNMASKED_VALUES), url).otherwise(self.token("url", text))
            else:
                whole, bare = F.concat(front, parts["tail"]), self.scrub(url)
            # Credentials in a URL are an identifier of their own.
            return (
                F.when(parts["authority"].contains("@"), self.placeholder(url))
                .when(parts["authority"] == "", bare)
                .otherwise(whole)
            )

        return F.when(url.isNotNull(), let(url_parts(F.trim(url)), rebuilt))


_MAC_ONLY = r"^[0-9a-fA-F]{2}([:-][0-9a-fA-F]{2}){5}$"
_IPV6_LIKE = r"^[0-9a-fA-F:]*:[0-9a-fA-F:]*:[0-9a-fA-F:.]*$"


def _is_address(value: Column) -> Column:
    """IPv4 with octets up to 255, or the colons of an IPv6 address that is no MAC."""
    six = value.rlike(_IPV6_LIKE) & ~value.rlike(_MAC_ONLY)
    return F.coalesce(value.rlike(IPV4) | six, F.lit(False))


def kept(values: Column) -> Column:
    """A keep set as ``element`` and ``mask`` take it: as spelled, and folded."""
    return F.struct(values.alias("exact"), F.transform(values, lambda v: F.lower(v)).alias("folded"))


def is_kept(kind: str, value: Column, keep: Column) -> Column:
    """Whether a record leaves this value readable; only user names mind their case."""
    if kind == "username":
        found = F.array_contains(keep["exact"], value)
    else:
        found = F.array_contains(keep["folded"], F.lower(value))
    return F.coalesce(found, F.lit(False))


def url_parts(text: Column) -> Column:
    """``scheme``, ``authority`` and ``tail`` as a struct; no authority, no URL."""
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*://|//)([^/?#]*)([\s\S]*)$"
    names = ("scheme", "authority", "tail")
    return F.struct(*(F.regexp_extract(text, pattern, i).alias(n) for i, n in enumerate(names, start=1)))
