"""Queries that pseudonymise, restore, redact and check."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweir.catalog.registry import query
from logweir.functions import text
from logweir.functions.tokens import _HEX, _LETTERS, PREFIXES, TOKEN_LENGTH, Tokenizer, key_id, subkey
from logweir.operators import masking
from logweir.operators.breakdown import buckets
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import Condition, compile_conditions
from logweir.plans.vocabulary import vocabulary

# Keys of the test tables only; a real key comes from the deployment's secrets.
KEY, OLD_KEY = b"catalog key", b"older catalog key"


# --- the same tokens in SQL --------------------------------------------------


def _bytes(data: bytes) -> str:
    return "'" + "".join(f"\\x{b:02X}" for b in data) + "'::BLOB"


def _digest(kind: str, value: str, key: bytes = KEY) -> str:
    return f"sha256({_bytes(subkey(key))} || encode(concat('{kind}:', {value})))"


def _token(kind: str, value: str, key: bytes = KEY) -> str:
    folded = value if kind in ("username", "url") else f"lower({value})"
    return (
        f"concat('{PREFIXES[kind]}-{key_id(key)}-', translate(substring({_digest(kind, folded, key)}, 1, {TOKEN_LENGTH}), "
        f"'{_HEX}', '{_LETTERS}'))"
    )


def _burned(value: str) -> str:
    return f"concat('{fv.UNREPRESENTABLE_MARK}', substring({_digest('unrepresentable', value)}, 1, {TOKEN_LENGTH}))"


def _swapped(source: str, pattern: str, swap: str) -> str:
    """Every match of ``pattern`` replaced; ``swap`` is SQL over the match ``m``."""
    found = f"regexp_extract_all({source}, '{pattern}')"
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({source}, '{pattern}'), list_append(list_transform({found}, "
        f"lambda m: {swap}), '')), lambda z: concat(z[1], z[2])), '')"
    )


_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IS_IP = f"regexp_full_match(m, '{_OCTET}(\\.{_OCTET}){{3}}')"


_USER = '"user"'


def _tokens(t) -> Tokenizer:
    return Tokenizer.of(t.spark, KEY)


# --- tables ------------------------------------------------------------------


@query(
    "l1_mask_table",
    f"SELECT itime, sessionid, {_token('ip', 'srcip')} AS srcip, {_token('ip', 'dstip')} AS dstip, "
    f"{_token('username', chr(34) + 'user' + chr(34))} AS user, devname, service, sentbyte FROM traffic",
    "traffic",
)
def _(t):
    rows = t.traffic.select("itime", "sessionid", "srcip", "dstip", "user", "devname", "service", "sentbyte")
    return masking.mask_table(rows, _tokens(t))


@query(
    "l1_mask_values",
    f"SELECT itime, sessionid, {_token('ip', 'srcip')} AS srcip, {_token('username', chr(34) + 'user' + chr(34))} AS user, devname FROM traffic",
    "traffic",
)
def _(t):
    # The form for columns with few values: each value is hashed once, and rows look it up.
    k, few = _tokens(t), ["srcip", "user"]
    rows = t.traffic.select("itime", "sessionid", "srcip", "user", "devname")
    return masking.mask_table(rows, k, values=t.kept(masking.masked_values(rows, k, few)), few=few)


@query(
    "l1_mask_list",
    f"SELECT epid, concat({_token('ip', 'epip')}, ',N/A,', {_token('ip', 'epip')}) AS ipaddr FROM endpoint",
    "endpoint",
)
def _(t):
    rows = t.endpoint.select("epid", F.concat("epip", F.lit(",N/A,"), "epip").alias("ipaddr"))
    return masking.mask_table(rows, _tokens(t))


@query(
    "l1_dictionary",
    f"SELECT 'ip' AS type, srcip AS raw, {_token('ip', 'srcip')} AS token FROM (SELECT srcip FROM traffic UNION SELECT dstip FROM traffic) "
    f"UNION ALL SELECT DISTINCT 'username', \"user\", {_token('username', chr(34) + 'user' + chr(34))} FROM traffic",
    "traffic",
)
def _(t):
    return masking.dictionary(t.traffic.select("srcip", "dstip", "user", "devname"), _tokens(t))


@query(
    "l1_collisions",
    "SELECT cast(0 AS BIGINT) AS collisions",
)
def _(t):
    words = masking.dictionary(t.traffic.select("srcip", "dstip", "user"), _tokens(t))
    return masking.collisions(words).agg(F.count(F.lit(1)).alias("collisions"))


@query(
    "l2_type_separation",
    f"SELECT epid, {_token('hostname', 'epname')} AS as_host, {_token('domain', 'epname')} AS as_domain, "
    f"{_token('username', 'epname')} AS as_user, {_token('username', 'upper(epname)')} AS as_other_user, true AS folded FROM endpoint",
    "endpoint",
)
def _(t):
    k, name = _tokens(t), F.col("epname")
    return k.attach(t.endpoint).select(
        "epid",
        k.token("hostname", name).alias("as_host"),
        k.token("domain", name).alias("as_domain"),
        k.token("username", name).alias("as_user"),
        k.token("username", F.upper(name)).alias("as_other_user"),
        (k.token("hostname", name) == k.token("hostname", F.upper(name))).alias("folded"),
    )


@query(
    "l3_key_id",
    f"SELECT epid, {_token('ip', 'epip')} AS token, {_token('ip', 'epip', OLD_KEY)} AS older, "
    f"'{key_id(KEY)}' AS kid FROM endpoint",
    "endpoint",
)
def _(t):
    new, old = _tokens(t), Tokenizer.of(t.spark, OLD_KEY)
    rows = new.attach(t.endpoint).select("epid", "epip", new.token("ip", F.col("epip")).alias("token"))
    return old.attach(rows).select(
        "epid", "token", old.token("ip", F.col("epip")).alias("older"), F.split("token", "-")[1].alias("kid")
    )


# --- text --------------------------------------------------------------------


_SCRUBBED = _swapped("text", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", f"CASE WHEN {_IS_IP} THEN {_token('ip', 'm')} ELSE m END")
_SCRUBBED_MAC = _swapped("a", r"\b[0-9a-fA-F]{2}(?::[0-9a-fA-F]{2}){5}\b", _token("mac", "m"))
_SCRUBBED_MAIL = _swapped("b", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", _token("email", "m"))


@query(
    "l4_scrub_text",
    f"SELECT doc_id, {_SCRUBBED_MAIL} AS text FROM (SELECT doc_id, {_SCRUBBED_MAC} AS b FROM "
    f"(SELECT doc_id, {_SCRUBBED} AS a FROM documents))",
)
def _(t):
    k = _tokens(t)
    return k.attach(t.raw("documents")).select("doc_id", k.scrub(F.col("text")).alias("text"))


@query(
    "l5_known_values",
    f"SELECT logid, concat({_token('username', 'u')}, ' signed in from ', {_token('ip', 'srcip')}, ' as ', {_token('username', 'u')}, '; not ', u, "
    "'x or x', u, ', on ', devname) AS msg FROM (SELECT logid, srcip, devname, \"user\" AS u FROM event)",
    "event",
)
def _(t):
    told = F.concat(
        F.upper("user"), F.lit(" signed in from "), "srcip", F.lit(" as "), "user", F.lit("; not "), "user",
        F.lit("x or x"), "user", F.lit(", on "), "devname",
    )
    rows = t.event.select("logid", "user", "srcip", "devname", told.alias("msg"))
    return masking.mask_table(rows, _tokens(t)).select("logid", "msg")


@query(
    "l6_composite",
    f"SELECT alertid, concat('epip:', {_token('ip', 'epip')}) AS groupby1, concat('policyid:', epid) AS groupby2, "
    f"concat('{{\"endpoint\":\"', {_token('ip', 'epip')}, '\",\"reason\":\"seen at ', {_token('ip', 'epip')}, '\",\"n\":\"1\"}}') AS grpby, "
    f"concat({_token('hostname', 'triggername')}, '[root],', {_token('hostname', 'devtype')}) AS devvds FROM alert",
    "alert",
)
def _(t):
    k = _tokens(t)
    blob = F.to_json(
        F.struct(F.col("epip").alias("endpoint"), F.concat(F.lit("seen at "), "epip").alias("reason"), F.lit("1").alias("n"))
    )
    rows = k.attach(t.alert).select(
        "alertid",
        "_key",
        F.concat(F.lit("epip:"), "epip").alias("g1"),
        F.concat(F.lit("policyid:"), F.col("epid").cast("string")).alias("g2"),
        blob.alias("blob"),
        F.concat("triggername", F.lit("[root],"), "devtype").alias("devices"),
    )
    return rows.select(
        "alertid",
        masking.prefixed(k, F.col("g1")).alias("groupby1"),
        masking.prefixed(k, F.col("g2")).alias("groupby2"),
        masking.json_fields(k, F.col("blob"), ["endpoint", "reason"]).alias("grpby"),
        masking.device_domains(k, F.col("devices")).alias("devvds"),
    )


def _blob(ip: str, user: str) -> str:
    """The nested JSON of ``_nested_alerts`` in SQL, around an address and a user."""
    return (
        f"concat('{{\"user\":\"', {user}, '\",\"n\":', epid, ',\"nested\":{{\"srcip\":[\"', {ip}, '\",\"N/A\"],\"list\":[{{\"User\":\"', {user}, "
        f"'\",\"note\":\"seen at ', {ip}, '\",\"score\":1.50}},null,[true,\"', {ip}, '\"]]}}}}')"
    )


def _nested_alerts(t):
    """Alerts with a JSON text of objects and lists in each other, with numbers and absent values.

    A walk costs far more than moving its row, so rows are dealt out: a file read in one piece would leave all of them to
    one task.
    """
    ip, user = F.col("epip"), F.col("euname")
    blob = F.concat(
        F.lit('{"user":"'), user, F.lit('","n":'), F.col("epid").cast("string"), F.lit(',"nested":{"srcip":["'), ip, F.lit('","N/A"],"list":[{"User":"'), user,
        F.lit('","note":"seen at '), ip, F.lit('","score":1.50},null,[true,"'), ip, F.lit('"]]}}'),
    )
    dealt = t.alert.select("alertid", "epid", "epip", "euname").repartition(_walkers(t))
    return dealt.select("alertid", "epid", blob.alias("grpby"))


def _walkers(t) -> int:
    """In how many tasks JSON is walked: a few for each core.  Each task reads the long expressions anew, so not many more."""
    return 4 * t.spark.sparkContext.defaultParallelism


@query(
    "l6_json_nested",
    f"SELECT alertid, grpby, json_extract_string(grpby, '$.user') AS user, json_extract_string(grpby, '$.nested.list[0].note') AS note, "
    f"json_extract_string(grpby, '$.nested.list[2][1]') AS deep, json_extract(grpby, '$.n')::bigint AS n FROM "
    f"(SELECT alertid, epid, {_blob(_token('ip', 'epip'), _token('username', 'euname'))} AS grpby FROM alert)",
    "alert",
)
def _(t):
    # The same JSON as text and as a variant, masked by keys at every depth.
    rows = _nested_alerts(t).select("alertid", "grpby", F.parse_json("grpby").alias("held"))
    masked = masking.mask_table(rows, _tokens(t))
    return masked.select(
        "alertid",
        "grpby",
        F.variant_get("held", "$.user", "string").alias("user"),
        F.variant_get("held", "$.nested.list[0].note", "string").alias("note"),
        F.variant_get("held", "$.nested.list[2][1]", "string").alias("deep"),
        F.variant_get("held", "$.n", "bigint").alias("n"),
    )


@query(
    "l6_target",
    f"SELECT alertid, 'ip' AS name, {_token('ip', 'epip')} AS value FROM alert UNION ALL "
    f"SELECT alertid, 'user', {_token('username', 'euname')} FROM alert UNION ALL "
    f"SELECT alertid, 'note', {_burned('name')} FROM alert",
    "alert",
)
def _(t):
    items = F.array(
        F.struct(F.lit("ip").alias("name"), F.col("epip").alias("value")),
        F.struct(F.lit("user").alias("name"), F.col("euname").alias("value")),
        F.struct(F.lit("note").alias("name"), F.col("name").alias("value")),
    )
    rows = t.alert.select("alertid", items.alias("target"))
    return masking.mask_table(rows, _tokens(t)).select("alertid", F.inline("target"))


@query(
    "l6_buckets",
    f"SELECT 'srcip' AS dimension, {_token('ip', 'srcip')} AS value, count(*) AS hits FROM traffic GROUP BY srcip UNION ALL "
    "SELECT 'service', service, count(*) FROM traffic GROUP BY service",
    "traffic",
)
def _(t):
    k = _tokens(t)
    counted = k.attach(buckets(t.traffic, ["srcip", "service"]))
    masked = masking.bucket_values(k, F.col("dimension"), F.col("value"))
    return counted.select("dimension", masked.alias("_v"), "hits").toDF("dimension", "value", "hits")


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_SCHEME = "regexp_extract(url, '^([a-z]+://)', 1)"
_TAIL = "regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1)"


@query(
    "l7_mask_url",
    f"SELECT page_id, concat({_SCHEME}, {_token('hostname', _HOST)}, {_TAIL}) AS host_only, "
    f"CASE WHEN {_TAIL} = '' THEN concat({_SCHEME}, {_token('hostname', _HOST)}) ELSE concat({_SCHEME}, {_token('hostname', _HOST)}, '/', "
    f"{_token('url', _TAIL)}) END AS sealed FROM pages",
)
def _(t):
    k = _tokens(t)
    pages = k.attach(t.raw("pages").select("page_id", "url"))
    return pages.select("page_id", k.url_host(F.col("url")).alias("host_only"), k.url_full(F.col("url")).alias("sealed"))


@query(
    "l8_indicator_pair",
    f"SELECT ordinal, CASE lower(type) WHEN 'ip' THEN {_token('ip', 'value')} WHEN 'domain' THEN {_token('domain', 'value')} WHEN 'url' THEN "
    f"concat('http://', {_token('hostname', chr(39) + 'ththre.example.com' + chr(39))}, '/', {_token('url', chr(39) + '/fr/825?page=2&ref=x' + chr(39))}) "
    "ELSE value END AS value FROM indicator",
    "indicator",
)
def _(t):
    k = _tokens(t)
    masked = masking.indicator_value(k, F.col("value"), F.col("type"))
    return k.attach(t.indicator).select("ordinal", masked.alias("_v")).toDF("ordinal", "value")


@query(
    "l8_threat_pair",
    f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN {_token('domain', _HOST)} ELSE 'sig' END AS threat, "
    f"CASE WHEN page_id % 2 = 0 THEN {_token('domain', _HOST)} ELSE '' END AS obf_url FROM pages",
)
def _(t):
    k = _tokens(t)
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    even = F.col("page_id") % 2 == 0
    rows = k.attach(t.raw("pages")).select(
        "page_id",
        "_key",
        F.when(even, host).otherwise(F.lit("sig")).alias("seen"),
        F.when(even, F.replace(host, F.lit("."), F.lit("[dot]"))).otherwise(F.lit("")).alias("escaped"),
    )
    threat, twin = masking.threat_pair(k, F.col("seen"), F.col("escaped"))
    return rows.select("page_id", threat.alias("threat"), twin.alias("obf_url"))


@query(
    "l9_keep_set",
    f"SELECT logid, devname, CASE WHEN action = 'failure' THEN upper(devname) ELSE {_token('hostname', chr(34) + 'user' + chr(34))} END AS hostname, "
    "CASE WHEN action = 'failure' THEN concat('login on ', devname) ELSE concat('login on ', "
    f"{_token('hostname', chr(34) + 'user' + chr(34))}) END AS msg FROM event",
    "event",
)
def _(t):
    failed = F.col("action") == "failure"
    host = F.when(failed, F.upper("devname")).otherwise(F.col("user"))
    said = F.concat(F.lit("login on "), F.when(failed, F.col("devname")).otherwise(F.col("user")))
    rows = t.event.select("logid", "devname", host.alias("hostname"), said.alias("msg"))
    return masking.mask_table(rows, _tokens(t))


@query(
    "l10_placeholder",
    f"SELECT epid, CASE WHEN epid % 2 = 0 THEN {_token('ip', 'epip')} ELSE {_burned('epname')} END AS srcip FROM endpoint",
    "endpoint",
)
def _(t):
    rows = t.endpoint.select("epid", F.when(F.col("epid") % 2 == 0, F.col("epip")).otherwise(F.col("epname")).alias("srcip"))
    return masking.mask_table(rows, _tokens(t))


# --- back --------------------------------------------------------------------


@query("l11_unmask", "SELECT sessionid, srcip, dstip, \"user\" FROM traffic", "traffic")
def _(t):
    k = _tokens(t)
    rows, few = t.traffic.select("sessionid", "srcip", "dstip", "user"), ["srcip", "dstip", "user"]
    masked = masking.mask_table(rows, k, values=t.kept(masking.masked_values(rows, k, few)), few=few)
    return masking.unmask_columns(masked, t.kept(masking.dictionary(rows, k)), few)


@query(
    "l1_mask_map",
    f"SELECT logid, {_token('ip', 'srcip')} AS srcip, {_token('username', _USER)} AS person, level AS level FROM event",
    "event",
)
def _(t):
    kept = F.create_map(F.lit("srcip"), F.col("srcip"), F.lit("User"), F.col("user"), F.lit("level"), F.col("level"))
    masked = masking.mask_table(t.event.select("logid", kept.alias("details")), _tokens(t))
    return masked.select("logid", F.col("details")["srcip"].alias("srcip"), F.col("details")["User"].alias("person"), F.col("details")["level"].alias("level"))


@query("l11_unmask_urls", "SELECT page_id, url FROM pages")
def _(t):
    k = _tokens(t)
    rows = t.raw("pages").select("page_id", "url")
    return masking.unmask_text(masking.mask_table(rows, k), masking.dictionary(rows, k), "url", k.kid)


@query(
    "l11_unmask_filter",
    "SELECT sessionid, srcip FROM traffic WHERE srcip IN ('10.0.7.1', '10.1.9.1') AND NOT contains(lower(\"user\"), 'user12')",
    "traffic",
)
def _(t):
    k = _tokens(t)
    rows = t.traffic.select("sessionid", "srcip", "user")
    words = masking.dictionary(rows, k)
    made = (k.token("ip", F.lit("10.0.7.1")), k.token("ip", F.lit("10.1.9.1")), k.token("username", F.lit("user12")))
    first, second, user = k.attach(t.spark.range(1)).select(*made).first()
    asked = [Condition("source_ip", "in", [first, second]), Condition("user", "not_contains", f"%{user}%")]
    vocab = vocabulary("traffic")
    meant = masking.unmask_conditions(asked, words, vocab)
    plain = [Condition(c.field, c.op, c.value.strip("%") if isinstance(c.value, str) else c.value) for c in meant]
    return compile_conditions(plain, vocab, rows).filter(rows).select("sessionid", "srcip")


# --- redaction and checks ----------------------------------------------------

_SECRET = text.SECRET_PATTERN.replace("'", "''")


@query(
    "l12_redact",
    f"SELECT doc_id, regexp_replace(regexp_replace(text, '{_SECRET}', '\\1={fv.REDACTED}', 'g'), '{fv.HEX_RUN_PATTERN}', "
    f"'{fv.REDACTED}', 'g') AS text FROM documents",
)
def _(t):
    return t.raw("documents").select("doc_id", text.redact(F.col("text")).alias("text"))


@query(
    "l13_redact_columns",
    f"SELECT epid, '{fv.REDACTED}' AS api_token, epname, '{fv.REDACTED}' AS secret, epip AS plain FROM endpoint",
    "endpoint",
)
def _(t):
    rows = t.endpoint.select(
        "epid",
        F.md5("epname").alias("api_token"),
        F.struct("epname", F.col("epip").alias("secret"), F.create_map(F.lit("sid"), "epip", F.lit("ip"), "epip").alias("m")).alias("nested"),
    )
    shown = text.redact_columns(rows)
    return shown.select("epid", "api_token", "nested.epname", "nested.secret", F.col("nested.m")["ip"].alias("plain"))


@query("l14_leak_check", "SELECT cast(0 AS BIGINT) AS leaks")
def _(t):
    k = _tokens(t)
    rows = t.raw("documents").select("doc_id", F.col("text").alias("msg"))
    masked, words = masking.mask_table(rows, k), masking.dictionary(rows, k)
    return masking.leaks(masked, words).agg(F.count(F.lit(1)).alias("leaks"))


@query(
    "l14_leak_planted",
    "SELECT 'msg' AS column, 'username' AS type, concat('Agent Nr ', epid) AS raw FROM endpoint WHERE epid % 10 = 0 UNION ALL "
    "SELECT 'details', 'ip', epip FROM endpoint WHERE epid % 7 = 0",
    "endpoint",
)
def _(t):
    k = _tokens(t)
    named = t.endpoint.select("epid", "epip", F.concat(F.lit("Agent Nr "), F.col("epid").cast("string")).alias("user"))
    words = masking.dictionary(named.select("user", F.col("epip").alias("srcip")), k)
    # A masked table into which known values are put again: names of several words in prose, addresses in a map.
    said = F.when(F.col("epid") % 10 == 0, F.concat(F.lit("seen: "), F.col("user"), F.lit(", again"))).otherwise("nothing")
    held = F.create_map(F.lit("note"), F.when(F.col("epid") % 7 == 0, F.concat(F.lit("from "), F.col("epip"))).otherwise("none"))
    return masking.leaks(named.select(said.alias("msg"), held.alias("details")), words)


@query(
    "l14_leak_json",
    "SELECT DISTINCT 'grpby' AS column, 'ip' AS type, epip AS raw FROM alert WHERE epid % 10 = 0 UNION ALL "
    "SELECT DISTINCT 'grpby', 'username', euname FROM alert WHERE epid % 10 = 0",
    "alert",
)
def _(t):
    # Nested JSON of a masked table, into which the JSON of every tenth endpoint is put again unmasked.
    k = _tokens(t)
    rows = _nested_alerts(t)
    words = t.kept(masking.dictionary(rows.select("grpby"), k))
    masked = masking.mask_table(rows.withColumn("shown", F.col("grpby")), k)
    planted = masked.withColumn("grpby", F.when(F.col("epid") % 10 == 0, F.col("shown")).otherwise(F.col("grpby")))
    return masking.leaks(planted.select("grpby"), words)


@query(
    "l14_leak_control",
    "SELECT DISTINCT 'srcip' AS column, 'ip' AS type, srcip AS raw FROM traffic UNION ALL "
    "SELECT DISTINCT 'user', 'username', \"user\" FROM traffic",
    "traffic",
)
def _(t):
    rows = t.traffic.select("srcip", "user")
    return masking.leaks(rows, masking.dictionary(rows, _tokens(t)))
