"""Tokens, masked tables, restoring, redaction and leak checks."""

import hashlib
import re

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.functions import text
from logweir.functions.tokens import Tokenizer, key_id, subkey
from logweir.operators import masking
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import Condition
from logweir.plans.vocabulary import vocabulary

KEY = b"unit test key"


@pytest.fixture(scope="module")
def k(spark):
    return Tokenizer.of(spark, KEY)


def token(prefix, kind, value):
    """The token in plain Python."""
    digest = hashlib.sha256(subkey(KEY) + f"{kind}:{value}".encode()).hexdigest()[:24]
    return f"{prefix}-{key_id(KEY)}-" + digest.translate(str.maketrans("0123456789abcdef", "ghjkmnpqrstvwxyz"))


def burned(value):
    return fv.UNREPRESENTABLE_MARK + hashlib.sha256(subkey(KEY) + f"unrepresentable:{value}".encode()).hexdigest()[:24]


IP1 = token("ip", "ip", "10.0.0.1")


def one(spark, k, schema, row, **more):
    return masking.mask_table(spark.createDataFrame([row], schema), k, **more).first()


def test_typed_columns(spark, k):
    row = one(spark, k, "srcip string, epname string, hostname string, user string, email string, mac string, other string",
              ("10.0.0.1", "10.0.0.1", "WEB", "Ann", "a@x.org", "AA:bb:cc:dd:ee:ff", "10.0.0.1"))
    assert tuple(row) == (
        IP1, IP1, token("host", "hostname", "web"), token("user", "username", "Ann"), token("mail", "email", "a@x.org"),
        token("mac", "mac", "aa:bb:cc:dd:ee:ff"), "10.0.0.1",
    )


@pytest.mark.parametrize("value", ["", "N/A", "n/a", "unknown", "none", "-", " - "])
def test_absent_words_stay(spark, k, value):
    assert one(spark, k, "srcip string", (value,))[0] == value


def test_nulls_stay_null(spark, k):
    row = one(spark, k, "srcip string, msg string, url string, user string", (None, None, None, None))
    assert tuple(row) == (None, None, None, None)


def test_lists_mask_by_element(spark, k):
    assert one(spark, k, "ipaddr string", ("10.0.0.1,N/A,bad",))[0] == f"{IP1},N/A,{burned('bad')}"
    assert one(spark, k, "ipaddr array<string>", (["10.0.0.1", "-"],))[0] == [IP1, "-"]


def test_types_keys_and_case_separate(spark, k):
    other = Tokenizer.of(spark, b"another key")
    df = spark.range(1)
    same = k.attach(df).select(k.token("hostname", F.lit("a")), k.token("hostname", F.lit("A")), k.token("domain", F.lit("a"))).first()
    users = k.attach(df).select(k.token("username", F.lit("a")), k.token("username", F.lit("A"))).first()
    assert same[0] == same[1] != same[2] and users[0] != users[1]
    assert other.attach(df).select(other.token("hostname", F.lit("a"))).first()[0] != same[0]
    assert k.kid != other.kid and f"-{k.kid}-" in same[0]
    with pytest.raises(ValueError):
        Tokenizer.of(spark, b"")


def test_the_key_is_not_in_the_plan(spark, k):
    masked = masking.mask_table(spark.createDataFrame([("10.0.0.1",)], "srcip string"), k)
    plan = masked._jdf.queryExecution().toString()
    secret = subkey(KEY)
    assert secret.hex().upper() not in plan.upper() and str(list(secret))[1:30] not in plan
    assert KEY.decode() not in plan


def test_text_is_scrubbed_whole(spark, k):
    said = "10.0.0.1 to 10.0.0.10, 999.1.1.1 v1.2.3 AA:BB:CC:DD:EE:FF a.b@x.org. End 10.0.0.1"
    got = one(spark, k, "msg string", (said,))[0]
    assert got == (
        f"{IP1} to {token('ip', 'ip', '10.0.0.10')}, 999.1.1.1 v1.2.3 {token('mac', 'mac', 'aa:bb:cc:dd:ee:ff')} "
        f"{token('mail', 'email', 'a.b@x.org')}. End {IP1}"
    )


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(said=st.lists(st.sampled_from(["10.0.0.1", "é", " ", "x", ".", "1", "a@b.co", "999.9.9.9", "\n", "é10.0.0.2", ":"]), max_size=12).map("".join))
def test_replacing_matches_agrees_with_python(spark, said):
    pattern = r"[0-9]+(?:\.[0-9]+)+"
    df = spark.createDataFrame([(said,)], "t string")
    got = df.select(text.replace_each(F.col("t"), pattern, lambda m: F.concat(F.lit("<"), m, F.lit(">")))).first()[0]
    assert got == re.sub(pattern, lambda m: f"<{m.group(0)}>", said)


def test_known_values_in_prose(spark, k):
    schema = "user string, hostname string, qname string, devname string, msg string"
    said = "ANNA on ws-9.corp (not ws-9.corp.x, xws-9.corp) asked corp.example and fw1; anna! bob"
    got = one(spark, k, schema, ("anna", "WS-9.corp", "corp.example", "fw1", said))["msg"]
    anna, host, dom = token("user", "username", "anna"), token("host", "hostname", "ws-9.corp"), token("dom", "domain", "corp.example")
    assert got == f"{anna} on {host} (not ws-9.corp.x, xws-9.corp) asked {dom} and fw1; {anna}! bob"


def test_spellings_that_differ_only_by_case_are_burned(spark, k):
    got = one(spark, k, "user string, dstuser string, msg string", ("Anna", "anna", "Anna anna ANNA"))["msg"]
    assert got == f"{token('user', 'username', 'Anna')} {token('user', 'username', 'anna')} {burned('ANNA')}"


def test_short_values_are_substituted_as_whole_words(spark, k):
    row = one(spark, k, "user string, msg string", ("bob", "bob and bobby"))
    assert row["msg"] == f"{row['user']} and bobby"


def test_maps_are_masked_by_their_keys(spark, k):
    row = one(
        spark, k, "srcip string, user string, event_details map<string,string>, many array<map<string,array<string>>>, deep map<string,struct<user:string>>",
        ("10.0.0.1", "anna", {"srcip": "10.0.0.1", "USER": "anna", "level": "high", "msg": "anna from 10.0.0.1"}, [{"srcip": ["10.0.0.1"]}], {"x": ("anna",)}),
    )
    told = row["event_details"]
    assert (told["srcip"], told["USER"], told["level"]) == (row["srcip"], row["user"], "high")
    assert told["msg"] == f"{row['user']} from {row['srcip']}"
    assert row["many"][0]["srcip"] == [row["srcip"]] and row["deep"]["x"]["user"] == row["user"]


def test_leaks_in_maps_and_of_names_of_several_words(spark, k):
    df = spark.createDataFrame([("John Smith", {"user": "anna", "srcip": "10.0.0.9"})], "user string, details map<string,string>")
    words = masking.dictionary(df, k)
    assert {r["raw"] for r in words.collect()} == {"John Smith", "anna", "10.0.0.9"}
    shown = spark.createDataFrame([("call john  SMITH, now", {"note": "by anna (10.0.0.9)"})], "msg string, details map<string,string>")
    found = {(r["column"], r["raw"]) for r in masking.leaks(shown, words).collect()}
    assert found == {("msg", "John Smith"), ("details", "anna"), ("details", "10.0.0.9")}
    assert masking.leaks(masking.mask_table(df, k), words).count() == 0


def test_values_with_pattern_characters(spark, k):
    user = r"a.b\c[d]$^|(e)*+?"
    got = one(spark, k, "user string, msg string", (user, f"<{user}> a.bxc"))["msg"]
    assert got == f"<{token('user', 'username', user)}> a.bxc"


def test_device_names_stay_readable_everywhere(spark, k):
    schema = "devname string, hostname string, user string, msg string, target array<struct<name:string,value:string>>"
    row = ("FW-01,fw-02", "fw-01", "FW-01", "fw-01 and fw-02", [("device", "fw-02"), ("ip", "10.0.0.1"), ("odd", "fw-02"), ("odd", "x")])
    got = one(spark, k, schema, row)
    assert (got["devname"], got["hostname"]) == ("FW-01,fw-02", "fw-01")
    assert got["user"] == "FW-01"
    assert [tuple(i) for i in got["target"]] == [("device", "fw-02"), ("ip", IP1), ("odd", "fw-02"), ("odd", burned("x"))]
    hidden = one(spark, k, schema, row, mask_devices=True)
    assert hidden["devname"] == ",".join(token("host", "hostname", v) for v in ("fw-01", "fw-02"))
    assert hidden["hostname"] == token("host", "hostname", "fw-01")


def test_user_names_are_kept_only_as_spelled(spark, k):
    assert one(spark, k, "devname string, user string", ("ADMIN", "admin"))["user"] == token("user", "username", "admin")


@pytest.mark.parametrize(
    ("url", "host_only", "sealed"),
    [
        ("https://x.org/a?b#c", "https://{h}/a?b#c", "https://{h}/{t:/a?b#c}"),
        ("https://X.ORG:8443", "https://{h}:8443", "https://{h}:8443"),
        ("http://x.org/", "http://{h}/", "http://{h}/{t:/}"),
        ("https://u:p@x.org/", "{burned}", "{burned}"),
        ("/only/path", "/only/path", "{t:/only/path}"),
        ("10.0.0.1/a", "{ip}/a", "{t:10.0.0.1/a}"),
        ("N/A", "N/A", "N/A"),
    ],
)
def test_urls(spark, k, url, host_only, sealed):
    host = token("host", "hostname", "x.org")

    def filled(form):
        form = form.replace("{h}", host).replace("{burned}", burned(url)).replace("{ip}", IP1)
        return re.sub(r"\{t:([^}]*)\}", lambda m: token("url", "url", m.group(1)), form)

    got = one(spark, k, "http_url string, url string", (url, url))
    assert tuple(got) == (filled(host_only), filled(sealed))


def test_composites(spark, k):
    df = k.attach(spark.createDataFrame([("srcip:10.0.0.1", "level:high", "plain", "fw[root],fw2", '{"endpoint":"10.0.0.1","note":"at 10.0.0.1"}', "no json 10.0.0.1")], "a string, b string, c string, d string, e string, f string"))
    got = df.select(
        masking.prefixed(k, F.col("a")), masking.prefixed(k, F.col("b")), masking.prefixed(k, F.col("c")), masking.device_domains(k, F.col("d")),
        masking.json_fields(k, F.col("e"), ["endpoint"]), masking.json_fields(k, F.col("f"), ["endpoint"]),
    ).first()
    host = [token("host", "hostname", v) for v in ("fw", "fw2")]
    assert tuple(got) == (f"srcip:{IP1}", "level:high", "plain", f"{host[0]}[root],{host[1]}", f'{{"endpoint":"{IP1}","note":"at {IP1}"}}', f"no json {IP1}")


def test_sibling_typed_pairs(spark, k):
    df = k.attach(spark.createDataFrame([("10.0.0.1", "IP"), ("x.org", "Domain"), ("https://x.org", "url"), ("high", "band"), ("N/A", "ip")], "v string, t string"))
    host = token("host", "hostname", "x.org")
    got = [r[0] for r in df.select(masking.indicator_value(k, F.col("v"), F.col("t"))).collect()]
    assert got == [IP1, token("dom", "domain", "x.org"), f"https://{host}", "high", "N/A"]
    pairs = k.attach(spark.createDataFrame([("x.org", "x[dot]org"), ("sig", ""), ("file.exe", None)], "a string, b string"))
    twins = [tuple(r) for r in pairs.select(*masking.threat_pair(k, F.col("a"), F.col("b"))).collect()]
    assert twins == [(token("dom", "domain", "x.org"),) * 2, ("sig", ""), ("file.exe", None)]


ROWS = [
    ("10.0.0.1,10.0.0.2", "Anna", "https://web.corp:8080/a?b", "fw1", "Anna from 10.0.0.9 wrote to z@x.org", "web.corp"),
    ("N/A", "bob", "/path", "fw1", "nothing", "fw1"),
    ("fe80::1", "carol,dave", "https://10.0.0.3/", "fw2", "carol met dave", "ws-7"),
]
SCHEMA = "srcip string, user string, url string, devname string, msg string, hostname string"


def test_round_trip_and_no_leak(spark, k):
    df = spark.createDataFrame(ROWS, SCHEMA)
    masked, words = masking.mask_table(df, k), masking.dictionary(df, k)
    assert masking.leaks(masked, words).count() == 0
    assert masking.collisions(words).count() == 0
    back = masked
    for name in ("srcip", "user", "url", "msg", "hostname"):
        back = masking.unmask_text(back, words, name, k.kid)
    assert values(back) == values(df)


def test_leaks_are_found(spark, k):
    df = spark.createDataFrame(ROWS, SCHEMA)
    words = masking.dictionary(df, k)
    leaky = masking.mask_table(df, k).withColumn("msg", F.lit("(Carol): seen, 10.0.0.2."))
    assert values(masking.leaks(leaky, words), "column", "raw") == [("msg", "10.0.0.2"), ("msg", "carol")]


def test_masked_tables_still_join(spark, k):
    left = spark.createDataFrame([("10.0.0.1", 1), ("10.0.0.2", 2)], "srcip string, n int")
    right = spark.createDataFrame([("10.0.0.1", 3)], "epip string, m int")
    a, b = masking.mask_table(left, k), masking.mask_table(right, k)
    assert values(a.join(b, a["srcip"] == b["epip"]), "n", "m") == [(1, 3)]


def test_conditions_are_resolved_before_compiling(spark, k):
    words = masking.dictionary(spark.createDataFrame(ROWS, SCHEMA), k)
    asked = [Condition("source_ip", "in", [IP1, "10.9.9.9"]), Condition("user", "contains", "%" + token("user", "username", "Anna") + "%"), Condition("policyid", "eq", 3)]
    meant = masking.unmask_conditions(asked, words, vocabulary("traffic"))
    assert [c.value for c in meant] == [["10.0.0.1", "10.9.9.9"], "%Anna%", 3]


def test_metadata_types_a_column(spark, k):
    df = spark.createDataFrame([("10.0.0.1",)], "odd string").select(F.col("odd").alias("odd", metadata={"pii": "ip"}))
    assert masking.mask_table(df, k).first()[0] == IP1


@pytest.mark.parametrize(
    ("said", "shown"),
    [
        ("password=abc next", "password=***REDACTED*** next"),
        ('{"api_token": "abc"}', '{"api_token=***REDACTED***"}'),
        ("TOKEN : x;y", "TOKEN=***REDACTED***;y"),
        ("key=abc auth=1", "key=abc auth=1"),
        ("id " + "a1" * 10, "id ***REDACTED***"),
        ("id " + "a1" * 9, "id " + "a1" * 9),
        ("srcip==10.0.0.1", "srcip==10.0.0.1"),
        ("", ""),
    ],
)
def test_secrets_in_text(spark, said, shown):
    assert spark.createDataFrame([(said,)], "t string").select(text.redact(F.col("t"))).first()[0] == shown


def test_sensitive_columns_at_any_depth(spark):
    schema = "api_key string, adm_passwd struct<x:int>, note string, deep struct<a:array<struct<token:string,ok:string>>,m:map<string,string>>"
    df = spark.createDataFrame([("a", (1,), "f" * 21, ([("t", "o")], {"Session-Id": "s", "fine": "v"}))], schema)
    row = text.redact_columns(df).first()
    assert (row["api_key"], row["adm_passwd"], row["note"]) == (fv.REDACTED,) * 3
    assert tuple(row["deep"]["a"][0]) == (fv.REDACTED, "o")
    assert row["deep"]["m"] == {"Session-Id": fv.REDACTED, "fine": "v"}


def test_nested_records(spark, k):
    schema = (
        "reporter string, incident_reporter string, grpby string, groupby1 string, "
        "event_details struct<src_ip:string,host_name:string,devname:string,msg:string>, "
        "user array<struct<euid:int,euname:string>>, filter_applied array<array<string>>"
    )
    row = (
        "ann1", "ann1", '{"dstendpoint":"10.0.0.1","x":"y"}', "srcip:10.0.0.1", ("10.0.0.1", "web1", "fw-1", "ann1 at web1 on fw-1"),
        [(1, "bobby"), (2, None)], [["srcip", "==", "10.0.0.1"], ["hostname", "==", "fw-1"], ["level", "==", "see 10.0.0.1"]],
    )
    df = spark.createDataFrame([row], schema)
    got = masking.mask_table(df, k).first()
    ann, bob, web = token("user", "username", "ann1"), token("user", "username", "bobby"), token("host", "hostname", "web1")
    assert (got["reporter"], got["incident_reporter"]) == (ann, ann)
    assert got["grpby"] == f'{{"dstendpoint":"{IP1}","x":"y"}}' and got["groupby1"] == f"srcip:{IP1}"
    assert tuple(got["event_details"]) == (IP1, web, "fw-1", f"{ann} at {web} on fw-1")
    assert [tuple(u) for u in got["user"]] == [(1, bob), (2, None)]
    assert got["filter_applied"] == [["srcip", "==", IP1], ["hostname", "==", "fw-1"], ["level", "==", f"see {IP1}"]]
    words = masking.dictionary(df, k)
    assert {(r["type"], r["raw"]) for r in words.collect()} >= {("ip", "10.0.0.1"), ("hostname", "web1"), ("username", "bobby"), ("username", "ann1")}
    leaky = masking.mask_table(df, k).withColumn("event_details", F.struct(F.lit("web1").alias("host_name")))
    assert values(masking.leaks(leaky, words), "column", "raw") == [("host_name", "web1")]


def test_an_alert_id_is_no_reporter(spark, k):
    got = one(spark, k, "reporter string, incident_reporter string", ("ann1", "alert-7"))
    assert got["incident_reporter"] == "alert-7"


def test_device_records(spark, k):
    schema, row = "name string, sn string, hostname string", ("edge-1", "FG1", "edge-1")
    assert tuple(one(spark, k, schema, row)) == row
    hidden = one(spark, k, schema, row, mask_devices=True)
    assert hidden["name"] == hidden["hostname"] == token("host", "hostname", "edge-1")
    plain = one(spark, k, "name string, hostname string", ("edge-1", "edge-1"))
    assert tuple(plain) == ("edge-1", token("host", "hostname", "edge-1"))


def test_pairs_inside_a_table(spark, k):
    got = one(spark, k, "value string, type string, threat string, obf_url string", ("x.org", "domain", "x.org", "x[dot]org"))
    dom = token("dom", "domain", "x.org")
    assert tuple(got) == (dom, "domain", dom, dom)
    bucket = one(spark, k, "dimension string, value string, hits long", ("srcip", "10.0.0.1", 3))
    assert tuple(bucket) == ("srcip", IP1, 3)


def test_values_masked_once_equal_the_projection(spark, k):
    rows = [("10.0.0.1", "Ann", "fw1"), ("10.0.0.1,10.0.0.2", "fw1", "fw1"), ("N/A", None, "fw2"), (None, "a,Ann", None), ("bad", "fw1,Ann", "fw1"), ("10.0.0.1", "Ann", "fw1")]
    df = spark.createDataFrame(rows, "srcip string, user string, devname string").withColumn("msg", F.lit("Ann from 10.0.0.1"))
    few = ["srcip", "user"]
    made = masking.masked_values(df, k, few)
    assert made.count() == made.select("key").distinct().count() == 8
    assert values(masking.mask_table(df, k, values=made, few=few)) == values(masking.mask_table(df, k))
    plan = masking.mask_table(df, k, values=made, few=few)
    assert values(masking.unmask_columns(plan, masking.dictionary(df, k), few)).count(("10.0.0.1", "Ann", "fw1", masking.mask_table(df, k).first()["msg"])) == 2
