"""JSON text and variants of any shape: masked, restored and checked."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_masking import IP1, KEY, burned, token

from logweir.catalog import masks
from logweir.catalog.registry import Tables
from logweir.functions import nested
from logweir.functions.tokens import Tokenizer
from logweir.operators import masking


@pytest.fixture(scope="module")
def k(spark):
    return Tokenizer.of(spark, KEY)


WORDS = ["anna", "Bobby", "", "N/A", "10.0.0.1", "x \"y\" z", "tab\there", "back\\slash", "é日😀", "{\"user\": \"in text\"}", "[1]", "a, b", "seen at 10.0.0.1"]
KEYS = ["user", "USER", "hostname", "note", "n", "e\"q", "ü", "srcip"]


def shape(rng, depth):
    roll = rng.random()
    if depth and roll < 0.35:
        return {rng.choice(KEYS): shape(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if depth and roll < 0.6:
        return [shape(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return rng.choice([*WORDS, *WORDS, 1, -2.5, 1e30, 12345678901234567890, True, False, None])


def plain_mask(value, key="", top=True):
    """The walk in plain Python, by the rules of the masker's docstring."""
    if isinstance(value, dict):
        return {n: plain_mask(v, n.lower(), False) for n, v in value.items()}
    if isinstance(value, list):
        return [plain_mask(v, key if not isinstance(v, list) else "", False) for v in value]
    if not isinstance(value, str):
        return value
    parts = value.split(",")
    if key in ("user", "hostname", "srcip"):
        return ",".join(plain_one(key, p) for p in parts)
    return value.replace("10.0.0.1", IP1)


def plain_one(key, part):
    if part.strip() in ("", "N/A", "n/a", "unknown", "none", "-"):
        return part
    if key == "user":
        return token("user", "username", part)
    if key == "hostname":
        return token("host", "hostname", part.lower())
    return IP1 if part == "10.0.0.1" else burned(part)


def test_random_json_equals_a_plain_walk(spark, k):
    rng = random.Random(6)
    shapes = [shape(rng, 5) for _ in range(400)]
    shapes = [s if isinstance(s, (dict, list)) else {"user": s} for s in shapes]
    texts = [json.dumps(s, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([(",", ":"), (", ", ": ")])) for s in shapes]
    df = k.attach(spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4))
    got = {r["i"]: r["m"] for r in df.select("i", masking.json_fields(k, F.col("t"), ["user", "hostname", "srcip"]).alias("m")).collect()}
    for i, s in enumerate(shapes):
        assert json.loads(got[i]) == plain_mask(s), texts[i]
        if plain_mask(s) == s:
            assert got[i] == texts[i]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet='{}[]:,"\\ au1é\n', max_size=40))
def test_any_text_is_walked_whole(spark, text):
    row = spark.range(1).select(F.array_join(F.transform(nested.walked(F.lit(text)), lambda p: p["part"]), "").alias("t")).first()
    assert row["t"] == text


def test_a_long_text_and_a_deep_one(spark, k):
    wide = {"rows": [{"user": f"u{i}", "n": i} for i in range(20_000)]}
    deep = "[" * 400 + '{"user": "anna"}' + "]" * 400
    df = k.attach(spark.createDataFrame([(json.dumps(wide),), (deep,)], "t string"))
    first, second = [r[0] for r in df.select(masking.json_fields(k, F.col("t"), ["user"])).collect()]
    assert json.loads(first) == {"rows": [{"user": token("user", "username", f"u{i}"), "n": i} for i in range(20_000)]}
    assert second == deep.replace("anna", token("user", "username", "anna"))


CASES = [
    ('{"user": "anna", "nested": {"user": "bobby", "n": 1.50, "on": true, "no": null}}', lambda u: f'{{"user": "{u("anna")}", "nested": {{"user": "{u("bobby")}", "n": 1.50, "on": true, "no": null}}}}'),
    ('["anna", {"user": ["bobby", 7, {"note": "anna"}, "cc"]}]', lambda u: f'["anna", {{"user": ["{u("bobby")}", 7, {{"note": "anna"}}, "{u("cc")}"]}}]'),
    # Cut off, and with a repeated key: masked by the keys all the same, and scrubbed.
    ('{"user": "anna", "note": "at 10.0.0.1", x 10.0.0.1', lambda u: f'{{"user": "{u("anna")}", "note": "at {IP1}", x {IP1}'),
    ('{"user": "anna", "user": "bobby"}', lambda u: f'{{"user": "{u("anna")}", "user": "{u("bobby")}"}}'),
    ('no json 10.0.0.1', lambda u: f"no json {IP1}"),
    ('"10.0.0.1"', lambda u: f'"{IP1}"'),
    ("17", lambda u: "17"),
    ("", lambda u: ""),
    (None, lambda u: None),
    # Typed by a sibling, before or after; a target of unknown name is burned; escapes hide no address.
    ('{"value": "10.0.0.1", "type": "ip"}', lambda u: f'{{"value": "{IP1}", "type": "ip"}}'),
    ('{"target": [{"name": "user", "value": "anna"}, {"value": "x", "name": "odd"}]}', lambda u: f'{{"target": [{{"name": "user", "value": "{u("anna")}"}}, {{"value": "{burned("x")}", "name": "odd"}}]}}'),
    ('{"grpby": "{\\"user\\":\\"anna\\"}"}', lambda u: f'{{"grpby": "{burned(chr(123) + chr(34) + "user" + chr(34) + ":" + chr(34) + "anna" + chr(34) + chr(125))}"}}'),
    ('{"groupby1": ["user:anna", "level:high"]}', lambda u: f'{{"groupby1": ["user:{u("anna")}", "level:high"]}}'),
    ('{"incident_reporter": "anna", "reporter": "anna"}', lambda u: f'{{"incident_reporter": "{u("anna")}", "reporter": "{u("anna")}"}}'),
]


def test_shapes(spark, k):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, grpby string")
    got = {r["i"]: r["grpby"] for r in masking.mask_table(rows, k).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == want(lambda v: token("user", "username", v)), text


def test_escapes_hide_no_address(spark, k):
    rows = spark.createDataFrame([('{"note": "line\\n10.0.0.1 \\u0041"}',)], "grpby string")
    assert json.loads(masking.mask_table(rows, k).first()[0]) == {"note": f"line\n{IP1} A"}


def test_variants_and_their_place_in_structs_and_lists(spark, k):
    blob = '{"user":"anna","list":[{"srcip":"10.0.0.1","n":1.50}]}'
    rows = spark.createDataFrame([(1, blob), (2, None)], "id int, t string").select("id", F.parse_json("t").alias("v"), F.struct(F.array(F.parse_json("t")).alias("inner")).alias("s"))
    masked = masking.mask_table(rows, k).select("id", F.to_json("v").alias("v"), F.to_json(F.col("s.inner")[0]).alias("w")).orderBy("id").collect()
    want = {"user": token("user", "username", "anna"), "list": [{"srcip": IP1, "n": 1.5}]}
    assert json.loads(masked[0]["v"]) == json.loads(masked[0]["w"]) == want and masked[1]["v"] is None
    words = {(r["type"], r["raw"]) for r in masking.dictionary(rows, k).collect()}
    assert words == {("username", "anna"), ("ip", "10.0.0.1")}


def test_keep_set_and_prose_reach_into_json(spark, k):
    rows = spark.createDataFrame([("fw1", '{"hostname": "FW1", "user": "anna", "note": "anna on fw1"}', "anna was here")], "devname string, grpby string, msg string")
    row = masking.mask_table(rows, k).first()
    user = token("user", "username", "anna")
    assert json.loads(row["grpby"]) == {"hostname": "FW1", "user": user, "note": f"{user} on fw1"} and row["msg"] == f"{user} was here"


def test_dictionary_and_leaks_read_json(spark, k):
    texts = ['{"a": {"user": "bobby", "url": "http://h.x/p?q"}, "note": "from 10.0.0.1"}', '[{"hostname": ["web", "N/A"]}, {"srcip": "10.0.0.2,10.0.0.3"}]', '{"user": "J\\u00f6rg M\\u00fcller"}']
    rows = spark.createDataFrame([(t,) for t in texts], "grpby string")
    words = masking.dictionary(rows, k)
    found = {(r["type"], r["raw"]) for r in words.collect()}
    assert found == {("username", "bobby"), ("hostname", "h.x"), ("url", "/p?q"), ("ip", "10.0.0.1"), ("hostname", "web"), ("ip", "10.0.0.2"), ("ip", "10.0.0.3"), ("username", "Jörg Müller")}
    masked = masking.mask_table(rows, k)
    assert masking.leaks(masked, words).count() == 0
    seen = {(r["column"], r["type"], r["raw"]) for r in masking.leaks(rows, words).collect()}
    assert seen >= {("grpby", t, r) for t, r in found if t != "url"}
    assert masking.unmask_text(masked, words, "grpby", k.kid).where("grpby like '%bobby%'").count() == 1


def test_plans_hold_no_python(spark, k):
    rows = spark.createDataFrame([('{"user": "anna"}',)], "grpby string")
    plan = masking.mask_table(rows, k)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_walk_takes_few_steps_and_keeps_the_keys(spark):
    # One part for each string or opening bracket, and one for the rest; signs of broken texts count in their order.
    cases = [
        ('{"a": [1, "x"], "b": "y"} ', 7, [("a", "x"), ("b", "y")]),
        ('{"a": {"b": ["x", {"C": "y"}], }, "z": ["w"]}', 13, [("b", "x"), ("c", "y"), ("z", "w")]),
        ('{"a": [[1], "x" "y"]] "z", "k": 1}}, "v"', 9, [("a", "x"), ("a", "y"), ("", "z"), ("", "k"), ("", "v")]),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string")
    got = rows.select(nested.walked(F.col("t")).alias("w"), nested.values(F.col("t")).alias("v")).orderBy("i").collect()
    for (text, parts, said), row in zip(cases, got, strict=True):
        assert "".join(p["part"] for p in row["w"]) == text
        assert len(row["w"]) == parts and [tuple(v) for v in row["v"]] == said


def test_json_of_the_catalogue_is_dealt_out(spark, small):
    plan = masks._nested_alerts(Tables(spark, small))._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" in plan


def test_patterns_tell_sound_json_as_the_walk_does(spark):
    rng = random.Random(8)
    shapes = [s for s in (shape(rng, 4) for _ in range(300)) if isinstance(s, (dict, list))]
    texts = [json.dumps(s, ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (", ", " : ")])) for s in shapes]
    texts += ['{"a]": ["x", 1, "y"], "B": {"c": "z", "d": [[true, "q"], []]}}', "[]", "{}", ' ["x"] ']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", nested.sound(F.col("t")).alias("s"), nested.plain_parts(F.col("t")).alias("p"), nested.walked(F.col("t")).alias("w")).collect()
    told = [r for r in got if r["p"] is not None]
    assert len(told) > 50 and all(r["s"] for r in got)
    for r in told:
        assert "".join(p["part"] for p in r["p"]) == r["t"]
        assert [(p["key"], p["value"]) for p in r["p"] if p["key"] is not None] == [(p["key"], p["value"]) for p in r["w"] if p["key"] is not None], r["t"]


def test_patterns_leave_the_rest_to_the_walk(spark, k):
    # A string in a list beside an object, values judged by their siblings, and text behind the value.
    apart = ['{"a": ["x", {"b": "y"}]}', '{"value": "a", "type": "ip"}', '{"Val\\u0075e": "a"}']
    behind = ['{"a": "b"} "x": "y" }', '{"a": "b"}, {}', '{"a": "b"}, "c": "d"', '["a"] ]', '{"a": "b"', '"a"', "", '{"a": "b", "a": "c"}']
    rows = spark.createDataFrame([(t,) for t in apart + behind], "t string")
    got = rows.select(nested.plain_parts(F.col("t")).isNull().alias("p"), nested.sound(F.col("t")).alias("s")).collect()
    assert all(r["p"] for r in got[: len(apart)]) and all(r["s"] for r in got[: len(apart)])
    assert not any(r["s"] for r in got[len(apart) :])


def test_known_values_get_their_tokens_only_where_a_text_mentions_them(spark, k):
    rows = spark.createDataFrame([("anna", "ANNA,Web", "x", "anna, Anna and WEB; Ünal anna"), ("-", None, "y", "- anna")], "user string, hostname string, id string, msg string")
    raws = masking._record_raws(rows, masking.type_table(rows), None)
    assert "sha2" not in str(raws)
    first, second = masking.mask_table(rows, k).orderBy("id").collect()
    assert first["msg"] == f"{token('user', 'username', 'anna')}, {burned('Anna')} and {token('host', 'hostname', 'web')}; Ünal {token('user', 'username', 'anna')}"
    assert second["msg"] == "- anna"


def test_leaks_of_json_shuffle_no_piece_longer_than_any_raw_value(spark, k):
    words = spark.createDataFrame([("username", "anna"), ("username", 'j"x y'), ("ip", "10.0.0.1")], "type string, raw string")
    texts = ['{"user": "anna", "n": 1}', '{"note": "at 10.0.0.1 J\\"X Y", "m": ["q"]}', '{"anna": "masked"', "no json"]
    found = masking.leaks(spark.createDataFrame([(t,) for t in texts], "grpby string"), words)
    assert {tuple(r) for r in found.collect()} == {("grpby", "username", "anna"), ("grpby", "username", 'j"x y'), ("grpby", "ip", "10.0.0.1")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "length(seen" in plan
