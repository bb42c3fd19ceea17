import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.llm import chat

EVENTS = "conv_id long, message_id long, seq long, kind string, role string, text string"


def plain_messages(events):
    """Events applied one after the other."""
    logs = {}
    for e in events:
        if e[3] in chat.KINDS:
            logs.setdefault((e[0], e[1]), []).append(e)
    found = []
    for (conv, message), log in logs.items():
        log.sort(key=lambda e: (e[2] is not None, e[2] or 0, chat.KINDS.index(e[3]), e[5] or ""))
        role, text = "", ""
        for _, _, seq, kind, named, part in log:
            text = text + (part or "") if kind == "delta" else (part or "")
        named = [(e[2] is not None, e[2] or 0, chat.KINDS.index(e[3]), e[4]) for e in log if e[4] is not None]
        role = max(named)[-1] if named else ""
        places = [e[2] for e in log if e[2] is not None]
        found.append((conv, message, min(places, default=None), role, text))
    return found


def test_folded_logs_equal_the_plain_version(spark):
    rng = random.Random(11)
    events = []
    for seq in range(900):
        kind = rng.choice(["start", "edit", "regenerate", "delta", "delta", "delta", "typing", None])
        role = rng.choice(["user", "assistant", None, None, "system"])
        events.append((rng.choice([1, 2, 3, 3, 3, None]), rng.choice([10, 11, 12, 13, None]), seq if rng.random() < 0.9 else rng.choice([None, seq // 10]), kind, role, rng.choice(["", None, "é", "<|end|>", "ab", "</s>"])))
    events += rng.sample(events, 40)
    rng.shuffle(events)
    frame = spark.createDataFrame(events, EVENTS).withColumn("event", F.lit(1)).withColumn("valid", F.lit("x")).withColumn("first", F.lit(0))
    found = [tuple(r) for r in chat.reconstruct(frame.repartition(4)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, plain_messages(events)))


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, 0, "start", "user", "helo"),
        (1, 1, 1, "edit", None, "hello"),
        (1, 2, 2, "start", "assistant", ""),
        (1, 2, 3, "delta", None, "wrong "),
        (1, 2, 4, "delta", None, "answer"),
        (1, 3, 8, "start", "user", "more"),
        (1, 2, 9, "regenerate", None, None),
        (1, 2, 10, "delta", None, "right "),
        (1, 2, 11, "delta", None, "answer"),
        (2, 1, 0, "delta", None, "lost start"),
    ]
    messages = chat.reconstruct(spark.createDataFrame(events, EVENTS))
    rendered = chat.render(messages).select("conv_id", "segments", chat.formatted(F.col("segments")).alias("text"))
    read = {r["conv_id"]: r for r in rendered.select("conv_id", "text", chat.turns(F.col("text")).alias("turns"), chat.trained(F.col("segments")).alias("loss")).collect()}
    assert read[1]["text"] == "<|turn|>user<|text|>hello<|end|><|turn|>assistant<|text|>right answer<|end|><|turn|>user<|text|>more<|end|>"
    assert [tuple(t) for t in read[1]["turns"]] == [("user", "hello"), ("assistant", "right answer"), ("user", "more")]
    assert read[1]["loss"] == "right answer" and read[2]["loss"] == ""
    assert [tuple(t) for t in read[2]["turns"]] == [("", "lost start")]


PARTS = ["<", "[", "~", "s>", "/s>", "INST]", "/INST]", "|turn|>", "|text|>", "|end|>", "<|turn|>", "</s>", "[INST]", "a", "\n", "é", "$1", "\\", ""]


def test_any_texts_are_read_back(spark):
    rng = random.Random(4)
    rows = [(i // 4, i % 4, "".join(rng.choices(PARTS, k=rng.randint(0, 3))), "".join(rng.choices(PARTS, k=rng.randint(0, 12)))) for i in range(4000)]
    told = spark.createDataFrame([(c, m, m, "assistant" if m == 1 else r, t) for c, m, r, t in rows], "conv_id long, message_id long, first long, role string, text string")
    rendered = chat.render(told).select("conv_id", "segments", chat.formatted(F.col("segments")).alias("text"))
    read = rendered.select("conv_id", chat.turns(F.col("text")).alias("turns"), chat.trained(F.col("segments")).alias("loss")).collect()
    assert len(read) == 1000
    for r in read:
        assert [tuple(t) for t in r["turns"]] == [("assistant" if m == 1 else role, t) for c, m, role, t in rows if c == r["conv_id"]]
        assert r["loss"] == "".join(t for c, m, role, t in rows if c == r["conv_id"] and m == 1)


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 1, "assistant", ""), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (None, 0, "user", "no id"), (2, 0, "assistant", "x" * 200_001)]
    frame = spark.createDataFrame([(*r, "z", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, kind string, copy int, step int")
    messages = chat.reconstruct(chat.logged(frame))
    rendered = chat.render(messages).select("conv_id", chat.formatted(F.col("segments")).alias("text"), chat.trained(F.col("segments")).alias("loss"))
    read = {r["conv_id"]: r for r in rendered.select("conv_id", chat.turns(F.col("text")).alias("turns"), "loss").collect()}
    assert [tuple(t) for t in read[1]["turns"]] == [("", "first"), ("user", ""), ("assistant", ""), ("assistant", "tie"), ("assistant", "tie")]
    assert read[1]["loss"] == "tietie" and read[None]["turns"][0]["text"] == "no id" and len(read[2]["loss"]) == 200_001
    assert chat.render(chat.reconstruct(chat.logged(frame.limit(0)))).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_escapes_are_taken_out_again(spark, parts):
    text = "".join(parts)
    there = chat.escaped(F.lit(text))
    read = spark.range(1).select(there.alias("e"), chat.unescaped(there).alias("t")).first()
    assert read["t"] == text and not any(m in read["e"] for m in (chat.TURN, chat.TEXT, chat.END, "</s>", "[INST]"))


def test_the_log_meets_once(spark, small):
    from logweir.llm.queries import QUERIES

    plan = QUERIES["op13_chat_formatting"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
