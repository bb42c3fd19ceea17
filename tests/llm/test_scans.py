"""License templates and personal data against plain definitions."""

import random
import re

import pytest

from logweir.llm import skipchain, templates

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def as_regex(template):
    """A template over words that each end in a blank."""
    out = ""
    for part in templates._PART.finditer(template):
        if part[0] in "{}":
            out += "(?:" if part[0] == "{" else ")?"
        elif part[1]:
            out += rf"(?:\S+ ){{{part[2]},{part[3]}}}"
        else:
            out += re.escape(part[4]) + " "
    return re.compile(out)


def test_scans_equal_regular_expressions():
    rng = random.Random(7)
    scanner = templates.Scanner(templates.TEMPLATES, templates.BASE)
    lines = [(label, t, False) for label, many in templates.TEMPLATES.items() for t in many] + [(label, t, True) for t, label in templates.BASE.items()]
    pool = [p for _, t, _ in lines for p in re.sub(r"<[^>]*>|[{}]", " ", t).split()] + ["filler", "x1"]
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.7:
                label, t, _ = rng.choice(lines)
                t = re.sub(r"<\w+:(\d+)-(\d+)>", lambda m: " ".join(rng.choice(pool) for _ in range(rng.randint(int(m[1]), int(m[2])))), t)
                t = re.sub(r"[{}]", "", t) if rng.random() < 0.5 else re.sub(r"\{[^{}]*\}", "", t)
                words += t.split()
            words += [rng.choice(pool) for _ in range(rng.randint(0, 4))]
        words = [w for w in words if w.isalnum()]
        text = rng.choice([" ", ", ", "\n-- "]).join(w.upper() if rng.random() < 0.2 else w for w in words)
        count, found = scanner.scan(text.encode())
        assert count == len(words)
        want = []
        for label, t, base in lines:
            pattern = as_regex(t)
            for at in range(len(words)):
                # The longest way: the regular expression over every end.
                ends = [e for e in range(at + 1, len(words) + 1) if pattern.fullmatch(" ".join(words[at:e]) + " ")]
                if ends:
                    want.append((label, at, max(ends), base))
        assert sorted(found) == sorted(want)


def test_a_changed_mandatory_word_is_not_accepted():
    scanner = templates.Scanner({"mit": ("released under the mit license",)}, {})
    assert scanner.scan(b"Released under the MIT license.")[1] and not scanner.scan(b"Released under a MIT license.")[1]


def spoken(template, holder, options):
    text = re.sub(r"<\w+:\d+-\d+>", holder, template)
    return re.sub(r"\{([^{}]*)\}", r"\1" if options else "", text).split()


@pytest.mark.parametrize("label", sorted(templates.WHOLE))
def test_whole_licences_need_every_mandatory_word(label):
    scanner = templates.Scanner(templates.WHOLE, {})
    (template,) = templates.WHOLE[label]
    for holder, options in (("X", True), ("The Regents of Some University", False), ("A B C D E F G H", True)):
        words = spoken(template, holder, options)
        text = ", ".join(["Copyright 2020 someone."] + [w.upper() if i % 3 else w for i, w in enumerate(words)] + ["The end"])
        count, found = scanner.scan(text.encode())
        assert count == len(words) + 5 and found == [(label, 3, 3 + len(words), False)]
    assert scanner.scan(" ".join(spoken(template, "nine words are more than a holder ever has", True)).encode())[1] == []
    words = spoken(template, "Holder", False)
    for at, word in enumerate(words):
        changed = " ".join([*words[:at], "changed", *words[at + 1 :]])
        assert bool(scanner.scan(changed.encode())[1]) == (word == "Holder"), word


@pytest.mark.parametrize("markup", ["{a", "a}", "<x:1-2> a", "{a}", ""])
def test_unusable_markup_is_refused(markup):
    with pytest.raises(ValueError):
        templates.compiled("x", markup)


def test_scans_of_odd_rows(odd_documents, no_documents):
    rows = templates.scan(odd_documents).collect()
    want = sorted(len(WORD.findall((r["text"] or "").translate(LOWER))) for r in odd_documents.collect())
    assert sorted(r["n_words"] for r in rows) == want
    assert templates.scan(no_documents).count() == 0


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and skipchain._luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    pieces = ["a", "Z9", "@", ".", "-", "+", " ", "1", "23", "456", "4012888888881881", "255", "256", "007", "(", ")", "x@y.z", "é", "@b.c", "+1 (212) 555-0100", "10.0.0.1", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert skipchain.base_spans(text) == plain_spans(text), text


def test_luhn():
    assert skipchain._luhn("4012888888881881") and not skipchain._luhn("4012888888881882")


def training(spark):
    rng = random.Random(12)
    card = lambda: rng.choice(["4012888888881881", "5105105105105100", "378282246310005" "0"[:0], "6011000990139424"])
    rows = []
    for i in range(300):
        parts = [rng.choice(["word", "other", "thing", "in 1999", "page 12", "7 of 9"]) for _ in range(12)]
        if i % 3 == 0:
            parts.insert(rng.randrange(12), card())
        if i % 4 == 0:
            parts.insert(rng.randrange(12), f"+1 (212) 555-{rng.randrange(1000, 9999)}")
        if i % 5 == 0:
            number = f"+1 (646) 555-{rng.randrange(1000, 9999)}"
            parts += [number, "again", number]
        rows.append((i, " and ".join(parts)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_the_field_adds_what_repeats_and_leaves_clean_text_alone(spark):
    field = skipchain.train(training(spark))
    # The base pattern takes both numbers as one and drops them; the field finds the card that stands elsewhere.
    text = "pay 4012888888881881 now. Later 77 4012888888881881 was used"
    assert [(s[0], s[1]) for s in plain_spans(text)] == [(4, 2)]
    spans = field.spans(text)
    assert [(text[a:b], skipchain.KINDS[k], base) for a, k, b, base, _ in spans] == [("4012888888881881", "card", True), ("4012888888881881", "card", False)]
    for clean in ("in 1999 page 12", "7 of 9 at 10:30", "version 2.0 of 2024-01-02", "a plain text"):
        assert field.spans(clean) == []


def test_every_repeat_in_a_long_text_is_found():
    # A form that seldom is personal data, and repeats that agree.
    shape = skipchain._shape("12025550143")
    field = skipchain.Field({("shape", shape, 0, 0): 40, ("shape", shape, 4, 0): 2, **{("skip", "", k, k): 500 for k in range(5)}})
    repeats = "or ask 12025550143 today. " * 150
    for text in (f"call +12025550143 now. {repeats}", f"{repeats}call +12025550143 now."):
        assert len(skipchain.base_spans(text)) == 1
        spans = field.spans(text)
        assert len(spans) == 151 and all(text[a:b].endswith("12025550143") and skipchain.KINDS[k] == "phone" for a, k, b, _, _ in spans)
    assert field.spans(repeats) == []


def test_copies_do_not_thin_the_texts_learned_from(spark, monkeypatch):
    monkeypatch.setattr(skipchain, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(skipchain, "Field", dict)
    docs = spark.createDataFrame([(f"copy {max(0, i - 3000)}",) for i in range(3300)], "text string")
    counts = skipchain.train(docs)
    # One token a text, of some 300.
    assert 150 <= sum(n for (part, *_), n in counts.items() if part == "shape") <= 250


def test_messages_are_exact_on_a_tree(spark):
    import itertools

    import numpy as np

    field = skipchain.train(training(spark))
    text = "12 345 777 888888 then 4012888888881881"
    graph = skipchain.Graph(text, skipchain.base_spans(text))
    assert graph.chain and not graph.skip
    size, n = len(skipchain.LABELS), len(graph.places)
    own = np.array([field.unary.get(s, field.unknown) for s in graph.shapes])
    for i, k in enumerate(graph.given):
        if k >= 0:
            own[i] = np.where(np.arange(size) == k, 0.0, -30.0)
    want = np.zeros((n, size))
    for labels in itertools.product(range(size), repeat=n):
        weight = sum(own[i, y] for i, y in enumerate(labels)) + sum(field.pairs["chain"][labels[a], labels[b]] for a, b in graph.chain)
        for i, y in enumerate(labels):
            want[i, y] += np.exp(weight)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(graph), want, atol=2e-3)


def test_personal_data_of_odd_rows(spark, odd_documents, no_documents):
    field = skipchain.train(odd_documents)
    assert skipchain.find(odd_documents, field).count() == odd_documents.count()
    assert skipchain.find(no_documents, skipchain.train(no_documents)).count() == 0
    clean = skipchain.redact(odd_documents, field)
    assert clean.columns == odd_documents.columns and clean.where("text is null").count() == odd_documents.where("text is null").count()
    told = spark.createDataFrame([(1, "mail a@b.co or +1 (212) 555-0100, card 4012888888881881")], "doc_id long, text string")
    assert skipchain.redact(told, field).first()["text"] == "mail [email] or [phone], card [card]"


def test_many_numbers_in_one_text_end(spark):
    field = skipchain.train(training(spark))
    assert field.spans("9" * 20000 + ".1.1.1 " + "5 " * 20000 + "+1" + " " * 20000) is not None
