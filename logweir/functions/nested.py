"""JSON text of any shape, walked without a schema: its string values with their keys, and the text rebuilt.

A text is cut behind each string and each opening bracket; a fold over these parts keeps the open objects and lists,
so that each string value knows its key.  Only strings are ever replaced: numbers, spacing, the order of keys
and repeated keys stay as they are, and a text that is no JSON comes back whole.

Most sound JSON needs no fold: its strings stand right behind their keys, alone or in a list of plain values, so that
patterns over the whole text find each with its key (``plain_parts``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.functions.text import let

#: A string or an opening bracket with all signs and other text before it; what comes after the last of them.
_PART = r'(?s)[^"{\[]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{\["])|[^"{\[]++'
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: A list of plain values with a string among them.
_LIST = rf'\[[^"\[\]{{}}]*+{_STRING}[^"\[\]{{}}]*+(?:{_STRING}[^"\[\]{{}}]*+)*+\]'
#: In sound JSON: all before a string or such a list, the key of it, and itself; what comes after the last of them.
_KEYED = rf'(?s)(?=.)(?:[^"\[]++|(?!{_LIST})\[|{_STRING}\s*+:\s*+(?!"|{_LIST}))*+(?:(?:({_STRING})\s*+:\s*+)?+({_STRING}|{_LIST}))?+'
_ITEM = rf'(?s)[^"]*+{_STRING}|[^"]++'
#: Keys whose values are judged by what stands beside them.
BESIDE = ("value", "incident_reporter", "threat", "obf_url")
_BESIDE = rf'(?i)"(?:{"|".join(BESIDE)})"\s*:|\\u[^"]*"\s*:'
#: Parts folded at a time, at least.  A fold copies what it has gathered at every step, so parts are gathered in chunks
#: and chunks in larger ones, each near the cube root of the number of parts.
CHUNK = 32

_FRAME = "struct<box:int,owner:string,key:string,listed:boolean>"
_WALKED = "struct<part:string,value:string,key:string,owner:string,box:int>"

Swap = Callable[[Column, Column, Column, Callable[[str], Column]], Column]


def shaped(text: Column) -> Column:
    """Whether a text begins as an object or a list."""
    return F.coalesce(text.rlike(r"^\s*[{\[]"), F.lit(False))


def content(part: Column) -> Column:
    """What a JSON string says."""
    plain = F.substring(part, F.lit(2), F.length(part) - 2)
    read = F.from_json(F.concat(F.lit("["), part, F.lit("]")), "array<string>")
    return F.when(plain.contains("\\"), F.coalesce(F.get(read, F.lit(0)), plain)).otherwise(plain)


def said(value: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(value))
    escaped = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return F.when(value.rlike(r'[\x00-\x1f"\\]'), escaped).otherwise(F.concat(F.lit('"'), value, F.lit('"')))


def _read(part: Column) -> Column:
    """A part as the fold needs it: the string it ends in or the bracket it opens, and the signs before them.

    ``closes`` counts the brackets closed there; ``sign`` is the last comma or colon, ``late`` the brackets closed after it.
    """

    def cut(quote: Column) -> Column:
        before = F.when(quote > 0, F.substring(part, F.lit(1), quote - 1)).otherwise(part)
        signs = F.when(before.isin("", ":", ","), before).otherwise(F.regexp_replace(before, r"[^\]},:]++", ""))
        return let(signs, lambda signs: told(quote, signs))

    def told(quote: Column, signs: Column) -> Column:
        late = F.when(signs.isin("", ":", ","), F.lit(0)).otherwise(F.length(F.regexp_extract(signs, r"[\]}]*$", 0)))
        return F.struct(
            part.alias("part"),
            # A lone quotation mark is no string.
            F.when((quote > 0) & (F.length(part) > quote), F.substring(part, quote, F.length(part))).alias("string"),
            F.when((quote == 0) & part.rlike(r"[{\[]$"), F.right(part, F.lit(1))).otherwise("").alias("opens"),
            F.length(F.translate(signs, ",:", "")).alias("closes"),
            F.substring(signs, F.length(signs) - late, F.lit(1)).alias("sign"),
            late.alias("late"),
        )

    return let(F.instr(part, F.lit('"')), cut)


def _step(state: Column, part: Column) -> Column:
    """The fold: open frames, whether a string here is a value, and the part with its place.

    Nothing here is named by ``let``, which copies whatever it holds, and so all that was gathered.
    """
    open_before, closes = F.size(state["stack"]), part["closes"]
    stack = F.when(closes == 0, state["stack"]).otherwise(F.slice(state["stack"], F.lit(1), F.greatest(open_before - closes, F.lit(0))))
    top = F.get(state["stack"], open_before - closes - 1)
    inside = F.coalesce(top["key"], F.lit(""))
    listed = F.coalesce(top["listed"], F.lit(True))
    # What a comma says depends on what is open there.
    comma = F.coalesce(F.get(state["stack"], open_before - closes + part["late"] - 1)["listed"], F.lit(True))
    value = F.when(part["sign"] == ":", F.lit(True)).when(part["sign"] == ",", comma).otherwise(state["value"])
    string = part["string"].isNotNull()
    shown = string & (value | listed)

    def frame(box: Column, owner: Column, key: Column, is_list: Column) -> Column:
        return F.array(F.struct(box.alias("box"), owner.alias("owner"), key.alias("key"), is_list.alias("listed")))

    renamed = frame(top["box"], top["owner"], F.lower(content(part["string"])), F.lit(False))
    opened = (
        F.when(part["opens"] == "{", F.concat(stack, frame(state["at"], inside, F.lit(""), F.lit(False))))
        # A list's strings are values of the list's key; a list in a list has none.
        .when(part["opens"] == "[", F.concat(stack, frame(state["at"], inside, F.when(listed, F.lit("")).otherwise(inside), F.lit(True))))
        .when(string & ~shown, F.concat(F.slice(stack, F.lit(1), F.size(stack) - 1), renamed))
        .otherwise(stack)
    )
    place = F.struct(
        part["part"].alias("part"),
        F.when(shown, part["string"]).alias("value"),
        F.when(shown, inside).alias("key"),
        F.coalesce(top["owner"], F.lit("")).alias("owner"),
        F.coalesce(top["box"], F.lit(-1)).alias("box"),
    )
    return F.struct(
        (state["at"] + 1).alias("at"),
        F.when(part["opens"] == "", value).otherwise(part["opens"] == "[").alias("value"),
        opened.alias("stack"),
        F.concat(state["out"], F.array(place)).alias("out"),
    )


def walked(text: Column) -> Column:
    """All parts of a text in order; ``key`` and ``value`` are null but for those that end in a string value.

    ``key`` is the key a value stands under, itself or its list, in lower case; ``owner`` is the key of the object it
    stands in, and ``box`` tells that object from others.
    """
    kinds = [f"array<{_WALKED}>", f"array<array<{_WALKED}>>", f"array<array<array<{_WALKED}>>>"]

    def state(of: Column, out: Column) -> Column:
        return F.struct(of["at"].alias("at"), of["value"].alias("value"), of["stack"].alias("stack"), out.alias("out"))

    def empty(level: int) -> Column:
        return F.array().cast(kinds[level])

    def gathered(level: int, below: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        """One step of a fold over chunks: the chunk folded by itself, and appended as one element."""

        def step(so_far: Column, chunk: Column) -> Column:
            return let(below(state(so_far, empty(level - 1)), chunk), lambda f: state(f, F.concat(so_far["out"], F.array(f["out"]))))

        return step

    def folded(parts: Column, width: Column) -> Column:
        def small(begun: Column, chunk: Column) -> Column:
            return F.aggregate(F.slice(parts, chunk * width + 1, width), begun, _step)

        def large(begun: Column, chunk: Column) -> Column:
            last = F.least((chunk + 1) * width - 1, ends)
            return F.aggregate(F.sequence(chunk * width, last), begun, gathered(1, small))

        ends = F.floor((F.size(parts) - 1) / width).cast("int")
        start = F.struct(F.lit(0).alias("at"), F.lit(True).alias("value"), F.array().cast(f"array<{_FRAME}>").alias("stack"), empty(2).alias("out"))
        every = F.sequence(F.lit(0), F.floor(ends / width).cast("int"))
        whole = F.aggregate(every, start, gathered(2, large), lambda s: F.flatten(F.flatten(s["out"])))
        return F.when(F.size(parts) > 0, whole).otherwise(empty(0))

    def sized(parts: Column) -> Column:
        return let(F.greatest(F.lit(CHUNK), F.ceil(F.cbrt(F.size(parts))).cast("int")), lambda width: folded(parts, width))

    return F.when(text.isNotNull(), let(F.transform(F.regexp_extract_all(text, F.lit(_PART), F.lit(0)), _read), sized))


def sound(text: Column) -> Column:
    """Whether a text is one JSON object or list and nothing else.

    A parser stops behind the first value, so the text is put into a list and into an object: what comes after the value
    may suit one of them, not both.
    """
    inside = (F.concat(F.lit("["), text, F.lit("]")), F.concat(F.lit('{"":'), text, F.lit("}")))
    return shaped(text) & F.try_parse_json(inside[0]).isNotNull() & F.try_parse_json(inside[1]).isNotNull()


def plain_parts(text: Column) -> Column:
    """The parts of sound JSON as ``walked`` gives them, without a fold; objects are not told from each other.

    Null where a string stands in a list beside objects or lists, or where a value is judged by its siblings.
    """

    def place(part: Column, value: Column, key: Column) -> Column:
        owner, box = F.lit(""), F.lit(-1)
        return F.struct(part.alias("part"), value.alias("value"), key.alias("key"), owner.alias("owner"), box.alias("box"))

    def read(cut: Column) -> Column:
        def one(part: Column, at: Column) -> Column:
            none, name, last = F.lit(None).cast("string"), F.get(cut["names"], at), F.get(cut["lasts"], at)

            def items(key: Column) -> Column:
                split = F.regexp_extract_all(last, F.lit(_ITEM), F.lit(0))
                head = F.array(place(F.substring(part, F.lit(1), F.length(part) - F.length(last)), none, none))
                return F.concat(head, F.transform(split, lambda item: item_of(item, F.instr(item, F.lit('"')), key)))

            def item_of(item: Column, quote: Column, key: Column) -> Column:
                value = F.when(quote > 0, F.substring(item, quote, F.length(item)))
                return place(item, value, F.when(quote > 0, key))

            listed = last.startswith("[")
            named = F.when(listed, let(F.lower(content(name)), items)).otherwise(F.array(place(part, last, F.lower(content(name)))))
            # One null makes all of them null.
            return F.when(last == "", F.array(place(part, none, none))).when(listed | (name != ""), named)

        return F.flatten(F.transform(cut["parts"], one))

    cut = (F.regexp_extract_all(text, F.lit(_KEYED), F.lit(group)).alias(name) for group, name in enumerate(("parts", "names", "lasts")))
    return F.when(~text.rlike(_BESIDE), let(F.struct(*cut), read))


def parts_of(text: Column, is_sound: Column) -> Column:
    """The parts of any text; ``is_sound`` tells whether it is ``sound``."""
    return F.coalesce(F.when(is_sound, plain_parts(text)), walked(text))


def values(text: Column, parts: Column | None = None) -> Column:
    """``array<struct<key, value>>`` of a text's string values; a text of another shape is one value without a key.

    ``parts`` may be given where the text has been walked already.
    """

    def read(parts: Column) -> Column:
        strings = F.filter(parts, lambda p: p["key"].isNotNull())
        return F.transform(strings, lambda p: F.struct(p["key"].alias("key"), content(p["value"]).alias("value")))

    whole = F.array(F.struct(F.lit("").alias("key"), text.alias("value")))
    found = let(parts_of(text, sound(text)), read) if parts is None else read(parts)
    return F.when(text.isNotNull(), F.when(shaped(text), found).otherwise(whole))


def strings(text: Column, is_sound: Column) -> Column:
    """``values`` whose keys are not asked for: all are empty."""

    def keyless(value: Column) -> Column:
        return F.struct(F.lit("").alias("key"), value.alias("value"))

    # Of sound JSON, all strings but those before a colon.
    every = F.regexp_extract_all(text, F.lit(rf"(?s){_STRING}\s*+:|({_STRING})"), F.lit(1))
    plain = F.transform(F.filter(every, lambda s: s != ""), lambda s: keyless(content(s)))
    other = F.transform(values(text, F.when(shaped(text), walked(text))), lambda v: keyless(v["value"]))
    return F.when(is_sound, plain).otherwise(other)


def rebuilt(text: Column, swap: Swap, parts: Column | None = None) -> Column:
    """``text`` with every string value replaced by ``swap(key, owner, value, sibling)``.

    ``sibling(name)`` is the text under another key of the same object, wherever it stands there.
    """

    def joined(parts: Column) -> Column:
        def one(part: Column) -> Column:
            def sibling(name: str) -> Column:
                same = F.filter(parts, lambda q: (q["box"] == part["box"]) & (q["key"] == name))
                return content(F.get(same, F.lit(0))["value"])

            def swapped(value: Column) -> Column:
                made = swap(part["key"], part["owner"], value, sibling)
                before = F.substring(part["part"], F.lit(1), F.length(part["part"]) - F.length(part["value"]))
                return let(made, lambda m: F.when(m.eqNullSafe(value), part["part"]).otherwise(F.concat(before, said(m))))

            return F.when(part["key"].isNull(), part["part"]).otherwise(let(content(part["value"]), swapped))

        return F.array_join(F.transform(parts, one), "")

    return let(parts_of(text, sound(text)), joined) if parts is None else joined(parts)
