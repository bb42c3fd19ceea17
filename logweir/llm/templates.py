"""License scans by template markup: mandatory, optional and replaceable wording, compiled into token automata.

In a template `{...}` is optional wording and `<name:a-b>` stands for a to b words of any kind; all other words are
mandatory and must stand exactly so.  A template becomes an automaton over words; a place of a text is accepted if
the automaton reaches its end from there, and the longest way counts.  Words are the same as in decontamination.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import in_small_batches

# The phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label -> templates of notices, as they stand in a file that is under a licence.
TEMPLATES = {
    "apache-2.0": (
        "licensed under {the} apache license {version} 2 0",
        "you may not use this file except in compliance with the license",
    ),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "cc-by": ("{this work is} licensed under {a} {the} creative commons attribution <version:0-4> license", "licensed under cc by <version:1-2>"),
    "cc-by-nc": (
        "licensed under {the} cc by nc {nd} {sa} {<version:1-2>}",
        "licensed under {a} {the} creative commons attribution noncommercial <version:0-4> license",
    ),
    "copyright": ("copyright {c} <year:1-1> {by} <holder:1-6> all rights reserved", "copyright {c} <year:1-1> <holder:0-6> licensed under"),
    "gpl-3.0": (
        "licensed under the {terms of the} gnu general public license {version} 3",
        "gnu general public license as published by the free software foundation either version 3",
    ),
    "isc": ("permission to use copy modify and {or} distribute this software for any purpose with or without fee is hereby granted",),
    "mit": (
        "{released} {licensed} under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of <work:1-4> and associated documentation files",
    ),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0",),
    "proprietary": ("no part of this <work:1-3> may be reproduced {stored} <means:0-8> without {the} {prior} {written} permission",),
    "reserved": ("all rights {are} reserved",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}

# Whole licence texts, word by word, with what their users may leave out or put in.
WHOLE = {
    "bsd-2-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "{1} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "{2} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution "
        "this software is provided by <holder:1-8> as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <holder:1-8> be liable "
        "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
        "or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract "
        "strict liability or tort including negligence or otherwise arising in any way out of the use of this software "
        "even if advised of the possibility of such damage",
    ),
    "bsd-3-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "{1} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "{2} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution "
        "{3} neither the name of <holder:1-8> nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission "
        "this software is provided by <holder:1-8> as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <holder:1-8> be liable "
        "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
        "or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract "
        "strict liability or tort including negligence or otherwise arising in any way out of the use of this software "
        "even if advised of the possibility of such damage",
    ),
    "isc-text": (
        "permission to use copy modify and {or} distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and <author:1-8> disclaims all warranties with regard to this software including all implied warranties "
        "of merchantability and fitness in no event shall <author:1-8> be liable for any special direct indirect or consequential damages "
        "or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software",
    ),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice {including the next paragraph} shall be included in all copies "
        "or substantial portions of the software the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall <holder:1-8> be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event will <holder:1-8> be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications "
        "and to alter it and redistribute it freely subject to the following restrictions "
        "{1} the origin of this software must not be misrepresented you must not claim that you wrote the original software "
        "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
        "{2} altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
        "{3} this notice may not be removed or altered from any source distribution",
    ),
}

_WORD_BYTE = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))
_PART = re.compile(r"\{|\}|<(\w+):(\d+)-(\d+)>|([^\s{}<>]+)")
ANY = None


@dataclass
class Automaton:
    """States of one template: ways[state] is a list of (word or ANY, next state); skips lead on without a word."""

    label: str
    base: bool
    ways: list[list[tuple[bytes | None, int]]]
    skips: list[list[int]]
    #: A mandatory word without which no place can match.
    needed: bytes = b""

    def close(self, states: Iterable[int]) -> set[int]:
        seen, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in seen:
                seen.add(state)
                todo += self.skips[state]
        return seen

    @property
    def first(self) -> set[bytes]:
        return {word for state in self.close([0]) for word, _ in self.ways[state]}

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted stretch from ``at``, or -1."""
        last, end, states = -1, len(self.ways) - 1, self.close([0])
        while states:
            if end in states:
                last = at
            if at == len(words):
                break
            states = self.close({to for s in states for word, to in self.ways[s] if word is ANY or word == words[at]})
            at += 1
        return last


def compiled(label: str, template: str, base: bool = False) -> Automaton:
    """The automaton of a template's markup; ValueError if it is not balanced or can begin with any word."""
    out = Automaton(label, base, [[]], [[]])
    opened: list[int] = []

    def step(word: bytes | None) -> None:
        out.ways[-1].append((word, len(out.ways)))
        out.ways.append([])
        out.skips.append([])

    def fork() -> int:
        # A state of its own, so that ways around a region never meet another region's.
        out.skips[-1].append(len(out.ways))
        out.ways.append([])
        out.skips.append([])
        return len(out.ways) - 1

    for part in _PART.finditer(template):
        if part[0] == "{":
            opened.append(fork())
        elif part[0] == "}":
            if not opened:
                raise ValueError(f"no region to close in {template!r}")
            start = opened.pop()
            out.skips[start].append(fork())
        elif part[1]:
            for n in range(int(part[3])):
                if n >= int(part[2]):
                    opened.append(fork())
                step(ANY)
            for _ in range(int(part[3]) - int(part[2])):
                start = opened.pop()
                out.skips[start].append(fork())
        else:
            step(part[4].encode())
            if not opened and len(part[4].encode()) > len(out.needed):
                out.needed = part[4].encode()
    if opened or not out.needed or ANY in out.first:
        raise ValueError(f"a template needs closed regions, a mandatory word and a first word: {template!r}")
    return out


class Scanner:
    """All templates together."""

    def __init__(self, templates: dict[str, tuple[str, ...]], base: dict[str, str]):
        self.automata = [compiled(label, phrase, True) for phrase, label in base.items()]
        self.automata += [compiled(label, t) for label, many in templates.items() for t in many]
        self.by_need: dict[bytes, list[Automaton]] = {}
        for automaton in self.automata:
            self.by_need.setdefault(b" " + automaton.needed + b" ", []).append(automaton)

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[str, int, int, bool]]]:
        """(number of words, places as (label, first word, end, base))."""
        line = b" " + (text or b"").lower().translate(_WORD_BYTE) + b" "
        filled = np.frombuffer(line, np.uint8) != 32
        count = int(np.count_nonzero(filled[1:] & ~filled[:-1]))
        able = [a for need, many in self.by_need.items() if need in line for a in many]
        if not able:
            return count, []
        words, starts = line.split(), {}
        for automaton in able:
            for word in automaton.first:
                starts.setdefault(word, []).append(automaton)
        found = []
        for at, word in enumerate(words):
            for automaton in starts.get(word, ()):
                end = automaton.match(words, at)
                if end >= 0:
                    found.append((automaton.label, at, end, automaton.base))
        return count, found


def scan(
    documents: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, base: dict[str, str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_words, matches) of every row; matches is an array of (label, start, end, base) over word places.

    ``templates`` gives the markup of each label (notices and whole licences if none), ``base`` plain phrases and their labels; both are few by nature.
    Null texts have no words.  Places may overlap and all count.  Repeated rows are kept; other columns aren't read.
    """
    scanner = Scanner(TEMPLATES | WHOLE if templates is None else templates, BASE if base is None else base)
    kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places = [], []
            for value in batch.column(1).cast(pa.binary()):
                count, found = scanner.scan(value.as_py())
                counts.append(count)
                places.append([dict(zip(("label", "start", "end", "base"), x, strict=True)) for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(places, kind)], ["id", "n_words", "matches"])

    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    return chosen.mapInArrow(
        run, f"id {chosen.schema['id'].dataType.simpleString()}, n_words long, matches array<struct<label:string,start:long,end:long,base:boolean>>"
    )
