r"""License notices in texts: fixed phrases, and templates with optional and variable parts.

A template is license wording with markup: ``<<beginOptional>> .. <<endOptional>>`` may be
left out, ``<<var;name="..";match="..">>`` stands for other words, where ``match`` is
``.+``, ``.*``, ``.{least,most}`` or ``\d{least,most}`` and counts words, the last one
numbers only. It is compiled into an automaton over
words. A text is accepted if all other wording stands in it exactly and in order.

A template is only run where its first mandatory words stand, and only in texts that hold
its longest mandatory wording. Both follow from acceptance, so nothing is missed.

``mit``, ``isc`` and the two ``bsd`` templates are whole licenses, disclaimer included: a text that
leaves out or changes any of their wording isn't accepted. All others are notices, which name a
license and don't contain it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches, utf8

#: The base phrases, and the wording of common notices and licenses.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
TEMPLATES = {
    "mit-notice": """<<var;name="grant";match=".{1,1}">> under <<beginOptional>>the terms of<<endOptional>>
        the <<beginOptional>>expat<<endOptional>> MIT License""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the
        License.<<endOptional>>""",
    "gpl-notice": """licensed under <<beginOptional>>the terms of<<endOptional>> the GNU General Public
        License <<beginOptional>>as published by the Free Software Foundation; either<<endOptional>>
        version <<var;name="version";match=".{1,1}">>
        <<beginOptional>>of the License, or (at your option) any later version<<endOptional>>""",
    "gpl-free-software": """is free software <<beginOptional>>;<<endOptional>> you can redistribute it and/or
        modify it under the terms of the GNU <<beginOptional>>Lesser<<endOptional>>
        <<beginOptional>>Affero<<endOptional>> General Public License as published by the Free Software
        Foundation""",
    "cc-by": r"""licensed under <<beginOptional>>a<<endOptional>> CC BY <<var;name="version";match="\d{2,2}">>""",
    "cc-by-nc": r"""licensed under <<beginOptional>>a<<endOptional>> CC BY-NC
        <<beginOptional>>SA<<endOptional>> <<beginOptional>>ND<<endOptional>>
        <<var;name="version";match="\d{2,2}">>""",
    "cc-by-sa": r"""licensed under <<beginOptional>>a<<endOptional>> CC BY-SA
        <<var;name="version";match="\d{2,2}">>""",
    "creative-commons": r"""licensed under a Creative Commons <<var;name="kind";match=".{1,6}">>
        <<var;name="version";match="\d{2,2}">> <<beginOptional>>International<<endOptional>> License""",
    "spdx-tag": 'SPDX-License-Identifier: <<var;name="identifier";match=".{1,6}">>',
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="software";match=".{1,8}">> <<beginOptional>>(the "Software")<<endOptional>>, to deal in
        the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        <<var;name="holder";match=".{1,12}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
        IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and <<beginOptional>>/or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        <<var;name="holder";match=".{1,12}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        <<var;name="holder";match=".{1,12}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>>
        Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS
        PROVIDED BY <<var;name="holder";match=".{1,12}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";match=".{1,12}">> BE
        LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
        THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
#: The third clause of the longer license, between the second one and the disclaimer.
_THIRD_CLAUSE = """provided with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;name="organisation";match=".{1,12}">> nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written permission."""
TEMPLATES["bsd-3-clause"] = TEMPLATES["bsd-2-clause"].replace(
    "provided with the distribution.", _THIRD_CLAUSE
)

_SEPARATORS = bytes(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123))
_WORDS = bytes.maketrans(
    bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b" " * len(_SEPARATORS)
)
_MARKUP = re.compile(r"<<(.*?)>>", re.DOTALL)
_SPAN = re.compile(r"(\.|\\d)\{(\d+),(\d+)\}")
#: Stands for "as many as there are".
_ANY = -1
#: Stands for any number among the words an automaton waits for; no word has such a sign.
_NUMBER = b"<number>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII bytes."""
    return text.translate(_WORDS).split()


@dataclass
class Automaton:
    """Words lead from state to state; ``skip`` leads on without one.

    ``step[s]`` is the word state s waits for, None for any word, _NUMBER for any number, or
    b"" for none.
    """

    name: str
    step: list[bytes | None] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    head: list[bytes] = field(default_factory=list)
    anchor: bytes = b""

    def add(self, word: bytes | None = b"") -> int:
        self.step.append(word)
        self.skip.append([])
        return len(self.step) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for state in self.skip[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return seen

    def longest(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest accepted run of words from ``start`` on."""
        final = len(self.step) - 1
        states, end = self.closure({0}), None
        for at in range(start, len(words) + 1):
            if final in states:
                end = at
            if at == len(words):
                break
            taken = (None, words[at], _NUMBER) if words[at].isdigit() else (None, words[at])
            states = self.closure({s + 1 for s in states if self.step[s] in taken})
            if not states:
                break
        return end


def compile_template(name: str, template: str) -> Automaton:
    """The automaton of a template. Its last state accepts."""
    machine, opened = Automaton(name), []
    runs: list[list[bytes]] = [[]]
    for i, part in enumerate(_MARKUP.split(template)):
        if i % 2 == 0:
            for word in words_of(part.encode()):
                machine.add(word)
                if not opened:
                    runs[-1].append(word)
            continue
        if not opened:
            runs.append([])
        if part == "beginOptional":
            opened.append(machine.add())
            machine.skip[opened[-1]].append(opened[-1] + 1)
        elif part == "endOptional":
            machine.skip[opened.pop()].append(len(machine.step))
        elif part.startswith("var"):
            match = re.search(r'match="(.*?)"', part)[1]
            bounds = _SPAN.fullmatch(match)
            if not bounds and match not in (".+", ".*"):
                raise ValueError(f"unknown match {match} in {name}")
            least, most = (int(bounds[2]), int(bounds[3])) if bounds else (int(match == ".+"), _ANY)
            _variable(machine, _NUMBER if bounds and bounds[1] != "." else None, least, most)
        else:
            raise ValueError(f"unknown markup <<{part}>> in {name}")
    if opened:
        raise ValueError(f"an optional region of {name} has no end")
    machine.add()
    runs = [run for run in runs if run]
    if not runs:
        raise ValueError(f"{name} has no mandatory wording")
    machine.anchor = b" " + max((b" ".join(run) for run in runs), key=len) + b" "
    machine.head = runs[0]
    return machine


def _variable(machine: Automaton, word: bytes | None, least: int, most: int) -> None:
    for _ in range(least):
        machine.add(word)
    if most == _ANY:
        fork = machine.add()
        again = machine.add(word)
        back = machine.add()
        machine.skip[fork] += [again, back + 1]
        machine.skip[back].append(fork)
        return
    forks = []
    for _ in range(most - least):
        forks.append(machine.add())
        machine.skip[forks[-1]].append(forks[-1] + 1)
        machine.add(word)
    for fork in forks:
        machine.skip[fork].append(len(machine.step))


def _places(joined: bytes, phrase: bytes) -> list[int]:
    """The word positions where a phrase stands; ``joined`` has a blank on either side of a word."""
    needle, found, words, last = b" " + phrase + b" ", [], 0, 0
    at = joined.find(needle)
    while at >= 0:
        words += joined.count(b" ", last, at)
        found.append(words)
        last = at
        at = joined.find(needle, at + 1)
    return found


class Scanner:
    """Finds phrases and templates in texts; small enough to be sent to every task."""

    def __init__(self, phrases=PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [(phrase.encode(), label) for phrase, label in phrases]
        self.machines = [compile_template(name, text) for name, text in templates.items()]

    def base(self, joined: bytes) -> list[tuple[int, str]]:
        return sorted(
            (at, label) for phrase, label in self.phrases for at in _places(joined, phrase)
        )

    def templates(self, joined: bytes, words: list[bytes]) -> list[tuple[int, int, str]]:
        """(start, end, name) in words of each accepted place, longest per start."""
        found = []
        for machine in self.machines:
            if machine.anchor not in joined:
                continue
            lead = self._lead(machine)
            for head in _places(joined, b" ".join(machine.head)):
                for start in range(max(0, head - lead), head + 1):
                    end = machine.longest(words, start)
                    if end is not None:
                        found.append((start, end, machine.name))
                        break
        return sorted(set(found))

    @staticmethod
    def _lead(machine: Automaton) -> int:
        """The most words that may stand before the first mandatory ones."""
        return machine.step.index(machine.head[0]) if machine.head else 0


_MATCHES = "array<struct<start:int,end:int,template:string>>"
_MATCH_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("template", pa.string())])
)


def scan_licenses(
    documents: DataFrame, scanner: Scanner | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``documents``.

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    ``matches`` (start, end, template in words). Labels are distinct, sorted and joined by a
    comma. The score is 1 if a template is accepted, 0.5 if only a phrase stands there, else
    0. Null and empty texts have no words; repeated rows get equal results.
    """
    scanner = scanner or Scanner()

    def scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in utf8(batch, "text"):
            words = words_of(text)
            joined = b" " + b" ".join(words) + b" "
            base = scanner.base(joined)
            matches = scanner.templates(joined, words)
            labels = {label for _, label in base}
            rows.append(
                {
                    "n_words": len(words),
                    "n_base": len(base),
                    "first_word": base[0][0] if base else None,
                    "last_word": base[-1][0] if base else None,
                    "base_labels": ",".join(sorted(labels)),
                    "labels": ",".join(sorted(labels | {name for _, _, name in matches})),
                    "score": 1.0 if matches else 0.5 if base else 0.0,
                    "matches": [
                        {"start": start, "end": end, "template": name} for start, end, name in matches
                    ],
                }
            )
        types = {
            "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(),
            "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(),
            "score": pa.float64(), "matches": _MATCH_TYPE,
        }
        columns = [pa.array([row[name] for row in rows], kind) for name, kind in types.items()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *types])

    narrow = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return map_batches(
        narrow,
        scanned,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long,"
        f" base_labels string, labels string, score double, matches {_MATCHES}",
    )
