"""Licence scan: matching statistics against a generalised suffix automaton of licence tokens.

The token sequences of all templates make one suffix automaton.  A text is
streamed through it word by word; the state reached and the length matched say
which template passages end at that word, the longest one for each place in each
template.  Matches on one diagonal of a template join up, and long ones are
chained in order, with bounded gaps, into spans that cover a share of the
template.  A span that covers enough gives the template's label, if it contains the
telling words of a licence whose notice shares the others with another licence's.
Templates are opening lines and whole notices, or the caller's table of them
(``templates_of``).  Base phrases are templates as well: a phrase stands where the
statistics contain it whole.

Words outside the automaton's word pairs cannot be part of a match of two words,
so the stream starts anew there; whole texts are read, in any length.  The
automaton is broadcast: its size is that of the template list, not of the corpus.

Defined cases: NULL is an empty text; a text without a match has score 0, empty
labels and no spans; the result is one column, so no input column clashes.  A text
with two copies of a notice has a span for each; what is left of a chain whose head
belongs to a better one is a span of its own share.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.spans import Run, column_bytes, slices, span_hashes

# ---- fixed values: phrases of the contract, opening words of public licence notices, and whole notices
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license"
               " at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
            " general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
            " that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu"
             " lesser general public license as published by the free software foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
             " affero general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
            " hereby granted"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"
            " to this work"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public"
            " license"),
)
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files the software to deal in the software without restriction including"
            " without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"
            " of the software and to permit persons to whom the software is furnished to do so subject to the"
            " following conditions the above copyright notice and this permission notice shall be included in all"
            " copies or substantial portions of the software the software is provided as is without warranty of any"
            " kind express or implied including but not limited to the warranties of merchantability fitness for a"
            " particular purpose and noninfringement in no event shall the authors or copyright holders be liable for"
            " any claim damages or other liability whether in an action of contract tort or otherwise arising from"
            " out of or in connection with the software or the use or other dealings in the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in"
               " compliance with the license you may obtain a copy of the license at http www apache org licenses"
               " license 2 0 unless required by applicable law or agreed to in writing software distributed under the"
               " license is distributed on an as is basis without warranties or conditions of any kind either express"
               " or implied see the license for the specific language governing permissions and limitations under the"
               " license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
            " general public license as published by the free software foundation either version 3 of the license or"
            " at your option any later version this program is distributed in the hope that it will be useful but"
            " without any warranty without even the implied warranty of merchantability or fitness for a particular"
            " purpose see the gnu general public license for more details you should have received a copy of the gnu"
            " general public license along with this program if not see http www gnu org licenses"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu"
             " lesser general public license as published by the free software foundation either version 2 1 of the"
             " license or at your option any later version this library is distributed in the hope that it will be"
             " useful but without any warranty without even the implied warranty of merchantability or fitness for a"
             " particular purpose see the gnu lesser general public license for more details you should have received"
             " a copy of the gnu lesser general public license along with this library"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
             " affero general public license as published by the free software foundation either version 3 of the"
             " license or at your option any later version this program is distributed in the hope that it will be"
             " useful but without any warranty without even the implied warranty of merchantability or fitness for a"
             " particular purpose see the gnu affero general public license for more details you should have received"
             " a copy of the gnu affero general public license along with this program if not see http www gnu org"
             " licenses"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
            " that the following conditions are met redistributions of source code must retain the above copyright"
            " notice this list of conditions and the following disclaimer redistributions in binary form must"
            " reproduce the above copyright notice this list of conditions and the following disclaimer in the"
            " documentation and or other materials provided with the distribution this software is provided by the"
            " copyright holders and contributors as is and any express or implied warranties including but not"
            " limited to the implied warranties of merchantability and fitness for a particular purpose are"
            " disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect"
            " incidental special exemplary or consequential damages including but not limited to procurement of"
            " substitute goods or services loss of use data or profits or business interruption however caused and on"
            " any theory of liability whether in contract strict liability or tort including negligence or otherwise"
            " arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
            " hereby granted provided that the above copyright notice and this permission notice appear in all copies"
            " the software is provided as is and the author disclaims all warranties with regard to this software"
            " including all implied warranties of merchantability and fitness in no event shall the author be liable"
            " for any special direct indirect or consequential damages or any damages whatsoever resulting from loss"
            " of use data or profits whether in an action of contract negligence or other tortious action arising out"
            " of or in connection with the use or performance of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl"
            " was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors"
             " be held liable for any damages arising from the use of this software permission is granted to anyone"
             " to use this software for any purpose including commercial applications and to alter it and"
             " redistribute it freely subject to the following restrictions the origin of this software must not be"
             " misrepresented you must not claim that you wrote the original software if you use this software in a"
             " product an acknowledgment in the product documentation would be appreciated but is not required"
             " altered source versions must be plainly marked as such and must not be misrepresented as being the"
             " original software this notice may not be removed or altered from any source distribution"),
    ("public-domain", "this is free and unencumbered software released into the public domain anyone is free to copy"
             " modify publish use compile sell or distribute this software either in source code form or as a compiled"
             " binary for any purpose commercial or non commercial and by any means"),
)
#: words that a chain has to contain in one match, where licences share nearly all others
TELLING = (
    ("gpl", "gnu general public"),
    ("lgpl", "lesser general public"),
    ("agpl", "affero general public"),
    ("cc-by", "attribution 4 0"),
    ("cc-by-sa", "attribution sharealike"),
    ("cc-by-nc", "attribution noncommercial"),
)
# ---- end of fixed values

APART = np.ones(256, bool)
APART[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B))] = False
APART[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_UPPER = "".join(map(chr, range(0x41, 0x5B)))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class ScanLimits:
    match: int = 3  # words of a match that counts for a span
    gap: int = 30  # words between chained matches, in the text
    cover: float = 0.75  # share of a template that gives its label


@dataclass
class SuffixAutomaton:
    """Of several token sequences; ``ends`` lists every (sequence, end) of a state's strings."""

    moves: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.moves.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, before: int, token: int, old: int) -> int:
        """A state of its own for the strings of ``old`` that ``before`` and ``token`` make."""
        clone = self._state(self.length[before] + 1, self.link[old], dict(self.moves[old]))
        self.link[old] = clone
        while before >= 0 and self.moves[before].get(token) == old:
            self.moves[before][token] = clone
            before = self.link[before]
        return clone

    def _extend(self, last: int, token: int) -> int:
        known = self.moves[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, token, known)
        state = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and token not in self.moves[last]:
            self.moves[last][token] = state
            last = self.link[last]
        if last >= 0:
            known = self.moves[last][token]
            near = self.length[known] == self.length[last] + 1
            self.link[state] = known if near else self._split(last, token, known)
        return state

    @staticmethod
    def of(sequences: Sequence[Sequence[int]]) -> SuffixAutomaton:
        made = SuffixAutomaton()
        for number, sequence in enumerate(sequences):
            last = 0
            for end, token in enumerate(sequence, 1):
                last = made._extend(last, token)
                made.ends[last].append((number, end))
        for state in sorted(range(1, len(made.link)), key=lambda s: -made.length[s]):
            if made.link[state] > 0:
                made.ends[made.link[state]].extend(made.ends[state])
        return made

    def step(self, state: int, matched: int, token: int) -> tuple[int, int]:
        """The longest suffix of what was matched and ``token`` that some sequence contains."""
        while state and token not in self.moves[state]:
            state = self.link[state]
            matched = self.length[state]
        following = self.moves[state].get(token)
        return (0, 0) if following is None else (following, matched + 1)

    def passages(self, state: int, matched: int, least: int):
        """(sequence, end, length) of every passage that ends here, the longest for each end."""
        seen = set()
        while state > 0 and matched >= least:
            for place in self.ends[state]:
                if place not in seen:
                    seen.add(place)
                    yield *place, matched
            state = self.link[state]
            matched = self.length[state]


def templates_of(table: DataFrame, most_words: int = 200_000) -> tuple[tuple[str, str], ...]:
    """Templates of the rows (label, text) of a caller's table, with words as in texts, sorted, each once.

    The list goes to every task, so more than ``most_words`` words in all are an
    error.  Rows without a label or a word are none.
    """
    words = F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit(f"({WORD})"))
    rows = table.select("label", words.alias("words")).where("label is not null and size(words) > 0").distinct()
    sized = rows.select("label", "words", F.size("words").alias("n"))
    total = sized.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total > most_words:
        raise ValueError(f"the templates have {total} words, more than {most_words}")
    return tuple(sorted((row["label"], " ".join(row["words"])) for row in sized.collect()))


class Scanner:
    def __init__(
        self, phrases=PHRASES, templates=TEMPLATES + NOTICES, limits: ScanLimits = ScanLimits(), telling=TELLING
    ):
        self.limits, self.phrases, self.templates = limits, phrases, templates
        texts = [text for _, text in (*phrases, *templates)]
        words = sorted({word for text in texts for word in text.split()})
        run = Run(*column_bytes(pa.array(words)))
        hashes = span_hashes(run.prefix(), run.starts, run.ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {words[k]: n for n, k in enumerate(order.tolist())}
        sequences = [[number[word] for word in text.split()] for text in texts]
        self.sizes = [len(sequence) for sequence in sequences]
        self.automaton = SuffixAutomaton.of(sequences)
        # pairs of neighbouring words as one number; len(words) stands for all words of no template
        pairs = {a * (len(words) + 1) + b for sequence in sequences for a, b in zip(sequence, sequence[1:])}
        self.pairs = np.array(sorted(pairs) or [-1], np.int64)
        needed = dict(telling)
        self.telling = [
            _places(text.split(), needed.get(label, "").split()) if n >= len(phrases) else []
            for n, (label, text) in enumerate((*phrases, *templates))
        ]

    def scan(self, texts: pa.Array) -> list[dict]:
        data, starts, ends = column_bytes(texts)
        out: list[dict] = []
        for i, j in slices(starts, ends, 2 << 20):
            run = Run(data, starts[i:j], ends[i:j])
            run.text = _LOWER[run.text]
            first, last, counts = run.words(APART)
            out.extend(self._scan(span_hashes(run.prefix(), first, last), counts))
        return out

    def _scan(self, words: np.ndarray, counts: np.ndarray) -> list[dict]:
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        tokens = np.where(self.hashes[at] == words, at, len(self.hashes))
        linked = np.zeros(len(tokens) + 1, bool)  # a word and the one before it are a pair of some template
        pairs = tokens[:-1] * (len(self.hashes) + 1) + tokens[1:]
        linked[1:-1] = self.pairs[np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)] == pairs
        stop = np.cumsum(counts)
        head = stop - counts
        linked[head] = False  # words of two texts are no pair
        edges = np.diff(linked.astype(np.int8))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)  # linked from begin + 1 to end
        owner = np.searchsorted(stop, begins, side="right")
        out = [
            {"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base": set(), "spans": []}
            for n in counts
        ]
        for text in np.unique(owner):
            low, high = np.searchsorted(owner, [text, text + 1])
            pieces = [
                (int(b - head[text]), tokens[b : e + 1].tolist()) for b, e in zip(begins[low:high], ends[low:high])
            ]
            self._stream(out[text], pieces)
        return out

    def _stream(self, found: dict, pieces: list[tuple[int, list[int]]]) -> None:
        step, passages = self.automaton.step, self.automaton.passages
        matches: dict[int, list[list[int]]] = {}
        for begin, tokens in pieces:
            running: dict[tuple[int, int], list[int]] = {}
            state = matched = 0
            for position, token in enumerate(tokens, begin):
                state, matched = step(state, matched, token)
                if matched < 2:
                    continue
                for template, end, length in passages(state, matched, 2):
                    if template < len(self.phrases):
                        if end == length == self.sizes[template]:
                            self._phrase(found, template, position - length + 1)
                    elif length >= self.limits.match:
                        start, diagonal = position - length + 1, (template, end - position)
                        match = running.get(diagonal)
                        if match is None or match[0] != start or match[1] != position:
                            match = running[diagonal] = [start, position, end - length, end]
                            matches.setdefault(template, []).append(match)
                        match[1], match[3] = position + 1, end
        for template, parts in matches.items():
            found["spans"].extend(self._chains(template, parts))

    def _phrase(self, found: dict, phrase: int, start: int) -> None:
        found["n_base"] += 1
        found["first_word"] = start if found["first_word"] is None else min(found["first_word"], start)
        found["last_word"] = start if found["last_word"] is None else max(found["last_word"], start)
        found["base"].add(self.phrases[phrase][0])

    def _tells(self, template: int, parts: list[list[int]]) -> bool:
        places = self.telling[template]
        return not places or any(low <= a and b <= high for a, b in places for _, _, low, high in parts)

    def _chains(self, template: int, parts: list[list[int]]) -> list[tuple[int, int, int, float, bool]]:
        """(template, first word, last word, share covered, whether it is telling) of chains, the best first.

        No match is in two chains.
        """
        parts = _longest(parts)
        size = self.sizes[template]
        best = [part[1] - part[0] for part in parts]
        before = [-1] * len(parts)
        stops = [part[0] for part in parts]
        for j, (begin, end, low, high) in enumerate(parts):
            reach = bisect_left(stops, begin - self.limits.gap - size)
            for i in range(reach, j):
                _, other_end, _, other_high = parts[i]
                shared = max(0, other_end - begin, other_high - low)
                gain = end - begin - shared
                if gain > 0 and begin - other_end <= self.limits.gap and best[i] + gain > best[j]:
                    best[j], before[j] = best[i] + gain, i
        chains, taken = [], set()
        for j in sorted(range(len(parts)), key=lambda j: (-best[j], j)):
            chain = []
            while j >= 0 and j not in taken:
                chain.append(j)
                j = before[j]
            if not chain:
                continue
            taken.update(chain)
            first, last = parts[chain[-1]], parts[chain[0]]
            begin, words = first[0], best[chain[0]]
            if j >= 0:  # the rest of a chain whose head has a span already: a span of its own after it
                begin = max(begin, parts[j][1])
                words += max(0, first[1] - begin) - best[chain[-1]]
            if last[1] > begin:
                telling = self._tells(template, [parts[k] for k in chain])
                chains.append((template, begin, last[1] - 1, min(1.0, words / size), telling))
        return chains


def _places(words: list[str], phrase: list[str]) -> list[tuple[int, int]]:
    """Where the phrase stands in the words, as (begin, end)."""
    n = len(phrase)
    return [(k, k + n) for k in range(len(words) - n + 1) if n and words[k : k + n] == phrase]


def _longest(parts: list[list[int]]) -> list[list[int]]:
    """Of matches on one diagonal that start together the longest stays; ordered by their start."""
    kept: dict[tuple[int, int], list[int]] = {}
    for part in parts:
        key = (part[0], part[2])
        if key not in kept or kept[key][1] < part[1]:
            kept[key] = part
    return sorted(kept.values())


RESULT = (
    "struct<n_words: long, n_base: long, first_word: long, last_word: long, base_labels: string, labels: string,"
    " score: double, spans: array<struct<label: string, first_word: long, last_word: long, cover: double>>>"
)


def scanned(spark: SparkSession, scanner: Scanner | None = None, text: str = "text") -> Column:
    """A struct column: RESULT."""
    scanner = scanner or Scanner()
    shared = spark.sparkContext.broadcast(scanner)  # as large as the template list

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        return rows_of(shared.value, texts)

    return found.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))


def rows_of(scanner: Scanner, texts: pa.Array) -> pa.Array:
    names = [label for label, _ in (*scanner.phrases, *scanner.templates)]
    rows = []
    for one in scanner.scan(texts):
        spans = [
            {"label": names[template], "first_word": first, "last_word": last, "cover": cover}
            for template, first, last, cover, telling in one["spans"]
            if telling and cover >= scanner.limits.cover
        ]
        score = max([1.0] * bool(one["base"]) + [cover for *_, cover, _ in one["spans"]], default=0.0)
        rows.append(
            {
                **{name: one[name] for name in ("n_words", "n_base", "first_word", "last_word")},
                "base_labels": ",".join(sorted(one["base"])),
                "labels": ",".join(sorted(one["base"] | {span["label"] for span in spans})),
                "score": score,
                "spans": sorted(spans, key=lambda span: (span["first_word"], span["label"], span["last_word"])),
            }
        )
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())])
    return pa.array(
        rows,
        pa.struct(
            [(name, pa.int64()) for name in ("n_words", "n_base", "first_word", "last_word")]
            + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))]
        ),
    )
