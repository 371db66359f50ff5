"""License notices in texts: an exact set-similarity join of the texts' lines with notice templates.

A line and a template are sets of words. A line matches if it holds at least ``threshold`` of the template's words. Words
are put in one order for all: rarest first, by the number of lines of the whole corpus that hold them. Words of no template
come last, as they take part in no overlap. With ``a`` words needed of a template:

* prefix filter: one of the template's first ``len - a + 1`` words must stand in the line;
* length filter: the line has at least ``a`` different words;
* positional filter: the words from the matching places on suffice on both sides for ``a``;
* what is left is counted exactly.

Notices are wrapped at any width, so a scan may also look across line ends: at each run of lines that have words, and in it at all
windows of twice as many words as the template has. The run as a whole goes through the same filters, and only the templates that it
meets are looked for in its windows.

The templates and the counts of their words are the only things that are broadcast; both are bounded by the templates.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import WORD_BYTES, ship, text_bytes, words_of

#: Phrases that are marked wherever they stand, by label.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

#: Notices and paragraphs of license headers, by label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This is free and unencumbered software released into the public domain",
    "apache-2.0-terms": """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "bsd-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "gpl-grant": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "mit-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
        copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions:""",
}

THRESHOLD = 0.8
KEEP_LINES = WORD_BYTES[:10] + b"\n" + WORD_BYTES[11:]

RESULT = (
    "doc_id {id}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, blocks array<struct<block int, label string, containment double>>"
)


def template_words(templates: dict[str, str]) -> dict[str, list[bytes]]:
    found = {label: sorted(set(words_of(text.encode()))) for label, text in templates.items()}
    return {label: words for label, words in found.items() if words}


def line_counter(vocabulary: frozenset[bytes]):
    """(id, text) to (word, lines): in how many lines each word of the templates stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(1):
                for line in text.as_py().translate(KEEP_LINES).split(b"\n"):
                    lines.update(vocabulary.intersection(line.split()))
        yield pa.RecordBatch.from_arrays([pa.array(list(lines), pa.binary()), pa.array(list(lines.values()), pa.int64())], ["word", "lines"])

    return run


class Index:
    """Templates by the words of their prefixes."""

    def __init__(self, templates: dict[str, list[bytes]], lines: dict[bytes, int], threshold: float, windows: dict[str, int] | None = None) -> None:
        vocabulary = {w for words in templates.values() for w in words}
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (lines.get(w, 0), w)))}
        self.vocabulary = frozenset(vocabulary)
        self.sets = {label: frozenset(words) for label, words in templates.items()}
        self.need = {label: max(1, ceil(threshold * len(words) - 1e-9)) for label, words in templates.items()}
        #: Words of a window by label: twice those of the notice, repeated ones included.
        self.windows = windows or {label: 2 * len(words) for label, words in templates.items()}
        self.postings: dict[bytes, list[tuple[str, int]]] = {}
        for label, words in templates.items():
            for i, w in enumerate(sorted(words, key=self.rank.__getitem__)[: len(words) - self.need[label] + 1]):
                self.postings.setdefault(w, []).append((label, i))
        self.first_words = frozenset(self.postings)
        self.least = min(self.need.values(), default=1)

    def matches(self, words: list[bytes]) -> list[tuple[str, float]]:
        """Templates that a line of these words meets, with their containment."""
        if len(words) < self.least or self.first_words.isdisjoint(words):
            return []
        line = set(words)
        known = sorted(line & self.vocabulary, key=self.rank.__getitem__)
        tried, found = set(), []
        for j, w in enumerate(known):
            for label, i in self.postings.get(w, ()):
                need, wanted = self.need[label], self.sets[label]
                if label in tried or len(line) < need:
                    continue
                # No earlier word of the template's prefix stood in the line, so this is the first overlap.
                if 1 + min(len(wanted) - i - 1, len(known) - j - 1) < need:
                    continue
                tried.add(label)
                both = len(wanted & line)
                if both >= need:
                    found.append((label, both / len(wanted)))
        return found

    def wrapped(self, run: list[bytes]) -> list[tuple[str, float, int]]:
        """Templates that a window of a run's words meets: the highest containment, and where its first window begins."""
        found = []
        for label, _ in self.matches(run):
            wanted, span = self.sets[label], self.windows[label]
            places = [i for i, w in enumerate(run) if w in wanted]
            held: Counter[bytes] = Counter()
            most, at, left = 0, 0, 0
            for i in places:
                held[run[i]] += 1
                while places[left] <= i - span:
                    w = run[places[left]]
                    held[w] -= 1
                    if not held[w]:
                        del held[w]
                    left += 1
                if len(held) > most:
                    most, at = len(held), places[left]
            if most >= self.need[label]:
                found.append((label, most / len(wanted), at))
        return found


def wrapped_blocks(lines: list[list[bytes]], index: Index, blocks: list[dict]) -> Iterator[dict]:
    """Notices that stand across line ends: those that hold more of a template than each line of their run does."""
    single = {(x["block"], x["label"]): x["containment"] for x in blocks}
    b = 0
    while b < len(lines):
        end = b
        while end < len(lines) and lines[end]:
            end += 1
        if end - b > 1:
            run = [w for line in lines[b:end] for w in line]
            for label, containment, at in index.wrapped(run):
                if containment > max(single.get((i, label), 0.0) for i in range(b, end)):
                    first = b
                    while at >= len(lines[first]):
                        at -= len(lines[first])
                        first += 1
                    yield {"block": first, "label": label, "containment": containment}
        b = end + 1


def phrase_starts(words: list[bytes], phrases: dict[str, bytes]) -> list[tuple[int, str]]:
    """Places (from 0) at which the words of a phrase stand one after another."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for label, phrase in phrases.items():
        at = joined.find(phrase)
        while at >= 0:
            out.append((joined.count(b" ", 0, at), label))
            at = joined.find(phrase, at + 1)
    return out


def scanner(index: Index, phrases: dict[str, bytes], wrapped: bool):
    """(id, text) to result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")][:9]
        block = pa.struct([("block", pa.int32()), ("label", pa.string()), ("containment", pa.float64())])
        types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(block)]
        for batch in batches:
            out = []
            for text in batch.column(1):
                words, lines, blocks = [], [], []
                for b, line in enumerate(text.as_py().translate(KEEP_LINES).split(b"\n")):
                    own = line.split()
                    words += own
                    lines.append(own)
                    blocks += [{"block": b, "label": label, "containment": c} for label, c in index.matches(own)]
                if wrapped:
                    blocks += wrapped_blocks(lines, index, blocks.copy())
                base = phrase_starts(words, phrases)
                labels = {label for _, label in base}
                starts = [at for at, _ in base]
                score = 1.0 if base else max((x["containment"] for x in blocks), default=0.0)
                out.append(
                    (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                     ",".join(sorted(labels | {x["label"] for x in blocks})), score, blocks)
                )
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    return run


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    wrapped: bool = False,
) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)`` for each row of ``docs``.

    ``blocks`` lists every line (from 0) with a template it meets. With ``wrapped`` it also lists, by the line in which they begin,
    notices across line ends: for each run of lines that have words and each template the best window, if it holds more of the
    template than each single line of the run. ``labels`` are those of phrases and blocks. ``score`` is 1 if a phrase stands in the text, else the highest
    containment of a match, else 0.

    A null text is empty: no words, no labels (empty strings), places null, score 0. A null identifier stays null; repeated rows give
    repeated rows; an empty table gives an empty result; other columns are not looked at. Words of equal frequency are ordered by
    their bytes, which cannot change a result.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = template_words(TEMPLATES if templates is None else templates)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col), text_bytes(text_col))
    vocabulary = frozenset(w for words in wanted.values() for w in words)
    counted = texts.mapInArrow(line_counter(vocabulary), "word binary, lines bigint").groupBy("word").agg(F.sum("lines").alias("lines"))
    lines = {bytes(r.word): r.lines for r in counted.collect()}  # at most one row per word of the templates
    notices = TEMPLATES if templates is None else templates
    index = Index(wanted, lines, threshold, {label: 2 * len(words_of(notices[label].encode())) for label in wanted})
    spaced = {label: f" {p} ".encode() for label, p in (PHRASES if phrases is None else phrases).items()}
    result = texts.mapInArrow(scanner(index, spaced, wrapped), RESULT.format(id=id_type))
    return result.withColumnRenamed("doc_id", id_col)
