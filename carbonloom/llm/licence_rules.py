"""Licences by sentences: known sentences become identifiers, ordered rules match identifier sequences.

A sentence starts at a text's or line's begin or after one of ``. ; : ! ?`` and blanks, and ends before one of them, at a
line end or the text's. Line ends inside a known sentence are blanks, so wrapped notices are recognised. Words are
runs of ASCII letters and digits, with points between digits (``2.0``), A-Z lower-cased; other characters only part
them. Where several known sentences start at one place the longest stands, and the search goes on behind it.

A rule is an ordered list of sentences. It matches where its identifiers follow one another, with at most ``GAP``
words between two of them; of rules that start at one sentence the longest wins, of equal ones the first, and its
sentences are used up.

A null or empty text has no findings; rows are scanned one by one, texts of any length whole. Columns beside id and
text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 40

# The wording of public licences and of usual notices.
SENTENCES = {
    "apache2-notice": "Licensed under the Apache License, Version 2.0",
    "apache2-header-1": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2-header-2": "you may not use this file except in compliance with the License",
    "apache2-header-3": "You may obtain a copy of the License at",
    "apache2-released": "Released under the Apache License, Version 2.0",
    "mit-notice": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License",
    "mit-title-osi": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission",
    "bsd2-notice": "Licensed under the BSD 2-Clause License",
    "bsd3-notice": "Licensed under the BSD 3-Clause License",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-program": "This program is licensed under the GNU General Public License, version 3",
    "gpl2-program": "This program is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software",
    "gpl3-may": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-may": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation; either version 2 of the License, or (at your option) any later version",
    "lgpl3-work": "This work is licensed under the GNU Lesser General Public License, version 3",
    "agpl3-work": "This work is licensed under the GNU Affero General Public License, version 3",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc0-notice": "Licensed under CC0 1.0",
    "cc-by-4-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-nd-4-notice": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa-4-notice": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "unlicense-1": "This is free and unencumbered software released into the public domain",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "all-rights": "All rights reserved",
}
#: Every known sentence has one of these words; a text without any has no sentence to find.
TRIGGERS = ("licen", "copyright", "permi", "redistribut", "reserved", "public domain", "free software", "software")


@dataclass(frozen=True)
class Rule:
    licence: str
    sentences: tuple[str, ...]


RULES = (
    Rule("Apache-2.0", ("apache2-header-1", "apache2-header-2", "apache2-header-3")),
    Rule("Apache-2.0", ("apache2-header-1",)),
    Rule("Apache-2.0", ("apache2-notice",)),
    Rule("Apache-2.0", ("apache2-released",)),
    Rule("Apache-2.0", ("spdx-apache2",)),
    Rule("MIT", ("mit-grant", "mit-keep")),
    Rule("MIT", ("mit-title", "mit-grant", "mit-keep")),
    Rule("MIT", ("mit-title-osi", "mit-grant", "mit-keep")),
    Rule("MIT", ("mit-notice",)),
    Rule("MIT", ("mit-licensed",)),
    Rule("MIT", ("mit-title",)),
    Rule("MIT", ("mit-title-osi",)),
    Rule("MIT", ("spdx-mit",)),
    Rule("ISC", ("isc-grant",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD-2-Clause", ("bsd2-notice",)),
    Rule("BSD-3-Clause", ("bsd3-notice",)),
    Rule("BSD-3-Clause", ("spdx-bsd3",)),
    Rule("GPL-3.0", ("gpl3-work",)),
    Rule("GPL-3.0", ("gpl3-program",)),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl3-may")),
    Rule("GPL-2.0", ("gpl2-program",)),
    Rule("GPL-2.0-or-later", ("gpl-free", "gpl2-may")),
    Rule("GPL-3.0", ("spdx-gpl3",)),
    Rule("GPL-2.0", ("spdx-gpl2",)),
    Rule("LGPL-3.0", ("lgpl3-work",)),
    Rule("AGPL-3.0", ("agpl3-work",)),
    Rule("MPL-2.0", ("mpl2-notice",)),
    Rule("CC0-1.0", ("cc0-notice",)),
    Rule("CC-BY-4.0", ("cc-by-4-notice",)),
    Rule("CC-BY-4.0", ("cc-by-4-work",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    Rule("CC-BY-ND-4.0", ("cc-by-nd-4-notice",)),
    Rule("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-notice",)),
    Rule("Unlicense", ("unlicense-1",)),
    Rule("all rights reserved", ("all-rights",)),
)

_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
_START = re.compile(r"[.;:!?]\s+$|[\n\r][^A-Za-z0-9]*$")
_END = re.compile(r"[^A-Za-z0-9\n\r.;:!?]*(?:[.;:!?](?:\s|$)|[\n\r]|$)")


class Recogniser:
    def __init__(self, sentences: dict[str, str], rules: Sequence[Rule], triggers: Sequence[str], gap: int):
        self.gap, self.triggers = gap, tuple(triggers)
        self.known: dict[tuple[str, ...], list[tuple[tuple[str, ...], str]]] = {}
        for name, text in sentences.items():
            if not any(t in text.lower() for t in triggers):
                raise ValueError(f"no trigger word in {name}")
            words = tuple(w.lower() for w in _WORD.findall(text))
            self.known.setdefault(words[:2], []).append((words, name))
        for found in self.known.values():
            found.sort(key=lambda x: -len(x[0]))
        self.rules: dict[str, list[Rule]] = {}
        for rule in rules:
            self.rules.setdefault(rule.sentences[0], []).append(rule)
        for some in self.rules.values():
            some.sort(key=lambda r: -len(r.sentences))

    def sentences(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(identifier, first and last word, character offsets) of the known sentences, in order."""
        folded = text.lower()
        if not any(t in folded for t in self.triggers):
            return []
        at = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in at]
        out, i = [], 0
        while i < len(words):
            found = self.known.get(tuple(words[i : i + 2])) if self._starts(text, at, i) else None
            for known, name in found or ():
                end = i + len(known)
                if tuple(words[i:end]) == known and _END.match(text, at[end - 1][1]):
                    out.append((name, i, end - 1, at[i][0], at[end - 1][1]))
                    i = end - 1
                    break
            i += 1
        return out

    @staticmethod
    def _starts(text: str, at: list[tuple[int, int]], i: int) -> bool:
        return i == 0 or _START.search(text, at[i - 1][1], at[i][0]) is not None

    def findings(self, text: str | None) -> tuple[list[str], list[dict]]:
        """Identifiers in order, and the licences found with their character offsets."""
        known = self.sentences(text) if text else []
        names, out, i = [k[0] for k in known], [], 0
        while i < len(known):
            step = 1
            for rule in self.rules.get(names[i], ()):
                n = len(rule.sentences)
                part = known[i : i + n]
                close = all(b[1] - a[2] - 1 <= self.gap for a, b in zip(part, part[1:]))
                if tuple(names[i : i + n]) == rule.sentences and close:
                    out.append({"licence": rule.licence, "start": part[0][3], "end": part[-1][4]})
                    step = n
                    break
            i += step
        return names, out


def scan(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: Sequence[Rule] = RULES,
    triggers: Sequence[str] = TRIGGERS,
    gap: int = GAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, ``sentences`` (identifiers in order of the text) and ``findings`` (licence, start, end) of every row."""
    recogniser = Recogniser(SENTENCES if sentences is None else sentences, rules, triggers, gap)
    kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [recogniser.findings(t.as_py()) for t in batch.column(1)]
            names = pa.array([n for n, _ in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array([f for _, f in found], kind)], names=["id", "sentences", "findings"])

    ids = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {ids}, sentences array<string>, findings array<struct<licence:string,start:long,end:long>>"
    )
    return out.withColumnRenamed("id", id_col)
