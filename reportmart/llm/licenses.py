r"""Recognition of licences by sentences and rules.

A text is cut into sentences: at ``.``, ``!`` or ``?`` before white space, and at a line end
after one of these or ``:``, before a blank line, before a line that begins like a known
sentence, or before a list item, whose number is left out. Comment marks before a line are no part of it. Where such a sentence is not known, it may
be several that lack their ends, as a heading over a notice, so it is cut at its line ends too,
except where the next line goes on in lower case. A sentence is normalised to its ASCII
letters and digits, in lower case with single spaces, and looked up among the known ones.
The identifiers of a text stand in a sequence; where more than ``MAX_GAP`` unknown sentences
lie between two of them, a new run begins. Rules are tried in order, each on what the rules
before it have left: a rule matches wherever its identifiers follow each other in a run, and
uses them up. What no rule uses stays as unmatched.

All of it happens within a row, so nothing is shuffled and no row depends on another.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, text_of

MAX_GAP = 2
#: Between sentences once they are found.
END = "\u0001"
#: A line that begins with a number, a number or letter in brackets, or a dash.
LIST_ITEM = r"\n(\([a-z0-9]{1,2}\)|[0-9]{1,2}[.)]|[-•])[ \t]+"
#: Known sentences of licence texts by identifier.
SENTENCES = {
    "apache-ref": ["Licensed under the Apache License, Version 2.0"],
    "apache-compliance": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "You may not use this file except in compliance with the License",
    ],
    "apache-copy": [
        "You may obtain a copy of the License at",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "apache-as-is": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    ],
    "apache-see": [
        "See the License for the specific language governing permissions and limitations under the License",
    ],
    "mit-ref": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the MIT License",
        "Distributed under the MIT License",
    ],
    "mit-grant": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    ],
    "mit-notice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "mit-as-is": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    ],
    "bsd-redistribution": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    ],
    "bsd-names": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "gpl3-ref": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
    ],
    "gpl3-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "gpl2-later": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    ],
    "gpl-no-warranty": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ],
    "cc-by-nc-4": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-4": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-sa-4": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "mpl2-ref": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v",
        "Licensed under the Mozilla Public License, version 2.0",
    ],
    "all-rights": ["All rights reserved"],
}
#: Licences and the sequences that stand for them, in the order of trial.
RULES = [
    ("Apache-2.0", ["apache-compliance", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-ref", "apache-compliance", "apache-copy"]),
    ("Apache-2.0", ["apache-compliance", "apache-copy"]),
    ("Apache-2.0", ["apache-ref"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-ref"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-no-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-no-warranty"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("MPL-2.0", ["mpl2-ref"]),
]


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def known_sentences(sentences: dict[str, list[str]]) -> dict[str, str]:
    """Identifier by normalised sentence."""
    return {normalised(s): name for name, several in sentences.items() for s in several}


def beginnings(known: Iterable[str], words: int = 6) -> str:
    """A pattern for the first words of known sentences, whatever stands between them."""
    first = sorted({tuple(s.split()[:words]) for s in known})
    return "(?i:" + "|".join("[^a-z0-9]+".join(ws) for ws in first) + ")"


def sentences_of(text: Column, known: Iterable[str]) -> Column:
    """The sentences of a text, with the line ends that are within them."""
    lines = F.regexp_replace(F.concat(F.lit("\n"), text), r"\r?\n[ \t#*/;]*", "\n")
    broken = F.regexp_replace(lines, LIST_ITEM, "\n\n")
    broken = F.regexp_replace(broken, rf"\n({beginnings(known)})", "\n\n$1")
    broken = F.regexp_replace(broken, r"([.!?:])[ \t]*\n", "$1\n\n")
    ended = F.regexp_replace(broken, r"\n\n+", END)
    return F.split(F.regexp_replace(ended, r"([.!?])[ \t]+", "$1" + END), END)


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(sentence), "[^a-z0-9]+", " "))


def identify(sentences: Column, known: dict[str, str], max_gap: int) -> Column:
    """The identifiers as ``<a><b>|<c>``, a bar where a new run begins."""
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())])

    def name(sentence: Column) -> Column:
        return F.concat(F.lit("<"), F.try_element_at(names, sentence), F.lit(">"))

    def by_lines(sentence: Column) -> Column:
        lines = F.split(F.regexp_replace(sentence, r"\n([a-z])", " $1"), "\n")
        # Empty lines are no sentences.
        said = F.filter(F.transform(lines, normalise), lambda s: s != "")
        return F.array_join(F.transform(said, lambda s: F.coalesce(name(s), F.lit("_"))), "")

    found = F.transform(sentences, lambda s: F.coalesce(name(normalise(s)), by_lines(s)))
    runs = F.regexp_replace(F.array_join(found, ""), f"_{{{max_gap + 1},}}", "|")
    return F.regexp_replace(F.regexp_replace(runs, "_", ""), r"^\||\|$", "")


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, list[str]] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """Per row: ``id_col``, the ``identifiers`` found, the ``licenses`` as ``name:matches`` in
    the order of the rules, joined by commas, ``n_matches``, and the ``unmatched`` identifiers.

    Null text counts as empty; a text without known sentences has empty results. Rows that
    repeat an id are rows of their own; other columns are not read. An empty table gives an
    empty result."""
    known = known_sentences(sentences)
    found = identify(sentences_of(text_of(docs, text_col), known), known, max_gap)
    steps = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{s}>" for s in ids)).alias("ids"))
            for name, ids in rules
        ]
    )

    def apply(state: Column, rule: Column) -> Column:
        left = F.replace(state["left"], rule["ids"], F.lit("|"))
        used = F.length(state["left"]) - F.length(F.replace(state["left"], rule["ids"], F.lit("")))
        n = F.floor(used / F.length(rule["ids"])).cast("long")
        names = F.when(
            n > 0, F.concat(state["names"], rule["name"], F.lit(":"), n.cast("string"), F.lit(","))
        ).otherwise(state["names"])
        return F.struct(left.alias("left"), names.alias("names"), (state["n"] + n).alias("n"))

    rows = docs.select(docs[id_col].alias("id"), found.alias("identifiers"))
    start = F.struct(
        F.col("identifiers").alias("left"), F.lit("").alias("names"), F.lit(0).cast("long").alias("n")
    )
    rows = rows.withColumn("state", F.aggregate(steps, start, apply))
    return rows.select(
        F.col("id").alias(id_col),
        "identifiers",
        F.rtrim(F.col("state.names"), F.lit(",")).alias("licenses"),
        F.col("state.n").alias("n_matches"),
        F.replace(F.col("state.left"), F.lit("|"), F.lit("")).alias("unmatched"),
    )
