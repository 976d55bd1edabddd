"""Licence rules on small texts; the whole table is held against SQL."""

from reportmart.llm.licenses import SENTENCES, scan_licenses

APACHE = " ".join(
    SENTENCES[n][-1] + "."
    for n in ("apache-ref", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")
)
MIT = "\n\n".join(SENTENCES[n][0] + "." for n in ("mit-grant", "mit-notice", "mit-as-is"))


def scan(df, **more):
    return {
        r.doc_id: (r.licenses, r.n_matches, r.unmatched) for r in scan_licenses(df, **more).collect()
    }


def test_rules(clashing):
    wrapped = MIT.replace(" of this software", "\n# of this   software")
    docs = clashing(
        [
            (1, "Some text.\nLicensed under CC BY-NC 4.0.\nMore text."),
            (2, APACHE),
            (3, wrapped.lower()),
            (4, "released under the mit license! Released under the MIT License."),
            (5, SENTENCES["mit-notice"][0]),
            (6, None),
            (7, ""),
            (8, "\n\n . ! ?"),
            (9, f"{SENTENCES['mit-grant'][0]}\nA. B. {SENTENCES['mit-notice'][0]}"),
            (10, f"{SENTENCES['mit-grant'][0]}\nA. B. C. {SENTENCES['mit-notice'][0]}"),
            (11, "word. " * 50_000 + "Licensed under the Apache License, Version 2.0."),
            (None, MIT + " " * 100_000 + APACHE),
            (1, "Licensed under CC BY-NC 4.0."),
        ]
    )
    found = scan(docs)
    assert found[1] == ("CC-BY-NC-4.0:1", 1, "")
    # The longest rule goes first; the reference before it stays for a later one.
    assert found[2] == ("Apache-2.0:1,Apache-2.0:1", 2, "")
    assert found[3] == ("MIT:1", 1, "")
    assert found[4] == ("MIT:2", 2, "")
    assert found[5] == ("", 0, "<mit-notice>")
    assert found[6] == found[7] == found[8] == ("", 0, "")
    assert found[9] == ("MIT:1", 1, "")
    assert found[10] == ("", 0, "<mit-grant><mit-notice>")
    assert found[11] == ("Apache-2.0:1", 1, "")
    assert found[None] == ("Apache-2.0:1,Apache-2.0:1,MIT:1", 3, "")


# Notices as they are distributed, wrapped as there.
BSD = """Copyright (c) 2020, A. Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE_HEADER = """Copyright 2020 A. Writer

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT_TEXT = """MIT License

Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE.
"""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
HEADERS = [
    (BSD, "BSD-2-Clause:1", "<all-rights>"),
    (BSD + BSD_NAMES, "BSD-3-Clause:1", "<all-rights>"),
    (APACHE_HEADER, "Apache-2.0:1", ""),
    (MIT_TEXT, "MIT:1", ""),
    (GPL.format(":", ",", 3), "GPL-3.0-or-later:1", ""),
    (GPL.format(";", ";", 2), "GPL-2.0-or-later:1", ""),
]


def commented(text, first, mark, last):
    lines = [f"{mark} {line}".rstrip() for line in text.splitlines()]
    return "\n".join([first, *lines, last, "code = 1"])


def test_headers_as_distributed(documents):
    shapes = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: commented(t, "#!/bin/sh", "#", ""),
        lambda t: commented(t, "/*", " *", " */"),
        lambda t: commented(t, "", "//", ""),
        lambda t: commented(t, "", ";;", ""),
    ]
    texts = [shape(text) for text, _, _ in HEADERS for shape in shapes]
    found = scan(documents(texts))
    for number, (_, licence, rest) in enumerate(HEADERS):
        for k in range(len(shapes)):
            assert found[number * len(shapes) + k] == (licence, 1, rest), (licence, k)


def test_notices_without_ends(documents):
    found = scan(documents(["A heading\nLicensed under the MIT License\nAnother line", "(a) All rights\nreserved"]))
    assert found[0] == ("MIT:1", 1, "") and found[1] == ("", 0, "<all-rights>")


def test_rules_go_in_order(documents):
    sentences = {"a": ["one"], "b": ["two"]}
    docs = documents(["One. Two. One.", "two one"])
    assert scan(docs, sentences=sentences, rules=[("x", ["a"]), ("y", ["a", "b"])])[0] == (
        "x:2",
        2,
        "<b>",
    )
    assert scan(docs, sentences=sentences, rules=[("y", ["a", "b"]), ("x", ["a"])])[0] == (
        "y:1,x:1",
        2,
        "",
    )


def test_empty(clashing):
    assert scan_licenses(clashing([])).collect() == []
