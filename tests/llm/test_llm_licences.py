import re

from clinilake.llm import licences
from llm_data import docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _brute(text, templates, percent):
    words = WORD.findall(_lower(text))
    places, labels = [], set()
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    base, score = set(labels), 0.0
    for block in re.split(licences.BLANK, _lower(text)):
        own = set(WORD.findall(block))
        for label, ws in licences.template_words(templates).items():
            both = len(own & set(ws))
            if 100 * both >= percent * len(ws):
                labels.add(label)
                score = max(score, both / len(ws))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.\nmore words here",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "MIT\n\nLicense is split", "mit license MIT  License mit-license", "GNU GENERAL\tPUBLIC LICENSE", None, "", "\n\n\n",
    licences.TEMPLATES["mit-permission"], licences.TEMPLATES["apache-2.0-header"].replace(" ", "\n", 20),
    " ".join(licences.TEMPLATES["gpl-3.0-header"].split()[:60]), "the of and to a in that is under version " * 40,
    "É mit license Kelvin", "Permission is hereby granted, free of charge, to any person", "x " * 60000 + "mit license",
]


def test_scan_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (None, TEXTS[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 50, 100):
        got = sorted((tuple(r) for r in licences.scan(table, percent=percent).collect()), key=repr)
        assert got == sorted(((i, *_brute(t, licences.TEMPLATES, percent)) for i, t in rows), key=repr)


def test_own_templates_clashing_columns_and_empty(spark):
    table = docs(spark)
    own = {"stone": "stone1 river2 walk3", "none": "zzz yyy"}
    got = sorted((tuple(r) for r in licences.scan(table, own, 60).collect()), key=repr)
    assert got == sorted(((r.doc_id, *_brute(r.text, own, 60)) for r in table.collect()), key=repr)
    assert licences.scan(table.limit(0)).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_notices_with_their_published_line_breaks(spark):
    """Plain and as comments, each paragraph is found, and nothing of another licence."""
    wanted = {
        APACHE: {"apache", "apache-2.0-notice", "apache-2.0-header-grant", "apache-2.0-header-disclaimer"},
        GPL: {"gpl", "gpl-3.0-notice", "gpl-header-grant", "gpl-header-warranty"},
        BSD: {"bsd-conditions-use", "bsd-conditions-source", "bsd-conditions-binary"},
        MIT: {"mit-permission", "mit-permission-grant", "mit-permission-notice"},
    }
    texts = [(mark, t) for t in wanted for mark in ("", " * ", "// ")]
    rows = [(i, "\n".join((mark + line).rstrip() for line in t.split("\n"))) for i, (mark, t) in enumerate(texts)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (_, t) in enumerate(texts):
        assert set(got[i].labels.split(",")) == wanted[t]
        assert got[i].score >= 0.8
