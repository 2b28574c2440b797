from llm_helpers import SCHEMA

from priceloom.llm import licenses, spdx

LINES = {
    "Licensed under the BSD 3-Clause License.": ["BSD-3-Clause"],
    "Released under the two-clause BSD license": ["BSD-2-Clause"],
    "This project is licensed under the terms of the MIT license.": ["MIT"],
    "Distributed under Apache 2.0": ["Apache-2.0"],
    "This file is available under the Apache License 2.0": ["Apache-2.0"],
    "This library is licensed under the GNU Lesser General Public License v2.1 or later.": ["LGPL-2.1-or-later"],
    "It is covered by the GNU Affero General Public License, version 3.": ["AGPL-3.0"],
    "released under GPLv2": ["GPL-2.0"],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA-4.0"],
    "Licensed under CC BY 4.0": ["CC-BY-4.0"],
    "Released under CC0 1.0 Universal": ["CC0-1.0"],
    "Licensed under the Mozilla Public License, v. 2.0": ["MPL-2.0"],
    "SPDX-License-Identifier: ISC": ["ISC"],
    "# SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0-only"],
    "MIT License Copyright (c) 2020 A. Person": ["MIT"],
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option": ["Apache-2.0", "MIT"],
    "She studied at MIT and BSD was her first system, in general public transport was free": [],
    "Creative people under the open sky read an Apache story, 3 of them by lesser known authors": [],
}


def found(spark, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    out = [[] for _ in rows]
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id", "start").collect():
        out[r["doc_id"]].append(r)
    return out


def test_short_notices_in_their_usual_wordings(spark):
    lead = "some words of a longer page about nothing much. "
    got = found(spark, [lead + t + " and so the page goes on" for t in LINES])
    for (line, want), rows in zip(LINES.items(), got):
        assert [r["license"] for r in rows] == want, line
        assert all(lead.rstrip() not in line and r["start"] >= len(lead) for r in rows)


def test_whole_texts_and_headers_give_their_own_name(spark):
    table = spdx.texts()
    for name, rows in zip(table, found(spark, ["word " * 40 + t + " word" * 40 for t in table.values()])):
        assert name in [r["license"] for r in rows if r["containment"] == 1.0], (name, rows)
        # kin of it, such as the two-clause text within the three-clause one, is not reported in its place
        assert len({r["license"] for r in rows if r["end"] - r["start"] > 900}) <= 1, (name, rows)


def test_licenses_in_turn_are_told_apart(spark):
    table = spdx.texts()
    names = ["BSD-2-Clause-full-text", "BSD-3-Clause-text", "MIT-full-text", "MIT-full-text", "ISC-full-text", "0BSD-text"]
    rows = found(spark, [" Copyright 2020 a person. ".join(table[n] for n in names)])[0]
    assert [r["license"] for r in rows] == names


def test_changed_holder_keeps_the_three_clause_text(spark):
    text = spdx.texts()["BSD-3-Clause-text"].replace("copyright holder nor", "Regents of the University nor")
    assert [r["license"] for r in found(spark, [text])[0]] == ["BSD-3-Clause-text"]
