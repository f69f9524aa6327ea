import duckdb
import pyarrow as pa
import pytest

from tests.llm.conftest import HARD
from tidemark.llm.licenses import ANCHORS, IDENTIFIER_LINES, RULES, SENTENCES, brute_force, checked, scan_licenses, wordings
from tidemark.llm.oracles import LICENSES

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
ROWS = HARD + [(100, "Text.\nLicensed under the Apache License, Version 2.0.\nMore"), (101, MIT), (102, "All rights reserved. Released under the MIT License"),
               (103, "not licensed under cc by nc 4 0"), (104, "LICENSED UNDER CC BY-NC 4.0!"), (105, "This program is free software: you can redistribute it."),
               (106, "all rights reserved.\n" * 500)]


def test_against_plain_python(docs):
    got = scan_licenses(docs(ROWS, clash=["licenses", "lang"])).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r["sentence_ids"], r["rule_matches"], r["licenses"]) == brute_force(r["text"]) and r["lang"] == "kept"


def test_known_texts(docs):
    got = {r["doc_id"]: r["licenses"] for r in scan_licenses(docs(ROWS)).where("doc_id >= 100").collect()}
    assert got[100] == ["Apache-2.0"] and got[101] == ["MIT"] and got[102] == ["MIT", "Proprietary"] and got[103] == [] and got[104] == ["CC-BY-NC-4.0"] and got[105] == []


def test_rules_and_anchors():
    checked(SENTENCES, RULES, ANCHORS)
    assert sum(isinstance(s, str) or len(s) for s in SENTENCES.values()) == len(wordings(SENTENCES))
    for sentences, rules in [({"ab": "a licence"}, []), ({"A": "a licence"}, [("X", "AB")]), ({"A": "no such word"}, []), ({"A": "licence"}, [("X", "A"), ("Y", "A")])]:
        with pytest.raises(ValueError):
            checked(sentences, rules, ANCHORS)


def test_tables_of_the_caller(docs):
    rows = [(1, "# House rules.\n# Do not ship; ask\n# the owner first."), (2, "Ask the owner first. House rules."), (3, None)]
    got = scan_licenses(docs(rows), sentences={"1": ("house rules", "our rules"), "2": "ask the owner first"}, rules=[("House", "12"), ("Ask", "2")],
                        anchors=["rules", "owner"])
    assert {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in got.collect()} == {1: ("12", ["House"]), 2: ("21", ["Ask"]), 3: ("", [])}


def test_identifier_lines(docs):
    rows = [(i, f"// SPDX-License-Identifier: {name}\nint x;") for i, name in enumerate(IDENTIFIER_LINES.values())]
    rows += [(100, "SPDX-License-Identifier: MIT OR Apache-2.0"), (101, "SPDX-License-Identifier:MIT")]
    got = {r["doc_id"]: r["licenses"] for r in scan_licenses(docs(rows)).collect()}
    assert got == {i: [name] for i, name in enumerate(IDENTIFIER_LINES.values())} | {100: [], 101: []}


def test_statement_against_plain_python_on_hard_texts(docs):
    rows = ROWS + [(200 + i * 10 + j, shape(text)) for i, (_, _, text) in enumerate(HEADERS) for j, shape in enumerate(SHAPES)] + ENDS
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in rows]), "text": pa.array([t for _, t in rows], pa.string())}))
    got = con.execute(f"SELECT doc_id, sentence_ids, rule_matches, licenses FROM ({LICENSES})").fetchall()
    want = [(i, ids, ",".join(found), ",".join(names)) for i, t in rows for ids, found, names in [brute_force(t)]]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(empty):
    assert scan_licenses(empty).collect() == []


#: Standard headers as their licences print them, and the identifiers in them.
HEADERS = [
    ("EBCD", ["Apache-2.0"], """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GHI", ["MIT"], MIT + """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""),
    ("KL", ["GPL-3.0-or-later"], """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by the
Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""),
    ("KMN", ["GPL-2.0-or-later"], """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by the
Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""),
    ("U", ["MPL-2.0"], """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("QRST", ["BSD-3-Clause"], """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission."""),
    ("V", ["Unlicense"], "This is free and unencumbered software released into the public\ndomain."),
    ("XYZ", ["LGPL-2.1-or-later"], """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""),
    ("Kb", ["AGPL-3.0-or-later"], """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""),
    ("cd", ["ISC"], """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY DAMAGES."""),
    ("e", ["BSL-1.0"], """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)"""),
]
SHAPES = [str, lambda t: t.replace("\n", "\r\n"), lambda t: "\n".join("# " + x for x in t.split("\n")),
          lambda t: "/*\n" + "\n".join(" * " + x for x in t.split("\n")) + "\n */\nint x;", lambda t: "\r\n".join("// " + x for x in t.split("\n")),
          lambda t: " ".join(t.split()), lambda t: "\n".join(t.split())]
ENDS = [(1, "All rights. Reserved seats"), (2, "All rights\n\nReserved"), (3, "# All rights\n# Reserved"), (4, "not\nreleased under the MIT License"), (5, "All rights reserved\nby others")]


def test_standard_headers_wrapped_and_commented(docs):
    rows = [(i * 10 + j, shape(text)) for i, (_, _, text) in enumerate(HEADERS) for j, shape in enumerate(SHAPES)]
    for r in scan_licenses(docs(rows)).collect():
        letters, names, _ = HEADERS[r["doc_id"] // 10]
        if r["doc_id"] % 10 < 5:  # on one line, nothing ends the address before "Unless"
            assert (r["sentence_ids"], r["licenses"]) == (letters, names), r["text"]
        assert (r["sentence_ids"], r["rule_matches"], r["licenses"]) == brute_force(r["text"])


def test_sentences_end_where_they_end(docs):
    got = {r["doc_id"]: r["sentence_ids"] for r in scan_licenses(docs(ENDS)).collect()}
    assert got == {1: "", 2: "", 3: "W", 4: "", 5: ""}
    assert all(brute_force(t)[0] == got[i] for i, t in ENDS)
