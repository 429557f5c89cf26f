"""Line dedup, decontamination, license scan and URL filter on small tables with odd rows."""

import numpy as np
import pytest

import helpers as H
from plumbline.llm import decontaminate, licenses, line_dedup, url_filter

DOCS = "doc_id long, text string, row string, kept string, score double"
LONG = "a long line that is found again and again\n" * 3000


def frame(spark, rows, schema=DOCS):
    wide = [(*r, "x", "y", 0.5) for r in rows] if schema == DOCS else rows
    return spark.createDataFrame(wide, schema)


ROWS = [
    (1, "Shared line here\nown one\n  shared LINE here \nshort"),
    (2, "\tSHARED line here\nshort\nother text of two"),
    (3, None),
    (4, ""),
    (5, "other text of two"),
    (5, "other text of two"),
    (None, "Shared line here"),
    (7, "Ä big line with ümlaut\nÄ BIG line with ümlaut\nä big line with ümlaut"),
    (8, "ä big line with ümlaut\n\n\n"),
    (9, LONG),
    (6, LONG + "its own end is here"),
    (0, "123456789\n1234567890"),
    (10, "123456789\n1234567890"),
]


def test_line_dedup_as_plain_python(spark):
    got = line_dedup.dedup_lines(frame(spark, ROWS)).collect()
    rows = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(rows, key=key) == sorted(H.dedup_lines(ROWS), key=key)
    assert {r["row"]["kept"] for r in got} == {"y"}


def test_line_dedup_heavy_line(spark):
    rows = [(i, f"the very common line\nline number {i} of its own") for i in range(3000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("n_dropped = 1").count() == 2999
    assert got.where("n_dropped = 0").first()["row"]["doc_id"] == 0


def test_line_dedup_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item, of six words."),
    (10, "short ITEM of six words"),
    (3, None),
    (4, " .,! "),
    (None, "no id for this one"),
]
TEXTS = [
    (1, "Say: ONE two three-four five six seven, eight nine ten. And eleven twelve"),
    (2, "one two three four five six seven eight nine ten eleven twelve one two"),
    (3, "a short item of six words short item of six words"),
    (4, None),
    (5, ""),
    (6, "one two three four five six seven eight nine"),
    (7, "no id for this one"),
    (8, "Über short item of six words" + " x" * 50000),
    (9, "shortitem of six words"),
]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 40])
def test_leaks_as_plain_python(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(frame(spark, TEXTS), items, block_bytes=block).collect()
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found}
    known = [i for i in ITEMS if i[0] is not None]
    assert got == {doc: H.leaks(text, known) for doc, text in TEXTS}
    texts = dict(TEXTS)
    for r in found:
        for a, b in r["spans"]:
            words = H.bench_words(texts[r["row"]["doc_id"]][a:b])
            assert len(words) >= 5


def test_leaks_without_benchmark_or_documents(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.find_leaks(frame(spark, TEXTS), items).collect()} == {0}
    assert decontaminate.find_leaks(frame(spark, []), items).collect() == []


def test_licences(spark):
    mit = "\n".join(licenses.SENTENCES[k][0] for k in ("mit_permission", "mit_conditions", "as_is_any_kind"))
    rows = [
        (1, "Copyright (c) 2020 Somebody\n" + mit.upper()),
        (2, "Text before. Licensed under the Apache License, Version 2.0. Text after"),
        (3, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (4, licenses.SENTENCES["mit_permission"][0] + "\n" + licenses.SENTENCES["bsd_source"][0]),
        (5, None),
        (6, ""),
        (7, "copyright law and order"),
        (8, "word " * 30000 + "\nThis work is licensed under the GNU General Public License, version 3."),
        (8, "Licensed under CC BY-NC 4.0."),
    ]
    found = licenses.scan_licences(frame(spark, rows)).collect()
    got = [(r["row"]["doc_id"], r["sentence_ids"], r["licences"], r["n_unused"]) for r in found]
    assert sorted(got, key=str) == sorted(
        [
            (1, ["copyright", "mit_permission", "mit_conditions", "as_is_any_kind"], ["MIT"], 0),
            (2, ["apache_notice"], ["Apache-2.0"], 0),
            (3, ["mit_notice", "cc_by_nc_notice"], ["MIT", "CC-BY-NC-4.0"], 0),
            (4, ["mit_permission", "bsd_source"], [], 2),
            (5, [], [], 0),
            (6, [], [], 0),
            (7, [], [], 0),
            (8, ["gpl3_notice"], ["GPL-3.0-only"], 0),
            (8, ["cc_by_nc_notice"], ["CC-BY-NC-4.0"], 0),
        ],
        key=str,
    )
    assert licenses.scan_licences(frame(spark, [])).collect() == []


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Copyright (c) 2020 Somebody

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def licences_of(spark, texts):
    found = licenses.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return [r["licences"] for r in sorted(found.collect(), key=lambda r: r["row"]["doc_id"])]


def test_wrapped_licences(spark):
    texts = {APACHE: "Apache-2.0", MIT: "MIT", ISC: "ISC", BSD2: "BSD-2-Clause", BSD3: "BSD-3-Clause", GPL3: "GPL-3.0-or-later"}
    marked = [p + t.replace("\n", end + p) for p, end in (("", "\n"), (" * ", "\n"), ("// ", "\r\n"), ("# ", "\n")) for t in texts]
    assert licences_of(spark, marked) == [[x] for x in texts.values()] * 4


def test_what_is_no_licence_and_what_is(spark):
    texts = {
        "published by MIT Press": [], "Courses offered by MIT are free": [], "Funding was provided by MIT": [],
        "This is not licensed under the MIT License.": [], "is no longer released under the MIT License": [],
        "It isn't licensed under the GPL version 3": [], "subject to MIT rules": [], "published under ISC guidance": [],
        "Licensed under the Apache License 2.0 and MIT students": ["Apache-2.0"], "the license MIT chose": [],
        "This file is licensed under either MIT or Apache-2.0.": ["Apache-2.0", "MIT"],
        "Licensed under Apache-2.0 or MIT": ["Apache-2.0", "MIT"],
        "Licensed under GPLv2+": ["GPL-2.0-or-later"], "distributed under the GPLv3": ["GPL-3.0-only"],
        "License: MIT": ["MIT"], "# Licence : ISC\n": ["ISC"], "Licensed under the BSD license.": ["BSD"],
        "SPDX-License-Identifier: MIT": ["MIT"], "governed by the Mozilla Public License, version 2.0": ["MPL-2.0"],
        "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby "
        "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": ["ISC"],
        "not here. Released under the MIT License.": ["MIT"],
    }
    assert [sorted(x) for x in licences_of(spark, texts)] == list(texts.values())


def test_notices_of_common_licences(spark):
    texts = {
        "This file is released under the MIT License": ["MIT"],
        "// SPDX-License-Identifier: MIT OR Apache-2.0": ["Apache-2.0", "MIT"],
        "# SPDX-License-Identifier: GPL-2.0+": ["GPL-2.0-or-later"],
        "SPDX-License-Identifier: LGPL-2.1-only\nmit freundlichem Text": ["LGPL-2.1-only"],
        "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.": ["MPL-2.0"],
        "made available under the\nterms of the Eclipse Public License v1.0 which": ["EPL-1.0"],
        "licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License": ["CC-BY-SA-3.0"],
        "This is free and unencumbered software released into the public domain.": ["Unlicense"],
        "it under the terms of the GNU Affero General Public License as\npublished by the Free Software "
        "Foundation, either version 3 of the\nLicense, or (at your option) any later version.": ["AGPL-3.0-or-later"],
        "it under the terms of the GNU General Public License version 2 as\n"
        "published by the Free Software Foundation.": ["GPL-2.0-only"],
        "Licensed under the GNU GPL v3 or later": ["GPL-3.0-or-later"],
        "The MIT Press and the Apache are under review": [],
    }
    assert licences_of(spark, texts) == list(texts.values())


def test_url_rules(spark):
    rules = [
        url_filter.Rule("block", "net/"),
        url_filter.Rule("allow", "example.net/en/"),
        url_filter.Rule("block", "*.ads-?.*", is_glob=True),
        url_filter.Rule("allow", "*.ads-1.*|/ok*", is_glob=True),
    ]
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"),
        "http://A.NET/X?y": ("a.net", "/X", "net/", "block"),
        "http://net/": ("net", "/", "net/", "block"),
        "http://anet/": ("anet", "/", None, "allow"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?/": ("a.net", "", None, "allow"),
        "http://b.example.net/en/1#x": ("b.example.net", "/en/1", "example.net/en/", "allow"),
        "http://x.com/a.net/b": ("x.com", "/a.net/b", None, "allow"),
        "http://ads-1.x.com/": ("ads-1.x.com", "/", None, "block"),
        "http://ads-1.x.com/ok/1": ("ads-1.x.com", "/ok/1", None, "allow"),
        "http://ads-12.x.com/": ("ads-12.x.com", "/", None, "allow"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://é.net/é": ("é.net", "/é", "net/", "block"),
        "http://q.com/" + "y" * 5000: ("q.com", "/" + "y" * 5000, None, "allow"),
    }
    rows = [(k, url, "x") for k, url in enumerate([*cases, "http://net/"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.judge_urls(pages, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["row"]["url"]], r["row"]["url"]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def test_many_globs_use_several_words():
    rules = [url_filter.Rule("block", f"*.site{k:03}.*|/p{k:03}*", is_glob=True) for k in range(100)]
    machine = url_filter.compile_rules(rules)
    assert machine.words > 10
    texts = [
        np.array([*f".a.site{k:03}.com".encode(), url_filter.GAP, *f"/p{j:03}/x".encode()], np.uint16)
        for k, j in ((0, 0), (57, 57), (99, 99), (4, 5))
    ]
    found = machine.matches(texts)
    assert [set(np.flatnonzero(f)) for f in found] == [{0}, {57}, {99}, set()]
