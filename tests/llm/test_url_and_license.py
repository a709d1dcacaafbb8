import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from paylake.llm import license_scan, queries, url_filter

D = dt.date


@pytest.fixture(scope="module")
def entries(spark):
    rows = [("bad.example.com", "block", "add", D(2024, 1, 10)), ("bad.example.com", "block", "remove", D(2024, 2, 1)),
            ("bad.example.com", "block", "add", D(2024, 3, 1)), ("bad.example.com", "block", "add", D(2024, 3, 5)),
            ("bad.example.com/ok", "allow", "add", D(2024, 1, 1)), ("example.org", "block", "add", D(2024, 1, 1)),
            ("example.org", "allow", "add", D(2024, 6, 1)), (None, "block", "add", D(2024, 1, 1)),
            ("x.y", "other", "add", D(2024, 1, 1)), ("x.y", "block", "add", None), ("example.net", "block", "add", D(2024, 1, 1)),
            ("example.net", "block", "remove", D(2024, 1, 1))]
    return spark.createDataFrame(rows + rows[:3], "pattern string, kind string, action string, entry_date date")


def test_as_of(spark, entries, clash):
    cases = [("http://www.bad.example.com/a", D(2024, 1, 9), False), ("http://bad.example.com/a", D(2024, 1, 10), True),
             ("HTTPS://u:p@Sub.BAD.example.com:80/a?q#f", D(2024, 1, 31), True), ("http://bad.example.com/", D(2024, 2, 1), False),
             ("http://bad.example.com/", D(2025, 1, 1), True), ("http://bad.example.com/ok/x", D(2025, 1, 1), False),
             ("http://a.b.example.org", D(2024, 5, 1), True), ("http://a.b.example.org", D(2024, 6, 1), False),
             ("http://example.net/", D(2024, 5, 1), False), ("not a url", D(2024, 5, 1), False), (None, D(2024, 5, 1), False),
             ("http://example.org", None, False), ("", D(2024, 5, 1), False), ("http:///x", D(2024, 5, 1), False)]
    caps = spark.createDataFrame([(i, u, d) for i, (u, d, _) in enumerate(cases)] + [(3, cases[3][0], cases[3][1])],
                                 "page_id long, url string, fetch_date date")
    out = url_filter.judge(clash.add(caps), entries).collect()
    assert len(out) == len(cases) + 1
    assert {r.page_id: r.blocked for r in out} == {i: b for i, (_, _, b) in enumerate(cases)}
    by = {r.page_id: r for r in out}
    assert by[5].rule == "bad.example.com/ok" and by[5].n_active == 2 and by[7].rule_kind == "allow"
    assert url_filter.judge(caps.limit(0), entries).count() == 0
    assert url_filter.judge(caps, entries.limit(0)).where("blocked").count() == 0


def rows(df):
    return sorted(tuple(str(v) for v in (r[c] for c in sorted(df.columns))) for r in df.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(small, t)}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    got = queries.QUERIES[name](spark, small)
    assert sorted(got.columns) == sorted(cols)
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    want = sorted(tuple(str(r[k]).replace("True", "True") for k in order) for r in cur.fetchall())
    assert rows(got) == want


MIT = """Copyright (c) 2020 A. B.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal in it without restriction.

The above copyright notice and this permission notice shall be included in all
copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""


def test_license_rules(spark, edge_docs, no_docs, clash):
    cases = {0: (MIT, "MIT"), 1: ("Words here.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"),
             2: ("x\nReleased under the MIT License. Licensed under CC BY-NC 4.0.", "MIT,CC-BY-NC-4.0"),
             3: ("This work is licensed under the GNU General Public\nLicense, version 3.", "GPL-3.0"),
             4: ("A driver's license is needed. No rule.", ""), 5: (None, ""), 6: ("", ""),
             7: ("# SPDX-License-Identifier: MIT", "MIT"),
             8: ("Licensed under CC BY 4.0.", "CC-BY-4.0"), 9: (MIT * 400, "MIT")}
    df = clash.add(spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string"))
    out = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    assert {i: r.licenses for i, r in out.items()} == {i: w for i, (_, w) in cases.items()}
    assert out[0].unmatched == "copyright" and out[0].n_sentences == 5
    assert license_scan.license_scan(edge_docs).count() == edge_docs.count()
    assert license_scan.license_scan(no_docs).count() == 0


def test_license_plan_is_native(spark, read):
    plan = license_scan.license_scan(read("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_trigger_words_cover_every_sentence():
    for _, pattern in license_scan.SENTENCES:
        for way in pattern.split("|") if "(?:" not in pattern else [pattern]:
            assert any(t in way for t in license_scan.TRIGGERS), way


GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU {name}General Public License as published by
the Free Software Foundation{mark} either version {n} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name}General Public License for more details.

You should have received a copy of the GNU {name}General Public License along
with this program; if not, see <https://www.gnu.org/licenses/>.
"""
BSD = """Copyright (c) 2020, A. B.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

{endorse}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software.

"""
HEADERS = [
    (MIT, "MIT"), (BSD.format(endorse=ENDORSE), "BSD-3-Clause"), (BSD.format(endorse=""), "BSD-2-Clause"),
    ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", "ISC"),
    ("""Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted.""", "ISC"),
    ("""Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.""", "Apache-2.0"),
    *[(GPL.format(name=name, n=n, mark=mark), licence) for name, n, licence in (
        ("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Lesser ", "2.1", "LGPL"), ("Lesser ", "3", "LGPL"),
        ("Affero ", "3", "AGPL-3.0")) for mark in ";,"],
    (GPL.format(name="", n="2", mark=";").replace("2 of the License, or", "2, or"), "GPL-2.0"),
    (GPL.format(name="", n="2", mark=";").replace("\n", "\n * "), "GPL-2.0"),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "MPL-2.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("A Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
    ("""To the extent possible under law, the person who associated CC0 with this work
has waived all copyright and related or neighboring rights to this work.""", "CC0-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("Copyright 2020 X, all rights reserved", "Copyrighted"), ("All rights reserved.", "Copyrighted"),
    ("Licensed under the MIT license and licensed under the Apache License, Version 2.0.", "Apache-2.0,MIT"),
    *[(f"// SPDX-License-Identifier: {n}", w) for n, w in (
        ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("BSD-3-Clause", "BSD-3-Clause"), ("BSD-2-Clause", "BSD-2-Clause"),
        ("GPL-3.0-only", "GPL-3.0"), ("GPL-2.0-or-later", "GPL-2.0"), ("MPL-2.0", "MPL-2.0"))]]


def test_standard_headers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "doc_id long, text string")
    out = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    assert [out[i].licenses for i in range(len(HEADERS))] == [w for _, w in HEADERS]
    assert not any(out[i].unmatched for i, (t, _) in enumerate(HEADERS) if "General Public" in t)


def test_long_and_loosely_written_patterns(spark):
    deep = ".".join("abcdefghijkl") + ".example.com"
    path = "/".join(f"s{i}" for i in range(9))
    day = D(2024, 1, 1)
    entries = spark.createDataFrame(
        [(p, "block", "add", day) for p in (deep, f"example.org/{path}", "www.Evil.com", "evil.net/ads/", "HTTPS://Full.example.net:443//x/",
                                            "no.example.net/a?q", "/", "//")],
        "pattern string, kind string, action string, entry_date date")
    cases = [(f"http://{deep}/", deep), (f"http://{deep[2:]}/", None), (f"http://z.{deep}/y", deep),
             (f"http://example.org/{path}/z", f"example.org/{path}"), (f"http://example.org/{path[:-1]}", None),
             ("http://evil.com/", "evil.com"), ("http://WWW.evil.com/a", "evil.com"), ("http://evil.net/Ads/1", "evil.net/ads"),
             ("http://evil.net/adsx", None), ("http://full.example.net/x/y", "full.example.net/x"),
             ("http://no.example.net/a", None)]
    caps = spark.createDataFrame([(i, u, day) for i, (u, _) in enumerate(cases)], "page_id long, url string, fetch_date date")
    out = {r.page_id: r for r in url_filter.judge(caps, entries).collect()}
    assert [out[i].rule for i in range(len(cases))] == [w for _, w in cases]
    assert [out[i].blocked for i in range(len(cases))] == [w is not None for _, w in cases]


def test_license_sql_keeps_all_identifiers_and_version_stops(spark):
    texts = ["Copyright 2020 Ada, all rights reserved.", "Mozilla Public License, v. 2.0. Free of charge.",
             "This Source Code Form is subject to the terms of the Mozilla Public License, v.\n2.0. Copyright 2021 B. "
             "All rights reserved; SPDX-License-Identifier: MIT", "version v. x. Licensed under the MIT License! rev. 2",
             "", None, "MIT License\n\nCopyright (c) 2020 C, all rights reserved"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    want = {tuple(map(str, r)) for r in db.execute(license_scan.oracle_sql()).fetchall()}
    got = license_scan.license_scan(docs).collect()
    assert {tuple(map(str, r)) for r in got} == want
    assert any(r.n_sentences > 1 for r in got) and any("MPL-2.0" in r.licenses for r in got)
