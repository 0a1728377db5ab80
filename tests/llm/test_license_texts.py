"""Licence notices as they stand in files, with and without comment marks, by the operator and by its SQL."""

from __future__ import annotations

import duckdb
import pytest

from rollbook.llm import licenses, queries

GPL_NOTICE = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
BSD_3 = BSD_2.format("""
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software.
""")
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
UNLICENSE = "This is free and unencumbered software released into the public domain.\nAnyone is free to copy it."
LGPL = "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."

NOTICES = [
    (GPL_NOTICE.format(2), "GPL-2.0-or-later"), (GPL_NOTICE.format(3), "GPL-3.0-or-later"), (BSD_2.format(""), "BSD-2-Clause"), (BSD_3, "BSD-3-Clause"), (APACHE, "Apache-2.0"),
    (MIT, "MIT"), (ISC, "ISC"), (UNLICENSE, "Unlicense"), (LGPL, "LGPL-2.1-or-later"), (MPL, "MPL-2.0"),
]
TAGS = [
    ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"), ("// SPDX-License-Identifier: MIT-0", "MIT-0"), ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */\nint x;", "MIT,Apache-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0\n# more words here", "GPL-2.0-or-later"), ("x\n;; SPDX-License-Identifier: (BSD-3-Clause AND Zlib)\ny", "BSD-3-Clause,Zlib"),
    ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"), ("SPDX-License-Identifier: LicenseRef-Own", ""),
]
PHRASES = [
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0,MIT"), ("Licensed under the MIT license or CC BY 4.0.", "MIT,CC-BY-4.0"),
    ("This file is not licensed under the Apache License, Version 2.0.", ""), ("It was never released under the MIT License. Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Use it under the terms of the 2-clause BSD license.", "BSD-2-Clause"), ("nothing said here about it", ""), ("  ", ""),
]
MARKS = {"none": "{}", "hash": "# {}", "slash": "// {}", "star": " * {}", "dash": "-- {}", "semicolon": ";; {}"}


def cases():
    for mark, shape in MARKS.items():
        for text, found in NOTICES:
            body = "\n".join(shape.format(line).rstrip() for line in text.split("\n"))
            yield (f"/*\n{body}\n */\ncode();" if mark == "star" else f"{body}\n\nx = 1"), found
    yield from TAGS
    yield from PHRASES
    yield "\n\n".join(t for t, _ in NOTICES[2:6]) + " word" * 20000, "Apache-2.0,MIT,BSD-3-Clause,BSD-2-Clause"


def rows():
    return [(i, text) for i, (text, _) in enumerate(cases())] + [(None, None), (None, TAGS[0][0])]


def test_notices_tags_and_phrases(spark):
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows(), "doc_id long, text string")).collect()}
    for i, (text, found) in enumerate(cases()):
        assert got[i].licenses == found, text[:300]
        if "\n" in text and found and "SPDX" not in text:
            assert got[i].unmatched == ""
    assert next(r.unmatched for r in got.values() if r.sentence_ids == "spdx:licenseref-own") == "spdx:licenseref-own"


def test_sql_states_the_same_rule(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows())
    want = sorted(map(repr, con.sql(queries.SQL["op9_license_rules"]).fetchall()))
    got = licenses.scan(spark.createDataFrame(rows(), "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == want


@pytest.mark.parametrize(("text", "ids"), [("not licensed under the MIT license", []), ("licensed under the mit license", ["MITRef"]), ("all rights reserved, licensed under x", ["Proprietary"])])
def test_a_sentence(spark, text, ids):
    from pyspark.sql import functions as F

    assert spark.range(1).select(licenses.sentence_ids(F.lower(F.lit(text)))).first()[0] == ids
