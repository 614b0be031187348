"""License scans: SQL, a plain reading, ordered rules and edge rows."""

from pitchside.llm import licenses, registry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


def test_sql(spark):
    df = registry.QUERIES["op5_licenses"](spark, SF)
    ok, msg = compare(df, duck(SF), registry.ORACLE_SQL["op5_licenses"])
    assert ok, msg
    assert {r["licenses"] for r in df.select("licenses").distinct().collect()} >= {"", "MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "all-rights-reserved"}


def test_every_known_sentence_has_a_word():
    import re
    assert all(re.search(licenses.WORDS, s) for s in licenses.known_sentences())
    assert set(licenses.known_sentences().values()) == {k for run, _ in licenses.RULES for k in run} | {"mit-notice", "as-is"}


def test_rules_and_edges(spark):
    s = licenses.SENTENCES
    bsd2 = [s["bsd-grant"], s["bsd-source"], s["bsd-binary"]]
    texts = [None, "", "\n".join([*bsd2, s["bsd-names"]]), ".\n".join(bsd2) + ".", ". ".join([s["mit-grant"] + "\n", s["mit-notice"], s["as-is"]]),
             "prose.  LICENSED   under the Apache License, Version 2.0! More; Released under the MIT License\nAll rights reserved.",
             "licensed under nothing. The MIT License", "x" * 200000 + ". Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0.\n" * 20000,
             "!" * 100000 + "Released under the MIT License.", s["mit-notice"], "Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    got = {r["doc_id"]: (",".join(r["licenses"]), r["category"], len(r["sentence_ids"])) for r in licenses.scan_licenses(df).collect()}
    assert got == {
        0: ("", "none", 0), 1: ("", "none", 0), 2: ("BSD-3-Clause", "permissive", 4), 3: ("BSD-2-Clause", "permissive", 3), 4: ("MIT", "permissive", 3),
        5: ("Apache-2.0,MIT,all-rights-reserved", "reserved", 3), 6: ("", "none", 0), 7: ("CC-BY-4.0", "permissive", 1),
        8: ("CC-BY-NC-4.0", "noncommercial", 20000), 9: ("MIT", "permissive", 1), 10: ("", "none", 1), 11: ("CC-BY-4.0,CC-BY-SA-4.0", "copyleft", 2)}
    assert licenses.scan_licenses(df.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Holder

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
ISC = """Copyright (c) 2020, A. Holder

Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
"""
BSD = """Copyright (c) 2020, A. Holder

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:

  1. Redistributions of source code must retain the above copyright
     notice, this list of conditions and the following disclaimer.
  2. Redistributions in binary form must reproduce the above
     copyright notice, this list of conditions and the following
     disclaimer in the documentation and/or other materials provided
     with the distribution.
"""
BSD_NAMES = """  3. Neither the name of Holder Inc. nor the names of its
     contributors may be used to endorse or promote products derived
     from this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def notice(name, family, version, enders):
    return f"""    {name} is free software{enders[0]} you can redistribute it and/or modify
    it under the terms of the GNU {family}General Public License as published by
    the Free Software Foundation{enders[1]} either version {version} of the License, or
    (at your option) any later version.
"""


def comment(text, mark):
    return "".join(f"{mark}{line}\n" for line in text.splitlines())


def test_wrapped_texts_notices_and_spdx(spark):
    texts = {
        MIT: "MIT", MIT.replace("\n", "\r\n"): "MIT", comment(MIT, " * "): "MIT", ISC: "ISC", comment(ISC, "# "): "ISC", BSD: "BSD-2-Clause",
        BSD + BSD_NAMES: "BSD-3-Clause", comment(BSD + BSD_NAMES, "// "): "BSD-3-Clause", BSD.replace("1.", "(1)").replace("2.", "b)"): "BSD-2-Clause",
        BSD.replace("1.", "*").replace("2.", "-"): "BSD-2-Clause", BSD + "3. The name of the author may not be used to endorse or promote products\n"
        "   derived from this software without specific prior written permission.": "BSD-3-Clause",
        APACHE: "Apache-2.0", comment(APACHE, "# "): "Apache-2.0", "Apache License\n   Version 2.0, January 2004\nhttp://www.apache.org/licenses/\n": "Apache-2.0",
        MPL: "MPL-2.0", notice("This program", "", "3", ":,"): "GPL-3.0", notice("This program", "", "2", ";;"): "GPL-2.0",
        comment(notice("Foo-Bar", "Affero ", "3", ":,"), "# "): "AGPL-3.0", notice("This library", "Lesser ", "2.1", ";;"): "LGPL-2.1",
        notice("This library", "Lesser ", "3", ":,"): "LGPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n": "GPL-2.0",
        "/* SPDX-License-Identifier: GPL-2.0+ */": "GPL-2.0", "# SPDX-License-Identifier: LGPL-2.1-or-later\n": "LGPL-2.1",
        "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nfn x": "Apache-2.0,MIT",
        "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note OR BSD-3-Clause": "GPL-2.0,BSD-3-Clause",
        "This work is\nlicensed under the\nMIT License\nAll rights reserved\nnothing": "MIT,all-rights-reserved",
        "Released under the MIT\n\nLicense": "", "Released under the\nMIT License or not": "", "MIT or Apache-2.0 licensed": ""}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["text"]: set(filter(None, r["licenses"])) for r in licenses.scan_licenses(df).collect()}
    wrong = {t: (got[t], want) for t, want in texts.items() if got[t] != set(filter(None, want.split(",")))}
    assert not wrong


def test_long_texts_with_marks(spark):
    texts = ["licens " + "- " * 300000, "licens" + ".\n" * 200000, "licens\n" * 100000, "is free software " * 20000, "the name of " * 20000 + "license",
             "licens " + "a) " * 100000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["category"] for r in licenses.scan_licenses(df).collect()} == {"none"}
