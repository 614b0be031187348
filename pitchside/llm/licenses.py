"""License scans by sentence rules.

A text is normalised (A-Z lower-cased, everything but letters, digits, ``.``, ``+`` and ``-`` to one
space) and cut into sentences: at ``. ! ? ;`` before white space or the end, at blank lines, after list
marks.  A single line end may end a sentence or lie within one, so both wrapped texts and one sentence
a line are read.  The known licence sentences among them give the text's sequence of sentence
identifiers.  Ordered rules then match runs of identifiers, those of more sentences first; what a
rule has matched no later rule sees, so a three-clause licence is not also found as a two-clause one.

Known sentences are grants, made by rule from phrases and licence names, sentences of common
licence texts, and notices, headers, titles and SPDX lines (these the SQL does not know, nor sentences
over several lines).  Holders' and programs' names in them may be any.  All work is in DataFrame
expressions over whole texts; texts without any word that every known sentence has one of are not cut.

Cases: null and empty texts have no identifiers and category ``none``; repeated sentences are listed
each time, licences once; repeated rows are scanned alike; empty input gives empty output; other
columns travel along unless they bear the name of an added column, which is then replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Names of licences, and phrases that grant one.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "MIT": ["MIT License", "Expat License"],
    "ISC": ["ISC License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL version 2", "GPL-2.0 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL version 3", "GPL-3.0 license"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
GRANTS = ["Licensed under", "This work is licensed under", "This software is licensed under", "This file is licensed under",
          "Released under license", "Released under", "Distributed under license", "Distributed under"]
#: Sentences of licence texts by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
                 "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
                 "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
             "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission",
    "reserved": "All rights reserved",
}
#: Further wordings by identifier; ``|`` is a place where the text may have a sentence end.
_CC = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial",
       "CC-BY-ND-4.0": "Attribution-NoDerivatives"}
NOTICES = {
    "mit-notice": ["The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or "
                   "substantial portions of the Software"],
    "isc-grant": [f"Permission to use, copy, modify, and{way} distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies" for way in ("", "/or")],
    "grant-Apache-2.0": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                         "The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\")"],
    "grant-MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v|2.0"],
    "grant-GPL-2.0": ["GNU General Public License Version 2, June 1991"],
    "grant-GPL-3.0": ["GNU General Public License Version 3, 29 June 2007"],
    "grant-LGPL-2.1": ["GNU Lesser General Public License Version 2.1, February 1999"],
    "grant-LGPL-3.0": ["GNU Lesser General Public License Version 3, 29 June 2007"],
    "grant-AGPL-3.0": ["GNU Affero General Public License Version 3, 19 November 2007"],
    **{f"grant-{k}": ["By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
                      f"Creative Commons {v} 4.0 International Public License (\"Public License\")"] for k, v in _CC.items()},
}
for _name, _family, _version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
                                 ("AGPL-3.0", "Affero ", "3")):
    _free = "This program is free software|you can redistribute it and/or modify it under the terms of"
    _gnu, _fsf = f"the GNU {_family}General Public License", "as published by the Free Software Foundation"
    for _later in ("", "|or (at your option) any later version"):
        NOTICES[f"grant-{_name}"] += [
            f"{_free} {_gnu} {_fsf}|either version {_version} of the License{_later}", f"{_free} {_gnu} {_fsf}|version {_version} of the License{_later}",
            f"{_free} {_gnu} version {_version} {_fsf}{_later}", f"{_free} version {_version} of {_gnu} {_fsf}{_later}"]
for _name in ("Apache-2.0", "MPL-2.0"):
    NOTICES[f"grant-{_name}"] += [f"{_grant} the {_form} (the \"License\")" for _grant in GRANTS for _form in NAMES[_name]]
SPDX = "spdx-license-identifier"
#: Wordings with a name in them, and the known sentence (or its beginning) that they stand for.
_ANY = "[a-z0-9.+ ZS-]"
SLOTS = [
    (rf"neither the name of {_ANY}{{1,200}}?[ ZS]nor the names of (?:its|their) contributors may be used to endorse", "neither the name of the "
     "copyright holder nor the names of its contributors may be used to endorse"),
    (rf"neither the names? of {_ANY}{{1,200}}? may be used to endorse or promote products derived from this software without specific prior "
     "written permission", SENTENCES["bsd-names"]),
    (rf"the names? of {_ANY}{{1,200}}? may not be used to endorse or promote products derived from this software without specific prior written "
     "permission", SENTENCES["bsd-names"]),
    (r"[a-z0-9.+ -]{1,80}? is free software", "this program is free software"),
]
#: Ordered rules: runs of identifiers and the licence they show.
RULES = [
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("isc-grant", "as-is"), "ISC"),
    (("isc-grant",), "ISC"),
    *(((f"grant-{name}",), name) for name in NAMES),
    (("reserved",), "all-rights-reserved"),
]
#: Categories from the strictest on.
CATEGORIES = {
    "reserved": ["all-rights-reserved"], "noncommercial": ["CC-BY-NC-4.0"], "noderivatives": ["CC-BY-ND-4.0"],
    "copyleft": ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0"],
    "permissive": ["Apache-2.0", "MIT", "ISC", "BSD-3-Clause", "BSD-2-Clause", "CC0-1.0", "CC-BY-4.0"],
}
#: Every known sentence has one of these words, or a part of one.
WORDS = "licens|released|distributed|permission|redistribution|warranty|reserved"
ADDED = ("sentence_ids", "licenses", "category")


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9.+-]+", " ", sentence.lower()).strip(" .+-")


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier."""
    out = {normalised(s): k for k, s in SENTENCES.items()}
    for name, forms in NAMES.items():
        for form in forms:
            for grant in GRANTS:
                for the in ("", "the "):
                    out[normalised(f"{grant} {the}{form}")] = f"grant-{name}"
    return out


def more_sentences() -> dict[str, str]:
    """Normalised wording that is not among the known sentences, ``|`` being kept, to identifier."""
    out = {"|".join(normalised(p) for p in form.split("|")): k for k, forms in NOTICES.items() for form in forms}
    spdx = {f"{SPDX} {normalised(name)}{end}": f"grant-{name}" for name in NAMES for end in ("", "+", "-only", "-or-later")}
    return {k: v for k, v in (out | spdx).items() if k not in known_sentences()}


def wrapped(sentence: str) -> str:
    """The pattern of a normalised sentence that line ends may lie in."""
    return re.escape(sentence).replace(r"\ ", "[ Z]").replace(r"\|", "[ ZS]")


def plain_sentences(text: Column) -> Column:
    """The normalised text; ``S`` is a sentence end, ``Z`` a single line end."""
    text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for pattern, new in ((r"(?<![.!?;])[.!?;]++(?:[\x20\x09-\x0D]++|\z)", "S"), (r"\x0D?\x0A|\x0D", "L"),
                         (r"(?<![^SL])[\x20\x09*#/]*+\(?(?:[0-9]{1,2}|[a-z])\)[\x20\x09]++", "LL"), ("[^a-z0-9.+SL-]++", " "),
                         # white space and dots around ends go; a blank line is a sentence end
                         ("(?<![ .+SL-])[ .+-]*+L[ .+-]*+(?![SL])", "Z"), ("(?<![ .+SL-])[ .+-]*+[SL][SL .+-]*+", "S")):
        text = F.regexp_replace(text, pattern, new)
    text = F.btrim(text, F.lit(" .+-"))
    for pattern, standard in SLOTS:
        text = F.regexp_replace(text, f"(?<![^SZ]){re.sub(r'(?<![+.]) (?!Z)', '[ Z]', pattern)}(?![a-z0-9])", normalised(standard))
    return text


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences in the order of the text."""
    table_ = known_sentences() | more_sentences()
    forms = sorted((s for s in table_ if not s.startswith(SPDX)), key=lambda s: (-len(s), s))
    named = sorted((s[len(SPDX) + 1:] for s in table_ if s.startswith(SPDX)), key=lambda s: (-len(s), s))
    pattern = (rf"((?<![^SZ])(?:{'|'.join(map(wrapped, forms))})(?![^SZ])"
               rf"|(?:(?<![^SZ]){SPDX} |\G(?: with [a-z0-9.+-]+)? (?:or|and) )(?:{'|'.join(map(re.escape, named))})(?![^SZ ]))")
    known = F.create_map(*[F.lit(x) for s, k in table_.items() for x in (s.replace("|", " "), k)])  # some hundred entries
    found = F.transform(F.regexp_extract_all(plain_sentences(text), F.lit(pattern), F.lit(1)), lambda s: F.try_element_at(
        known, F.regexp_replace(F.translate(s, "ZS", "  "), "^(?: with [a-z0-9.+-]+)? (?:or|and) ", f"{SPDX} ")))
    return F.when(text.rlike(f"(?i){WORDS}"), F.array_compact(found)).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The documents with ``sentence_ids`` (array), ``licenses`` (array, in rule order) and ``category``."""
    docs = docs.drop(*ADDED).withColumn("sentence_ids", sentence_ids(F.coalesce("text", F.lit(""))))
    docs = docs.withColumn("_run", F.array_join(F.transform("sentence_ids", lambda k: F.concat(F.lit("<"), k, F.lit(">"))), ""))
    for i, (run, _) in enumerate(RULES):
        pattern = F.lit("".join(f"<{k}>" for k in run))
        docs = docs.withColumn(f"_hit{i}", F.contains("_run", pattern)).withColumn(
            "_run", F.when(F.col(f"_hit{i}"), F.replace("_run", pattern, F.lit("#"))).otherwise(F.col("_run")))
    hits = [F.when(F.col(f"_hit{i}"), F.lit(name)) for i, (_, name) in enumerate(RULES)]
    docs = docs.withColumn("licenses", F.array_distinct(F.array_compact(F.array(*hits))))
    category = F.lit("none")
    for name, members in reversed(CATEGORIES.items()):
        category = F.when(F.arrays_overlap("licenses", F.array(*[F.lit(m) for m in members])), name).otherwise(category)
    return docs.withColumn("category", category).drop("_run", *[f"_hit{i}" for i in range(len(RULES))])


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_known"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"), "category")


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(k)})" for s, k in known_sentences().items())
    run, hits, steps = "run0", [], []
    for i, (ids, name) in enumerate(RULES):
        pattern = q("".join(f"<{k}>" for k in ids))
        steps.append(f"r{i + 1} AS (SELECT *, contains(run{i}, {pattern}) AS h{i}, replace(run{i}, {pattern}, '#') AS run{i + 1} FROM r{i})")
        hits.append(f"CASE WHEN h{i} THEN {q(name)} END")
    order = ", ".join(q(x) for x in dict.fromkeys(n for _, n in RULES))
    cases = " ".join(f"WHEN len(list_intersect(l, [{', '.join(map(q, m))}])) > 0 THEN {q(c)}" for c, m in CATEGORIES.items())
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT rn, unnest(string_split_regex(text, '[.!?;]+([\\x20\\x09-\\x0D]+|$)|[\\x0A\\x0D]+')) AS sentence,
             generate_subscripts(string_split_regex(text, '[.!?;]+([\\x20\\x09-\\x0D]+|$)|[\\x0A\\x0D]+'), 1) AS i FROM d),
k AS (SELECT rn, i, id FROM s JOIN known ON known.sentence =
      trim(regexp_replace(translate(s.sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.+-]+', ' ', 'g'), ' .+-')),
r0 AS (SELECT d.rn, d.doc_id, count(id) AS n_known, coalesce(string_agg(id, ',' ORDER BY i), '') AS sentence_ids,
              coalesce(string_agg('<' || id || '>', '' ORDER BY i), '') AS run0 FROM d LEFT JOIN k USING (rn) GROUP BY d.rn, d.doc_id),
{", ".join(steps)},
l AS (SELECT doc_id, n_known, sentence_ids, list_filter([{', '.join(hits)}], lambda x: x IS NOT NULL) AS l FROM r{len(RULES)})
SELECT doc_id, n_known, sentence_ids, array_to_string(list_filter([{order}], lambda x: list_contains(l, x)), ',') AS licenses,
       CASE {cases} ELSE 'none' END AS category FROM l
"""


SQL = _sql()
