"""Licence scan: known sentences become identifiers, identifier sequences are matched with ordered rules.

A text is read twice: by line, where a line end closes a sentence, and by flow, where lines are joined first, so
that a wrapped sentence is whole. In both readings ``.``, ``!``, ``?`` or ``;`` with white space after it closes a
sentence, except for the dot of ``v. 2``, which a version follows. A sentence is normalised (A-Z to lower case, every run of other characters than a-z and 0-9 to one blank)
and looked up; unknown sentences leave no trace. A rule matches if its identifiers stand one after the other in
the sequence of either reading.

Only built-in functions are used, and no row leaves its task: there is no join and no shuffle.

Defined cases: a null or empty text has no sentence and no licence; a sentence that stands several times counts
each time; equal rows give equal rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licences and of the usual notices, as they are written there.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is '
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "apache-limits": (
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the '
        'Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
    ),
    "mit-grant-notice": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the '
        'Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
        'conditions: The above copyright notice and this permission notice shall be included in all copies or '
        'substantial portions of the Software.'
    ),
    "mit-keep": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "mit-as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        'TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    ),
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl2-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "gpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "gpl-details": "See the GNU General Public License for more details.",
    "bsd-redistribute": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright to this work.",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-cc-by": "SPDX-License-Identifier: CC-BY-4.0",
    "lgpl21-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."
    ),
    "lgpl-warranty": (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "agpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "epl-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "unlicense-more": "For more information, please refer to <https://unlicense.org/>",
    "unlicense-more-http": "For more information, please refer to <http://unlicense.org/>",
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "spdx-agpl3": "SPDX-License-Identifier: AGPL-3.0-only",
    "spdx-agpl3-later": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "spdx-boost": "SPDX-License-Identifier: BSL-1.0",
    "spdx-bsd2": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-cc-by-sa": "SPDX-License-Identifier: CC-BY-SA-4.0",
    "spdx-cc0": "SPDX-License-Identifier: CC0-1.0",
    "spdx-epl": "SPDX-License-Identifier: EPL-2.0",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl2-later": "SPDX-License-Identifier: GPL-2.0-or-later",
    "spdx-gpl3-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-lgpl21": "SPDX-License-Identifier: LGPL-2.1-only",
    "spdx-lgpl21-later": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "spdx-lgpl3": "SPDX-License-Identifier: LGPL-3.0-only",
    "spdx-lgpl3-later": "SPDX-License-Identifier: LGPL-3.0-or-later",
    "spdx-mpl": "SPDX-License-Identifier: MPL-2.0",
    "spdx-unlicense": "SPDX-License-Identifier: Unlicense",
    "spdx-zlib": "SPDX-License-Identifier: Zlib",
}
# A licence and the sentences, in order, that state it.
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-header", "apache-comply"]),
    ("Apache-2.0", ["apache-as-is", "apache-limits"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-4.0", ["spdx-cc-by"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-work"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-details"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-details"]),
    ("ISC", ["isc-grant"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant", "mit-keep", "mit-as-is"]),
    ("MIT", ["mit-grant-notice", "mit-as-is"]),
    ("MIT", ["spdx-mit"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("AGPL-3.0", ["spdx-agpl3"]),
    ("AGPL-3.0-or-later", ["agpl3-later", "gpl-warranty", "agpl-details"]),
    ("AGPL-3.0-or-later", ["spdx-agpl3-later"]),
    ("BSD-2-Clause", ["spdx-bsd2"]),
    ("BSL-1.0", ["boost-notice"]),
    ("BSL-1.0", ["spdx-boost"]),
    ("CC-BY-SA-4.0", ["spdx-cc-by-sa"]),
    ("CC0-1.0", ["spdx-cc0"]),
    ("EPL-2.0", ["epl-notice"]),
    ("EPL-2.0", ["spdx-epl"]),
    ("GPL-2.0", ["spdx-gpl2"]),
    ("GPL-2.0-or-later", ["spdx-gpl2-later"]),
    ("GPL-3.0-or-later", ["spdx-gpl3-later"]),
    ("ISC", ["spdx-isc"]),
    ("LGPL-2.1", ["spdx-lgpl21"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "lgpl-warranty", "lgpl-details"]),
    ("LGPL-2.1-or-later", ["spdx-lgpl21-later"]),
    ("LGPL-3.0", ["spdx-lgpl3"]),
    ("LGPL-3.0-or-later", ["spdx-lgpl3-later"]),
    ("MPL-2.0", ["spdx-mpl"]),
    ("Unlicense", ["unlicense-more"]),
    ("Unlicense", ["unlicense-more-http"]),
    ("Unlicense", ["spdx-unlicense"]),
    ("Zlib", ["zlib-grant"]),
    ("Zlib", ["spdx-zlib"]),
]
# only sentences with one of these are looked up; the others need no normalising
KEYWORDS = ["licen", "copyright", "permission", "warrant", "redistribut"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"([.!?;])[ \t\r\n]+"
# the same without the dot between a "v" and its number
WHOLE_END = r"([!?;]|(?<![^A-Za-z0-9][vV])\.|\.(?![ \t\r\n]+[0-9]))[ \t\r\n]+"


def sentence_parts(text: str, end: str = SENTENCE_END) -> list[str]:
    """The normalised sentences of a text read by flow that have a keyword."""
    flow = re.sub(end, "\\1\n", re.sub(r"[\r\n]+", " ", text))
    parts = [" ".join(re.findall("[a-z0-9]+", s.lower())) for s in flow.split("\n")]
    return [p for p in parts if any(k in p for k in KEYWORDS)]


def known_sentences() -> dict[str, list[int]]:
    """Position of every normalised sentence part, counted from 1, by the name of the sentence."""
    order: dict[str, int] = {}
    ids: dict[str, list[int]] = {}
    for name, text in SENTENCES.items():
        ids[name] = [order.setdefault(p, len(order) + 1) for p in sentence_parts(text)]
    known_sentences.parts = list(order)  # type: ignore[attr-defined]
    return ids


IDS = known_sentences()
PARTS: list[str] = known_sentences.parts  # type: ignore[attr-defined]


def whole_parts() -> list[str]:
    """``PARTS`` as they are looked up, with the version after a "v."."""
    whole = {
        a: b for t in SENTENCES.values() for a, b in zip(sentence_parts(t), sentence_parts(t, WHOLE_END), strict=True)
    }
    return [whole[p] for p in PARTS]


WHOLE: list[str] = whole_parts()


def rule_text(names: list[str]) -> str:
    """A rule as it stands in the text form of a sequence."""
    return " " + "  ".join(str(k) for n in names for k in IDS[n]) + " "


def _sequence(text: Column) -> Column:
    """The known sentences of a text with one sentence end per line, as `` 3  17  4 ``."""
    marked = F.regexp_replace(text, WHOLE_END, "$1\n")
    near = F.filter(
        F.split(marked, "\n"), lambda u: F.lower(u).rlike("|".join(KEYWORDS))
    )
    plain = F.transform(
        near, lambda u: F.trim(F.regexp_replace(F.translate(u, UPPER, LOWER), "[^a-z0-9]+", " "))
    )
    known = F.array(*[F.lit(p) for p in WHOLE])
    ids = F.filter(F.transform(plain, lambda u: F.array_position(known, u)), lambda k: k > 0)
    return F.array_join(F.transform(ids, lambda k: F.concat(F.lit(" "), k.cast("string"), F.lit(" "))), "")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_sentences`` (known ones, of the reading with more), ``licenses`` (sorted, ``;``)."""
    text = F.coalesce("text", F.lit(""))
    small = F.lower(text)
    hit = small.contains(KEYWORDS[0])
    for k in KEYWORDS[1:]:
        hit = hit | small.contains(k)
    read = docs.select(
        "doc_id",
        F.when(hit, _sequence(text)).otherwise("").alias("by_line"),
        F.when(hit, _sequence(F.regexp_replace(text, r"[\r\n]+", " "))).otherwise("").alias("by_flow"),
    )
    found = []
    for name in sorted({n for n, _ in RULES}):
        own = [rule_text(s) for n, s in RULES if n == name]
        met = F.lit(False)
        for r in own:
            met = met | F.col("by_line").contains(r) | F.col("by_flow").contains(r)
        found.append(F.when(met, F.lit(name)))

    def count(c: str) -> Column:
        return F.regexp_count(F.col(c), F.lit("[0-9]+"))

    return read.select(
        "doc_id", F.greatest(count("by_line"), count("by_flow")).cast("long").alias("n_sentences"),
        F.array_join(F.array_compact(F.array(*found)), ";").alias("licenses"),
    )


def oracle_sql() -> str:
    """The same scan in DuckDB's SQL."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def sequence(text: str) -> str:
        # without look-behind: the dot between a "v" and its number becomes a comma, which ends no sentence
        joined = f"regexp_replace({text}, '([^A-Za-z0-9][vV])\\.([ \\t\\r\\n]+[0-9])', '\\1,\\2', 'g')"
        marked = f"regexp_replace({joined}, '([.!?;])[ \\t\\r\\n]+', E'\\\\1\\n', 'g')"
        plain = (
            f"list_transform(string_split({marked}, chr(10)), lambda u: "
            f"trim(regexp_replace(translate(u, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')))"
        )
        known = "[" + ", ".join(quoted(p) for p in WHOLE) + "]"
        ids = f"list_filter(list_transform({plain}, lambda u: coalesce(list_position({known}, u), 0)), lambda k: k > 0)"
        return f"coalesce(array_to_string(list_transform({ids}, lambda k: ' ' || k || ' '), ''), '')"

    found = []
    for name in sorted({n for n, _ in RULES}):
        tests = " OR ".join(
            f"contains(by_line, {quoted(rule_text(s))}) OR contains(by_flow, {quoted(rule_text(s))})"
            for n, s in RULES if n == name
        )
        found.append(f"CASE WHEN {tests} THEN {quoted(name)} END")
    text = "coalesce(text, '')"
    flow = "regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g')"
    return f"""
WITH seq AS (
  SELECT doc_id, {sequence(text)} AS by_line, {sequence(flow)} AS by_flow FROM documents
)
SELECT doc_id,
  CAST(greatest(len(regexp_extract_all(by_line, '[0-9]+')), len(regexp_extract_all(by_flow, '[0-9]+'))) AS BIGINT)
    AS n_sentences,
  coalesce(array_to_string(list_filter([{", ".join(found)}], lambda x: x IS NOT NULL), ';'), '') AS licenses
FROM seq
"""
