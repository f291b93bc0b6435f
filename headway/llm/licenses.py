"""License scans by sentence rules, in DataFrame functions alone.

Texts are cut into sentences, which are normalised to words. A table maps known license sentences to identifiers;
the identifiers that a text holds, in order, are matched against rules, each the ordered sentences of one license notice.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import let

# The known sentences, as licenses and common notices have them.
SENTENCES = {
    "mit_ref": "Released under the MIT License.",
    "mit_ref2": "Licensed under the MIT License.",
    "mit_ref3": "This project is licensed under the MIT License.",
    "mit_title": "The MIT License (MIT)",
    "mit_title2": "MIT License",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_as_is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit_liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache_ref": "Licensed under the Apache License, Version 2.0.",
    "apache_ref2": "Released under the Apache License, Version 2.0.",
    "apache_head": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache_comply": "you may not use this file except in compliance with the License.",
    "apache_obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache_unless": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3_ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3_ref2": "Licensed under the GNU General Public License, version 3.",
    "gpl2_ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3_later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2_free": "This program is free software;",
    "gpl2_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2_either": "either version 2 of the License, or (at your option) any later version.",
    "lgpl3_later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl21_free": "This library is free software;",
    "lgpl21_terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21_either": "either version 2.1 of the License, or (at your option) any later version.",
    "agpl3_later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl_hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl_see": "See the GNU Lesser General Public License for more details.",
    "agpl_see": "See the GNU Affero General Public License for more details.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl_see": "See the GNU General Public License for more details.",
    "gpl_received": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl3_ref": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3_ref": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd_ref": "Released under the BSD License.",
    "mpl2_form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl11_subject": 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License");',
    "mpl2_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl2_terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense_free": "This is free and unencumbered software released into the public domain.",
    "unlicense_anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib_as_is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib_liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl_grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "cc_by_nc_4": "Licensed under CC BY-NC 4.0.",
    "cc_by_4": "Licensed under CC BY 4.0.",
    "cc_by_sa_4": "Licensed under CC BY-SA 4.0.",
    "cc0": "Licensed under CC0 1.0.",
    "proprietary": "All rights reserved.",
}

# Identifiers of the tag format that a line "SPDX-License-Identifier: ..." may have.
TAGS = ("MIT", "MIT-0", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "EPL-1.0", "EPL-2.0", "MPL-1.1", "MPL-2.0", "EUPL-1.2")
TAGS += tuple(f"{name}-{end}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("only", "or-later"))
SENTENCES |= {f"spdx_{tag}": f"SPDX-License-Identifier: {tag}" for tag in TAGS}

# The rules. A rule holds where its sentences stand in this order, with no other known sentence between them.
RULES = (
    ("MIT", "text", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("MIT", "title", ("mit_title",)),
    ("MIT", "title", ("mit_title2",)),
    ("MIT", "reference", ("mit_ref",)),
    ("MIT", "reference", ("mit_ref2",)),
    ("MIT", "reference", ("mit_ref3",)),
    ("ISC", "text", ("isc_grant",)),
    ("Apache-2.0", "notice", ("apache_head", "apache_comply", "apache_obtain", "apache_unless", "apache_see")),
    ("Apache-2.0", "reference", ("apache_ref",)),
    ("Apache-2.0", "reference", ("apache_ref2",)),
    ("GPL-3.0-or-later", "notice", ("gpl3_later", "gpl_hope", "gpl_see", "gpl_received")),
    ("GPL-3.0", "reference", ("gpl3_ref",)),
    ("GPL-3.0", "reference", ("gpl3_ref2",)),
    ("GPL-2.0", "reference", ("gpl2_ref",)),
    ("LGPL-3.0", "reference", ("lgpl3_ref",)),
    ("AGPL-3.0", "reference", ("agpl3_ref",)),
    ("BSD-3-Clause", "text", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", "text", ("bsd_grant", "bsd_source", "bsd_binary", "mit_as_is")),
    ("BSD", "reference", ("bsd_ref",)),
    ("MPL-2.0", "notice", ("mpl2_form",)),
    ("GPL-2.0-or-later", "notice", ("gpl2_free", "gpl2_terms", "gpl2_either", "gpl_hope", "gpl_see", "gpl_received")),
    ("LGPL-3.0-or-later", "notice", ("lgpl3_later", "lgpl_hope", "lgpl_see")),
    ("LGPL-2.1-or-later", "notice", ("lgpl21_free", "lgpl21_terms", "lgpl21_either", "lgpl_hope", "lgpl_see")),
    ("AGPL-3.0-or-later", "notice", ("agpl3_later", "gpl_hope", "agpl_see")),
    ("MPL-2.0", "full notice", ("mpl2_form", "mpl2_copy")),
    ("MPL-1.1", "notice", ("mpl11_subject",)),
    ("EPL-2.0", "notice", ("epl2_terms",)),
    ("Unlicense", "text", ("unlicense_free", "unlicense_anyone")),
    ("Zlib", "text", ("zlib_as_is", "zlib_liable", "zlib_grant")),
    ("BSL-1.0", "text", ("bsl_grant",)),
    ("CC-BY-NC-4.0", "reference", ("cc_by_nc_4",)),
    ("CC-BY-4.0", "reference", ("cc_by_4",)),
    ("CC-BY-SA-4.0", "reference", ("cc_by_sa_4",)),
    ("CC0-1.0", "reference", ("cc0",)),
    *((tag, "tag", (f"spdx_{tag}",)) for tag in TAGS),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every known sentence has one of these in it; a text without any needs no cutting.
MARKS = "licen|permi|redistrib|free software|warrant|liable|copyright|rights reserved|mozilla|mpl|this program|this library|unencumbered|anyone is free"
#: Sentences end at these before white space, and at line ends. The point of "v. 2.0" ends none.
END = r"([.!?;])[ \t\r]+"
VERSION = r"((?:^|[^A-Za-z0-9])[vV])\.([ \t\r\n]+[0-9])"
BLANK = r"[ \t\r]*\n[ \t\r]*\n[ \t\r\n]*"
#: Stand for a cut between sentences, and for one between lines of a sentence; texts hardly hold them, and one that does is cut there.
CUT, LINE = "\x01", "\x02"


def normalised(sentence: str) -> str:
    """Words of ASCII letters and digits in lower case, one space apart."""
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


@lru_cache(maxsize=1)
def known() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out: dict[str, str] = {}
    for name, sentence in SENTENCES.items():
        whole = normalised(sentence)
        pieces = [x for x in re.split(END, re.sub(VERSION, r"\1\2", sentence)) if normalised(x)]
        if whole in out or len(pieces) > 1 or "\n" in sentence or not re.search(MARKS, sentence.lower()):
            raise ValueError(f"{name} is known already, is more than one sentence, or has none of the marks")
        out[whole] = name
    return out


def _sequence(text: Column) -> Column:
    """Identifiers of the known sentences, in order."""
    table = F.create_map(*(F.lit(x) for pair in known().items() for x in pair))
    firsts = sorted({s.split(" ")[0] for s in known()})
    longest = max(len(s.split(" ")) for s in known())  # more lines than that are no known sentence, so a long run of lines costs no more a line
    plain: Callable[[Column], Column] = lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))
    name: Callable[[Column], Column] = lambda s: F.try_element_at(table, s)

    flowing = F.regexp_replace(F.regexp_replace(text, VERSION, "$1$2"), BLANK, CUT)
    sentences = F.split(F.regexp_replace(F.replace(flowing, F.lit("\n"), F.lit(LINE)), r"([.!?;])[ \t\r\x02]+", "$1" + CUT), CUT, -1)

    def of_lines(lines: Column) -> Column:
        """The whole is known; or else its last lines together, as many as make a known sentence, and known lines before that; or else known lines."""
        opens = lambda x, i: (F.size(lines) - i <= longest) & F.substring_index(x, " ", 1).isin(*firsts)
        tail: Callable[[Column], Column] = lambda i: name(F.array_join(F.slice(lines, i, F.size(lines)), " "))
        starts = F.filter(F.transform(lines, lambda x, i: F.when(opens(x, i), i + 1)), lambda i: i.isNotNull())
        known_tails = F.filter(F.transform(starts, lambda i: F.struct(i.alias("at"), tail(i).alias("name"))), lambda t: t["name"].isNotNull())
        single = lambda some: F.filter(F.transform(some, name), lambda x: x.isNotNull())
        begun = let(F.try_element_at(known_tails, F.lit(1)), lambda t: F.when(t.isNotNull(), F.concat(single(F.slice(lines, 1, t["at"] - 1)), F.array(t["name"]))).otherwise(single(lines)))
        return let(name(F.array_join(lines, " ")), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(begun))

    pieces = F.transform(sentences, lambda s: F.filter(F.transform(F.split(s, LINE), plain), lambda x: x != ""))
    return F.flatten(F.transform(pieces, lambda lines: let(lines, of_lines)))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append ``license_sentences`` (identifiers in order) and ``licenses`` (array of license and rule kind).

    A text is cut into sentences at sentence ends and blank lines. A sentence may run over lines; one that isn't known as a whole is looked at by
    lines: a known sentence may begin at a line within it and run to its end, and single lines may be known, such as titles. So a title line,
    a wrapped notice and lines without points are found in one text, in their order. A rule counts once however
    often it holds, in the order of RULES. Null and empty texts have none. All rows and columns stay, but two of
    these names, which are replaced; there is no shuffle, and whole texts are read.
    """
    empty = F.array().cast("array<string>")
    found = F.when(F.coalesce(F.col(text).rlike("(?i)" + MARKS), F.lit(False)), _sequence(F.col(text))).otherwise(empty)
    listed = docs.withColumn("license_sentences", found)
    row = F.concat(F.lit("|"), F.array_join("license_sentences", "|"), F.lit("|"))
    table = F.array(*(F.struct(F.lit(name).alias("license"), F.lit(kind).alias("rule"), F.lit("|" + "|".join(ids) + "|").alias("ids")) for name, kind, ids in RULES))
    hits = F.array_distinct(F.transform(F.filter(table, lambda r: F.contains(row, r["ids"])), lambda r: F.struct(r["license"].alias("license"), r["rule"].alias("rule"))))
    return listed.withColumn("licenses", hits)


def oracle_sql() -> str:
    """The same over rows of sentences and lines, from the fixed values alone: doc_id, n_known, sentences, licenses."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    plain = lambda s: f"trim(regexp_replace(translate({s}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    given = ", ".join(f"({quote(name)}, {quote(sentence)})" for name, sentence in SENTENCES.items())
    rules = ", ".join(f"({n}, {quote(name)}, {quote(kind)}, {quote('|' + '|'.join(ids) + '|')})" for n, (name, kind, ids) in enumerate(RULES))
    return f"""
WITH k AS (SELECT name, {plain("sentence")} AS s FROM (VALUES {given}) v(name, sentence)
), t AS (
  SELECT doc_id, regexp_replace(regexp_replace(text, '{VERSION}', '\1\2', 'g'), '{BLANK}', chr(1), 'g') AS x FROM documents WHERE regexp_matches(text, '(?i){MARKS}')
), cut AS (
  SELECT doc_id, string_split(regexp_replace(replace(x, chr(10), chr(2)), '([.!?;])[ \t\r\x02]+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM t
), se AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM cut
), li AS (SELECT doc_id, i, list_filter(list_transform(string_split(s, chr(2)), lambda y: {plain("y")}), lambda y: y <> '') AS ls FROM se
), ln AS (SELECT doc_id, i, unnest(ls) AS line, generate_subscripts(ls, 1) AS j, ls FROM li WHERE len(ls) > 0
), tails AS (
  SELECT ln.doc_id, ln.i, ln.j, k.name FROM ln JOIN k ON k.s = array_to_string(ls[j:], ' ')
  WHERE j = 1 OR len(ls) - j < (SELECT max(len(string_split(s, ' '))) FROM k)
), f AS (SELECT doc_id, i, min(j) AS j, arg_min(name, j) AS name FROM tails GROUP BY ALL
), hits AS (
  SELECT doc_id, i, j, name FROM f
  UNION ALL SELECT ln.doc_id, ln.i, ln.j, k.name FROM ln JOIN k ON k.s = ln.line LEFT JOIN f ON f.doc_id = ln.doc_id AND f.i = ln.i WHERE f.j IS NULL OR ln.j < f.j
), ids AS (SELECT doc_id, list(name ORDER BY i, j) AS ids FROM hits GROUP BY doc_id
), r AS (SELECT * FROM (VALUES {rules}) v(n, license, kind, ids)
), found AS (
  SELECT doc_id, license || ':' || kind AS hit, min(n) AS n FROM ids JOIN r ON contains('|' || array_to_string(ids.ids, '|') || '|', r.ids) GROUP BY ALL
), listed AS (SELECT doc_id, string_agg(hit, ',' ORDER BY n) AS licenses FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(ids), 0) AS INTEGER) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentences, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN ids ON ids.doc_id = d.doc_id LEFT JOIN listed ON listed.doc_id = d.doc_id
"""
