"""Licence scans by sentence rules.

A text is cut into sentences, each sentence is normalised (lower case, words
separated by one blank) and looked up among known licence sentences. The
document's sequence of sentence identifiers is then matched against ordered
rules: the first rule whose identifiers stand in a row takes them, and the
next rule sees what is left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import let

# Known licence sentences.
SENTENCES = {
    "mit_short": ["Released under the MIT License.", "Licensed under the MIT License.",
                  "This project is licensed under the MIT License.", "This software is released under the MIT License."],
    "mit_grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                  "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit_notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software."],
    "software_as_is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                       "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "authors_not_liable": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
                           "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
                           "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "apache2_short": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                      "This work is licensed under the Apache License, Version 2.0."],
    "apache2_grant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                      "compliance with the License."],
    "apache2_copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                     "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
                     "You may obtain a copy of the License at"],
    "apache2_url": ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"],
    "apache2_as_is": ["Unless required by applicable law or agreed to in writing, software distributed under the License is "
                      "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache2_see": ["See the License for the specific language governing permissions and limitations under the License."],
    "gpl3_short": ["This work is licensed under the GNU General Public License, version 3.",
                   "Licensed under the GNU General Public License, version 3.", "Licensed under the GPL, version 3."],
    "gpl2_short": ["This work is licensed under the GNU General Public License, version 2.",
                   "Licensed under the GNU General Public License, version 2."],
    "gpl3_later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                   "option) any later version."],
    "gpl2_later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                   "option) any later version."],
    "gpl_no_warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl_see": ["See the GNU General Public License for more details."],
    "gpl_received": ["You should have received a copy of the GNU General Public License along with this program."],
    "cc_by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc_by_sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc_by_nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc_by_nd": ["Licensed under CC BY-ND 4.0."],
    "bsd_grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met:"],
    "bsd_source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer."],
    "bsd_binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd_names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                  "products derived from this software without specific prior written permission."],
    "bsd_short": ["Released under the BSD License.", "Licensed under the BSD License."],
    "isc_grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "mpl2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "mit_title": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "bsd2_title": ["BSD 2-Clause License"],
    "bsd3_title": ["BSD 3-Clause License"],
    "bsd_as_is": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                  "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                  "DISCLAIMED."],
    "bsd_not_liable": ["IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
                       "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
                       "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
                       "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                       "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "lgpl21_later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                     "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
                     "option) any later version."],
    "lgpl3_later": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                    "option) any later version."],
    "lgpl_no_warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                         "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "lgpl_see": ["See the GNU Lesser General Public License for more details."],
    "lgpl21_short": ["Licensed under the GNU Lesser General Public License, version 2.1.",
                     "This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "agpl3_later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                    "option) any later version."],
    "agpl_see": ["See the GNU Affero General Public License for more details."],
    "agpl3_short": ["Licensed under the GNU Affero General Public License, version 3.",
                    "This work is licensed under the GNU Affero General Public License, version 3."],
    "cc0": ["Licensed under CC0 1.0.", "This work is licensed under CC0 1.0 Universal.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "epl2": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
             "available at https://www.eclipse.org/legal/epl-2.0/", "Licensed under the Eclipse Public License 2.0."],
    "zlib_as_is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib_not_liable": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib_grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
                   "it and redistribute it freely, subject to the following restrictions:"],
    "zlib_notice": ["This notice may not be removed or altered from any source distribution."],
    "all_rights": ["All rights reserved."],
}

# Short identifiers of licences as they stand in tags, with their kind.
TAGS = {"0BSD": "permissive", "AGPL-3.0-only": "copyleft", "AGPL-3.0-or-later": "copyleft", "Apache-2.0": "permissive", "BSD-2-Clause": "permissive",
        "BSD-3-Clause": "permissive", "BSL-1.0": "permissive", "CC-BY-4.0": "permissive", "CC-BY-NC-4.0": "restricted", "CC-BY-ND-4.0": "restricted",
        "CC-BY-SA-4.0": "copyleft", "CC0-1.0": "permissive", "EPL-2.0": "copyleft", "GPL-2.0-only": "copyleft", "GPL-2.0-or-later": "copyleft",
        "GPL-3.0-only": "copyleft", "GPL-3.0-or-later": "copyleft", "ISC": "permissive", "LGPL-2.1-only": "copyleft", "LGPL-2.1-or-later": "copyleft",
        "LGPL-3.0-only": "copyleft", "LGPL-3.0-or-later": "copyleft", "MIT": "permissive", "MPL-2.0": "copyleft", "Unlicense": "permissive",
        "Zlib": "permissive"}
SENTENCES |= {f"tag {t}": [f"SPDX-License-Identifier {t}"] for t in TAGS}

# Ordered rules (licence, identifiers that stand in a row, kind); longer evidence first.
RULES = [
    ("MIT", ["mit_title", "mit_grant", "mit_notice", "software_as_is", "authors_not_liable"], "permissive"),
    ("MIT", ["mit_grant", "mit_notice", "software_as_is", "authors_not_liable"], "permissive"),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is", "bsd_not_liable"], "permissive"),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_not_liable"], "permissive"),
    ("LGPL-2.1-or-later", ["lgpl21_later", "lgpl_no_warranty", "lgpl_see"], "copyleft"),
    ("LGPL-3.0-or-later", ["lgpl3_later", "lgpl_no_warranty", "lgpl_see"], "copyleft"),
    ("AGPL-3.0-or-later", ["agpl3_later", "gpl_no_warranty", "agpl_see"], "copyleft"),
    ("Zlib", ["zlib_as_is", "zlib_not_liable", "zlib_grant", "zlib_notice"], "permissive"),
    ("Zlib", ["zlib_as_is", "zlib_not_liable", "zlib_grant"], "permissive"),
    ("Apache-2.0", ["apache2_grant", "apache2_copy", "apache2_url", "apache2_as_is", "apache2_see"], "permissive"),
    ("Apache-2.0", ["apache2_grant", "apache2_copy", "apache2_as_is", "apache2_see"], "permissive"),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"], "permissive"),
    ("GPL-3.0-or-later", ["gpl3_later", "gpl_no_warranty", "gpl_see", "gpl_received"], "copyleft"),
    ("GPL-2.0-or-later", ["gpl2_later", "gpl_no_warranty", "gpl_see", "gpl_received"], "copyleft"),
    ("GPL-3.0-or-later", ["gpl3_later", "gpl_no_warranty", "gpl_see"], "copyleft"),
    ("GPL-2.0-or-later", ["gpl2_later", "gpl_no_warranty", "gpl_see"], "copyleft"),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"], "permissive"),
    ("MIT", ["mit_grant", "mit_notice", "software_as_is"], "permissive"),
    ("MIT", ["mit_grant", "mit_notice"], "permissive"),
    ("Apache-2.0", ["apache2_grant"], "permissive"),
    ("GPL-3.0-or-later", ["gpl3_later"], "copyleft"),
    ("GPL-2.0-or-later", ["gpl2_later"], "copyleft"),
    ("ISC", ["isc_grant"], "permissive"),
    ("MPL-2.0", ["mpl2"], "copyleft"),
    ("Unlicense", ["unlicense"], "permissive"),
    ("MIT", ["mit_short"], "permissive"),
    ("Apache-2.0", ["apache2_short"], "permissive"),
    ("GPL-3.0-only", ["gpl3_short"], "copyleft"),
    ("GPL-2.0-only", ["gpl2_short"], "copyleft"),
    ("CC-BY-NC-4.0", ["cc_by_nc"], "restricted"),
    ("CC-BY-ND-4.0", ["cc_by_nd"], "restricted"),
    ("CC-BY-SA-4.0", ["cc_by_sa"], "copyleft"),
    ("CC-BY-4.0", ["cc_by"], "permissive"),
    ("BSD", ["bsd_short"], "permissive"),
    ("LGPL-2.1-or-later", ["lgpl21_later"], "copyleft"),
    ("LGPL-3.0-or-later", ["lgpl3_later"], "copyleft"),
    ("LGPL-2.1-only", ["lgpl21_short"], "copyleft"),
    ("AGPL-3.0-or-later", ["agpl3_later"], "copyleft"),
    ("AGPL-3.0-only", ["agpl3_short"], "copyleft"),
    ("CC0-1.0", ["cc0"], "permissive"),
    ("EPL-2.0", ["epl2"], "copyleft"),
    ("MIT", ["mit_title"], "permissive"),
    ("BSD-2-Clause", ["bsd2_title"], "permissive"),
    ("BSD-3-Clause", ["bsd3_title"], "permissive"),
    *[(t, [f"tag {t}"], kind) for t, kind in TAGS.items()],
    ("Proprietary", ["all_rights"], "restricted"),
]
# A licence of this name counts only where no other was found: a notice that stands above most licences, too.
FALLBACK = "Proprietary"

# Every known sentence has one of these; a sentence without any of them cannot be known.
TRIGGERS = ["licen", "copyright", "warranty", "permission", "redistribution", "rights reserved", "public domain", "liable", "gpl", "source distribution"]

UNKNOWN = "unknown"
CUT = "\x01"
BLANK_LINES = r"\n[ \t\r\f]*\n"
SENTENCE_END = r"([^ \t\n\r\f][\p{L}\p{N})\"][.!?])[ \t\n\r\f]+"
COLON_END = r"([^ \t\n\r\f][\p{L}\p{N})\"]:)[ \t\n\r\f]+([^\p{Ll}])"
NOT_WORD = r"[^\p{L}\p{N}]+"
LIST_NUMBER = r"(?m)^[ \t]*(?:\(?[0-9a-z]{1,2}[.)]|[*-])[ \t]+"
TAG = r"SPDX-License-Identifier:[ \t]*([^\n]*)"
COPYRIGHT_LINE = r"^copyright (c )?[0-9]{4}"


def normalised(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


KNOWN = {normalised(s): name for name, variants in SENTENCES.items() for s in variants}
MOST_WORDS = max(len(s.split()) for s in KNOWN)


def _has_trigger(lowered: Column) -> Column:
    found = F.contains(lowered, F.lit(TRIGGERS[0]))
    for t in TRIGGERS[1:]:
        found = found | F.contains(lowered, F.lit(t))
    return found


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence-like sentences of a text in their order.

    A sentence ends at '.', '!' or '?' before white space (not after a single letter), at ':' before anything but a small
    letter, or at a blank line. Prose
    without punctuation may stand before a licence line, so a known sentence may start at any line
    of the sentence it ends. List numbers at line starts are left out, an SPDX tag is a sentence of its own, and so is what stands
    around it. Copyright lines (with a year) are no evidence and give none. Other sentences with a licence word that are not known
    give 'unknown'; the rest give none.
    """
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def look(lines: Column) -> Column:
        first = F.greatest(F.lit(0), F.size(lines) - MOST_WORDS)
        norm = lambda j: F.btrim(F.regexp_replace(F.lower(F.array_join(F.slice(lines, j + 1, F.size(lines) - j), " ")), NOT_WORD, " "))
        ids = F.filter(F.transform(F.sequence(first, F.size(lines) - 1), lambda j: F.try_element_at(known, norm(j))), lambda x: x.isNotNull())
        notice = norm(F.lit(0)).rlike(COPYRIGHT_LINE)
        return let(ids, lambda a: F.coalesce(F.get(a, F.lit(0)), F.when(notice, F.lit("")).otherwise(F.lit(UNKNOWN))))

    def of_sentence(s: Column) -> Column:
        return let(F.filter(F.split(s, "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")), look)

    clean = F.regexp_replace(F.regexp_replace(text, LIST_NUMBER, ""), TAG, f"{CUT}SPDX-License-Identifier $1{CUT}")
    cut = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean, BLANK_LINES, CUT), SENTENCE_END, "$1" + CUT), COLON_END, "$1" + CUT + "$2")
    licence_like = F.filter(F.split(cut, CUT), lambda s: _has_trigger(F.lower(s)))
    none = F.array().cast("array<string>")
    ids = F.filter(F.transform(licence_like, of_sentence), lambda x: x != "")
    return let(F.lower(text), lambda low: F.when(_has_trigger(low), ids).otherwise(none))


def match_rules(ids: Column) -> Column:
    """Struct (licenses, kinds, n_left) of an identifier sequence: rules in order, each taking every run it matches."""
    mark = lambda xs: "".join(f"<{x}>" for x in xs)
    rules = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(mark(xs)).alias("p"), F.lit(k).alias("k")) for n, xs, k in RULES])
    none = F.array().cast("array<string>")
    start = F.struct(F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "").alias("s"), none.alias("n"), none.alias("k"))

    def step(acc: Column, r: Column) -> Column:
        hit = F.contains(acc["s"], r["p"]) & ((r["n"] != FALLBACK) | (F.size(acc["n"]) == 0))
        return F.struct(F.replace(acc["s"], r["p"], F.lit("|")).alias("s"),
                        F.when(hit, F.concat(acc["n"], F.array(r["n"]))).otherwise(acc["n"]).alias("n"),
                        F.when(hit, F.concat(acc["k"], F.array(r["k"]))).otherwise(acc["k"]).alias("k"))

    end = lambda acc: F.struct(
        F.sort_array(F.array_distinct(acc["n"])).alias("licenses"), acc["k"].alias("kinds"),
        (F.char_length(acc["s"]) - F.char_length(F.replace(acc["s"], F.lit("<"), F.lit("")))).alias("n_left"))
    return F.aggregate(rules, start, step, end)


def license_scan(docs: DataFrame) -> DataFrame:
    """Licences of every document: one row per row of ``docs``, without a shuffle.

    Returns doc_id, n_sentences (licence-like sentences), sentence_ids (joined by blanks), licenses (sorted,
    joined by commas), n_left (sentences no rule took) and kind: 'restricted' over 'copyleft' over
    'permissive', 'unknown' when only unmatched sentences were found, 'none' without any. Null text counts as empty;
    repeated rows give repeated results; other columns are left out; an empty table gives an empty result.
    """
    found = docs.select("doc_id", let(sentence_ids(F.coalesce(F.col("text"), F.lit(""))), lambda ids: F.struct(
        ids.alias("ids"), F.when(F.size(ids) > 0, match_rules(ids)).alias("m"))).alias("_f"))
    ids, m = F.col("_f.ids"), F.col("_f.m")
    has = lambda kind: F.coalesce(F.array_contains(m["kinds"], kind), F.lit(False))
    kind = F.when(F.size(ids) == 0, "none").when(has("restricted"), "restricted").when(has("copyleft"), "copyleft").when(
        has("permissive"), "permissive").otherwise("unknown")
    return found.select(
        "doc_id", F.size(ids).cast("bigint").alias("n_sentences"), F.array_join(ids, " ").alias("sentence_ids"),
        F.coalesce(F.array_join(m["licenses"], ","), F.lit("")).alias("licenses"),
        F.coalesce(m["n_left"], F.lit(0)).cast("bigint").alias("n_left"), kind.alias("kind"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_sql() -> str:
    """DuckDB SQL of ``license_scan`` over documents."""
    lookup = ", ".join(f"({_quoted(s)}, {_quoted(n)})" for s, n in KNOWN.items())
    trigger = lambda c: "(" + " OR ".join(f"contains({c}, {_quoted(t)})" for t in TRIGGERS) + ")"
    steps, hits = [], []
    for i, (name, xs, kind) in enumerate(RULES):
        p = _quoted("".join(f"<{x}>" for x in xs))
        steps.append(f"contains(s{i}, {p}) AS h{i}, replace(s{i}, {p}, '|') AS s{i + 1}")
        h = f"h{i}" if name != FALLBACK else f"(h{i} AND NOT ({' OR '.join(x[2] for x in hits)}))"
        hits.append((f"CASE WHEN {h} THEN {_quoted(name)} END", kind, h))
    any_of = lambda kind: "(" + " OR ".join(h for _, k, h in hits if k == kind) + ")"
    last = f"s{len(RULES)}"
    return f"""
WITH known(sentence, id) AS (VALUES {lookup}),
clean AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '{LIST_NUMBER}', '', 'g'), '{TAG}',
    chr(1) || 'SPDX-License-Identifier \\1' || chr(1), 'g') AS text FROM documents),
cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(regexp_replace(text, '\\n[ \\t\\r\\f]*\\n', chr(1), 'g'),
    '([^ \\t\\n\\r\\f][\\p{{L}}\\p{{N}})"][.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'),
    '([^ \\t\\n\\r\\f][\\p{{L}}\\p{{N}})"]:)[ \\t\\n\\r\\f]+([^\\p{{Ll}}])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS parts FROM clean),
numbered AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS i, parts FROM cut),
licence_like AS (SELECT doc_id, i, list_filter(string_split(parts[i], chr(10)), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS lines
    FROM numbered WHERE {trigger('lower(parts[i])')}),
starts AS (SELECT doc_id, i, lines, unnest(range(1, len(lines) + 1)) AS j FROM licence_like),
looked AS (SELECT doc_id, i, j, trim(regexp_replace(lower(array_to_string(lines[j:], ' ')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS n FROM starts),
hit AS (SELECT doc_id, i, arg_min(id, j) AS id FROM looked JOIN known ON n = sentence GROUP BY doc_id, i),
notice AS (SELECT doc_id, i, bool_or(j = 1 AND regexp_matches(n, '{COPYRIGHT_LINE}')) AS is_notice FROM looked GROUP BY doc_id, i),
ids AS (SELECT doc_id, i, coalesce(id, '{UNKNOWN}') AS id FROM licence_like LEFT JOIN hit USING (doc_id, i) LEFT JOIN notice USING (doc_id, i)
    WHERE id IS NOT NULL OR NOT coalesce(is_notice, false)),
per_doc AS (SELECT doc_id, count(*) AS n, string_agg(id, ' ' ORDER BY i) AS sentence_ids, string_agg('<' || id || '>', '' ORDER BY i) AS s0
    FROM ids GROUP BY doc_id),
ruled AS (SELECT doc_id, n, sentence_ids, s0, {', '.join(steps)} FROM per_doc)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids,
    coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(h for h, _, _ in hits)}], lambda x: x IS NOT NULL))), ','), '') AS licenses,
    coalesce(length({last}) - length(replace({last}, '<', '')), 0)::BIGINT AS n_left,
    CASE WHEN n IS NULL THEN 'none' WHEN {any_of('restricted')} THEN 'restricted' WHEN {any_of('copyleft')} THEN 'copyleft'
        WHEN {any_of('permissive')} THEN 'permissive' ELSE 'unknown' END AS kind
FROM documents d LEFT JOIN ruled USING (doc_id)""".strip()
