"""Licence scans: full licence texts, wrapped lines, rule order, and edge cases."""

import duckdb

from shelfspark.llm import licenses
from shelfspark.llm.licenses import KNOWN, RULES, SENTENCES, TRIGGERS, license_scan, license_sql, normalised


def scan(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (r["licenses"], r["kind"], r["n_left"]) for r in license_scan(df).collect()}


def test_tables_agree():
    assert all(any(t in s for t in TRIGGERS) for s in KNOWN)
    assert {x for _, xs, _ in RULES for x in xs} == set(SENTENCES)
    assert len(KNOWN) == sum(map(len, SENTENCES.values()))


def full(*names):
    return " ".join(SENTENCES[n][0] for n in names)


def test_licences(spark):
    mit = full("mit_grant", "mit_notice", "software_as_is", "authors_not_liable")
    wrapped = "\n".join(mit[i:i + 70] for i in range(0, len(mit), 70))  # cuts words, so nothing may match
    by_words = mit.replace(" the ", "\nthe ")
    got = scan(spark, mit, by_words, "Some words without an end\nReleased under the MIT License.\nMore words.",
               full("bsd_grant", "bsd_source", "bsd_binary", "bsd_names"), full("bsd_grant", "bsd_source", "bsd_binary"),
               full("gpl3_later", "gpl_no_warranty", "gpl_see", "gpl_received"), full("gpl_see"), "This licence is strange.",
               "Licensed under CC BY-NC 4.0. Released under the MIT License.", "No such thing here.", None, "", wrapped,
               "LICENSED UNDER the  apache license,\tversion 2.0.", full("mpl2"), full("software_as_is", "mit_grant"))
    assert got == {
        0: ("MIT", "permissive", 0), 1: ("MIT", "permissive", 0), 2: ("MIT", "permissive", 0), 3: ("BSD-3-Clause", "permissive", 0),
        4: ("BSD-2-Clause", "permissive", 0), 5: ("GPL-3.0-or-later", "copyleft", 0), 6: ("", "unknown", 1), 7: ("", "unknown", 1),
        8: ("CC-BY-NC-4.0,MIT", "restricted", 0), 9: ("", "none", 0), 10: ("", "none", 0), 11: ("", "none", 0), 12: got[12],
        13: ("Apache-2.0", "permissive", 0), 14: ("MPL-2.0", "copyleft", 0), 15: ("", "unknown", 2)}
    assert "MIT" not in got[12][0]
    header = "\n".join([SENTENCES["apache2_grant"][0], "You may obtain a copy of the License at\n", "    http://www.apache.org/licenses/LICENSE-2.0\n",
                        SENTENCES["apache2_as_is"][0], SENTENCES["apache2_see"][0]])
    assert scan(spark, header) == {0: ("Apache-2.0", "permissive", 0)}


def test_edges_match_sql(spark, edge_docs, no_docs, small_docs):
    assert license_scan(no_docs).count() == 0
    assert license_scan(edge_docs).count() == edge_docs.count()
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    want = sorted(con.sql(license_sql()).fetchall())
    df = license_scan(small_docs)
    assert con.sql(license_sql()).columns == df.columns
    assert sorted(map(tuple, df.collect())) == want
    assert any(r[3] for r in want)


def test_normalised():
    assert normalised("Permission, is (hereby)\n granted:") == "permission is hereby granted"
    assert licenses.MOST_WORDS < 100


def wrapped(sentence, width=76, indent=""):
    import textwrap

    return textwrap.fill(sentence, width, initial_indent="", subsequent_indent=indent)


def test_licences_as_they_are_published(spark):
    """Titles, copyright lines, numbered clauses on lines of their own, wrapped lines, SPDX tags in comments."""
    one = {n: v[0] for n, v in SENTENCES.items()}
    clauses = lambda *names: "\n\n".join(f"{i}. {wrapped(one[n], indent='   ')}" for i, n in enumerate(names, 1))
    end = "\n\n" + wrapped(one["bsd_as_is"] + " " + one["bsd_not_liable"]) + "\n"
    head = "Copyright (c) 2019, Some Person\nAll rights reserved.\n\n" + wrapped(one["bsd_grant"]) + "\n\n"
    mit = "MIT License\n\nCopyright (c) 2021 Some Person\n\n" + "\n\n".join(
        wrapped(x) for x in (one["mit_grant"], one["mit_notice"], one["software_as_is"] + " " + one["authors_not_liable"]))
    lgpl = "\n".join(" * " + x for x in wrapped(one["lgpl21_later"] + "\n").split("\n"))
    got = scan(spark, "BSD 2-Clause License\n\n" + head + clauses("bsd_source", "bsd_binary") + end, head + clauses("bsd_source", "bsd_binary", "bsd_names") + end, mit,
               "// SPDX-License-Identifier: MIT\nint main() { return 0; }", "/* SPDX-License-Identifier: LGPL-2.1-or-later */\n# a licensed thing of no name.",
               lgpl, " ".join(one[n] for n in ("agpl3_later", "gpl_no_warranty", "agpl_see")), wrapped(one["cc0"]), one["epl2"],
               " ".join(one[n] for n in ("zlib_as_is", "zlib_not_liable", "zlib_grant", "zlib_notice")), "Copyright 2020 Someone. All rights reserved.",
               "# SPDX-License-Identifier: Made-Up-1.0", "All rights reserved. Licensed under CC BY-NC 4.0.")
    assert got == {
        0: ("BSD-2-Clause", "permissive", 0), 1: ("BSD-3-Clause", "permissive", 0), 2: ("MIT", "permissive", 0), 3: ("MIT", "permissive", 0),
        4: ("LGPL-2.1-or-later", "copyleft", 1), 5: ("LGPL-2.1-or-later", "copyleft", 0), 6: ("AGPL-3.0-or-later", "copyleft", 0),
        7: ("CC0-1.0", "permissive", 0), 8: ("EPL-2.0", "copyleft", 0), 9: ("Zlib", "permissive", 0), 10: ("Proprietary", "restricted", 0),
        11: ("", "unknown", 1), 12: ("CC-BY-NC-4.0", "restricted", 0)}


def test_published_layouts_match_sql(spark):
    texts = ["Copyright (c) 2019, X\nAll rights reserved.\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions "
             "and the\n   following disclaimer.\n(b) All rights reserved.", "x SPDX-License-Identifier: MIT */ y\nz", "MIT License\n\nCopyright 2020 A", "* All rights reserved."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert sorted(map(tuple, license_scan(df).collect())) == sorted(con.sql(license_sql()).fetchall())
