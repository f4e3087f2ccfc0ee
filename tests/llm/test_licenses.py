from __future__ import annotations

import textwrap
from pathlib import Path

import duckdb
import pytest
from txloom.llm import licenses
from txloom.llm.queries import ORACLE_SQL, op2_license_scan

SF = "/root/testdata/sf0.001"


PUBLISHED = Path("/usr/share/common-licenses")


def found(docs, **options):
    return sorted(tuple(r) for r in licenses.license_matches(docs, **options).collect())


def test_variants_of_one_text(spark, docs_of):
    shouted = "Copyright (c) 2020 Someone\n\n" + licenses.MIT.upper().replace('"', "“").replace("SUBLICENSE", "SUB-LICENCE").replace(" TO DEAL", "\n\tto deal")
    other = licenses.MIT.replace("free of charge", "for a fee")
    docs = docs_of((1, shouted), (2, other), (3, licenses.MIT), (4, "x " + licenses.MIT))
    assert [m for m in found(docs) if m[1] == "text"] == [(1, "text", 0, "MIT"), (3, "text", 0, "MIT")]


def test_notice_lines_and_odd_rows(spark, docs_of):
    notice = "released under the  MIT licence"
    docs = docs_of((1, f"Some prose.\n{notice}!\nMore."), (2, None), (3, ""), (4, "\n \n"), (5, notice), (5, notice), (6, f"prose {notice}"), (7, ("word " * 2000 + "\n") * 50 + notice))
    assert found(docs) == [(1, "line", 2, "MIT"), (5, "line", 1, "MIT"), (5, "line", 1, "MIT"), (5, "text", 0, "MIT"), (5, "text", 0, "MIT"), (7, "line", 51, "MIT")]
    assert [tuple(r) for r in licenses.license_matches(docs_of((None, notice))).collect()] == [(None, "text", 0, "MIT"), (None, "line", 1, "MIT")]


def test_no_rows_and_no_known_texts(spark, docs_of):
    assert found(docs_of((1, "x")).limit(0)) == []
    assert found(docs_of((1, licenses.MIT)), known=[], digests=[]) == []


def test_first_name_counts(spark, docs_of):
    assert found(docs_of((1, "A b.")), known=[("first", "a B"), ("second", "a, b")]) == [(1, "line", 1, "first"), (1, "text", 0, "first")]


def files():
    """Whole files, as they stand in source trees, and their licences."""
    wrapped = lambda text, mark="": "\n".join(line for p in text.split("\n") for line in textwrap.wrap(p, 72, initial_indent=mark, subsequent_indent=mark) or [mark.rstrip()])
    shared = "Copyright (c) 2024, Someone Else <mail@example.org>\nAll rights reserved."
    return {
        1: ("MIT", f"MIT License\n\n{shared}\n\n{licenses.MIT}"),
        2: ("MIT", wrapped(f"The MIT License (MIT)\n\n{shared}\n\n{licenses.MIT}")),
        3: ("Apache-2.0", wrapped(f"{shared}\n\n{licenses.APACHE_HEADER}", "# ")),
        4: ("Apache-2.0", "/*\n" + wrapped(f"{shared}\n\n{licenses.APACHE_HEADER}", " * ") + "\n */"),
        5: ("ISC", f"ISC License\n\n{shared}\n\n{licenses.ISC}"),
        6: ("BSD-2-Clause", f"BSD 2-Clause License\n\n{shared}\n\n" + wrapped(licenses.BSD_2)),
        7: ("BSD-3-Clause", f"{shared}\n\n" + wrapped(licenses.BSD_3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))),
        # lines that go on with the text begin with "copyright"
        8: ("BSD-3-Clause", f"{shared}\n\n" + licenses.BSD_3.replace(" copyright ", "\n  copyright\t").replace("HOLDER ", "OWNER ").replace(" COPYRIGHT ", "\n// COPYRIGHT ")),
        9: ("BSL-1.0", licenses.BOOST.replace(" copyright", "\ncopyright")),
        10: ("Unlicense", wrapped(licenses.UNLICENSE, "-- ")),
        11: ("GPL-3.0-or-later", wrapped(f"{shared}\n\n{licenses.GPL_3_HEADER}", "// ")),
        12: ("Zlib", f"zlib License\n\n(C) 2001 Somebody\n\n{licenses.ZLIB}"),
        13: ("MIT", "// SPDX-License-Identifier: MIT"),
        14: (None, licenses.BSD_2.replace("provided that", "if")),
        15: (None, f"MIT License\n\n{licenses.ISC}"),
        16: (None, "Copyright 2024 Someone\n# Copyright Office Inc."),
    }


def test_files_as_they_stand_and_sql(spark, docs_of):
    made = files()
    docs = docs_of(*((k, text) for k, (_, text) in made.items()))
    got = found(docs)
    assert {k: name for k, unit, _, name in got if unit == "text"} == {k: name for k, (name, _) in made.items() if name}
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    assert sorted(con.execute(f"select doc_id, unit, line, license_id from ({licenses.duckdb_sql()})").fetchall()) == got


@pytest.mark.skipif(not PUBLISHED.is_dir(), reason="the published texts are not on this machine")
def test_published_texts_have_the_known_digests(spark, docs_of):
    files_ = ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0"]
    docs = docs_of(*((k, (PUBLISHED / name).read_text().replace("\n\n", "\n \n\n")) for k, name in enumerate(files_)))
    got = [name for _, unit, _, name in found(docs) if unit == "text"]
    assert got == ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    rows = con.execute(f"select doc_id, unit, line, license_id from ({ORACLE_SQL['op2_license_scan']})").fetchall()
    assert sorted(rows) == sorted(tuple(r) for r in op2_license_scan(spark, SF).collect())
    assert rows
