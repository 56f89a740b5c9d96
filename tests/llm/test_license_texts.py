"""Standard licence headers and full texts, as they stand in files."""

import pytest
from llm_data import documents
from pyspark.sql import functions as F

from tabprep.llm import license_scan

GPL = """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software
Foundation, either version %s of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this
program. If not, see <http://www.gnu.org/licenses/>."""
APACHE = next(t for n, t, file in license_scan.TEXTS if n == "Apache-2.0" and not file and t.startswith("Licensed under"))
FULL = {n: t for n, t, file in license_scan.TEXTS if file}
CODE = "\nimport os\n\ndef run(path, size):\n    return os.stat(path).st_size > size  # bytes\n" * 8


def comment(text, lead, first="", last=""):
    return first + "\n".join(f"{lead}{line}".rstrip() for line in text.split("\n")) + last


ROWS = [
    ("gpl3/a.py", comment("Copyright (C) 2019 Jane Roe\n\n" + GPL % 3, "# ") + CODE, "GPL-3.0"),
    ("gpl2/a.c", comment("Copyright (C) 2019 Jane Roe\n\n" + GPL % 2, " * ", "/*\n", "\n */") + CODE, "GPL-2.0"),
    ("gpl3b/a.c", "/*\n" + GPL % 3 + "\n*/" + CODE, "GPL-3.0"),
    ("apache/a.js", comment("Copyright 2020 Acme Ltd\n" + APACHE, "// ") + CODE, "Apache-2.0"),
    ("mit/a.py", '"""\nCopyright (c) 2021 A. Writer\n\n' + FULL["MIT"].split("\n", 2)[2] + '"""' + CODE, "MIT"),
    ("bsd/a.h", comment("Copyright (c) 2005, The Group. All rights reserved.\n\n" + FULL["BSD-3-Clause"], " * ", "/*\n", "*/") + CODE, "BSD-3-Clause"),
    ("wrapped/a.sh", "#!/bin/sh\n# Licensed under the Apache\n# License, Version 2.0.\n" + CODE, "Apache-2.0"),
]


def scan(spark, rows):
    df = documents(spark, [(k, t) for k, (_, t, *_) in enumerate(rows)])
    paths = F.element_at(F.array(*(F.lit(p) for p, *_ in rows)), (F.col("doc_id") + 1).cast("int"))
    return {r.path: r for r in license_scan.scan_licenses(df, paths).collect()}


def test_standard_headers_of_several_lines(spark):
    got = scan(spark, [*ROWS, *((f"plain/{k}.py", CODE + f"name_{k} = {k}\n") for k in range(60))])
    assert {p: got[p].own_license for p, *_ in ROWS} == {p: name for p, _, name in ROWS}
    assert all(got[p].declared is None for p, *_ in ROWS)
    assert not any(r.license for p, r in got.items() if p.startswith("plain/"))


def test_full_texts_declare_for_their_directory(spark):
    rows = [(f"{n}/LICENSE", ("Copyright (c) 2018 Jane Roe\n\n" if n in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause") else "") + t) for n, t in FULL.items()]
    rows += [(f"{n}/src/deep/x.py", CODE + f"key = {k}\n") for k, n in enumerate(FULL)]
    got = scan(spark, [*rows, *((f"plain{k}/x.py", CODE + f"name_{k} = {k}\n") for k in range(60))])
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"} <= set(FULL)
    for n in FULL:
        assert got[f"{n}/LICENSE"].declared == n
        assert (got[f"{n}/src/deep/x.py"].license, got[f"{n}/src/deep/x.py"].inherited_from) == (n, n)


@pytest.mark.parametrize("text", ["# run with permission\nx = 1\n", "The licence of the driver was renewed.\nHe paid the fee.\n"])
def test_a_marker_alone_is_no_licence(spark, text):
    assert scan(spark, [("a/x", text), ("a/y", CODE)])["a/x"].license is None
