import textwrap

import pytest

from kinfold.llm.licenses import APACHE_HEADER, full_texts
from tests.llm.test_licenses import scan


def test_full_texts_and_file_headers(spark):
    texts = dict(reversed(full_texts()))
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "MIT"]
    wrapped = ["\n\n".join(textwrap.fill(p, 60) for p in texts[n].split("\n\n")) for n in names[-3:]]
    found = scan(spark, [texts[n] for n in names[:-3]] + [w.replace("(c) <year> <owner>", "The Foo Authors") for w in wrapped])
    assert [(i, n, "text", 1) for i, n in enumerate(names)] == [r for r in found if r[2] == "text"]


@pytest.mark.parametrize("before", ["# Copyright The Foo Authors\n", "# Copyright (c) Foo Inc.\n#\n", "# Copyright 2020 Foo\n#\n"])
def test_header_of_a_source_file(spark, before):
    lines = textwrap.wrap(APACHE_HEADER[0], 70) + ["", "    " + APACHE_HEADER[1].replace("http:", "https:"), ""] + textwrap.wrap(APACHE_HEADER[2], 70)
    file = before + "\n".join("# " + x for x in lines) + "\n\nimport os\n"
    plain = "Notes\n\n" + "\n".join(lines)
    found = scan(spark, [file, plain])
    assert {(0, "Apache-2.0", "paragraph", 1), (1, "Apache-2.0", "paragraph", 1)} <= set(found)
