from kinfold.llm.licenses import NOTICES, known_licenses, license_scan
from tests.llm.rows import awkward, frame

MIT = NOTICES[13][1]


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    return sorted(map(tuple, license_scan(docs, known_licenses(spark)).collect()))


def test_spellings_punctuation_and_copyright_lines(spark):
    texts = [
        "Copyright (c) 2020 Someone Else\n\nreleased under the mit LICENCE!",
        "some text\nReleased under the   MIT License.\nmore\nReleased under the MIT License",
        f"intro\n\n(C) 2019-2021 X\n{MIT.replace('sublicense', 'sub-license').replace(' copy', chr(10) + 'copy')}\n\nend",
        MIT.upper(),
        "Released under the MIT License, they say",
        "This work is licensed under the GNU General Public Licence, version 3",
    ]
    assert scan(spark, texts) == [(0, "MIT", "line", 1), (0, "MIT", "paragraph", 1), (0, "MIT", "text", 1), (1, "MIT", "line", 2), (2, "MIT", "paragraph", 1), (3, "MIT", "text", 1), (5, "GPL-3.0", "text", 1)]


def test_awkward_rows_and_empty_tables(spark):
    known = known_licenses(spark)
    assert license_scan(frame(spark), known).count() == 0
    assert license_scan(frame(spark, []), known).count() == 0
    assert license_scan(frame(spark), known.limit(0)).count() == 0
    rows = [(None, "All rights reserved.", *awkward()[0][2:])] * 2
    assert list(map(tuple, license_scan(frame(spark, rows), known).collect())) == [(None, "all-rights-reserved", "text", 2)]
