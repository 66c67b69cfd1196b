import hashlib
import re

import pytest

from kinfold.llm.exact import exact_duplicates
from tests.llm.rows import awkward, frame


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r[1] or ""), []).append(r)
    out = []
    for norm, own in groups.items():
        own = sorted(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], own[0][0], len(own), n == 0, hashlib.sha256(norm.encode()).hexdigest()) for n, r in enumerate(own)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.5, 1e-6])
def test_against_brute_force(spark, share):
    """With the smallest share every repeated text counts as hot and is dealt over all tasks."""
    found = exact_duplicates(frame(spark), share=share).collect()
    assert sorted(map(tuple, found), key=repr) == expected(awkward())


@pytest.mark.parametrize("share", [0.5, 1e-6])
def test_carried_rows(spark, share):
    rows = awkward()
    kept = exact_duplicates(frame(spark), carry=True, share=share).filter("kept").select("row.*")
    assert kept.columns == frame(spark).columns
    assert kept.count() == sum(r[3] for r in expected(rows))


def test_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_one_shuffle_of_texts(spark):
    plan = exact_duplicates(frame(spark), share=1e9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "Python" not in plan
