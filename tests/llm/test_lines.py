import random

import pytest

from kinfold.llm.lines import apply_bitmaps, line_bitmaps
from tests.llm.rows import awkward, frame

BLANKS = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def expected(rows, min_docs, keep_first):
    docs = list(dict.fromkeys((r[0], r[1] or "") for r in rows))
    places = {}
    for i, text in docs:
        for at, line in enumerate(text.split("\n")):
            if key(line):
                places.setdefault(key(line), []).append((i is None, i or 0, text, at))
    drop = set()
    for own in places.values():
        if len({p[:3] for p in own}) >= min_docs:
            first = min(own, key=lambda p: p[:2])
            drop |= {p for p in own if not (keep_first and p[:3] == first[:3] and p[3] == min(q[3] for q in own if q[:3] == first[:3]))}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for at, x in enumerate(lines) if (r[0] is None, r[0] or 0, r[1] or "", at) not in drop]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def many():
    rng = random.Random(3)
    pool = [f"Line {i}" for i in range(40)] + [" line 1 ", "LINE 2", "É", "é", ""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 3, 90, 300])))) for i in range(60)]
    return awkward() + [(i + 100, t, *awkward()[0][2:]) for i, t in rows]


@pytest.mark.parametrize("share", [0.5, 1e-6])
@pytest.mark.parametrize("keep_first", [False, True])
def test_against_brute_force(spark, share, keep_first):
    docs = frame(spark, many())
    maps = line_bitmaps(docs, min_docs=5, keep_first=keep_first, share=share)
    found = sorted(map(tuple, apply_bitmaps(docs, maps).collect()), key=repr)
    assert found == expected(many(), 5, keep_first)


def test_empty_table_and_nothing_to_drop(spark):
    assert line_bitmaps(frame(spark, []), min_docs=2).count() == 0
    docs = frame(spark)
    kept = apply_bitmaps(docs, line_bitmaps(docs, min_docs=1000))
    assert kept.filter("n_dropped > 0").count() == 0 and kept.count() == len(awkward())
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()
