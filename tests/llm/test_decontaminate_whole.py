"""Leaks that a template with one shift and one verdict per passage cannot show."""

import pytest

from tests.llm.rows import prose
from tests.llm.test_decontaminate import leaks


def test_verbatim_text_of_any_make_up(spark):
    around = prose(1, 50)
    items = ["If John has 5 apples, Mary has 3 and Bob has 2, then 7 or 8 go to Ann", "7 14 3 99 12 8 41 6 5 22", "Name three primes", "Berlin"]
    texts = [f"{around} {t} {around}" for t in items] + [around]
    assert leaks(spark, texts, items) == [(i, i, "exact") for i in range(4)]


def test_one_contradiction_does_not_hide_a_verbatim_passage(spark):
    item = "the old baker sold 3 apples to a child who then ran along the narrow road into a green field and later came back for some more bread and 3 pears"
    # The two values fall into different runs of changed windows.
    other = item.replace("3 apples", "5 apples").replace("3 pears", "7 pears")
    short = "she put 3 apples and 3 pears into the basket"
    texts = [item.replace("3 pears", "7 pears"), f"{prose(1, 30)} {other}", short.replace("3 apples", "4 apples")]
    found = leaks(spark, texts, [item, short])
    assert [(d, i) for d, i, _ in found] == [(0, 0), (1, 0)]
    assert found[1][2] == "changed"


@pytest.mark.parametrize("before", ["Question: ", "Geography\n", "Geography\n\n", "- ", "see ", "1) "])
def test_start_of_a_short_item(spark, before):
    item = "What is the capital of old France now?"
    other = item.replace("France", "Peru")
    assert leaks(spark, [before + item, before + other], [item]) == [(0, 0, "exact"), (1, 0, "changed")]


def test_any_case(spark):
    item = "In the year when Maria met a young Peter at the old mill by the Danube near the small town of Linz they sang and Maria wept over poor Peter"
    assert leaks(spark, [item.lower(), item.upper(), item.title()], [item]) == [(0, 0, "exact"), (1, 0, "exact"), (2, 0, "exact")]


def test_values_of_other_lengths(spark):
    item = "a farmer named Tom has five sheep and he sells some of them in Paris for eighty coins while the neighbour Eve only keeps ten more"
    other = item.replace("Tom", "Mary Ann").replace("five", "twenty-five").replace("Paris", "New York").replace("eighty", "one hundred and two").replace("Eve", "Tom and Bob")
    short = "we saw how Anna went to the market again"
    found = leaks(spark, [f"{prose(1, 30)} {other}", short.replace("Anna", "Mary Ann")], [item, short])
    assert found == [(0, 0, "changed"), (1, 1, "changed")]
