from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinfold.operators import training
from kinfold.operators.frequency import tf_tables, with_tf
from kinfold.operators.model import load_model
from kinfold.operators.profiles import collapse
from kinfold.plans import catalog
from kinfold.plans.catalog import FROZEN
from kinfold.session import materialize
from kinfold.settings import DEFAULT_SETTINGS


@pytest.fixture(scope="module")
def people(spark, folder):
    return catalog._compared(spark, folder)


@pytest.fixture(scope="module")
def profiles(people):
    rows = collapse(people, DEFAULT_SETTINGS)
    return materialize(with_tf(rows, tf_tables(rows, DEFAULT_SETTINGS, F.col("copies")), "record_id"))


def test_fit_save_load(spark, people, tmp_path):
    found = training.train(people, DEFAULT_SETTINGS, allow_partial=True)
    model = found.model
    for c in DEFAULT_SETTINGS.comparisons:
        assert sum(model.u[c.column]) == pytest.approx(1.0, abs=1e-6)
        assert sum(model.m[c.column]) == pytest.approx(1.0, abs=1e-6)
        # A level that no random pair showed is rare, not impossible.
        assert all(v > 1e-6 for v in model.u[c.column])
    assert model.weight("national_id", 1) > 0 > model.weight("clean_name", 0)
    assert model.prior == pytest.approx(10 / 0.7 / (150 * 149 / 2))
    assert all(s.m[c][i] is None for s in found.sessions for c, i in found.untaught if c in s.m)
    path = str(tmp_path / "model")
    model.save(spark, path)
    assert load_model(spark, path) == load_model(spark, path, DEFAULT_SETTINGS) == model
    # Other rules or thresholds are other settings.
    with pytest.raises(ValueError):
        load_model(spark, path, replace(DEFAULT_SETTINGS, rules=DEFAULT_SETTINGS.rules[:2]))
    first, *rest = DEFAULT_SETTINGS.comparisons[::-1]
    with pytest.raises(ValueError):
        load_model(spark, path, replace(DEFAULT_SETTINGS, comparisons=(*rest[::-1], replace(first, thresholds=(0.5, 0.4, 0.3)))))


def test_rounds_that_do_not_settle_are_told(profiles, people):
    session = training.em_session(profiles, FROZEN, DEFAULT_SETTINGS.rules[0], max_rounds=1)
    assert session.rounds == 1 and not session.settled
    assert set(session.m) == set(DEFAULT_SETTINGS.columns) - {"national_id"}


def test_untrainable_comparisons_are_reported(people):
    lonely = people.dropDuplicates(["clean_mother"]).withColumns({"national_id": F.col("record_id"), "clean_name": F.col("record_id")})
    with pytest.raises(training.TrainingIncomplete):
        training.fit(lonely, DEFAULT_SETTINGS)
    # A thin sample of rows holds no matching pairs and raises instead of teaching something else.
    with pytest.raises(training.TrainingIncomplete):
        training.fit(people.filter("record_id < '004'"), DEFAULT_SETTINGS)
    training.fit(lonely, DEFAULT_SETTINGS, allow_partial=True)


def test_nothing_to_train_on(people):
    with pytest.raises(training.TrainingIncomplete):
        training.fit(people.limit(0), DEFAULT_SETTINGS)


def test_prior_without_pairs(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "record_id string, national_id string")
    assert tuple(training.estimate_prior(rows).first()) == (3, 0, 0.0)
