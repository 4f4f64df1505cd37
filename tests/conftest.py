from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from clickloom.session import ship_package  # noqa: E402
from verification.compare import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny_samples(spark):
    """The sample table at the smallest scale, written once."""
    from clickloom.session import materialise
    from verification.queries import samples

    return materialise(samples(spark, TINY), "tiny").cache()


@pytest.fixture(scope="session")
def small_split(spark):
    """Training and validation part at sf0.01, where the planted label can be learned."""
    from verification.queries import split

    train, validation = split(spark, SMALL)
    return train.cache(), validation.cache()


@pytest.fixture(scope="session")
def inner_small(small_split):
    """Prepared inner features of both parts."""
    from clickloom.operators.features import fit_features
    from clickloom.plans.models import prepared_table

    train, validation = small_split
    features = fit_features(train, "inner", 64)
    return prepared_table(features, train, "label_planted").cache(), features.transform(validation).cache()
