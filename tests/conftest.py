from __future__ import annotations

import pytest

from ledgerlark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set runtime options for one test and put the old values back."""
    saved = {}

    def set_option(key: str, value: str) -> None:
        saved.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def shop(spark):
    from tests.shop import make_shop

    return make_shop(spark)
