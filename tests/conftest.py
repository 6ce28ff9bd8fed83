from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import oracle_connection  # noqa: E402

from wardmart.plans.star import star_for  # noqa: E402
from wardmart.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, **{"spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return star_for(spark, SF_DIR)


@pytest.fixture(scope="session")
def oracle():
    return oracle_connection(SF_DIR)
