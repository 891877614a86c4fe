from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ebbtide.session import local_session

    return local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def customers(spark):
    from ebbtide.sources import derived

    return derived.table(spark, SF, "customers")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
