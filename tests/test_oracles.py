"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import connect, difference

from quayload.plans.catalog import REGISTRY

DATA = "/root/testdata"
# Comparing megabytes of generated text is slow, and its rule is the same at any size.
SMALL = {name for name in REGISTRY if name.startswith("shape_")}


@pytest.fixture(scope="module")
def databases():
    return {sf: connect(f"{DATA}/{sf}") for sf in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, databases, name):
    sf = "sf0.001" if name in SMALL else "sf0.01"
    item = REGISTRY[name]
    df = item.run(spark, f"{DATA}/{sf}")
    assert item.oracle, "every query has a statement of its result"
    assert difference(df, databases[sf], item.oracle) is None


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(REGISTRY) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
