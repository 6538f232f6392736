"""Registered queries vs their DuckDB oracle (sf0.001) + the entry smoke check."""
import pytest

from conftest import SF001
from oracle_check import check
from lendspark.plans import catalog

ALL = sorted(catalog.oracle_sql())


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, name):
    res = check(spark, SF001, [name], verbose=True)
    assert res[name][0] == "OK", res[name]


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "sk_id_curr" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
