import pytest
from parity import rows_of, twin_rows

from grainfield.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    assert rows_of(QUERIES[name](spark, SF)) == twin_rows(ORACLES[name], SF)


def test_entry_has_a_query_for_each_oracle(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
