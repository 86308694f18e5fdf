import pytest
from conftest import rows_of

from chunklake.plans import catalogue


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query_equals_its_sql(spark, sf_dir, oracle, name):
    ours, sql = catalogue.QUERIES[name](spark, sf_dir).toPandas(), oracle(catalogue.ORACLE_SQL[name])
    assert sorted(ours.columns) == sorted(sql.columns)
    assert rows_of(ours) == rows_of(sql)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
