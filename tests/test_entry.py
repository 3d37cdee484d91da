import __spark_entry__
from brontide.plans import registry


def test_names_and_sql_fit():
    names = registry.queries()
    assert set(registry.oracle_sql()) <= set(names)
    assert set(names) <= set(__spark_entry__.queries())


def test_flagship_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
