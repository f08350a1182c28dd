import __spark_entry__ as entry


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 50
