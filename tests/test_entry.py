"""The driver contract module."""

import importlib


def test_entry_runs(spark):
    mod = importlib.import_module("__spark_entry__")
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["AGE_GROUP", "CLIENT_COUNT", "DEFAULT_RATE"]


def test_oracles_are_subset_of_queries():
    mod = importlib.import_module("__spark_entry__")
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert len(mod.queries()) >= 60
