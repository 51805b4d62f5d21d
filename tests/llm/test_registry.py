"""The registry holds the whole set of training-data queries."""

import __spark_entry__


def test_all_operators_and_the_pipeline_are_registered():
    names = set(__spark_entry__.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert {"op8_warc", "pipeline"} <= names
    assert "op8_warc" in __spark_entry__.oracle_sql()
