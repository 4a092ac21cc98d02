import importlib.util

import __spark_entry__ as entry


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_llm_is_optional():
    has = importlib.util.find_spec("plumbline.llm") is not None
    assert any(k.startswith("p3_") for k in entry.queries()) == has
