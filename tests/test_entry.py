import __spark_entry__ as entry


def test_names_and_smoke(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 70
    assert entry.entry(spark).count() > 0


def test_optional_parts_may_be_absent(monkeypatch):
    import importlib.util

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith(("contrail.llm", "corpus_pipeline")) else real(n, *a))
    names = set(entry.queries())
    assert "feature_store" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
