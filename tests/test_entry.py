"""Driver contract of __spark_entry__.py."""

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["territorio", "agencia", "centro", "fecha_inicio", "tiempo_total", "oferta"]


def test_contract_keys_match():
    from carecast import oracle, registry

    assert set(registry.queries()) == set(oracle.oracle_sql())  # every workload query has its SQL twin
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(registry.queries()) >= 30
