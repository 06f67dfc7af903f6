"""Driver contract: flagship query and registry consistency."""


def test_entry_runs(spark, entry_module):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "company" in df.columns and "best_month" in df.columns


def test_registry_names(entry_module):
    qs = entry_module.queries()
    sqls = entry_module.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 200
    for name in qs:
        prefix = name.split("_")[0]
        if name == "pipeline" or (prefix.startswith("op") and prefix[2:].isdigit()):
            continue                                     # of the training-data subpackage
        assert prefix[0] in "abcdefghijklmno" and prefix[1:].isdigit(), name
