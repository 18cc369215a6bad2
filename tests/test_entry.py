def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["lang", "n_texts", "n_tokens"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
