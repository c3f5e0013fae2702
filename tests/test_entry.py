def test_entry_flagship_runs_on_smallest_tables(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["cluster", "rank", "gene", "score", "logfoldchange", "pval", "pval_adj"]
    assert len(rows) == 25  # 5 market segments x top 5 part names
    assert set(E.oracle_sql()) <= set(E.queries())
