"""Driver contract: entry() runs on sf0.001 with a stable schema; every
oracle belongs to a registered query."""


def test_entry_schema_and_rows(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["language", "n_docs", "n_pass", "rej_too_short", "rej_too_long", "rej_too_few_lines",
                          "rej_minified", "rej_low_alnum", "n_unique", "dedup_rate"]
    rows = {r.language: r for r in df.collect()}
    assert "*" in rows and rows["*"].n_docs == sum(r.n_docs for k, r in rows.items() if k != "*")


def test_oracles_are_registered_queries():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 120
    assert all(isinstance(s, str) and s.strip() for s in o.values())
