"""Driver contract."""

import __spark_entry__ as E


def test_every_query_has_oracle_sql():
    # the training-data queries are optional and have their own tests
    own = {q for q in E.queries() if not q.startswith("op") and q != "pipeline"}
    assert own == {q for q in E.oracle_sql() if not q.startswith("op")}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "rank", "product_id", "score"]
    assert df.count() > 0


def test_exact_queries_small(spark):
    """A handful of catalog queries at sf0.001 against DuckDB."""
    import duckdb

    from conftest import SF_SMALL

    con = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem", "events", "embeddings"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ["feed_parse", "rejected_lines", "topk_from_factors", "cold_start", "upsert_partial",
                 "keyed_compact", "recs_merge", "rmse_duplicate_pairs", "assign_to_centers"]:
        df = E.queries()[name](spark, SF_SMALL)
        key = lambda t: tuple((x is None, str(x)) for x in t)
        got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=key)
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        rows = rel.fetchall()
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted((tuple(r[i] for i in order) for r in rows), key=key)
        assert got == want, name
