"""Every query of the engine proper against its SQL, on the small tables."""

import datetime

import duckdb
import pytest

from tessella.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    return sorted(repr([norm(v) for _, v in sorted(zip(columns, r))]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    found = duck.execute(registry.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_without_sql_runs(spark, sf, name):
    rows = registry.QUERIES[name](spark, sf).collect()
    assert rows and any(v is not None for r in rows for v in r)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_prune_keeps_rows_not_ids(spark):
    """A row of an old run that shares its id with a row of a new run does not stay for it; both stay if the id is a newest one."""
    from tessella.operators.findings import prune

    rows = [(1, 1, "A", "p", "1"), (1, 3, "A", "p", "1"), (2, 1, "C1", "p", "1"), (2, 2, "A", "p", "1"), (3, 2, "A", "p", "1"), (4, 1, "C1", "p", "2"), (5, None, "A", "p", "1"), (4, None, "C1", None, "1")]
    got = prune(spark.createDataFrame(rows, "id long, run_id long, code string, slug string, version string"), 1, ["C1"])
    assert sorted(map(tuple, got.select("id", "run_id").fillna(-1).collect())) == [(1, 3), (2, 1), (2, 2), (4, -1), (4, 1)]


def test_owned_merge_drops_owned_rows_only(spark):
    from tessella.operators.checks import owned_merge

    existing = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4)], "key long, pos long")
    generated = spark.createDataFrame([(1, 1), (4, 2), (9, 3)], "key long, n long")
    got = owned_merge(existing, generated, spark.createDataFrame([(2,)], "key long"))
    assert sorted(map(tuple, got.select("side", "place", "key").collect())) == [(0, 1, 1), (1, 1, 1), (1, 2, 4), (1, 3, 9), (2, 3, 3), (2, 4, 4)]


def test_sentences_equal_sql_on_digits_and_spaces(spark, tmp_path):
    """A part's place among the parts is no character to trim; white space and trimmed spaces are those of the SQL."""
    texts = [None, "", "0. 1. 2 or 2. 31.3 3", "End. 19.37.233.111", " a ", "a.  b!\n c;\t\fd:\r\ne", "a.\x0bb. \x0b c", " a　.　b.  c ", "a. ␟b␟ c", "\nx\n", "...", ". . .", "9?! 8"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.ORACLE["f151_sentences"]).fetchall()
    assert sorted(map(tuple, registry.QUERIES["f151_sentences"](spark, str(tmp_path)).collect())) == sorted(want)
