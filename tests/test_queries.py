"""Every query without a model against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from marlstone.plans import queries as plans

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, FOLDER)
    rows = df.collect()
    assert rows
    if name in plans.oracle_sql():
        cursor = duck.execute(plans.oracle_sql()[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, cursor.fetchall()))


def test_titles_with_other_references(spark, tmp_path):
    """html_meta decodes what its SQL does: three references with their semicolons."""
    titles = ["a &quot;b&quot;", "x &amp;&amp", "&lt;i&gt; &amp;lt; &nbsp;&#38; &copy", "&", "plain"]
    rows = [(i, f"http://p/{i}", f"<html><title>{t}</title><p>&quot;</p>") for i, t in enumerate(titles)] + [(9, "http://p/9", "<p>none</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.sql(plans.oracle_sql()["html_meta"]).fetchall())
    assert sorted(map(tuple, plans.queries()["html_meta"](spark, str(tmp_path)).collect())) == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
