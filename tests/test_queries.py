import pytest
from helpers import SF, same

from tidewright.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_fits_its_sql(spark, duck, name):
    same(QUERIES[name](spark, SF), duck, ORACLES[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_byte_origin_of_urls_on_several_pages(spark, tmp_path):
    import duckdb

    urls = ["http://a.example/x", "http://a.example/x", "http://a.example/x", "http://a.example/x", "http://b.example/", "http://b.example/", "ftp://c.example/y", None, None, None, "d1"]
    spark.createDataFrame([(i, u) for i, u in zip([1, 3, 5, 7, 2, 4, 9, 11, 12, 20, 6], urls, strict=True)] + [(None, "http://e.example/"), (-15, "http://f.example/z.txt")], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i,) for i in [None, 0, 1, 1, 2, 3, 6]], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    same(QUERIES["q68_byte_origin"](spark, str(tmp_path)), con, ORACLES["q68_byte_origin"])
