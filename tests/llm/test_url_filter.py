import re

import duckdb

from pitbars.llm import url_filter as uf

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/1", "https://example.net/de/1?x=/en/", "ftp://a.example.com/de/", "http://org/fr/x#y", "http://xorg/fr/", "http://a.org", "x://b.net:80/", "http://example.com/DE/", "http://É.net/", "a://b://c.net/", "http://u.net?/en/", "http://w.example.net/en/" + "z" * 3000]


def tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(100000 + i if i else None, u) for i, u in enumerate(URLS)] + [(100003, URLS[3])] * 2, "page_id long, url string")
    return pages.unionByName(extra)


def test_against_sql(spark, sf):
    pages_df = tables(spark, "/root/testdata/sf0.01")
    pages = pages_df.toArrow()  # noqa: F841
    got = uf.judge(pages_df.selectExpr("*", "1 as HOST", "2 as key", "3 as text"))
    got = sorted(map(str, got.select("page_id", "host", "path", "rule", "verdict").collect()))
    want = duckdb.sql(uf.SQL)
    names = want.columns
    want = sorted(f"Row({', '.join(f'{n}={x!r}' for n, x in zip(names, row))})" for row in want.fetchall())
    assert got == want


def test_rules(spark):
    rows = {r.url: r for r in spark.createDataFrame([(u,) for u in URLS], "url string").select("url", *(c.alias(n) for c, n in zip(uf.parts(__import__("pyspark").sql.functions.col("url")), ("host", "path")))).collect()}
    assert (rows[URLS[4]].host, rows[URLS[4]].path) == ("www.example.net", "/en/1")
    assert (rows["http://u.net?/en/"].host, rows["http://u.net?/en/"].path) == ("u.net", "")
    assert (rows["http://É.net/"].host, rows["a://b://c.net/"].path) == ("É.net", "//c.net/")
    got = {r.host + r.path: (r.rule, r.verdict) for r in uf.judge(spark.createDataFrame([(1, u) for u in URLS], "page_id long, url string")).collect()}
    assert got["www.example.net/en/1"] == ("example.net/en/", "allow") and got["example.net/de/1"] == ("net/", "block")
    assert got["a.example.com/de/"] == ("example.com/de/", "block") and got["org/fr/x"] == ("org/fr/", "allow") and got["xorg/fr/"][0] is None


def test_model_tells_classes_apart(spark):
    rows = [(i, f"http://h{i % 7}.{'good' if i % 2 else 'spam'}.{'example.net/en' if i % 2 else 'net'}/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://h{i % 7}.{'good' if i % 2 else 'spam'}.test/{i}") for i in range(100)]
    got = uf.judge(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 1000").collect()
    assert all((r.verdict == "allow") == bool(r.page_id % 2) for r in got)


def test_empty_and_native(spark, sf):
    pages = tables(spark, sf)
    assert uf.judge(pages.limit(0)).count() == 0
    assert not re.search("Python|Pandas|Arrow", uf.judge(pages)._jdf.queryExecution().toString())
