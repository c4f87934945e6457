import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pitbars.llm import maxscore as ms


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 60), st.integers(1, 6), st.integers(1, 12))
def test_top_against_all_scores(seed, n, d, k):
    rng = np.random.default_rng(seed)
    rows, query = rng.integers(-4, 5, (n, d)), rng.integers(-4, 5, d)
    ids, before = np.sort(rng.integers(0, 80, n)), ms.BLOCK
    ms.BLOCK = 7
    try:
        found, scores = ms.top(query, 5, ids, np.ascontiguousarray(rows.T), k)
    finally:
        ms.BLOCK = before
    want = sorted((-int(s), int(i)) for s, i in zip(rows @ query, ids) if i != 5)[:k]
    assert [(-int(s), int(i)) for s, i in zip(scores, found)] == want


def test_search_against_sql(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).round(2)]) for i in range(-300, 700)]
    rows += [(1000, [0.5] * 8)] * 30 + [(i, [0.25] * 8) for i in range(1001, 1400)]  # ties and repeated rows
    rows += [(None, [1.0] * 8), (2000, None), (2001, [None] + [1.0] * 7), (2100, [float("nan")] * 8), (2200, [float("inf")] * 8), (2300, []), (2400, [1.0] * 5), (2401, [2.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(ms, "ROWS", 100)
    monkeypatch.setattr(ms, "QUERIES", 3)
    got = sorted(tuple(r) for r in ms.search(df.selectExpr("*", "1 as id", "2 as shard")).collect())
    embeddings = df.toArrow()  # noqa: F841
    assert got == sorted(duckdb.sql(ms.SQL).fetchall())
    assert ms.search(df.limit(0)).count() == 0
