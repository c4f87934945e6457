import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitbars.llm import laesa as la


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 40), st.integers(1, 16), st.integers(0, 5), st.sampled_from([1, 3, 1000, 10**8]))
def test_nearest_against_all_distances(seed, n, k, width, high):
    rng = np.random.default_rng(seed)
    rows, entries = rng.integers(-high, high + 1, (n, width)), rng.integers(-high, high + 1, (k, width))
    pivots = la.far_apart(entries, la.PIVOTS)
    near = la.distances(rows, pivots).astype(np.float32).astype(np.float64)
    code, best, asked = la.nearest(rows, near, entries, la.distances(entries, pivots))
    exact = ((rows[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert code.tolist() == exact.argmin(axis=1).tolist() and best.tolist() == exact.min(axis=1).tolist()
    assert asked <= n * k


def test_pivots_save_distances():
    rng = np.random.default_rng(4)
    entries = rng.integers(-2000, 2000, (16, 4))
    rows = entries[rng.integers(0, 16, 3000)] + rng.integers(-50, 50, (3000, 4))
    pivots = la.far_apart(entries, la.PIVOTS)
    _, _, asked = la.nearest(rows, la.distances(rows, pivots), entries, la.distances(entries, pivots))
    assert asked < 3000 * 16 / 4


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_report_against_sql(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=24).round(2)], int(i) % 5) for i in rng.permutation(300)]
    rows += [(400 + i, [0.25] * 24, None) for i in range(40)] + [(500, [-0.5] * 24, None)] * 30
    rows += [(-9, [0.0] * 24, 1), (-8, None, 1), (-7, [None] + [1.0] * 23, 1), (-6, [float("nan")] * 24, 1), (-5, [float("inf")] * 24, 2), (-4, [1.0] * 24, 2)]
    rows += [(None, [0.125] * 24, 3)]
    df = rows_of(spark, rows).repartition(4).selectExpr("*", "1 as code", "2 as v", "3 as PARTS")
    got = la.report(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    embeddings = rows_of(spark, rows).toArrow()  # noqa: F841
    want = duckdb.sql(la.SQL).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_few_rows_odd_lengths_and_empty_table(spark):
    few = rows_of(spark, [(2, [0.5] * 10, 1), (1, [0.25] * 10, 1), (3, [0.25] * 10, None), (4, [1.0] * 8, 1), (5, [], 1)])
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in la.report(few).collect()}
    assert got == {1: ("00" * 8, 0, 0), 2: ("0101010101" + "00" * 3, 0, 0), 3: ("00" * 8, 0, 0)}
    assert la.report(few.limit(0)).collect() == []
    assert {r.code for r in la.report(rows_of(spark, [(1, [], 1), (2, [], 1)])).collect()} == {"00" * 8}
    with pytest.raises(Exception, match="too large"):
        la.report(rows_of(spark, [(1, [1e30] * 8, 1)])).collect()
