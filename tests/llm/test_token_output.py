import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitbars.llm import bpe
from pitbars.llm import token_output as to


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**63))
def test_permutation(n, key):
    numbers = np.arange(n)
    slots = to.permuted(numbers, n, key)
    assert sorted(slots) == list(numbers)
    assert (to.permuted(slots, n, key, back=True) == numbers).all()


@pytest.mark.parametrize("slots", [500, 1 << 19])
def test_round_trip(spark, sf, tmp_path, slots):
    folder, data = f"{tmp_path}/out", f"{tmp_path}/docs"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, "a b"), (5000, None), (5001, ""), (5002, "q " * 3000), (5003, "same"), (5003, "same"), (5004, "\u0958" * 900)], "doc_id long, text string")
    docs.unionByName(extra).repartition(5).selectExpr("*", "1 as slot", "2 as SHARD").write.parquet(data)
    docs = spark.read.parquet(data)
    placed = to.write(docs, folder, length=128, slots=slots).collect()
    manifest = json.loads(spark.read.text(f"{folder}/manifest").first().value)
    placed.sort(key=lambda r: r.slot)
    assert len({r.slot for r in placed}) == len(placed) and placed[-1].slot < manifest["numbers"]
    got = list(to.read(folder, manifest))
    assert [(s, x) for s, x, _ in got] == [(r.shard, r.row) for r in placed]
    again = list(to.read(folder, manifest, got[9][0], got[9][1]))
    assert [(s, x, list(i)) for s, x, i in again] == [(s, x, list(i)) for s, x, i in got[9:]]
    by = {}
    for r, (_, _, row) in zip(placed, got):
        assert r.shard == r.slot // slots
        ids = row[: r.n_tokens]
        assert (row[r.n_tokens :] == 0).all() and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        by.setdefault(r.doc_id, []).append((r.start, list(ids)))
    c = bpe.coder(bpe.default_path())
    for r in docs.collect():
        want = [*np.frombuffer(c.encode([r.text or ""])[0], dtype="<u4"), 1]
        parts = sorted(by[r.doc_id])
        if r.doc_id == 5003:
            assert len(parts) == 2 and parts[0] == parts[1] == (0, want)
            continue
        assert [x for _, p in parts for x in p] == want


def test_empty_table_and_changed_input(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert to.write(docs, f"{tmp_path}/none").count() == 0
