import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitbars.llm import bpe
from pitbars.llm import packing as pk

SCHEMA = "doc_id long, text string"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 9000), st.sampled_from([64, 100, 2048]))
def test_cuts(n, capacity):
    parts = pk.cuts(n, capacity)
    assert sum(parts) == n and all(0 < p <= capacity for p in parts)
    wasted = sum(capacity / (capacity // p) - p for p in parts)
    assert wasted <= capacity / 16 + len(parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_filled_and_first_fit(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, offsets, used = pk.filled(64 // lengths if len(lengths) else lengths, lengths)
    rest = bins < 0
    more, offsets[rest], n = pk.first_fit(lengths[rest], 64)
    bins[rest] = used + more
    for b in range(used + n):
        at = sorted(zip(offsets[bins == b], lengths[bins == b]))
        assert [o for o, _ in at] == [sum(x for _, x in at[:i]) for i in range(len(at))] and sum(x for _, x in at) <= 64


def whole(rows, texts, capacity=2048):
    """Every id lies in exactly one piece, and pieces fill sequences without gaps or overlap."""
    t = Tokenizer.from_file(bpe.default_path())
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    used = [sum(n for _, n in p) for p in sequences.values()]
    return sum(used) / sum(u if u & (u - 1) == 0 else capacity for u in used)


def test_pack_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(5, "doc_id").cache()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert whole(pk.pack(docs).collect(), texts) > 0.95


@pytest.mark.parametrize("group", [2, 64])
def test_rounds_of_workers(spark, group, monkeypatch):
    monkeypatch.setattr(pk, "GROUP", group)
    texts = [(i, "word " * (i * 7 % 90)) for i in range(300)] + [(1000, None), (1001, ""), (1002, "a b c " * 3000)]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(9, "doc_id").selectExpr("*", "1 as worker", "2 as LENGTH")
    assert whole(pk.pack(docs).collect(), texts) > 0.9


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same text")] * 3 + [(None, "x")], SCHEMA)
    rows = pk.pack(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 9 and sum(r.length for r in rows if r.doc_id is None) == 2
    assert pk.pack(docs.limit(0)).count() == 0
