import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitbars.llm import best_two_fit as bt
from pitbars.llm import bpe

SCHEMA = "doc_id long, text string"


def bin_by_bin(lengths, capacity):
    """The method on a list of documents, one bin after the other, pairs by trying all."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        held = []
        for n in list(left):
            if sum(held) + n <= capacity:
                held.append(n)
                left.remove(n)
        if sum(held) < capacity and len(held) > 1:
            room = capacity - sum(held) + held[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= room]
            if pairs and max(pairs)[0] > held[-1]:
                _, a, b = max(pairs)
                left.append(held.pop())
                for n in (a, b):
                    left.remove(n)
                    held.append(n)
                left.sort(reverse=True)
        bins.append(tuple(sorted(held)))
    return Counter(bins)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=150), st.sampled_from([40, 50, 64]))
def test_patterns_are_the_bins_of_the_plain_method(lengths, capacity):
    got = Counter()
    for times, bin_ in bt.patterns(np.bincount(lengths, minlength=capacity + 1), capacity):
        got[tuple(sorted(n for n, k in bin_ for _ in range(k)))] += times
    assert got == bin_by_bin(lengths, capacity)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_places_hold_every_number_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    table, seen = bt.places(counts, 64), {}
    for n, first, times, bin_, offset in zip(*(table[c].tolist() for c in ("length", "first", "times", "bin", "offset"))):
        upto = min((f for m, f in zip(table["length"], table["first"]) if m == n and f > first), default=counts[n])
        for nr in range(first, upto):
            assert (n, nr) not in seen
            seen[n, nr] = (bin_ + (nr - first) % times, offset + (nr - first) // times * n)
    assert len(seen) == len(lengths)
    bins = {}
    for (n, _), (b, o) in seen.items():
        bins.setdefault(b, []).append((o, n))
    gapless(bins)
    assert sorted(bins) == list(range(len(bins)))


def gapless(bins, capacity=64):
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity


def test_a_million_documents_plan_quickly():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2048, 1 + rng.geometric(1 / 600, 1_000_000))
    counts = np.bincount(lengths, minlength=2049)
    table = bt.places(counts)
    bins = max(table["bin"] + table["times"])
    assert len(table["bin"]) < 40_000 and bins <= 1.002 * lengths.sum() / 2048 + 1


def check(rows, texts, capacity=2048):
    t = Tokenizer.from_file(bpe.default_path())
    by, bins = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    gapless(bins, capacity)
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in parts] == [(n, s) for n, s in enumerate(range(0, len(ids), capacity))]
        for r in parts:
            part = ids[r.start : r.start + capacity]
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    assert sum(map(len, by.values())) == len(rows) and len(by) == len(texts)
    return bins


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(5, "doc_id").cache()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = bt.pack(docs).collect()
    bins = check(rows, texts)
    used = Counter(r.length for r in rows)
    plain = bin_by_bin([n for n, k in used.items() for _ in range(k)], 2048)
    assert Counter(tuple(sorted(n for _, n in b)) for b in bins.values()) == plain


def test_hard_rows_extra_columns_and_empty_table(spark):
    texts = [(i, "word " * (i * 37 % 500)) for i in range(300)] + [(1000, None), (1001, ""), (1002, "a b c " * 3000), (1003, "x " * 2047)]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(9, "doc_id").selectExpr("*", "1 as worker", "2 as LENGTH", "3 as ids")
    check(bt.pack(docs).collect(), texts)
    same = spark.createDataFrame([(1, "same text")] * 3 + [(None, "x")], SCHEMA)
    rows = bt.pack(same).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 9 and sum(r.length for r in rows if r.doc_id is None) == 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert bt.pack(same.limit(0)).count() == 0
