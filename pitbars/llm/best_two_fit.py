"""Best-two-fit packing of whole documents into sequences of a fixed capacity.

A bin is filled greedily, the longest document that fits first. If that leaves a gap and the bin holds
more than one document, its smallest one makes room for the two unpacked documents that fill the gap
and its place best, if they fill more than it did.

What a bin takes depends only on how many documents of each length are left, so the plan is made of
numbers per length: a table of at most ``capacity`` rows, whatever the input's size. The same choice
holds for all further bins until one of its lengths runs short, so one pattern stands for as many bins
as its lengths allow, which is what bin after bin would give. Documents are then dealt to the places of
the patterns by their number among those of their length. These numbers come from the workers' own
counts, so no length, however common, is gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitbars.llm import bpe
from pitbars.llm.common import cut, picked

CAPACITY, END = 2048, 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, worker long, nr long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_two(left: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths of which some are left that fill the room best, the greater one first and as great
    as can be; (0, 0) if no two fit."""
    there = np.flatnonzero(left[: room + 1] > 0)
    if not len(there):
        return 0, 0
    below = np.maximum.accumulate(np.where(left[: room + 1] > 0, np.arange(room + 1), 0))
    second = below[np.minimum(room - there, there)]
    alone = (second == there) & (left[there] < 2)
    second[alone] = below[there[alone] - 1]
    sums = np.where(second > 0, there + second, 0)
    x = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(there[x]), int(second[x])) if sums[x] else (0, 0)


def patterns(counts: np.ndarray, capacity: int = CAPACITY) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(number of bins, [(length, how many in a bin)]) until counts[length] documents are packed."""
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    while left.any():
        rest, gap, bin_ = left.copy(), capacity, Counter()
        largest = np.maximum.accumulate(np.where(rest > 0, lengths, 0))
        while n := int(largest[gap]):
            k = min(gap // n, int(rest[n]))
            bin_[n] += k
            rest[n] -= k
            gap -= n * k
            if not rest[n]:
                largest = np.maximum.accumulate(np.where(rest > 0, lengths, 0))
        if gap and bin_.total() > 1:
            small = min(bin_)
            a, b = best_two(rest, gap + small)
            if a + b > small:
                bin_[small] -= 1
                bin_.update((a, b))
                bin_ = +bin_
        times = min(int(left[n]) // k for n, k in bin_.items())
        for n, k in bin_.items():
            left[n] -= times * k
        yield times, sorted(bin_.items(), reverse=True)


def places(counts: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Stretches of documents: those of `length` from number `first` on lie in the `times` bins from `bin`
    on, one in each and then again one in each, from `offset` on."""
    rows, numbers, used = [], [0] * (capacity + 1), 0
    for times, bin_ in patterns(counts, capacity):
        offset = 0
        for n, k in bin_:
            rows.append((n, numbers[n], times, used, offset))
            numbers[n] += times * k
            offset += n * k
        used += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "times", "bin", "offset"), table.T))


def _pieces(capacity: int, end: int | None):
    """Pieces of the documents of a partition, numbered within it by length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        last = end.to_bytes(4, "little") if end is not None else b""
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = (ids or b"") + last
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(part), worker, seen[n]))
                    seen[n] += 1
            yield _batch(rows, PIECES)

    return run


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in fields.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == "int" else pa.int64()) for c, k in zip(columns, kinds)], names)


def _placed(table: dict[str, np.ndarray]):
    """Rows PIECES, whose nr is the number among all of that length, with the places of the plan."""
    # One ascending key for both columns: lengths are few, numbers fit in 2**50.
    keys = (table["length"] << 50) + table["first"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nr = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(keys, (length << 50) + nr, side="right") - 1
            turn, which = np.divmod(nr - table["first"][at], table["times"][at])
            columns = [pa.array(table["bin"][at] + which), pa.array(table["offset"][at] + turn * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *columns], [f.split()[0] for f in PLACED.split(", ")])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents of more than `capacity` tokens are cut. A null or empty text is the end token alone.
    Repeated rows are packed once each, null ids too. Documents without any token (no end token, no
    text) have no piece. Columns of other names play no part. No row, no sequence.
    """
    coded = bpe.encode(picked(docs, doc_id="doc_id", text="text"), path=path).select(F.col("doc_id").cast("long"), "ids")
    return pack_ids(coded, capacity, end)


def pack_ids(coded: DataFrame, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """The same from rows (doc_id, ids), ids as unsigned 32-bit little-endian integers."""
    pieces = cut(coded.mapInArrow(_pieces(capacity, end), PIECES), "pieces")
    by_worker = cut(pieces.groupBy("worker", "length").agg(F.count("*").alias("n")), "counts")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in by_worker.groupBy("length").agg(F.sum("n")).collect():  # a row per length
        counts[length] = n
    before = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    first = by_worker.select("worker", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = pieces.join(first, ["worker", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nr")).alias("nr"))
    return numbered.mapInArrow(_placed(places(counts, capacity)), PLACED)
