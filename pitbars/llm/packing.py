"""Harmonic packing of token sequences into bins of a fixed capacity.

Class k takes pieces of more than capacity / (k + 1) and at most capacity / k tokens, and k pieces of
it fill a bin, whatever they are: a worker needs no knowledge of the others. Documents are cut so
that little is lost in a bin: off come full bins, then, as long as a rest would waste more than
``WASTE`` of its place, the largest capacity // k that it holds.

A worker is a partition of the input. It fills bins from its own pieces; what is left of each class,
fewer than k pieces, goes on to a second round in which one worker takes the rests of up to
``GROUP`` others, and so on; the rests of the last worker, less than a bin of each class, are
put together first-fit by falling length. So no worker ever holds more than GROUP times the rests of
one, which depend on the capacity only.

A sequence whose tokens are a power of two in number needs no padding, any other is padded to the
capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitbars.llm import bpe
from pitbars.llm.common import cut, picked, tidied

CAPACITY, END = 2048, 1
#: Share of its place in a bin that a piece may waste before it is cut.
WASTE = 1 / 64
#: Workers whose rests one worker of the next round takes.
GROUP = 64

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker long, sequence long, offset long"


def cuts(n: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity // k - rest <= waste * (capacity // k):
            out.append(rest)
            break
        size = capacity // (k + 1)
        out.append(size)
        rest -= size
    return out


def filled(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, by its class, in the order given; -1 for those left over.
    Also the number of bins."""
    bins, offsets, used = np.full(len(classes), -1), np.zeros(len(classes), dtype=np.int64), 0
    order = np.argsort(classes, kind="stable")
    edges = np.flatnonzero(np.diff(classes[order], prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:]):
        k = int(classes[order[a]])
        full = (b - a) // k
        if full:
            at = order[a : a + full * k]
            bins[at] = used + np.repeat(np.arange(full), k)
            part = lengths[at].reshape(full, k)
            offsets[at] = (np.cumsum(part, axis=1) - part).ravel()
            used += full
    return bins, offsets, used


def first_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, the longest first into the first bin that has room."""
    bins, offsets, room = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), []
    for x in np.argsort(-lengths, kind="stable"):
        n = int(lengths[x])
        y = next((i for i, r in enumerate(room) if r >= n), None)
        if y is None:
            y = len(room)
            room.append(capacity)
        bins[x], offsets[x] = y, capacity - room[y]
        room[y] -= n
    return bins, offsets, len(room)


def _first_round(capacity: int, end: int | None):
    """Pieces of the documents of a partition, with the bins that it fills from them alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple]] = {}
        used = 0
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column("ids").to_pylist()):
                tokens = (ids or b"") + (end.to_bytes(4, "little") if end is not None else b"")
                start, n = 0, len(tokens) // 4
                for length in cuts(n, capacity):
                    crc = zlib.crc32(tokens[4 * start : 4 * (start + length)])
                    k = capacity // length
                    room = waiting.setdefault(k, [])
                    room.append((doc, start, length, crc, n))
                    if len(room) == k:  # a full bin
                        offset = 0
                        for p in room:
                            rows.append((*p, worker, used, offset))
                            offset += p[2]
                        used += 1
                        room.clear()
                    start += length
            yield _batch(rows)
        yield _batch([(*p, worker, None, None) for room in waiting.values() for p in room])

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _round(capacity: int, last: bool):
    """The rests of some workers: more full bins; in the last round all of them find a place."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["worker", "doc_id", "start", "length", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(dtype=np.int64)
        bins, offsets, used = filled(capacity // lengths, lengths)
        if last:
            rest = bins < 0
            more, offsets[rest], _ = first_fit(lengths[rest], capacity)
            bins[rest] = used + more
        pdf["worker"] //= GROUP
        pdf["sequence"] = pd.array(np.where(bins < 0, 0, bins), dtype="Int64")
        pdf["offset"] = pd.array(np.where(bins < 0, 0, offsets), dtype="Int64")
        pdf.loc[bins < 0, ["sequence", "offset"]] = pd.NA
        return pdf

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end token alone. Repeated rows are packed once each. Documents without
    any token (no end token, no text) have no piece. No row, no sequence.
    """
    rows = picked(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return _packed(bpe.encode(rows, path=path, then=_first_round(capacity, end), schema=PIECES), capacity)


def pack_ids(coded: DataFrame, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """The same from rows (doc_id, ids), ids as unsigned 32-bit little-endian integers."""
    return _packed(coded.select("doc_id", "ids").mapInArrow(tidied(_first_round(capacity, end)), PIECES), capacity)


def _packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """All rounds after the first."""
    first = cut(pieces, "packed")
    parts, workers, level = [first.where("sequence is not null").withColumn("level", F.lit(0))], (first.agg(F.max("worker")).first()[0] or 0) + 1, 1
    rest = first.where("sequence is null")
    while True:
        last = workers <= GROUP
        done = rest.groupBy((F.col("worker") / GROUP).cast("long")).applyInPandas(_round(capacity, last), PIECES)
        if last:
            parts.append(done.withColumn("level", F.lit(level)))
            break
        done = cut(done, "packed")
        parts.append(done.where("sequence is not null").withColumn("level", F.lit(level)))
        rest, workers, level = done.where("sequence is null"), -(-workers // GROUP), level + 1
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # Level, worker and the worker's own count make a number of their own: 3, 24 and 36 bits.
    number = F.shiftleft(F.col("level").cast("long"), 60).bitwiseOR(F.shiftleft("worker", 36)).bitwiseOR(F.col("sequence"))
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", number.alias("sequence_id"), "offset")
