"""Training-order token shards: every sequence of ids gets a global slot, shards hold slots in order.

Documents are cut into sequences of ``LENGTH`` ids, the last one padded. How many there are is known
only once they are encoded, but not more than their bytes allow: each partition of the input gets a
range of numbers of that size, and numbers its sequences from the start of the range. A keyed Feistel
network over the next even power of two permutes the numbers, and walks on from any that falls
outside until it is back inside, so no two sequences share a slot. Slots are handed out more sparsely
than sequences by a factor that is the same everywhere; training goes through them in order.

``SLOTS`` slots in a row are a shard: one partition, written as one file of rows of the same width,
in the order of their slots and without any header. Row r starts at byte r * stride, so a reader may
begin at any row of any shard and go on from there. The slot of a number, and the number of a slot,
follow from the key alone.

The writing pass checks that its partitions are those that were measured and fails otherwise, rather
than give a slot twice. A shard is written under a name of its attempt and then moved, so a repeated
task does no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitbars.llm import bpe
from pitbars.llm.common import checkpoint_dir, picked

#: Ids of a sequence, slots of a shard (about one in eight is taken), rounds of the network.
LENGTH, SLOTS, ROUNDS = 512, 1 << 19, 6
#: The most ids that a byte can give: normal forms make three of one at worst.
PER_BYTE = 3
KEY, END, PAD = 20240229, 1, 0

PLACED = "doc_id long, start long, n_tokens int, slot long, shard int, row int, ids_crc32 long"


def _mixed(x: np.ndarray, key: int, r: int) -> np.ndarray:
    x = (x + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xBF58476D1CE4E5B9) % (1 << 64))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _network(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    """The Feistel network on 2 * half bits, or its inverse."""
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        if back:
            left, right = right ^ (_mixed(left, key, r) & mask), left
        else:
            left, right = right, left ^ (_mixed(right, key, r) & mask)
    return (left << np.uint64(half)) | right


def permuted(numbers: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The slots of some of the numbers 0 .. n - 1 (`back`: the numbers of some slots)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    out = _network(numbers.astype(np.uint64), half, key, back)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = _network(out[outside], half, key, back)
    return out.astype(np.int64)


def width(vocabulary: int) -> int:
    """Bytes of an id."""
    return 2 if vocabulary <= 1 << 16 else 4


def _slotted(path: str, length: int, end: int | None, first: dict[int, int], room: dict[int, int], total: int, key: int, slots: int):
    """Rows (shard, slot, doc_id, start, ids): the sequences of a partition with their places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, c, done, seen = TaskContext.get().partitionId(), bpe.coder(path), 0, 0
        wide = f"<u{width(len(c.vocabulary))}"
        changed = RuntimeError("the input's partitions changed between measuring and writing; write it as a table and run again")
        for batch in batches:
            for x in range(0, batch.num_rows, 512):
                docs, starts, ids = [], [], []
                some = batch.slice(x, 512)
                seen += sum(some.column(2).to_pylist())
                for doc, coded in zip(some.column(0).to_pylist(), c.encode([t or "" for t in some.column(1).to_pylist()])):
                    tokens = np.frombuffer(coded, dtype="<u4")
                    if end is not None:
                        tokens = np.append(tokens, np.uint32(end))
                    small = tokens.astype(wide)
                    for start in range(0, len(small), length):
                        docs.append(doc)
                        starts.append(start)
                        ids.append(small[start : start + length].tobytes())
                if done + len(docs) > seen or seen > room.get(part, 0):
                    raise changed
                taken = permuted(first[part] + done + np.arange(len(docs)), total, key)
                done += len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((taken // slots).astype(np.int32)), pa.array(taken), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    ["shard", "slot", "doc_id", "start", "ids"],
                )
        if seen != room.get(part, 0):
            raise changed

    return run


def _written(folder: str, length: int, wide: int, pad: int):
    """Writes the shards of a partition; rows (PLACED) of what was written."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(_uri(folder))
        kind = np.dtype(f"<u{wide}")
        shards: dict[int, list] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for shard, *row in zip(*columns):
                shards.setdefault(shard, []).append(row)
        for shard, rows in shards.items():  # one, unless partitions were merged
            rows.sort(key=lambda r: r[0])
            block = np.full((len(rows), length), pad, dtype=kind)
            report = []
            for x, (slot, doc, start, tokens) in enumerate(rows):
                part = np.frombuffer(tokens, dtype=kind)
                block[x, : len(part)] = part
                report.append((doc, start, len(part), slot, shard, x, zlib.crc32(part.astype("<u4").tobytes())))
            if any(a[0] == b[0] for a, b in zip(rows, rows[1:])):
                raise RuntimeError(f"a slot of shard {shard} is taken twice")
            _put(store, f"{base}/shard-{shard:08d}.bin", block)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            names = [x.split()[0] for x in PLACED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*report), types)], names)

    return run


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _put(store, path: str, block: np.ndarray) -> None:
    attempt = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        out.write(memoryview(np.ascontiguousarray(block)).cast("B"))
    store.move(attempt, path)


def write(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, slots: int = SLOTS, key: int = KEY, end: int | None = END, pad: int = PAD) -> DataFrame:
    """Write the sequences of all texts as shards into `folder`; one row per sequence that was written.

    `docs` should be read from files (or a table written before), so that both passes see the same
    partitions. `folder` is a path that all executors share. Beside the shards lies `manifest`, a JSON
    table of one row. A null or empty text is the end token alone; without an end token such texts
    have no sequence. Repeated rows are written each. No sequence, no shard. The shards are written,
    and the rows appear, when the result is computed.
    """
    path = path or bpe.default_path()
    wide = width(len(bpe.coder(path).vocabulary))
    texts = picked(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    most = F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") * PER_BYTE + 1) / F.lit(length)).cast("long")
    texts = texts.select("doc_id", "text", most.alias("most"))
    measured = texts.groupBy(F.spark_partition_id().alias("part")).agg(F.sum("most").alias("n")).collect()  # one row a partition
    room, first, total = {r.part: r.n for r in measured}, {}, 0
    for part in sorted(room):
        first[part] = total
        total += room[part]
    shards = max(1, -(-total // slots))
    manifest = {"numbers": total, "shards": shards, "slots": slots, "length": length, "stride": length * wide, "id_bytes": wide, "key": key, "end": end, "pad": pad}
    spark = docs.sparkSession
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/manifest")
    placed = texts.mapInArrow(_slotted(path, length, end, first, room, total, key, slots), "shard int, slot long, doc_id long, start long, ids binary")
    return placed.repartitionById(shards, F.col("shard")).mapInArrow(_written(folder.rstrip("/"), length, wide, pad), PLACED)


def read(folder: str, manifest: dict, shard: int = 0, row: int = 0) -> Iterator[tuple[int, int, np.ndarray]]:
    """(shard, row, ids with padding) of all sequences from a row of a shard on, in training order."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(_uri(folder))
    stride = manifest["stride"]
    while shard < manifest["shards"]:
        name = f"{base}/shard-{shard:08d}.bin"
        if store.get_file_info(name).type == fs.FileType.File:  # a shard without sequences has no file
            with store.open_input_file(name) as f:
                f.seek(row * stride)
                while data := f.read(1024 * stride):
                    for ids in np.frombuffer(data, dtype=f"<u{manifest['id_bytes']}").reshape(-1, manifest["length"]):
                        yield shard, row, ids
                        row += 1
        shard, row = shard + 1, 0


def ordered(docs: DataFrame) -> DataFrame:
    """All documents written in training order into a new folder of the shared one."""
    folder = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return write(docs, folder)
