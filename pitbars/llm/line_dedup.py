"""Repeated runs of words across all documents, found by winnowing over the hashes of lines.

Copies of a passage are wrapped differently and begin anywhere in a physical line, so a line here is a row
of ``LINE`` words that starts at any word; words are what ASCII white space separates. Of ``WINDOW`` lines in
a row the one of least hash, the first of equals, is a fingerprint. Two places that share ``LINE + WINDOW - 1``
words in a row or more share a fingerprint there; consecutive ones overlap, so the lines of the fingerprints
cover the run but for fewer than ``WINDOW`` words at either end.

Each fingerprint is joined to its first place, in the order of (doc_id, word), nulls first. Matches of two
documents at one distance that follow each other make a run. It is then extended to both sides, word by
word: the words around the ends of the first place are fetched from its text and compared. A run of ``LEAST``
words or more is deleted; its first copy stays. (Where that first place has only a part of what a later one
shares with a third, fewer than ``WINDOW`` words of the third may stay at an end.) Repeats within one document are found in the document itself.

A fingerprint is 96 bits of hashes over its words; the words of the extension are compared themselves
(those of more than 40 bytes by a digest of 128 bits).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.llm.common import cut, give_back, numbered, picked, place, together

#: Words of a line, lines of a window, words from which a run counts.
LINE, WINDOW, LEAST = 26, 25, 30
#: Words beyond the ends of a run that are fetched for the extension.
REACH = WINDOW

_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {1: np.ones(1, dtype=np.uint64), -1: np.ones(1, dtype=np.uint64)}


def powers(n: int, sign: int) -> np.ndarray:
    """The first n powers of the base, or of its inverse."""
    if len(_powers[sign]) < n:
        size = max(n, 2 * len(_powers[sign]))
        steps = np.full(size, _P if sign > 0 else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _powers[sign] = np.multiply.accumulate(steps)
    return _powers[sign][:n]


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A number for each byte, without pattern.
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], dtype=np.uint64)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, one after the other, and the bounds of each text's."""
    edges = np.frombuffer(texts.buffers()[1] or bytes(4), dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    edges -= edges[0]
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = _BLANK[data]
    inner = ~blank[1:-1]
    first, last = inner & blank[:-2], inner & blank[2:]
    cuts = edges[1:-1][(edges[1:-1] > 0) & (edges[1:-1] < len(data))]  # a word ends with its text
    first[cuts] |= inner[cuts]
    last[cuts - 1] |= inner[cuts - 1]
    starts, sizes = np.flatnonzero(first), np.flatnonzero(last) + 1
    sizes -= starts
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(len(edges), dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum()), dtype=np.int32) - np.repeat(begins.astype(np.int32), sizes)
    x = np.add.reduceat(_BYTE[data[inner]] * powers(int(sizes.max()), 1)[within], begins)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32)), np.searchsorted(starts, edges)


def lines(hashes: np.ndarray, size: int = LINE) -> np.ndarray:
    """A hash of the `size` words from each word on, as far as there are as many."""
    n = len(hashes)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers(n, 1), dtype=np.uint64)])
    x = (total[size:] - total[:-size]) * powers(n, -1)[: max(0, n - size + 1)] if n >= size else np.empty(0, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def checks(hashes: np.ndarray, size: int = LINE) -> np.ndarray:
    """32 further bits of the same words."""
    x = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (lines(x ^ (x >> np.uint64(32)), size) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def minima(ranks: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least rank of each stretch, the first of equals: minima over doubling spans, two of which
    cover a stretch."""
    level = np.frexp(last - first + 1)[1] - 1
    spans = [np.arange(len(ranks))]

    def least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.where(ranks[y] < ranks[x], y, x)

    for k in range(int(level.max(initial=0))):
        spans.append(least(spans[-1][: -(1 << k)], spans[-1][1 << k :]))
    out = np.empty(len(first), dtype=np.int64)
    for k, span in enumerate(spans):
        at = level == k
        out[at] = least(span[first[at]], span[last[at] + 1 - (1 << k)])
    return out


def fingerprints(ranks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word at which each selected line starts, ascending, and the text it is of. A text with fewer lines
    than a window has one window."""
    sizes = np.diff(bounds) - LINE + 1
    text = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
    if not len(text):
        return text, text
    begins = bounds[:-1][text]
    start = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0), np.maximum(sizes, 0)) + begins
    final = begins + sizes[text] - 1
    whole = (start + WINDOW - 1 <= final) | (start == begins)
    at = np.unique(minima(ranks, start[whole], np.minimum(start + WINDOW - 1, final)[whole]))
    return at, np.searchsorted(bounds, at, side="right") - 1


PRINTS = "id long, part long, print long, mark int, pos int"


def _prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows PRINTS: the first place of each fingerprint of a text; a text that has one twice also has a
    row without print."""
    for batch in together(batches, 2, 1_500_000):
        hashes, bounds = words(pc.fill_null(batch.column(2).cast(pa.string()), ""))
        ranks = lines(hashes)
        at, text = fingerprints(ranks, bounds)
        order = np.lexsort((at, ranks[at], text))
        at, text = at[order], text[order]
        again = np.zeros(len(at), dtype=bool)
        again[1:] = (ranks[at[1:]] == ranks[at[:-1]]) & (text[1:] == text[:-1])
        repeated, at, text = np.unique(text[again]), at[~again], text[~again]
        docs, n = pa.array(np.concatenate([text, repeated])), len(repeated)
        columns = [
            pa.concat_arrays([pa.array(ranks[at].view(np.int64)), pa.nulls(n, pa.int64())]),
            pa.array(np.concatenate([checks(hashes)[at], np.zeros(n, dtype=np.int32)])),
            pa.array(np.concatenate([at - bounds[text], np.full(n, -1)]).astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(docs), batch.column(1).take(docs), *columns], ["id", "part", "print", "mark", "pos"])


def runs(prints: DataFrame) -> DataFrame:
    """(id, part, a, b, i, p, d): words a to b of a document are those d words earlier of (i, p), the first place."""
    spot = F.struct(F.col("id").isNotNull(), "id", "part", "pos")
    marked = prints.where("print is not null")
    first = marked.groupBy("print", "mark").agg(F.min(spot).alias("f"), F.count("*").alias("n")).where("n > 1")
    # Written, so that the join's two sides are shuffled by it and a frequent line can be split.
    first = cut(first.select("print", "mark", F.col("f.id").alias("i"), F.col("f.part").alias("p"), F.col("f.pos").alias("q")), "first")
    later = ~(F.col("id").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")))
    found = marked.join(first, ["print", "mark"]).where(later).select("id", "part", "pos", "i", "p", (F.col("pos") - F.col("q")).alias("d"))
    pair = ["id", "part", "i", "p", "d"]
    along = Window.partitionBy(*pair).orderBy("pos")
    gap = F.when(F.col("pos") - F.lag("pos").over(along) > LINE, 1).otherwise(0)
    found = found.withColumn("gap", gap).withColumn("run", F.sum("gap").over(along))
    return found.groupBy(*pair, "run").agg(F.min("pos").alias("a"), (F.max("pos") + LINE).alias("b")).drop("run")


def short(word: bytes) -> bytes:
    return word if len(word) <= 40 else xxhash.xxh3_128_digest(word)


def around(text: bytes, asks: list[tuple[int, int]]) -> list[list[bytes]]:
    """The words before (side 0), nearest first, or from the given word on (side 1)."""
    parts = text.split()
    return [[*map(short, parts[max(0, at - REACH) : at][::-1] if side == 0 else parts[at : at + REACH])] for side, at in asks]


def alike(mine: list[bytes], theirs: list[bytes]) -> int:
    """How many words agree from the first on."""
    n = 0
    for a, b in zip(mine, theirs):
        if a != b:
            break
        n += 1
    return n


def agreeing(hashes: np.ndarray, x: int, y: int) -> int:
    """How many words from x on are those from y on; x > y."""
    n, step = 0, 64
    while x + n < len(hashes):
        upto = min(step, len(hashes) - x - n)
        same = hashes[x + n : x + n + upto] == hashes[y + n : y + n + upto]
        if not same.all():
            return n + int(same.argmin())
        n, step = n + upto, 2 * step
    return n


def own_runs(text: bytes) -> list[tuple[int, int]]:
    """Runs of a text that occur in it before, a line or more away."""
    hashes, bounds = words(pa.array([text], pa.binary()).cast(pa.string()))
    ranks = lines(hashes)
    at, _ = fingerprints(ranks, bounds)
    known, out, covered = {}, [], 0
    for x in at.tolist():
        y = known.setdefault(int(ranks[x]), x)
        if x + LINE <= covered or x - y < LINE:
            continue
        before = min(REACH, y)
        left = (hashes[x - before : x] == hashes[y - before : y])[::-1]
        a = x - (before if left.all() else int(left.argmin()))
        b = x + agreeing(hashes, x, y)
        if b - a >= LEAST:
            out.append((a, b))
            covered = max(covered, b)
    return out


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """The text without the given runs of words, each up to the next word that stays."""
    blank = _BLANK[np.frombuffer(text, dtype=np.uint8)]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.append(np.flatnonzero(first), len(text))
    out, at = [], 0
    for a, b in sorted(gone):
        if starts[a] > at:
            out.append(text[at : starts[a]])
        at = max(at, int(starts[b]))
    out.append(text[at:])
    return b"".join(out)


def _asked(at: int, size: int):
    """Rows (i, p, side, place, around) of the texts in column `at`; the last columns are part and asks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                batch, rows = whole.slice(x, 256), []
                own, texts, part, asks = (batch.column(c).to_pylist() for c in (size, at, size + 1, size + 2))
                for i, text, p, wanted in zip(own, texts, part, asks):
                    wanted = [(w["side"], w["place"]) for w in wanted]
                    rows.extend((i, p, side, n, near) for (side, n), near in zip(wanted, around((text or "").encode(), wanted)))
                columns = list(zip(*rows)) or [()] * 5
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["i", "p", "side", "place", "around"])
        give_back()

    return run


def _deleted(at: int, fields: list[str]):
    """The rows with their texts after deletion and the number of characters that went."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, ends, own = [*batch.columns[:-4]], batch.columns[-2], batch.columns[-1]
            changed = np.flatnonzero(pc.or_(ends.is_valid(), own.is_valid()).to_numpy(zero_copy_only=False))
            some, deleted, left = pa.array(changed), np.zeros(batch.num_rows, dtype=np.int64), []
            texts = columns[at].take(some).cast(pa.binary()).to_pylist()
            for x, text, found, twice in zip(changed.tolist(), texts, ends.take(some).to_pylist(), own.take(some).to_pylist()):
                gone = (own_runs(text) if twice else []) + (extended(text, found) if found else [])
                left.append(without(text, gone) if gone else text)
                if gone:
                    deleted[x] = len(text.decode()) - len(left[-1].decode())
            if len(changed):
                mask = np.zeros(batch.num_rows, dtype=bool)
                mask[changed] = True
                columns[at] = pc.replace_with_mask(columns[at], pa.array(mask), pa.array(left, pa.binary()).cast(columns[at].type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(deleted)], fields)
        give_back()

    return run


def extended(text: bytes, ends: list[dict]) -> list[tuple[int, int]]:
    """Runs of LEAST words or more, from rows (a, b, i, p, d, side, around), one for each end of a run."""
    found = {}
    near = around(text, [(e["side"], e["a"] if e["side"] == 0 else e["b"]) for e in ends])
    for e, mine in zip(ends, near):
        run = found.setdefault((e["i"], e["p"], e["d"], e["a"], e["b"]), [e["a"], e["b"]])
        n = alike(mine, e["around"])
        run[e["side"]] = e["b"] + n if e["side"] else e["a"] - n
    return [(a, b) for a, b in found.values() if b - a >= LEAST]


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of `docs` with its columns, its text without later copies of runs, and one more column
    `n_deleted`, the number of deleted characters.

    Null texts stay null, empty ones empty; texts of fewer than LEAST words are never changed. Rows that
    agree in id and text count as one place: none of them loses a run to the other. Null ids come first,
    and rows with one id in the order of their texts' hashes. A column named n_deleted gives way to the new one.
    """
    flat, names, at = numbered(docs), docs.columns, place(docs, text)
    own = F.col(f"c{place(docs, 'doc_id')}").cast("long")
    size = len(names)
    # The same columns on both sides of the two joins with texts, so that texts are shuffled once.
    rows = flat.withColumn("own", own).withColumn("part", F.xxhash64(F.col(f"c{at}")))
    read = picked(docs, id="doc_id", text=text).where("text is not null").select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("part"), "text")
    prints = cut(read.mapInArrow(_prints, PRINTS), "prints")
    found = cut(runs(prints), "runs")
    ends = found.select("*", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), x.alias("place")) for s, x in ((0, F.col("a") - F.col("d")), (1, F.col("b") - F.col("d")))))).alias("e"))
    ends = ends.select("id", "part", "a", "b", "i", "p", "d", "e.side", "e.place")
    asks = ends.select("i", "p", "side", "place").distinct().groupBy("i", "p").agg(F.collect_list(F.struct("side", "place")).alias("asks"))
    asked = rows.join(asks, F.col("own").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")), "left").where("asks is not null").drop("i", "p")
    near = asked.mapInArrow(_asked(at, size), "i long, p long, side int, place int, around array<binary>")
    near = near.select(*(F.col(c).alias(f"n_{c}") for c in near.columns)).dropDuplicates(["n_i", "n_p", "n_side", "n_place"])
    same = F.col("i").eqNullSafe(F.col("n_i")) & (F.col("p") == F.col("n_p")) & (F.col("side") == F.col("n_side")) & (F.col("place") == F.col("n_place"))
    ended = ends.join(near, same).groupBy("id", "part").agg(F.collect_list(F.struct("a", "b", "i", "p", "d", "side", F.col("n_around").alias("around"))).alias("ends"))
    twice = prints.where("print is null").select("id", "part").distinct().withColumn("twice", F.lit(True))
    gone = ended.select(F.col("id").alias("i"), F.col("part").alias("p"), "ends", F.lit(None).cast("boolean").alias("twice"))
    gone = gone.unionByName(twice.select(F.col("id").alias("i"), F.col("part").alias("p"), F.lit(None).cast(gone.schema["ends"].dataType).alias("ends"), "twice"))
    gone = gone.groupBy("i", "p").agg(F.first("ends", ignorenulls=True).alias("ends"), F.first("twice", ignorenulls=True).alias("twice"))
    joined = rows.join(gone, F.col("own").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")), "left").drop("i", "p")
    schema = T.StructType([*flat.schema.fields, T.StructField("n_deleted", T.LongType())])
    done = joined.mapInArrow(_deleted(at, [f.name for f in schema.fields]), schema)
    return done.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() != "n_deleted"), "n_deleted")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """`docs` after dedup(), without the rows whose text it deleted altogether; the columns stay."""
    text, own = place(docs, "text"), place(docs, "doc_id")
    names = [{text: "text", own: "doc_id"}.get(i, f"c{i}") for i in range(len(docs.columns))]
    done = dedup(docs.toDF(*names))
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"\S")
    return done.where(~emptied).drop("n_deleted").toDF(*docs.columns)
