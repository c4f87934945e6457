"""Vector codes by product quantisation in whole numbers, with pivots that save distances (LAESA).

Vectors are cut into equal parts, and each part position has a codebook. The distances of every part to
a few fixed pivots are computed once and kept beside it. In each round only the distances of the
pivots to the codebook's entries are new: by the triangle inequality the greatest difference of the two
is a lower bound of the distance of a part to an entry. Entries are tried in the order of their
bounds, and no further once the bound exceeds the best exact distance. Bounds are widened by more
than their rounding; all that decides is exact.

A round is one job over the written parts. Tasks add up parts by entry, so what is shuffled and what
the driver gets per round is one number per entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitbars.llm.common import cut, picked

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Pivots of each part position.
PIVOTS = 4
#: By how much, of the two distances, a bound is lowered; single precision rounds by less.
SLACK = 1e-6

PREPARED = "vec_id long, label {label}, parts binary, pivots binary"


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the entries, each as far as can be from those before it."""
    chosen = [0]
    while len(chosen) < min(n, len(entries)):
        away = np.stack([((entries - entries[c]) ** 2).sum(axis=1) for c in chosen]).min(axis=0)
        chosen.append(int(away.argmax()))
    return entries[chosen]


def distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row to each of `to`."""
    return np.sqrt(((rows[:, None, :] - to[None, :, :]) ** 2).sum(axis=2).astype(np.float64))


def nearest(rows: np.ndarray, near: np.ndarray, entries: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row, the lower of equals, and its exact squared distance; `near` has the
    rows' distances to the pivots, `between` the entries'. Also how many distances were computed."""
    gap = np.abs(near[:, None, :] - between[None, :, :]) - SLACK * (near[:, None, :] + between[None, :, :])
    bound = np.maximum(gap.max(axis=2), 0.0) ** 2
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(rows), np.iinfo(np.int64).max)
    code, alive, asked = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows)), 0
    for step in range(len(entries)):
        entry = order[alive, step]
        can = bound[alive, entry] <= best[alive]
        alive, entry = alive[can], entry[can]
        if not len(alive):
            break
        asked += len(alive)
        found = ((rows[alive] - entries[entry]) ** 2).sum(axis=1)
        better = (found < best[alive]) | ((found == best[alive]) & (entry < code[alive]))
        best[alive[better]], code[alive[better]] = found[better], entry[better]
    return code, best, asked


def _prepared(pivots: np.ndarray, size: int):
    """Rows PREPARED from rows (vec_id, label, components as long)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 4096):
                batch = whole.slice(x, 4096)
                rows = np.asarray(batch.column(2).flatten(), dtype=np.int64).reshape(batch.num_rows, size)
                parts = _cut_up(rows)
                if rows.size and 4 * int(np.abs(rows).max()) ** 2 * parts.shape[2] >= 2**62:
                    raise OverflowError("components are too large for errors of 64 bits")
                away = np.stack([distances(parts[:, p], pivots[p]) for p in range(PARTS)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), _binary(parts.reshape(len(rows), -1), "<i4"), _binary(away.reshape(len(rows), -1), "<f4")],
                    ["vec_id", "label", "parts", "pivots"],
                )

    return run


def _cut_up(rows: np.ndarray) -> np.ndarray:
    """Rows by part position and component; short of a multiple of PARTS they end in zeros."""
    width = -(-rows.shape[1] // PARTS)
    padded = np.zeros((len(rows), PARTS * width), dtype=np.int64)
    padded[:, : rows.shape[1]] = rows
    return padded.reshape(len(rows), PARTS, width)


def _binary(rows: np.ndarray, kind: str) -> pa.Array:
    data = np.ascontiguousarray(rows.astype(kind))
    offsets = (np.arange(len(rows) + 1) * rows.shape[1] * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _read(batch: pa.RecordBatch, parts: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    rows = np.frombuffer(b"".join(batch.column(parts).to_pylist()), dtype="<i4").astype(np.int64)
    near = np.frombuffer(b"".join(batch.column(pivots).to_pylist()), dtype="<f4").astype(np.float64)
    return rows.reshape(n, PARTS, -1) if rows.size else np.zeros((n, PARTS, 0), dtype=np.int64), near.reshape(n, PARTS, -1)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for x in range(0, whole.num_rows, 4096):
            yield whole.slice(x, 4096)


def _sums(books: np.ndarray, between: np.ndarray):
    """Rows (part, entry, n, at, total): sums of a task's parts by nearest entry and component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for batch in _batches(batches):
            rows, near = _read(batch, 0, 1)
            for p in range(PARTS):
                code, _, _ = nearest(rows[:, p], near[:, p], books[p], between[p])
                counts[p] += np.bincount(code, minlength=books.shape[1])
                for e in np.unique(code):
                    totals[p, e] += rows[code == e, p].sum(axis=0)
        part, entry, at = (x.ravel().astype(np.int32) for x in np.indices(books.shape))
        used = counts[part, entry] > 0
        columns = [part[used], entry[used], counts[part, entry][used], at[used], totals.ravel()[used]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["part", "entry", "n", "at", "total"])

    return run


def _coded(books: np.ndarray, between: np.ndarray):
    """Rows (vec_id, label, code, error)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            rows, near = _read(batch, 2, 3)
            codes, error = np.empty((batch.num_rows, PARTS), dtype=np.uint8), np.zeros(batch.num_rows, dtype=np.int64)
            for p in range(PARTS):
                code, best, _ = nearest(rows[:, p], near[:, p], books[p], between[p])
                codes[:, p] = code
                error += best
            text = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text, pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def codes(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, and the codebooks: part by entry by component.

    Rows whose vector is null or holds null, NaN or infinite components are dropped. Kept vectors have
    the length of the first one, by vec_id (null ids last) and then by components; others take no part.
    A length that PARTS does not divide is filled up with zeros. Of repeated rows each counts, also among the first
    ENTRIES; with fewer rows the codebooks are shorter. Components that could make an error exceed 64 bits raise
    an OverflowError. Extra columns play no part. No row, no code.
    """
    rows = picked(vectors, vec_id="vec_id", v="embedding", label="label").withColumn("v", F.col("v").cast("array<double>"))
    whole = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("long")).alias("v"))
    first = [r.v for r in rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).collect()]
    size = len(first[0]) if first else 0
    if any(len(v) != size for v in first):
        rows = rows.where(F.size("v") == size)
        first = [r.v for r in rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).collect()]
    label = rows.schema["label"].dataType.simpleString()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), np.zeros((PARTS, 0, 0), dtype=np.int64)
    books = np.ascontiguousarray(_cut_up(np.array(first, dtype=np.int64).reshape(len(first), size)).transpose(1, 0, 2))
    pivots = np.stack([far_apart(b, PIVOTS) for b in books])
    kept = rows.where(F.size("v") == size).select("vec_id", "label", "v")
    prepared = cut(kept.mapInArrow(_prepared(pivots, size), PREPARED.format(label=label)), "parts")

    def between() -> np.ndarray:
        return np.stack([distances(books[p], pivots[p]) for p in range(PARTS)])

    for _ in range(ROUNDS):
        sums = prepared.select("parts", "pivots").mapInArrow(_sums(books, between()), "part int, entry int, n long, at int, total long")
        total = F.sum(F.col("total").cast("decimal(38,0)"))
        new = books.copy()
        for part, entry, at, count, value in sums.groupBy("part", "entry", "at").agg(F.sum("n"), total).collect():
            new[part, entry, at] = int(value) // count
        books = new
    return prepared.mapInArrow(_coded(books, between()), f"vec_id long, label {label}, code string, error long"), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    coded, books = codes(vectors)
    coded = cut(coded, "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by all distances: rounds one after the other, for vectors whose length PARTS divides."""
    distance = "list_sum(list_transform(range(1, len(t.x) + 1), lambda i: (t.x[i] - b.x[i]) * (t.x[i] - b.x[i])))"
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT t.r, t.p, min({ENTRIES} * CAST({distance} AS BIGINT) + b.e) AS m FROM t JOIN b{i} b ON b.p = t.p GROUP BY t.r, t.p
)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (
    SELECT a.p, a.m % {ENTRIES} AS e, j, CAST(sum(t.x[j]) AS BIGINT) AS s, count(*) AS n
    FROM a{i} a JOIN t ON t.r = a.r AND t.p = a.p, unnest(range(1, len(t.x) + 1)) AS u(j) GROUP BY a.p, e, j
), n{i} AS (SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY j) AS x FROM s{i} GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN n{i} n ON n.p = b.p AND n.e = b.e)""")
    return f"""
WITH k AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), t AS MATERIALIZED (
    SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM k, range({PARTS}) AS q(p)
), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM t WHERE r <= {ENTRIES}),
{", ".join(steps)},
c AS (SELECT r, string_agg(format('{{:02x}}', m % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
FROM c JOIN k USING (r)
"""


SQL = _sql()
