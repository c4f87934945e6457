"""Near copies by order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with how often it came before in the
text. Each of ``SKETCHES`` sketches takes the ``DEPTH`` labelled shingles that are smallest under its
own permutation and hashes them in the order in which they stand in the text. Texts that agree in a
sketch share a bucket and are candidates; reordered texts are not.

Two texts are near copies if M / (n + m - M) >= 0.8, where n and m are their numbers of shingles and
M the length of the longest common subsequence of shingles, found by an alignment in the band of
diagonals that such a pair cannot leave. For edits that keep the order this is the Jaccard similarity
of the shingles. A text of fewer than five words is one shingle; texts without a word stay alone.

Equal texts are one node from the start, so thousands of exact copies cost one. First the members of
each bucket are compared with a leader, the member with the most company in all its buckets: among
copies of one original that is the original, whose shingles most of them kept. Each bucket is also
split by a further sketch, and the parts by another one, which keeps near copies together and parts
texts that share a passage only; each part has a leader of its own. Linked nodes become one component.

In buckets that still hold several components every pair of members of different components is then
looked at, block by block, so no candidate is left out. Pairs are compared unless their sizes or their
rarest shingles rule them out: a text can miss a fifth of its shingles at most, so of the fifth that is
rarest a near copy has a certain number too. Which shingles count as rare changes the cost only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pitbars.llm.common import cut, numbered, picked, place, tidied

WORDS, SIMILARITY = 5, 0.8
SKETCHES, DEPTH = 24, 4
#: Further sketches that split buckets.
FURTHER = 2
#: Members in a block of an open bucket; counters of shingles, a power of two.
BLOCK, SLOTS = 256, 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = (np.random.default_rng(20240229).integers(1, 1 << 63, size=(SKETCHES + FURTHER, 2), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) < 64:
            self[word] = h
        return h


_hashes = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the five-word shingles in the order of the text."""
    words = (text or "").split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(WORDS, len(h))):
        out = out * _MIX + h[i : i + n]
    return mixed(out)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Each shingle with its number of earlier occurrences mixed in."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    if len(first) == len(hashes):
        return hashes
    seen = np.empty(len(hashes), dtype=np.uint64)
    seen[order] = np.arange(len(hashes)) - np.repeat(first, np.diff(np.r_[first, len(hashes)]))
    return np.where(seen == 0, hashes, mixed(hashes + seen * _MIX))


def sketch(hashes: np.ndarray, first: int = 0, n: int = SKETCHES) -> np.ndarray:
    """The buckets of a text in n sketches from `first` on."""
    base, keys = labelled(hashes), _ODD[first : first + n]
    depth = min(DEPTH, len(base))
    least = np.empty((n, depth), dtype=np.int64)
    step = max(1, 1_000_000 // len(base))  # sketches at a time, so that long texts stay small in memory
    for i in range(0, n, step):
        order = base * keys[i : i + step, :1]
        order ^= order >> np.uint64(29)
        order *= keys[i : i + step, 1:]
        least[i : i + step] = np.argpartition(order, depth - 1, axis=1)[:, :depth]
    least.sort(axis=1)
    out = np.arange(first + 1, first + n + 1, dtype=np.uint64)
    for column in base[least].T:
        out = (out * _MIX) ^ column
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out


def common(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Length of the longest common subsequence if it is `least` or more, else something smaller.

    A subsequence that long leaves out at most len(a) - least of one side and len(b) - least of the
    other, so an alignment stays between these diagonals; one bit of a large integer stands for each
    position of the band.
    """
    if min(len(a), len(b)) < least:
        return 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    kept = head + tail
    if not len(a) or not len(b) or kept >= least:
        return kept
    above, below = len(a) + kept - least, len(b) + kept - least  # left out of a, of b
    if above < 0 or below < 0:
        return 0
    if np.count_nonzero(np.isin(a, b)) + kept < least:
        return kept
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | (1 << i)
    # Row j of b may meet positions j - below .. j + above of a.
    low, done, width = 0, 0, above + below + 1
    full = (1 << width) - 1
    row = full
    for j, x in enumerate(b.tolist()):
        if j - below > low:  # the lowest position leaves the band: what it found is settled
            done += not row & 1
            row = (row >> 1) | (1 << (width - 1))
            low += 1
        match = places.get(x)
        if match is not None:
            u = row & (match >> low)
            row = ((row + u) | (row - u)) & full
    inside = min(width, len(a) - low)
    done += inside - (row & ((1 << max(0, inside)) - 1)).bit_count()
    return kept + done


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < similarity * max(n, m):
        return False
    least = int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))
    return common(a, b, least) >= least


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, shingles, bucket) for each text: binary id of the text, size, bucket."""
    for batch in batches:
        for x in range(0, batch.num_rows, 256):
            part = batch.slice(x, 256)
            nodes, sizes, buckets = [], [], [np.empty(0, dtype=np.uint64)]
            for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                h = shingles(text)
                if len(h):
                    nodes += [node] * SKETCHES
                    sizes += [len(h)] * SKETCHES
                    buckets.append(sketch(h))
            signed = np.concatenate(buckets).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signed, pa.int64())], ["node", "n", "bucket"])


def _further(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, more): the further sketches of each text."""
    for batch in batches:
        more = [sketch(h, SKETCHES, FURTHER).view(np.int64).tolist() if len(h := shingles(t)) else [0] * FURTHER for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(more, pa.list_(pa.int64()))], ["node", "more"])


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory: dict[bytes, np.ndarray] = {}
    for batch in batches:
        a, b, s, t = (batch.column(i).to_pylist() for i in range(4))
        keep = []
        for x in range(batch.num_rows):
            pair = []
            for node, text in ((a[x], s[x]), (b[x], t[x])):
                if (h := memory.get(node)) is None:
                    if len(memory) > 200:
                        memory.clear()
                    h = memory[node] = shingles(text)
                pair.append(h)
            if near(*pair):
                keep.append(x)
        yield pa.RecordBatch.from_arrays([pa.array([a[x] for x in keep], pa.binary()), pa.array([b[x] for x in keep], pa.binary())], ["a", "b"])


def _slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slot, n): how many labelled shingles fall to each slot."""
    seen = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for text in batch.column(1).to_pylist():
            np.add.at(seen, labelled(shingles(text)) & np.uint64(SLOTS - 1), 1)
    slots = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(seen[slots])], ["slot", "n"])


def n_rarest(n: np.ndarray) -> np.ndarray:
    """How many of n shingles cannot all be missing in a near copy."""
    return n - np.ceil(SIMILARITY * n - 1e-9).astype(np.int64) + 1


def rarest(text: str, ranks: np.ndarray) -> np.ndarray:
    """The rarest shingles of a text, by the rank of their slot and then by hash."""
    h = labelled(shingles(text))
    keys = (ranks[h & np.uint64(SLOTS - 1)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
    n = int(n_rarest(np.array(len(h))))
    return np.partition(keys, n - 1)[:n]


def _rarest(ranks: np.ndarray):
    """Rows (node, rare): the rarest shingles of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rarest(t, ranks).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.int64), *found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), rare], ["node", "rare"])

    return run


def possible(n: np.ndarray, root: np.ndarray, sizes: np.ndarray, rare: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of texts with different roots (and, if given, on different sides `apart`) that
    sizes and rarest shingles do not rule out. `rare` holds `sizes` shingles of each text in turn.

    Of two texts the shingles after the one whose rarest end first are met by those of that text at
    most; what is wanted beyond them must be among the rarest of both.
    """
    low, high = np.minimum.outer(n, n), np.maximum.outer(n, n)
    fit = (low >= SIMILARITY * high - 1e-9) & (root[:, None] != root)
    if apart is not None:
        fit &= apart[:, None] != apart
    fit = np.triu(fit, 1)
    if not fit.any():
        return np.nonzero(fit)
    _, column, count = np.unique(rare, return_inverse=True, return_counts=True)
    twice = count > 1
    who = np.repeat(np.arange(len(n)), sizes)[twice[column]]
    column = (np.cumsum(twice) - 1)[column[twice[column]]]
    by = np.argsort(column, kind="stable")
    who, column = who[by], column[by]
    shared = np.zeros(fit.shape, dtype=np.float32)
    for x in range(0, int(twice.sum()), 4096):
        i, j = np.searchsorted(column, (x, x + 4096))
        has = np.zeros((len(n), int(column[j - 1]) - x + 1), dtype=np.float32)
        has[who[i:j], column[i:j] - x] = 1
        shared += has @ has.T
    least = np.ceil(SIMILARITY * np.add.outer(n, n) / (1 + SIMILARITY) - 1e-9)
    left = n - sizes
    return np.nonzero(fit & (shared >= least - np.maximum.outer(left, left)))


def _possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b): the pairs of each two blocks that may be near copies; rows come by bucket, x and y."""

    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y, own, n = (t.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3, 5))
        root = t.column(6).combine_chunks().dictionary_encode().indices.to_numpy()
        lists = t.column(7).combine_chunks()
        ends, rare = lists.offsets.to_numpy(), lists.values.to_numpy()
        for i, j in zip(edges := groups(t), [*edges[1:], t.num_rows]):
            sizes = np.diff(ends[i : j + 1]).astype(np.int64)
            first, second = possible(n[i:j], root[i:j], sizes, rare[ends[i] : ends[j]], own[i:j] if x[i] != y[i] else None)
            if len(first):
                nodes = t.column(4).slice(i, j - i).to_pylist()
                pairs = [sorted((nodes[f], nodes[s])) for f, s in zip(first.tolist(), second.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

    def groups(t: pa.Table) -> list[int]:
        keys = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(3)])
        return [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]

    held = None
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = groups(held)[-1]  # the last group may go on in the next batch
            if last:
                yield from found(held.slice(0, last))
                held = held.slice(last)
    if held is not None:
        yield from found(held)


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are near copies."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("s"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("t"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t")
    return rows.mapInArrow(tidied(_verify), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes with links: each takes the least label around it, labels of labels
    halve the way, until nothing changes. Labels are written between rounds."""
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), "labels")
    while True:
        around = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least"))
        nearer = labels.join(around, "node").select("node", F.col("root").alias("was"), F.least("root", "least").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = nearer.join(jump, "root", "left").select("node", "was", F.least("root", F.coalesce("further", "root")).alias("root"))
        changes = Observation()
        labels = cut(after, "labels", (changes, F.count_if(F.col("was") != F.col("root")).alias("n"))).select("node", "root")
        if not changes.get["n"]:
            return labels


def joined_up(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after further links: the components are the nodes of a smaller graph."""
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
        links = links.join(own, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    links = cut(links.select("a", "b", "ra", "rb"), "links")
    merged = components(links.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    new = links.select(F.col("a").alias("node"), F.col("ra").alias("root")).union(links.select("b", "rb"))
    every = roots.union(new).distinct()
    further = merged.select(F.col("node").alias("root"), F.col("root").alias("further"))
    return cut(every.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "roots")


def near_copies(texts: DataFrame) -> DataFrame:
    """(node, root) for nodes that have near copies; `texts`: node binary, text, equal texts with one node.

    See the module's docstring for how buckets are worked off.
    """
    sketches = texts.select("node", "text").mapInArrow(tidied(_sketches), "node binary, n int, bucket long")
    sketches = cut(sketches, "sketches")
    shared = sketches.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("size")).where("first <> last")
    members = cut(sketches.join(shared.select("bucket", "size"), "bucket").distinct(), "members")
    if members.isEmpty():
        return members.select("node", F.col("node").alias("root"))
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    wanted = texts.join(reach.select("node"), "node", "left_semi")
    texts = cut(wanted.groupBy("node").agg(F.first("text").alias("text")), "candidates")
    members = members.select("node", "n", "bucket")

    further = texts.mapInArrow(tidied(_further), "node binary, more array<bigint>").join(reach, "node")
    # A bucket, its parts and their parts: each member has FURTHER + 1 places.
    parts = [F.col("bucket")]
    for level in range(FURTHER):
        parts.append(F.xxhash64(parts[-1], F.element_at("more", level + 1)))
    every = members.join(further, "node").select("node", "n", "reach", F.explode(F.array(*parts)).alias("bucket"))
    compared = cut(_candidates(_with_leaders(every)), "compared")
    roots = components(cut(_checked(compared, texts), "links"))
    rest = _open(members, roots)
    if rest.isEmpty():
        return roots
    fresh = cut(_all_pairs(rest, texts).join(compared, ["a", "b"], "left_anti"), "compared")
    return joined_up(roots, _checked(fresh, texts))


def _with_leaders(members: DataFrame) -> DataFrame:
    """Each member of a bucket beside the bucket's leader, the node with the largest reach."""
    most = members.groupBy("bucket").agg(F.max(F.struct("reach", "node", "n")).alias("l"), F.count("*").alias("size")).where("size > 1")
    return members.join(most, "bucket").select("node", "n", F.col("l.node").alias("leader"), F.col("l.n").alias("m"))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the size of the bucket's largest one
    and of the rest; in a bucket of two the leader has met all."""
    grouped = cut(members.join(roots, "node", "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root")), "grouped")
    kinds = grouped.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket")
    kinds = kinds.agg(F.max(F.struct("k", "root")).alias("m"), F.sum("k").alias("size"), F.count("*").alias("kinds")).where("kinds > 1 and size > 2")
    kinds = kinds.select("bucket", F.col("m.root").alias("main"), F.col("m.k").alias("most"), (F.col("size") - F.col("m.k")).alias("others"))
    return cut(grouped.join(kinds, "bucket"), "open")


def _all_pairs(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components that share an open bucket and may be near copies.

    A bucket's largest component and its other members are dealt to blocks. Every two blocks meet, but
    for two of the largest component, and what they hold is gone through in memory.
    """
    texts = texts.join(rest.select("node").distinct(), "node", "left_semi")
    counts = texts.mapInArrow(tidied(_slots), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # SLOTS rows at most
    seen = np.zeros(SLOTS)
    seen[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    ranks = np.minimum(255, 8 * np.log2(1 + seen)).astype(np.uint8)
    rare = texts.mapInArrow(tidied(_rarest(ranks)), "node binary, rare array<bigint>")

    small, salt = F.col("most") + F.col("others") <= BLOCK, F.xxhash64("node")
    mains, others = (F.ceil(F.col(c) / BLOCK) for c in ("most", "others"))
    own = F.when(small, F.lit(0)).when(F.col("root") == F.col("main"), F.pmod(salt, mains)).otherwise(mains + F.pmod(salt, others)).cast("int")
    from_ = F.when(~small & (F.col("root") == F.col("main")), mains).otherwise(0)
    upto = F.when(small, 0).otherwise(mains + others - 1)
    placed = rest.join(rare, "node").select("bucket", "node", "n", "root", "rare", own.alias("own"), F.explode(F.sequence(from_.cast("int"), upto.cast("int"))).alias("other"))
    met = placed.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "n", "root", "rare")
    key = ["bucket", "x", "y"]
    return met.repartition(*key).sortWithinPartitions(*key).mapInArrow(tidied(_possible), "a binary, b binary").distinct()


def _candidates(pairs: DataFrame) -> DataFrame:
    """Each pair once, without those whose sizes alone rule them out."""
    alike = (F.col("node") != F.col("leader")) & (F.least("n", "m") >= SIMILARITY * F.greatest("n", "m"))
    return pairs.where(alike).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _nodes(docs: DataFrame) -> DataFrame:
    """(id, node, text): node is the digest of the text, null for a text without a word."""
    rows = picked(docs, id="doc_id", text="text")
    return rows.withColumn("node", F.when(F.col("text").rlike(r"\S"), F.unhex(F.md5("text"))))


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and class_id, the smallest doc_id among its copies and near copies.

    Documents with null, empty or blank text have no copies: their class is their own id. Repeated
    rows share a class and give a row each. A null id is smaller than none: a class of null ids only
    has a null class_id. Near copies of near copies are in one class.
    """
    rows = _nodes(docs)
    roots = near_copies(rows.where("node is not null").select("node", "text"))
    # A text without near copies is its own root.
    found = rows.select("id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = found.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return found.join(least, "root", "left").select(
        F.col("id").alias("doc_id"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("class_id")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns as they are, with one row of each class: that of the smallest
    id, and among rows that share it the least by text and then by the other columns. Blank texts stay."""
    flat = numbered(docs)
    at, own = F.col(f"c{place(docs, 'text')}"), F.col(f"c{place(docs, 'doc_id')}")
    nodes = _nodes(docs).where("node is not null")
    roots = near_copies(nodes.select("node", "text"))
    found = nodes.select("id", "node").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"), "id", "node").agg(F.count("*").alias("rows"))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "rows")).alias("b")).select("b.*")
    filled = F.coalesce(at.rlike(r"\S"), F.lit(False))
    keyed = flat.where(filled).withColumn("node", F.unhex(F.md5(at)))

    def of(best: DataFrame) -> DataFrame:
        return keyed.join(best, (keyed["node"] == best["node"]) & own.eqNullSafe(best["id"]), "left_semi")

    once = of(best.where("rows = 1")).drop("node")
    # Rows that share the id and the text: the least of them stays.
    others = [c for c in flat.columns if c not in (f"c{place(docs, 'text')}",)]
    repeated = of(best.where("rows > 1")).groupBy("node", f"c{place(docs, 'doc_id')}").agg(F.min(F.struct(*others)).alias("o"), F.first(at).alias("t"))
    repeated = repeated.select(*(F.col("t").alias(c) if c not in others else F.col(f"o.{c}").alias(c) for c in flat.columns))
    return once.unionByName(repeated).unionByName(flat.where(~filled)).toDF(*docs.columns)
