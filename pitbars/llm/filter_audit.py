"""How five filters on texts act together: in every order, step by step.

Which texts are copies is found with compressed tries. A task inserts the texts of its share into a trie
of its own, whose terminals hold the least id, so of each different text one row goes on, however often
it occurs there. These rows are dealt by range of adaptive prefixes: a prefix under which more than a
share of all bytes lies is lengthened, so texts that begin alike spread, and equal texts meet. The tries
of the ranges hold the least id of the whole table at each terminal; they are traversed for the rows
whose own least id is not that one.

Each document then has a mask of the filters that it fails. Masks are counted per part; all orders and
steps follow from these counts, at most 32 masks of a part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitbars.llm.common import cut, picked

FILTERS = "ABCDE"
COPY = 16  # the mask of E
#: Bytes of different texts, and rows, of one trie of a task's share.
SHARE, ROWS = 16 << 20, 1 << 16
#: Bytes of texts that a range holds, about.
RANGE = 32 << 20
#: Lengths of prefixes, in bytes; a text beyond the last one's share is told by its hash as well.
PREFIXES = 16, 64, 256

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))


class Node:
    """A node of a trie: children by first byte, each with the bytes that lead to it."""

    __slots__ = ("edges", "least", "rows")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.least: int | None = None
        self.rows: list | None = None  # of texts that end here


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b[at:]."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def terminal(root: Node, text: bytes) -> Node:
    """The node at which the text ends, put in if it is new."""
    node, at, n = root, 0, len(text)
    while at < n:
        edge = node.edges.get(text[at])
        if edge is None:
            new = Node()
            node.edges[text[at]] = (text[at:], new)
            return new
        label, child = edge
        if text.startswith(label, at):
            node, at = child, at + len(label)
            continue
        k = common(label, text, at)
        middle = Node()
        middle.edges[label[k]] = (label[k:], child)
        node.edges[label[0]] = (label[:k], middle)
        node, at = middle, at + k
    return node


def insert(root: Node, text: bytes, least: int | None, row: object) -> bool:
    """Whether the text is new; its terminal keeps the least id and the row."""
    node = terminal(root, text)
    new = node.rows is None
    if new:
        node.rows = []
    if least is not None and (node.least is None or least < node.least):
        node.least = least
    node.rows.append(row)
    return new


def terminals(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.rows is not None:
            yield node
        stack.extend(child for _, child in node.edges.values())


def failed(text: bytes) -> int:
    """The mask of the filters A to D that a text fails."""
    words = text.split()  # at the six ASCII characters of white space
    points = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < 50)
        + 2 * (100 * len(set(words)) < 65 * len(words))
        + 4 * (100 * capitals > 5 * points)
        + 8 * any(c in text for c in b"#$%&*|")
    )


SHARED = "doc_id long, part string, mask int, record long, low long, text binary"


def _shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows SHARED: every document; `record` numbers the different texts of a task's share, `low` is the
    least id of them there. One row of each record has the text."""
    from pyspark import TaskContext

    base, records = TaskContext.get().partitionId() << 34, 0
    root, texts, size, rows = Node(), [], 0, 0

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal records
        out = []
        for node in terminals(root):
            x = node.rows[0][2]
            mask, text = failed(texts[x]), texts[x]
            for doc, part, _ in node.rows:
                out.append((doc, part, mask, base + records, node.least, text))
                text = None
            records += 1
            if len(out) >= 1024:
                yield _batch(out)
                out = []
        yield _batch(out)

    for batch in batches:
        for doc, part, text in zip(*(c.to_pylist() for c in batch.columns)):
            if insert(root, text, doc, (doc, part, len(texts))):
                texts.append(text)
                size += len(text)
            rows += 1
            if size > SHARE or rows >= ROWS:
                yield from done()
                root, texts, size, rows = Node(), [], 0, 0
    yield from done()


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], fields: str = SHARED) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in fields.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(list(zip(*rows)) or [()] * len(names), kinds)], names)


def _copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (record, least) of the records whose least id is not that of all records with the text."""
    root, fields, out = Node(), "record long, least long", []
    for batch in batches:
        for record, low, text in zip(*(c.to_pylist() for c in batch.columns)):
            insert(root, text, low, (record, low))
    for node in terminals(root):
        out.extend((record, node.least) for record, low in node.rows if low is not None and node.least < low)
        if len(out) >= 65536:
            yield _batch(out, fields)
            out = []
    yield _batch(out, fields)


def _spread(texts: DataFrame) -> DataFrame:
    """Rows (record, low, text) dealt by range of adaptive prefixes, equal texts together."""

    def prefix(n: int):
        return F.expr(f"substring(text, 1, {n})")

    short, middle, long = PREFIXES
    weights = cut(texts.groupBy(prefix(middle).alias("p")).agg(F.sum(F.length("text")).alias("bytes")), "prefixes")
    total = weights.agg(F.sum("bytes")).first()[0] or 0
    # From 2**10 to 2**16 prefixes of each length, at most, can have more than this.
    much = max(min(RANGE, total >> 10), total >> 16)
    heavy_short = weights.groupBy(F.expr(f"substring(p, 1, {short})").alias("s")).agg(F.sum("bytes").alias("b")).where(F.col("b") > much).select("s")
    heavy_middle = weights.where(F.col("bytes") > much).select(F.col("p").alias("m"))
    marked = texts.join(F.broadcast(heavy_short), prefix(short) == F.col("s"), "left").join(F.broadcast(heavy_middle), prefix(middle) == F.col("m"), "left")
    further = F.concat(prefix(long), F.unhex(F.md5("text")))
    key = F.when(F.col("m").isNotNull(), further).when(F.col("s").isNotNull(), prefix(middle)).otherwise(prefix(short))
    ranges = max(1, -(-total // RANGE), min(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // (RANGE >> 3)))
    dealt = marked.select("record", "low", "text", key.alias("key")).repartitionByRange(int(ranges), "key")
    return dealt.select("record", "low", "text")


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every document: bit 0 for filter A to bit 4 for E.

    A null text is empty, a null source the part ''. A document without id is no copy of any other and
    none is a copy of it; of documents with one id and text, none is a copy for the other's sake.
    """
    rows = picked(docs, doc_id="doc_id", source="source", text="text")
    texts = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    shares = cut(texts.mapInArrow(_shares, SHARED), "shares")
    copies = _spread(shares.where("text is not null").select("record", "low", "text")).mapInArrow(_copies, "record long, least long")
    least = F.coalesce("least", "low")
    mask = F.when(F.col("doc_id") > least, F.col("mask") + COPY).otherwise(F.col("mask"))
    return shares.select("doc_id", "part", "mask", "record", "low").join(copies, "record", "left").select("doc_id", "part", mask.alias("mask"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, mask of its filter, mask of those before it) of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, letter in enumerate(order):
            own = 1 << FILTERS.index(letter)
            out.append(("".join(order), i + 1, own, before))
            before |= own
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    Rows of `docs` count each, also repeated ones; of several labels of a document one that says 1 is
    enough, null labels say nothing. Further columns play no part. No document, no row.
    """
    spark = docs.sparkSession
    said = picked(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    said = said.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c) for c in ("quality", "toxic")))
    counted = (
        masks(docs).join(said, "doc_id", "left").groupBy("part", "mask")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )
    own, before, mask = F.col("own"), F.col("before"), F.col("mask")
    each = counted.withColumn("own", F.explode(F.array(*(F.lit(1 << i) for i in range(5))))).withColumn("before", F.explode(F.sequence(F.lit(0), F.lit(31))))
    each = each.where(before.bitwiseAND(own) == 0)
    fails, earlier = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    here = fails & ~earlier

    def total(condition, value: str = "n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    orders = F.lit(120) / F.bit_count("mask")  # in so many of them a filter that it fails comes first
    sums = each.groupBy("part", "own", "before").agg(
        total(~fails & ~earlier).alias("kept"), total(here).alias("removed"), total(fails & earlier).alias("redundant"), total(mask == own).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * orders.cast("long")).otherwise(0)).alias("shapley"),
    )
    order = F.broadcast(spark.createDataFrame(steps(), "filter_order string, step int, own int, before int"))  # 600 rows
    return sums.join(order, ["own", "before"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 END), 0) AS toxic FROM labels GROUP BY doc_id),
m AS (
    SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN w.doc_id > least THEN 16 ELSE 0 END AS mask
    FROM w LEFT JOIN l ON l.doc_id = w.doc_id
), h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(c, b)),
p AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
    FROM f a JOIN f b ON b.c <> a.c JOIN f c ON c.c NOT IN (a.c, b.c) JOIN f d ON d.c NOT IN (a.c, b.c, c.c)
    JOIN f e ON e.c NOT IN (a.c, b.c, c.c, d.c)
), s AS (
    SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS own, CAST(coalesce(list_sum(bits[1:i-1]), 0) AS INTEGER) AS before
    FROM p, range(1, 6) AS r(i)
)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN mask & own <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END) AS BIGINT) AS shapley
FROM h CROSS JOIN s GROUP BY part, filter_order, step
"""
