"""BPE encoding and decoding with a public tokenizer file, in parallel also within one text.

A text of more than ``limit`` characters is halved until its pieces are short enough; the pieces are
rows of their own, so tasks encode them side by side. Neighbouring encodings are then joined in a
tree: the text around the join is encoded anew, in a window that grows until it shares tokens, at
the same place, with the left and with the right encoding. What lies beyond the shared tokens is the
same as in one encoding of the whole: within a run that the tokenizer treats as one word a token
sequence is the encoding exactly if each pair of neighbours is, and each such pair comes from one of
the three encodings; at the end of a word the scan starts afresh in all of them.

Shorter texts are cut at ASCII white space, which ends a word in every tokenizer whose pre-tokenizer
drops white space; each different word of a batch is encoded once, those of Latin-1 letters side by
side in arrays (`merges`), and the ids are gathered by word.

Ids are carried as binary: unsigned 32-bit little-endian integers.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.llm.common import appended, numbered, place, tidied, together
from pitbars.llm.merges import Merges, lowered, plain

VOCABULARY = "word_bpe_49k.json"
#: Characters above which a text is halved.
LIMIT = 32_768
#: Words of each of the two generations that a worker remembers, and their longest length.
REMEMBERED, WORD = 50_000, 48
#: Characters of the bytes that a Latin-1 letter beyond ASCII has in UTF-8, as byte-level models write them.
_BYTES = {b: c for c, b in zip(range(256, 324), [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255)])}
#: First half-width in characters of the window around a join.
WINDOW = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Memory(dict):
    """Ids of words: two generations of up to REMEMBERED words, so that frequent ones stay."""

    def __init__(self, ids, apart: bool):
        super().__init__({"": b""})
        self.ids, self.apart, self.old = ids, apart, {}

    def __missing__(self, word: str) -> bytes:
        if self.apart:
            # A run of punctuation after letters is a word of its own.
            core = word.rstrip(punctuation)
            if len(core) < len(word) and core.isalpha():
                return self[core] + self[word[len(core) :]]
        if (known := self.old.get(word)) is None:
            known = self.ids(word)
            if len(word) > WORD:
                return known
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = known
        return known


class Coder:
    """One tokenizer file in one worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = json.dumps(spec["pre_tokenizer"]), json.dumps(spec["normalizer"])
        # Words end at white space if the split drops it and nothing else looks over it.
        self.by_word = '"Removed"' in pre and '"invert": true' in pre and '"add_prefix_space": true' not in pre
        # Lower case by character, and nothing else that could change a Latin-1 text; a run of letters
        # is one word, its bytes go to the merges.
        self.lowers = self.by_word and '"Lowercase"' in norm and "[\\\\p{L}]+" in pre and '"use_regex": false' in pre
        model = spec["model"]
        usual = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback", "fuse_unk"))
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "") if self.lowers and usual else None
        self.spaced = spec["decoder"] is None
        # A special token that spans a join reaches less than this far from it.
        self.reach = max([0, *(len(t["content"]) for t in spec["added_tokens"])])
        self.vocabulary = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.exact = Memory(lambda word: self._plain([word])[0], apart=False)
        self.lowered = Memory(self._lowered, apart=True)

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _lowered(self, word: str) -> bytes:
        """Ids of a Latin-1 word in lower case without special tokens: letters go straight to the merges."""
        if not word.isalpha():
            return self._plain([word])[0]
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _words(self, text: str) -> tuple[list[str], Memory]:
        """The text cut at spaces and line feeds, in lower case if it is Latin-1, and their memory."""
        memory = self.exact
        if self.lowers and "<|" not in text:
            try:
                text.encode("latin-1")
                text, memory = text.lower(), self.lowered
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" "), memory

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text."""
        ids, offsets = self.flat(pa.array(texts, pa.string()))
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the offsets at which each begins and ends."""
        if not self.by_word:
            return _flat(self._plain(texts.to_pylist()))
        words = pc.ascii_split_whitespace(texts)
        bounds = words.offsets.to_numpy()
        seen = words.flatten().dictionary_encode()
        if not len(seen):
            return np.empty(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        ids, counts = self._different(seen.dictionary)
        at = seen.indices.to_numpy()
        sizes = counts[at]
        return ids[spread((np.cumsum(counts) - counts)[at], sizes)], np.concatenate([[0], np.cumsum(sizes)])[bounds - bounds[0]]

    def _different(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, one after the other, and each one's number."""
        if self.merges is None:
            ids, offsets = _flat([*map(self.exact.__getitem__, words.to_pylist())])
            return ids, np.diff(offsets)
        data, offsets = _bytes(words)
        easy, letters = plain(data, offsets)
        starts, ends = offsets[:-1], offsets[1:]
        split = starts + letters
        # Two parts a word: its letters and its marks, or all of it and nothing.
        parts = np.zeros((len(words), 2), dtype=np.int64)
        rows = [np.flatnonzero(easy & (split > starts)), np.flatnonzero(easy & (ends > split))]
        low = pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(lowered(data))])
        cores = pc.ascii_rtrim(low.take(pa.array(rows[0])), characters=punctuation).dictionary_encode()
        core, at = _bytes(cores.dictionary)
        marks, counts = self.merges.encode(data, split[rows[1]], ends[rows[1]])
        known, sizes = self.merges.encode(core, at[:-1], at[1:])
        at = cores.indices.to_numpy()
        ids = np.concatenate([known[spread((np.cumsum(sizes) - sizes)[at], sizes[at])], marks])
        counts = np.concatenate([sizes[at], counts])
        parts[rows[0], 0], parts[rows[1], 1] = counts[: len(rows[0])], counts[len(rows[0]) :]
        hard = np.flatnonzero(~easy)
        more, offsets = _flat([*map(self.exact.__getitem__, words.take(pa.array(hard)).to_pylist())])
        parts[hard, 0] = np.diff(offsets)
        begins = (np.cumsum(parts) - parts.ravel()).reshape(-1, 2)
        out = np.empty(int(parts.sum()), dtype="<u4")
        out[spread(np.concatenate([begins[rows[0], 0], begins[rows[1], 1], begins[hard, 0]]), np.concatenate([counts, parts[hard, 0]]))] = np.concatenate([ids, more])
        return out, parts.sum(axis=1)

    def piece(self, text: str, start: int) -> np.ndarray:
        """Rows (id, first character, end) of the text, which starts at `start` of its document. The
        tokens of a short word between spaces have the place of the word."""
        words, memory = self._words(text) if self.by_word else ([text], self.exact)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        begins = np.cumsum(sizes + 1) - sizes - 1 + start
        if self.by_word and sizes.max() <= WORD:
            got = [*map(memory.__getitem__, words)]
            counts = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
            ids = np.frombuffer(b"".join(got), dtype="<u4").astype(np.int64)
            return np.stack([ids, np.repeat(begins, counts), np.repeat(begins + sizes, counts)], axis=1)
        parts = []
        for word, begin in zip(words, begins.tolist()):
            if self.by_word and len(word) <= WORD:
                ids = np.frombuffer(memory[word], dtype="<u4").astype(np.int64)
                parts.append(np.stack([ids, np.full(len(ids), begin), np.full(len(ids), begin + len(word))], axis=1))
            else:
                e = self.tokenizer.encode(word, add_special_tokens=False)
                ids = np.array(e.ids, dtype=np.int64).reshape(-1, 1)
                parts.append(np.hstack([ids, np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + begin]))
        return np.concatenate(parts)

    def pieces(self, texts: list[str], starts: list[int]) -> list[np.ndarray]:
        """piece() of each text; the words of all of them are encoded together."""
        words = [t.replace("\n", " ").split(" ") for t in texts]
        if self.merges is None or any(len(w) > WORD for part in words for w in part):
            return [self.piece(t, s) for t, s in zip(texts, starts)]
        seen = pa.array([w for part in words for w in part], pa.string()).dictionary_encode()
        ids, counts = self._different(seen.dictionary)
        at, out, first = seen.indices.to_numpy(), [], 0
        begun = np.cumsum(counts) - counts
        for part, start in zip(words, starts):
            mine = at[first : first + len(part)]
            sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            begins, n = np.cumsum(sizes + 1) - sizes - 1 + start, counts[mine]
            out.append(np.stack([ids[spread(begun[mine], n)].astype(np.int64), np.repeat(begins, n), np.repeat(begins + sizes, n)], axis=1))
            first += len(part)
        return out

    def joined(self, left: np.ndarray, right: np.ndarray, text: str, first: int, at: int, end: int) -> np.ndarray:
        """One encoding of text[first:end] from those of its two sides, which meet at `at`."""
        width = WINDOW
        while True:
            a, b = max(first, at - width), min(end, at + width)
            middle = self.piece(text[a:b], a)
            i, j = (0, 0) if a == first else shared(left, middle, at - self.reach, last=False)
            k, m = (len(right), len(middle)) if b == end else shared(right, middle, at + self.reach, last=True)
            if i is not None and k is not None and j <= m:
                return np.concatenate([left[:i], middle[j:m], right[k:]])
            width *= 2

    def tree(self, pieces: list[np.ndarray], cuts: list[int], text: str) -> np.ndarray:
        """All pieces joined, neighbours first."""
        while len(pieces) > 1:
            new, ends = [], [cuts[0]]
            for x in range(0, len(pieces) - 1, 2):
                new.append(self.joined(pieces[x], pieces[x + 1], text, cuts[x], cuts[x + 1], cuts[x + 2]))
                ends.append(cuts[x + 2])
            if len(pieces) % 2:
                new.append(pieces[-1])
                ends.append(cuts[-1])
            pieces, cuts = new, ends
        return pieces[0]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        if not self.spaced:
            return self.tokenizer.decode(numbers, skip_special_tokens=False)
        vocabulary, half = self.vocabulary, 1 << 16
        parts = (" ".join([vocabulary[i] for i in numbers[x : x + half]]) for x in range(0, len(numbers), half))
        return " ".join(parts)


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts, one after the other, and the offsets at which each begins and ends."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    return np.frombuffer(b"".join(parts), dtype="<u4"), np.concatenate([[0], np.cumsum(sizes)])


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its strings in them."""
    offsets = np.frombuffer(words.buffers()[1] or bytes(4), dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]], offsets


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... up to each size, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 2**31 and begins.max(initial=0) < 2**31 else np.int64
    out = np.repeat((begins - (ends - sizes)).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


def places(rows: np.ndarray) -> list[tuple]:
    """(begin, end, ids, index of the first, index after the last) of each run of tokens with one place."""
    edges = [0, *(np.flatnonzero((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)) + 1).tolist(), len(rows)]
    ids = rows[:, 0].tolist()
    return [(*rows[a, 1:].tolist(), tuple(ids[a:b]), a, b) for a, b in zip(edges, edges[1:])]


def shared(side: np.ndarray, middle: np.ndarray, bound: int, last: bool) -> tuple[int | None, int]:
    """Where two encodings agree in two places in a row that own their characters: index after their tokens
    in each (`last` false: the right-most such place before `bound`), or before them (`last`: the left-most
    one after it)."""
    lo, hi = (middle[0, 1], middle[-1, 2]) if len(middle) else (0, 0)
    near = np.flatnonzero((side[:, 1] >= lo) & (side[:, 2] <= hi))
    if len(near) < 2 or len(middle) < 4:
        return None, 0
    base = int(near[0])
    ours, theirs = places(side[base : int(near[-1]) + 1]), places(middle)
    known = {p[:3]: n for n, p in enumerate(ours)}

    def own(n: int) -> bool:  # no neighbour starts within the two places' characters or before
        before, first, second, after = theirs[n - 1 : n + 3]
        if first[0] < bound if last else second[1] > bound:
            return False
        return before[1] <= first[0] and first[1] <= second[0] and second[1] <= after[0]

    for n in range(1, len(theirs) - 2) if last else range(len(theirs) - 3, 0, -1):
        x = known.get(theirs[n][:3])
        if x is not None and x + 1 < len(ours) and ours[x + 1][:3] == theirs[n + 1][:3] and own(n):
            return (base + ours[x][3], theirs[n][3]) if last else (base + ours[x + 1][4], theirs[n + 1][4])
    return None, 0


@cache
def coder(path: str) -> Coder:
    return Coder(path)


#: Characters, about, and texts that are encoded at once.
AT_ONCE, TEXTS = 3_000_000, 1024


def encoded(path: str, batches: Iterable[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches put together, with the ids of their texts and the offsets at which each text's begin and end."""
    c = coder(path)
    for batch in together(batches, text, AT_ONCE, TEXTS):
        yield batch, *c.flat(pc.fill_null(batch.column(text).cast(pa.string()), ""))


def _short(path: str, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, offsets in encoded(path, batches, text):
            column = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids)])
            for x in range(0, batch.num_rows, 512):
                part = batch.slice(x, 512)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, column.slice(x, 512), pa.array(np.diff(offsets[x : x + 513]))], [*part.schema.names, "ids", "n_tokens"]
                )

    return run


Step = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encode(
    docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT, then: Step | None = None, schema: str | None = None
) -> DataFrame:
    """Every row with two more columns: `ids` (binary, unsigned 32-bit little-endian) and `n_tokens`.

    A null text counts as empty and has no ids. Rows are kept as they are, also repeated ones; columns
    of `docs` that are named ids or n_tokens give way to the new ones. No row, no result.

    `then` goes on with a task's batches (the other columns in their order, then `ids` and `n_tokens`) in the same
    Python worker, so ids needn't pass through the JVM; its rows, of `schema`, are the result.
    """
    path = path or default_path()
    at, names = place(docs, text), docs.columns
    flat = numbered(docs)
    body = F.col(f"c{at}")
    long = F.coalesce(F.length(body), F.lit(0)) > limit
    fields = T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())
    few, many = flat.where(~long), _halved(flat.where(long), at, path, limit)
    if then:

        def on(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return then(batch.drop_columns([f"c{at}"]) for batch in _short(path, at)(batches))

        return few.mapInArrow(tidied(on), schema).unionByName(many.drop(f"c{at}").mapInArrow(tidied(then), schema))
    both = few.mapInArrow(tidied(_short(path, at)), appended(flat, *fields)).unionByName(many)
    kept = [i for i, n in enumerate(names) if n.lower() not in ("ids", "n_tokens")]
    return both.select(*(F.col(f"c{i}").alias(names[i]) for i in kept), "ids", "n_tokens")


def _halved(rows: DataFrame, at: int, path: str, limit: int) -> DataFrame:
    """The long texts: pieces of halves encoded in rows of their own, joined per text.

    Rows with the same text share one encoding; what is together in a group is one text.
    """
    body = F.col(f"c{at}")
    key = F.unhex(F.md5(body))
    texts = rows.select(key.alias("key"), body.alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    body = F.col("text")
    n = F.length(body)
    count = F.expr(f"cast(shiftleft(1L, cast(ceil(log2(length(text) / {limit}D)) as int)) as long)")
    pieces = (
        texts.select("key", "text", n.cast("long").alias("n"), count.alias("pieces"))
        .select("key", "text", "n", "pieces", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
        .withColumn("start", F.expr("n * piece div pieces"))
        .withColumn("end", F.expr("n * (piece + 1) div pieces"))
        .select("key", "piece", "start", F.expr("substring(text, cast(start + 1 as int), cast(end - start as int))").alias("part"))
    )

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            starts, parts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for x in range(0, len(parts), 64):
                found = [p.astype("<u4").tobytes() for p in c.pieces(parts[x : x + 64], starts[x : x + 64])]
                yield pa.RecordBatch.from_arrays([*batch.slice(x, 64).columns, pa.array(found, pa.binary())], ["key", "piece", "start", "part", "rows"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for x in range(batch.num_rows):
                got = sorted(batch.column(1)[x].as_py(), key=lambda p: p["piece"])
                whole = "".join(p["part"] for p in got)
                found = [np.frombuffer(p["rows"], dtype="<u4").reshape(-1, 3).astype(np.int64) for p in got]
                ids = c.tree(found, [*(p["start"] for p in got), len(whole)], whole)[:, 0].astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(x, 1).column(0), pa.array([ids], pa.binary()), pa.array([len(ids) // 4], pa.int64())], ["key", "ids", "n_tokens"]
                )

    encoded = (
        pieces.repartition("key", "piece")
        .mapInArrow(tidied(leaf), "key binary, piece long, start long, part string, rows binary")
        .groupBy("key")
        .agg(F.collect_list(F.struct("piece", "start", "part", "rows")).alias("pieces"))  # one text's pieces
        .mapInArrow(tidied(join), "key binary, ids binary, n_tokens long")
        # Readers in Python would else run beside this, and each task would hold two Python workers.
        .repartition("key")
    )
    rows = rows.withColumn("key", key)
    return rows.join(encoded, "key").drop("key")


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Every row with one more column `decoded`, the text of its ids, special tokens included.

    Null ids give an empty text. A column of that name gives way to the new one.
    """
    path = path or default_path()
    flat, at = numbered(rows), place(rows, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for x in range(0, batch.num_rows, 512):
                part = batch.slice(x, 512)
                texts = [c.decode(i or b"") for i in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    names = rows.columns
    done = flat.mapInArrow(tidied(run), appended(flat, T.StructField("decoded", T.StringType())))
    return done.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() != "decoded"), "decoded")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digests of ids and decoded text per document."""
    coded = decode(encode(docs.select("doc_id", "text"), path=path).drop("text"), path=path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
