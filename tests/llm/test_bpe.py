import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitbars.llm import bpe

PATH = bpe.default_path()
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


PARTS = st.sampled_from(
    ["'s", "'", "'re", "'ll", "!", "!?", "the", "Thing", "tion", "é", "é", "́", "ß", "İ", "Σ", "ς", "1", "23", " ", "\n", "\t", " ", " ", "\x1c"]
    + ["<|endoftext|>", "<|startoftext|>", "<|", "日本", "😀", "가", "가", "a" * 40, "xyz" * 20, "ﬁ", "Å", "\x00", "़", "क"]
)
TEXTS = st.lists(PARTS, max_size=60).map("".join)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_whole_texts_by_word(text):
    c = bpe.coder(PATH)
    t = c.tokenizer
    ids = np.frombuffer(c.encode([text])[0], dtype="<u4").tolist()
    assert ids == t.encode(text, add_special_tokens=False).ids
    assert c.decode(np.array(ids, dtype="<u4").tobytes()) == t.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([2, 3, 4, 8]), st.sampled_from([1, 4, 16]))
def test_tree_of_pieces_is_the_whole_encoding(text, n, width):
    c = bpe.coder(PATH)
    cuts = [len(text) * i // n for i in range(n + 1)]
    pieces = [c.piece(text[a:b], a) for a, b in zip(cuts, cuts[1:])]
    before, bpe.WINDOW = bpe.WINDOW, width
    try:
        assert c.tree(pieces, cuts, text)[:, 0].tolist() == c.piece(text, 0)[:, 0].tolist()
    finally:
        bpe.WINDOW = before


def test_documents_with_hard_texts(spark, plain):
    texts = [None, "", " ", "a b\nc", "ab" * 4000, "The quick brown fox " * 400, "x" * 5000, "don't <|endoftext|> 'tis " * 99, "a b\nc"]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], SCHEMA)
    docs = docs.selectExpr("doc_id", "text", "doc_id as IDS", "'x' as decoded", "'y' as key")
    coded = bpe.decode(bpe.encode(docs, limit=256))
    assert coded.columns == ["doc_id", "text", "key", "ids", "n_tokens", "decoded"]
    rows = {r.doc_id: r for r in coded.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids
        r = rows[i or None]
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == plain.decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe.digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_the_library(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in bpe.digest(docs).collect()}
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_every_latin_character_beside_letters_and_marks(plain):
    c = bpe.coder(PATH)
    texts = [f"{a}{chr(x)}{b}" for x in range(1, 0x250) for a in ("", "th", "É", "1", ",") for b in ("", "e.", "ñ,", "'s", " x")]
    ids = [np.frombuffer(i, dtype="<u4").tolist() for i in c.encode(texts)]
    assert ids == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_long_texts_take_one_python_worker_at_a_time(spark):
    docs = spark.createDataFrame([(1, "a few words " * 40), (2, "short")], "doc_id long, text string")
    coded = bpe.decode(bpe.encode(docs, limit=64))
    # Between the pieces put together and the decoder lies a shuffle.
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [key") == 2, plan
    assert {r["doc_id"]: r["decoded"].split("<")[0] for r in coded.collect()} == {1: "a", 2: "short"}
