"""The stages one after the other, each against what it must do to the rows that it gets."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from pitbars.llm import bpe, common

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(sf):
    """The smallest documents and hard ones; labels that the toxicity stage can learn from."""
    documents = pq.read_table(f"{sf}/documents.parquet").select(COLUMNS)
    labels = pq.read_table(f"{sf}/labels.parquet")
    rng = random.Random(9)

    def prose(n, seed):
        r = random.Random(seed)
        return " ".join(f"v{r.randrange(5000)}" for _ in range(n))

    near = prose(300, 1).split()
    near[150] = "changed"
    passage = prose(70, 2)
    more = [
        (900_000, None), (900_001, ""), (900_002, " \n "), (900_003, prose(300, 1)), (900_004, " ".join(near)), (900_005, prose(300, 1)),
        (900_006, prose(80, 3) + " " + passage), (900_007, prose(90, 4) + " " + passage + " " + prose(30, 5)),
        (900_008, prose(60, 6) + " password=hunter2secret " + prose(20, 7)), (900_009, prose(9000, 8)), (None, prose(40, 10)),
    ] + [(900_020, prose(50, 11))] * 2
    rng.shuffle(more)
    table = pa.table([[i for i, _ in more], [t for _, t in more], ["en"] * len(more), [None] * len(more), [len(t or "") for _, t in more]], schema=documents.schema)
    return pa.concat_tables([documents, table]), labels


def write(folder, documents, labels):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(documents, f"{folder}/documents.parquet")
    pq.write_table(labels, f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """The rows after each stage, the documents first."""
    folder = write(tmp_path_factory.mktemp("in"), *planted(sf))
    docs, out = common.table(spark, folder, "documents"), []
    out.append([tuple(r) for r in docs.collect()])
    for name, stage in cp.STAGES:
        path = f"{tmp_path_factory.mktemp('out')}/{name}"
        done = stage(spark, docs, folder)
        if name != "packing":
            assert done.columns == COLUMNS
        done.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append([tuple(r) if name != "packing" else r for r in docs.collect()])
    return folder, out


def ids(rows):
    return sorted((r[0] for r in rows), key=str)


def test_filters_drop_only_what_they_should(stages):
    _, (docs, mild, unrepeated, single, clean, _) = stages
    assert set(ids(mild)) <= set(ids(docs)) and {i for i in ids(docs) if i and i >= 900_000} <= set(ids(mild))
    text = {i: t for i, t, *_ in unrepeated}
    before = {i: t for i, t, *_ in mild}
    assert text[900_000] is None and text[900_001] == "" and text[900_002] == " \n "
    # Of copies the first stays whole; a shared passage goes from the later document.
    assert 900_005 not in text and text[900_003] == before[900_003] and text[900_006] == before[900_006]
    assert len(text[900_007].split()) == 120 and before[900_007].split()[:90] == text[900_007].split()[:90]
    assert all(set((t or "").split()) <= set((before[i] or "").split()) for i, t in text.items())
    assert sum(i == 900_020 for i in ids(unrepeated)) == 2 and sum(i == 900_020 for i in ids(single)) == 1
    assert {900_003, 900_006, 900_007, 900_008, 900_009, None} <= set(ids(single)) <= set(ids(unrepeated))
    after = {i: t for i, t, *_ in clean}
    assert ids(clean) == ids(single) and "hunter2secret" not in after[900_008]
    assert sum(t != u for (i, t, *_), u in ((r, after[r[0]]) for r in single)) >= 1


def test_packed_pieces_are_the_tokens_of_what_is_left(stages):
    _, (*_, clean, pieces) = stages
    t, by = Tokenizer.from_file(bpe.default_path()), {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == set(ids(clean))
    for i, text, *_ in clean:
        tokens = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(by[i], key=lambda p: p.start)
        if sum(j == i for j in ids(clean)) == 1:
            assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
            for p in parts:
                assert p.ids_crc32 == zlib.crc32(np.array(tokens[p.start : p.start + p.length], dtype="<u4").tobytes())
            assert sum(p.length for p in parts) == len(tokens)


def test_run_is_the_stages_and_leaves_no_tables(spark, stages):
    folder, (*_, pieces) = stages
    got = cp.run(spark, folder)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(str, (tuple(r) for r in got.select(*key).collect()))) == sorted(str(tuple(p[c] for c in key)) for p in pieces)


def test_empty_tables(spark, sf, tmp_path):
    documents, labels = planted(sf)
    assert cp.run(spark, write(tmp_path / "a", documents.slice(0, 0), labels.slice(0, 0))).count() == 0
