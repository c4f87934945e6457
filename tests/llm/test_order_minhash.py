import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pitbars.llm import order_minhash as om

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.integers(0, 6), max_size=40), st.integers(0, 40))
def test_banded_alignment(a, b, least):
    full = lcs(a, b)
    got = om.common(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), least)
    assert (got >= least) == (full >= least)
    assert got <= full


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=30, max_size=80), st.randoms(use_true_random=False))
def test_near_after_edits(a, rng):
    b = list(a)
    for _ in range(rng.randrange(8)):
        x = rng.randrange(len(b))
        b[x : x + rng.randrange(3)] = [rng.randrange(60) for _ in range(rng.randrange(3))]
    m = lcs(a, b)
    want = bool(b) and m / (len(a) + len(b) - m) >= 0.8 - 1e-12
    assert om.near(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) == want


def brute(texts):
    """Class of each text: components over all pairs."""
    n, root = len(texts), list(range(len(texts)))
    sh = [om.shingles(t).tolist() for t in texts]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if texts[i] is None or not texts[i].strip(" \t\n\v\f\r") or texts[j] is None:
                continue
            if texts[i] == texts[j]:
                link = True
            elif sh[i] and sh[j] and min(len(sh[i]), len(sh[j])) >= 0.8 * max(len(sh[i]), len(sh[j])):
                m = lcs(sh[i], sh[j])
                link = m / (len(sh[i]) + len(sh[j]) - m) >= 0.8
            else:
                link = False
            if link:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(words, k=rng.randrange(20, 120))) for _ in range(25)]
    texts = list(base)
    passage = " ".join(rng.choices(words, k=40))
    for t in base[:12]:
        for _ in range(4):
            w = t.split()
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.randrange(5, 20))) for _ in range(30)]
    texts += [base[0]] * 5 + ["", None, " \n", "one two", "one two", "one", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return texts


def test_classes_against_all_pairs(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA).selectExpr("*", "1 as node", "'x' as ROOT", "2 as rows")
    got = {r.doc_id: r.class_id for r in om.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    kept = om.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(texts)))


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d e f g", None, None, None)] * 3 + [(None, "q r s t u v", "en", "s", 1), (None, None, None, None, None), (2, "a b c d e f g", "en", "z", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(((r.doc_id, r.class_id) for r in om.classes(docs).collect()), key=str) == sorted([(1, 1)] * 3 + [(2, 1), (None, None), (None, None)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in om.drop_copies(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c d e f g"), (None, "q r s t u v"), (None, None)], key=str)
    assert om.classes(docs.limit(0)).count() == 0 and om.drop_copies(docs.limit(0)).count() == 0


def star(copies, seed):
    """An original of 400 words and copies of it that are 0.82 to 0.88 like it, hardly two of them like each other."""
    rng = random.Random(seed)
    original = [f"{seed}v{i}" for i in range(400)]
    texts = [" ".join(original)]
    while len(texts) <= copies:
        w = list(original)
        for x in rng.sample(range(0, 400, 5), 7):
            w[x] = f"u{rng.random()}"
        texts.append(" ".join(w))
    return texts


def test_star_of_copies(spark):
    texts = star(100, 1) + star(20, 2)
    sh = [om.shingles(t) for t in texts]
    assert all(om.near(sh[0], s) for s in sh[1:101]) and all(om.near(sh[101], s) for s in sh[102:])
    among = [om.near(sh[i], sh[j]) for i in range(1, 101) for j in range(1, i)]
    assert sum(among) < 0.05 * len(among)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.class_id for r in om.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [0] * 101 + [101] * 21


def test_every_candidate_pair_is_looked_at(spark, monkeypatch):
    """Without the splits, with blocks of three and a leader that is like nobody, all links are still found."""
    monkeypatch.setattr(om, "BLOCK", 3)
    real = om._with_leaders
    monkeypatch.setattr(om, "_with_leaders", lambda members: real(members).where("false"))
    texts = corpus(4)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.class_id for r in om.classes(docs).collect()}
    pairs_only = {i: c for i, c in enumerate(brute(texts))}
    assert sum(got[i] != c for i, c in pairs_only.items()) == 0


def test_rarest_shingles_keep_near_copies():
    rng = np.random.default_rng(3)
    ranks = rng.integers(0, 4, om.SLOTS).astype(np.uint8)
    texts = [*star(12, 3), *corpus(5)[:60]]
    texts = [t for t in texts if t and t.strip()]
    sh = [om.shingles(t) for t in texts]
    rare = [om.rarest(t, ranks) for t in texts]
    n, sizes = np.array([len(s) for s in sh]), np.array([len(r) for r in rare])
    got = set(zip(*(x.tolist() for x in om.possible(n, np.arange(len(n)), sizes, np.concatenate(rare)))))
    want = {(i, j) for j in range(len(n)) for i in range(j) if om.near(sh[i], sh[j])}
    assert want <= got and len(got) < len(n) * (len(n) - 1) / 4
