import random
from itertools import permutations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitbars.llm import filter_audit as fa

DOCS = "doc_id long, source string, text string"
LABELS = "doc_id long, quality int, toxic int"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abé", max_size=6), st.one_of(st.none(), st.integers(0, 50))), max_size=60))
def test_trie_against_dictionary(rows):
    root, want = fa.Node(), {}
    for text, i in rows:
        new = fa.insert(root, text.encode(), i, (text, i))
        assert new == (text not in want)
        want.setdefault(text, []).append(i)
    got = {node.rows[0][0]: (node.least, [i for _, i in node.rows]) for node in fa.terminals(root)}
    assert got == {t: (min((i for i in ids if i is not None), default=None), ids) for t, ids in want.items()}


def brute(docs, labels):
    """Every order applied document by document."""
    import re

    rows = []
    for i, source, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in docs),
        }
        said = [(q, t) for j, q, t in labels if j == i and i is not None]
        rows.append((source or "", fails, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [r for r in left if r[1][c]]
                shapley[c] += len(gone)
                before = order[: step - 1]
                out[part, "".join(order), step] = [
                    len(left) - len(gone), len(gone), sum(r[1][c] and any(r[1][x] for x in before) for r in mine),
                    sum(r[1][c] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
                left = [r for r in left if not r[1][c]]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def corpus():
    rng = random.Random(11)
    start = "the same beginning of many texts, longer than sixty-four bytes, so that prefixes must grow "
    pool = [None, "", " ", "\x0b\x1c x y ", "ÉTÉ " * 60, "A" * 30, "cost 5 %", "word " * 80, "日本 " * 55]
    pool += [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(20, 90))) for _ in range(25)]
    pool += [start + " ".join(f"v{rng.randrange(900)}" for _ in range(60)) for _ in range(25)] + [start * 4 + x for x in "abcd"]
    docs = [(i, rng.choice(["s", "s", "t", None, ""]), rng.choice(pool)) for i in range(400)]
    docs += [(1000 + i, "hot", pool[7]) for i in range(300)] + [(5, "s", pool[20])] * 3 + [(None, "t", pool[21])] * 2 + [(2000, "far", start * 5000)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1500, 3)] + [(6, 1, 1), (6, 0, 0), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("small", [False, True])
def test_audit_against_every_order(spark, monkeypatch, small):
    docs, labels = corpus()
    if small:  # many tries, long prefixes
        monkeypatch.setattr(fa, "SHARE", 2000)
        monkeypatch.setattr(fa, "RANGE", 1 << 10)
        monkeypatch.setattr(fa, "PREFIXES", (2, 8, 16))
    left = spark.createDataFrame(docs, DOCS).repartition(7).selectExpr("*", "1 as part", "2 as mask", "3 as TOXIC", "4 as record")
    right = spark.createDataFrame(labels, LABELS).selectExpr("*", "1 as source", "2 as text")
    got = fa.audit(left, right)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == ["part", "filter_order", "step", *names]
    rows = got.collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows} == brute(docs, labels)
    assert len(rows) == 600 * len({s or "" for _, s, _ in docs})
    documents, labels = spark.createDataFrame(docs, DOCS).toArrow(), spark.createDataFrame(labels, LABELS).toArrow()  # noqa: F841
    assert sorted(map(tuple, rows)) == sorted(duckdb.sql(fa.SQL).fetchall())


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert fa.audit(*none).count() == 0
    one = fa.audit(spark.createDataFrame([(1, None, None)], DOCS), none[1]).where("step = 1 and filter_order = 'ABCDE'").first()
    assert tuple(one) == ("", "ABCDE", 1, 0, 1, 0, 1, 0, 0, 120)
