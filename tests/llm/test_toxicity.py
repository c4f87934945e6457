import random

from pitbars.llm import toxicity as tx

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=11, n=900):
    """Toxic texts hold inflected words of an invented family or a plain insult."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(["ba", "ko", "ti", "ne", "su", "ra", "lo"], k=rng.randrange(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        t = rng.choices(words, k=rng.randrange(5, 80))
        toxic = int(i % 6 == 0)
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            t.insert(rng.randrange(len(t)), rng.choice(["zorgu" + rng.choice(["s", "na", "ko"]), "Vlimp,"]))
        rows.append((i, " ".join(t), "en", "s", 1))
        if i % 5:
            labels.append((i, 1, toxic))
    return rows, labels


def auc(pairs):
    good, bad = [s for s, t in pairs if not t], [s for s, t in pairs if t]
    return sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(good) * len(bad))


def test_learned_family_and_held_out_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(9001, "", "en", "s", 0), (9002, None, None, None, None), (None, "zorguna", None, None, None), (3, rows[3][1], "en", "s", 1)], DOCS)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (4, None, None), (3, 1, 0), (7777, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs.selectExpr("*", "0.5 as SCORE", "1 as toxic", "2 as id")
    got = tx.judge(docs, marks).collect()
    assert len(got) == len(rows) + 4
    by = {r.doc_id: r for r in got}
    held = [(by[i].score, t) for i, _, t in labels if by[i].held_out]
    assert len(held) > 200 and auc(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= tx.LIMIT) for r in got)
    assert by[9001].predicted == 0 and by[9002].predicted == 0 and by[None].predicted == 1
    kept = tx.drop_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text", "en", "s", 9)], DOCS)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in tx.judge(docs, marks).collect()] == [0]
    assert tx.judge(docs.limit(0), marks).count() == 0 and tx.drop_toxic(docs.limit(0), marks).columns == docs.columns


def test_clauses():
    g = tx.Grammar({"idiot": 5.0})

    def kind(text):
        return [k for k, x in zip(tx.KINDS, g.features(text)) if x]

    assert kind("What an idiot.") == ["insult_plain"] and kind("You idiots!") == ["insult_targeted"]
    assert kind("That is not an idiot.") == ["insult_negated"] and kind("He said: x. They called him an idiot") == ["insult_reported"]
    assert kind("we will hurt you") == ["threat_targeted"] and kind("they hurt you") == [] and kind("I'll not hurt them") == ["threat_negated"]
    assert kind("a plain text") == [] and kind("") == [] and kind(None) == []
    assert g.score(g.features("you idiot")) > g.score(g.features("an idiot")) > g.score(g.features("not an idiot")) > g.score(g.features("x"))
