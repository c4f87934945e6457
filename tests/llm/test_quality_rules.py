import random
import re

from pitbars.llm import quality_rules as qr

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {x for at in windows.values() if len(at) > 1 for i in at for x in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


HARD = [None, "", " ", "\n\n", "a", "\x0b\x0c\r\t a b   c", "x " * 5000, "a b c d e " * 3, "a b c d e f a b c d e", "a a a a a a", "a\na\n a\nb\na", "😀 é <|> # $%&*", "\x00 \x1f \x85", "one two three four five six seven eight nine ten"]


def test_statistics_against_brute_force(spark, sf):
    rng = random.Random(1)
    texts = HARD + [" ".join(rng.choices("abc", k=rng.randrange(60))) + rng.choice(["", "\n", " \n a b"]) * 3 for _ in range(60)]
    docs = spark.createDataFrame([(i if i else None, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    docs = docs.unionByName(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.selectExpr("*", "1 as t", "2 as W", "3 as g")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in qr.judge(docs, labels).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute(r.text), r.text
        assert not (g.base_failed and g.kept)


def test_learned_rules(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(2000)]
    rows, labels = [], []
    for i in range(900):
        t = rng.sample(words, k=rng.randrange(20, 90))
        kind = i % 9
        if kind == 0:
            t = [w + rng.choice(["$$$", "***"]) for w in t]
        elif kind == 1:
            t = [w.upper() + "!!" for w in t]
        rows.append((i, " ".join(t), "en", "s", 1))
        if i % 2:
            labels.append((i, int(kind > 1), 0))
    docs = spark.createDataFrame(rows + [(5, rows[5][1], None, None, None)], DOCS)
    marks = spark.createDataFrame(labels + [(None, 0, 0), (2, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    got = qr.judge(docs, marks).collect()
    assert len(got) == 901
    wrong = sum(r.kept != (r.doc_id % 9 > 1) for r in got if not r.base_failed and r.doc_id % 2 == 0)
    assert wrong <= 5
    rules = qr.learn(qr.statistics(docs), marks)
    assert 1 <= len(rules) <= qr.RULES and all(1 <= len(r) <= qr.CONDITIONS for r in rules)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten", "en", "s", 9)], DOCS)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in qr.judge(docs, marks).collect()] == [True]
    assert qr.judge(docs.limit(0), marks).count() == 0


def test_plan_has_no_python(spark, sf):
    plan = qr.statistics(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
