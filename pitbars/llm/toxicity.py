"""Toxicity from a weighted finite-state grammar over clauses.

Words map to classes; five small transducers read the classes of a clause and are composed:

* insult: a word that begins with a learned stem, with any ending, emits the stem's weight;
* threat: agent or intent, then a harming verb, emits a fixed weight;
* target: a second person anywhere in the clause turns a match into a targeted one;
* negation: a negating word up to three words earlier turns a match into a negated one;
* reported speech: a reporting verb or an opening quotation earlier in the clause turns it into a reported one.

A text's score is a logistic function of the weights of its matched clauses by kind of match; a word
counts only through the clause that the grammar accepted. The stems and the weights of the kinds
are learned from labels: at most about ``SAMPLE`` labelled rows of either class (drawn by a hash of
the id) are read; with fewer labels, all of them are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.llm.common import appended, cut, numbered, picked, place, tidied

#: Labelled rows of a class that the fit reads, and the most stems it keeps.
SAMPLE, STEMS = 20_000, 2_000
#: Lengths of a stem; evidence (log-likelihood ratio) and weight (log odds) it needs.
SHORTEST, LONGEST, EVIDENCE, LEAST_WEIGHT = 3, 12, 30.0, 2.5
#: A score from which a text counts as toxic.
LIMIT = 0.7
#: Words a negation reaches over.
SCOPE = 3

TARGETS = "you your yours yourself u ur tu toi te vous votre vos du dich dir dein deine ihr euch euer usted ustedes ti vosotros".split()
NEGATIONS = "not no never neither nor nobody don't isn't aren't wasn't ne pas jamais aucun nicht kein keine keinen nie niemals ni nunca jamás".split()
REPORTS = "said says say called calls calling claimed claims wrote quoted quote told reported alleged dit disait appelle sagte sagt nannte nennt behauptet dijo dice llamó llama".split()
AGENTS = "i we will shall gonna going i'll we'll je nous vais allons ich wir werde werden yo nosotros voy vamos".split()
HARMS = "kill murder shoot stab hurt beat strangle burn destroy hunt tuer tuerai frapper töten umbringen schlagen verletzen matar mataré golpear".split()

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“”«»]")
CLAUSE = re.compile(r"[.!?;:\n,]+(?=\s|$)|\n")
QUOTES = frozenset("\"“”«»")
FORMS = ("plain", "targeted", "negated", "reported")
KINDS = [f"{match}_{form}" for match in ("insult", "threat") for form in FORMS]
#: Weights of the kinds before anything is learned: a negated or reported match says less.
PRIOR = np.array([-3.5, 1.0, 1.3, 0.4, 0.3, 1.0, 1.5, 0.4, 0.3])
THREAT = 4.0


@dataclass
class Grammar:
    """The composed transducers with learned stems and weights."""

    stems: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def __post_init__(self) -> None:
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.fixed = {w: c for words, c in ((HARMS, "H"), (AGENTS, "A"), (REPORTS, "R"), (NEGATIONS, "N"), (TARGETS, "T")) for w in words}
        self.memory: dict[str, bool] = {}
        self.arcs: dict[tuple, tuple] = {}

    def insult(self, word: str) -> float:
        for n in self.lengths:
            if len(word) >= n and (w := self.stems.get(word[:n])):
                return w
        return 0.0

    def starts(self, chunk: str) -> bool:
        """Whether any word of a chunk between spaces can begin a match."""
        return any(self.fixed.get(w) == "H" or self.insult(w) for w in WORD.findall(chunk))

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str]:
        """One arc of the composed machine: new state and the form of a match that ends here.

        State: words that a negation still reaches, agent seen, reported.
        """
        if (arc := self.arcs.get((state, symbol))) is None:
            negated, agent, reported = state
            out = ""
            if symbol == "I" or symbol == "H" and agent:
                out = "reported" if reported else "negated" if negated else "plain"
            arc = (SCOPE if symbol == "N" else max(0, negated - 1), agent or symbol == "A", reported or symbol in "RQ"), out
            self.arcs[state, symbol] = arc
        return arc

    def clause(self, words: list[str], found: np.ndarray) -> None:
        """Add the weights of a clause's matches to `found`, by kind."""
        state, matches, target = (0, False, False), [], False
        for word in words:
            weight = self.insult(word)
            symbol = "I" if weight else "Q" if word in QUOTES else self.fixed.get(word, "O")
            target = target or symbol == "T"
            state, form = self.step(state, symbol)
            if form:
                matches.append((0 if symbol == "I" else 4, form, weight or THREAT))
        for base, form, weight in matches:
            if form == "plain" and target:
                form = "targeted"
            if base and form == "plain":
                weight /= 2  # a threat at nobody
            found[base + FORMS.index(form)] += weight

    def features(self, text: str | None) -> np.ndarray:
        found = np.zeros(len(KINDS))
        if not text:
            return found
        text = text.lower()
        chunks = set(text.split())
        memory = self.memory
        if len(memory) > 500_000:
            memory.clear()
        hit = False
        for c in chunks:
            known = memory.get(c)
            if known is None:
                known = memory[c] = self.starts(c)
            if known:
                hit = True
        if hit:
            for part in CLAUSE.split(text):
                words = WORD.findall(part)
                if any(self.fixed.get(w) == "H" or self.insult(w) for w in words):
                    self.clause(words, found)
        return np.log1p(found)

    def score(self, features: np.ndarray) -> float:
        x = self.weights[0] + float(self.weights[1:] @ features)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the drawn labelled rows that are not held out; a document with several labels
    is toxic if one of them says so, rows without id or label are left out."""
    marks = picked(labels, id="doc_id", toxic="toxic").dropna().where(~held_out(F.col("id")))
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for toxic in (0, 1):
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, SAMPLE / max(1, sizes.get(toxic, 0))))).otherwise(share)
    drawn = marks.where(F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 30)) < share * (1 << 30))
    # At most about two times SAMPLE ids: a small table by construction.
    rows = picked(docs, id="doc_id", text="text").join(F.broadcast(drawn), "id").select("text", F.col("toxic").cast("int").alias("toxic"))
    return cut(rows, "toxicity-sample")


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task's rows with the number of toxic and of clean rows that have them."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[int(toxic == 1)].update({w for w in WORD.findall((text or "").lower()) if len(w) >= SHORTEST})
    words = [*(counts[0].keys() | counts[1].keys())]
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()), pa.array([counts[0][w] for w in words], pa.int64())],
        ["word", "toxic", "clean"],
    )


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Stems that tell toxic texts from clean ones: the best prefix of each family of words."""
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    words = sample.select("text", "toxic").mapInArrow(tidied(_words), "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = (
        words.select(F.explode(F.transform(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word"))), lambda n: F.substring("word", F.lit(1), n))).alias("stem"), "toxic", "clean")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .where("t >= 3")
    )
    t, c, n = F.col("t"), F.col("c"), float(bad + good)
    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    g = 2 * (part(t, (t + c) * (bad / n)) + part(c, (t + c) * (good / n)))
    weight = F.log((t + 0.5) / (bad + 1.0)) - F.log((c + 0.5) / (good + 1.0))
    rows = stems.select("stem", g.alias("g"), weight.alias("w")).where((F.col("g") >= EVIDENCE) & (F.col("w") >= LEAST_WEIGHT))
    found: dict[str, float] = {}
    for r in rows.orderBy(F.desc("g"), F.desc(F.length("stem")), "stem").limit(STEMS * LONGEST).collect():
        if len(found) < STEMS and not any(r.stem.startswith(s) or s.startswith(r.stem) for s in found):
            found[r.stem] = float(r.w)
    return found


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, toxic, s, t): with the least hash of three-word shingles in two orders."""
    for batch in batches:
        signs = []
        for text in batch.column(0).to_pylist():
            words = (text or "").lower().split()
            shingles = {" ".join(words[i : i + 3]).encode("utf-8", "surrogatepass") for i in range(max(1, len(words) - 2))}
            signs.append([min(xxhash.xxh64_intdigest(x, seed) for x in shingles) >> 1 for seed in (1, 2)])
        columns = [pa.array([x[i] for x in signs], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["text", "toxic", "s", "t"])


def unlike(sample: DataFrame) -> DataFrame:
    """The sample with few copies of a text: copies share all their words, which would pass for stems."""
    rows = sample.select("text", "toxic").mapInArrow(tidied(_signed), "text string, toxic int, s long, t long")
    return rows.dropDuplicates(["toxic", "s"]).dropDuplicates(["toxic", "t"]).select("text", "toxic")


def learn_weights(grammar: Grammar, x: np.ndarray, y: np.ndarray, steps: int = 12) -> np.ndarray:
    """Logistic weights of the kinds, held to the prior where the labels say little."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w, hold = PRIOR.copy(), np.full(a.shape[1], 0.2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (y - p) - hold * (w - PRIOR)
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag(hold)
        w = w + np.linalg.solve(curve, slope)
    w[1:] = np.maximum(w[1:], 0.0)  # a match never speaks for a text
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Grammar:
    """Learn stems, then the weights of the kinds of match, from labelled rows."""
    sample = labelled(docs, labels)
    grammar = Grammar(learn_stems(cut(unlike(sample), "toxicity-unlike")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[(tuple(np.round(grammar.features(text), 2)), int(toxic == 1))] += 1
            rows = [[list(k[0]), k[1], n] for k, n in found.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["x", "y", "n"]
            )

    if grammar.stems:
        rows = sample.select("text", "toxic").mapInArrow(tidied(run), "x array<double>, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
        rows = sorted(rows, key=lambda r: (r.x, r.y))
        x = np.repeat(np.array([r.x for r in rows]).reshape(-1, len(KINDS)), [r.n for r in rows], axis=0)
        y = np.repeat(np.array([r.y for r in rows], dtype=float), [r.n for r in rows])
        grammar.weights = learn_weights(grammar, x, y)
    return Grammar(grammar.stems, grammar.weights)


def score(docs: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """Every row with one more column `score` (0 to 1, higher: likelier toxic).

    Null and empty texts score as texts without a match. Rows stay as they are; a column named score
    gives way to the new one.
    """
    flat, at, names = numbered(docs), place(docs, text), docs.columns
    stems, weights = grammar.stems, grammar.weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(stems, weights)
        for batch in batches:
            scores = [g.score(g.features(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    done = flat.mapInArrow(tidied(run), appended(flat, T.StructField("score", T.DoubleType())))
    return done.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() != "score"), "score")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    grammar = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), grammar)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns as they are, without those that score LIMIT or more."""
    flat = numbered(docs)
    scored = score(flat, fit(docs, labels), f"c{place(docs, 'text')}")
    return scored.where(F.col("score") < LIMIT).drop("score").toDF(*docs.columns)
