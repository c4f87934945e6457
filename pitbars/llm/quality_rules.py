"""Quality rules: base statistics of a text and a decision list learned from labels.

Everything on the way of a row is a DataFrame expression. The list is learned by sequential covering:
a rule grows condition by condition (a threshold on one statistic), each time by the one with the best
gain on two thirds of the labelled rows; it is pruned on the last third, kept if it is precise there,
and the rows that it covers leave the training set before the next rule grows. Each step is one small
aggregate over binned statistics; only counts by statistic and bin reach the driver. The rules become
one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitbars.llm.common import cut, picked

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS, REPEATED_PERCENT = 10, 20

#: Statistics that rules may test, all by word or character so that a text's length doesn't matter.
FEATURES = {
    "word_length": "try_divide(word_chars, n_words)",
    "symbols": "try_divide(n_symbols, n_words)",
    "duplicate_lines": "try_divide(n_dup_lines, n_lines)",
    "repeated": "try_divide(n_repeat_words, n_words)",
    "capitals": "try_divide(n_capitals, word_chars)",
    "marks": "try_divide(n_marks, n_words)",
    "stops": "try_divide(n_stops, n_words)",
    "digits": "try_divide(n_digits, word_chars)",
    "distinct": "try_divide(n_distinct, sqrt(n_words))",
    "lines": "try_divide(n_lines, n_words)",
}
#: Quantiles of either class that serve as thresholds; bounds of the list.
QUANTILES = [0.001, 0.01, 0.03, 0.1, 0.25, 0.5, 0.75, 0.9, 0.97, 0.99, 0.999]
RULES, CONDITIONS, PRECISION, SUPPORT = 8, 3, 0.97, 0.005


def _without(column: Column, characters: str) -> Column:
    return F.length(F.translate(column, characters, ""))


def _repeated(grams: Column) -> Column:
    """Words in windows that occur more than once: positions of equal neighbours among sorted windows,
    then the stretch that they cover."""
    ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["g"].eqNullSafe(x["g"])) | (F.get(s, i + 1)["g"].eqNullSafe(x["g"])))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        total = F.aggregate(places, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")))
        return total["n"]

    # The sorted array as one value, named by a one-element array.
    return F.transform(F.array(ordered), covered)[0]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and further counts.

    A null text counts as empty: no words and all counts 0. Repeated rows and null ids give a row each.
    """
    rows = picked(docs, doc_id="doc_id", t=text).select("doc_id", F.coalesce("t", F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", F.array_remove(F.split("t", SPACE), "").alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"))
    rows = rows.select("doc_id", "t", "w", "l", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    n = F.size("w")
    grams = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get("h", i + x) for x in range(WINDOW))))
    rows = rows.withColumn("g", F.when(n >= WINDOW, grams).otherwise(F.array().cast("array<bigint>")))
    size = F.length("t")
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        _without(F.col("t"), SPACES).cast("long").alias("word_chars"),
        (size - _without(F.col("t"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("g")) == F.size("g"), F.lit(0)).otherwise(_repeated(F.col("g"))).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        (size - _without(F.col("t"), "!?")).cast("long").alias("n_marks"),
        (size - _without(F.col("t"), ".,;:")).cast("long").alias("n_stops"),
        (size - _without(F.col("t"), "0123456789")).cast("long").alias("n_digits"),
        F.size(F.array_distinct("h")).cast("long").alias("n_distinct"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expression(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return F.coalesce(value > self.threshold if self.above else value <= self.threshold, F.lit(False))


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.expression()
    return out


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each statistic in either class: at most 2 * len(QUANTILES) of each."""
    columns = [F.percentile_approx(F.expr(e), QUANTILES, 1000).alias(f) for f, e in FEATURES.items()]
    found = rows.groupBy("bad").agg(*columns).collect()
    return {f: sorted({float(x) for r in found for x in r[f] or []}) for f in FEATURES}


def _gain(p: int, n: int, total_p: int, total_n: int) -> float:
    """First-order information gain of covering p bad and n good rows instead of all."""
    return p * (math.log2(p / (p + n)) - math.log2(total_p / (total_p + total_n))) if p else 0.0


def _counts(rows: DataFrame, limits: dict[str, list[float]]) -> dict[tuple[str, int], list[int]]:
    """(statistic, bin) -> good and bad rows of the growing part, good and bad rows of the pruning part."""

    def binned(f: str) -> Column:
        value = F.expr(FEATURES[f])
        below = F.filter(F.lit(limits[f]).cast("array<double>"), lambda x: x < value)
        return F.struct(F.lit(f).alias("f"), F.size(below).alias("b"))

    bins = [binned(f) for f in FEATURES]
    found = rows.select("bad", "prune", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b", "bad", "prune").agg(F.count("*").alias("n"))
    out: dict[tuple[str, int], list[int]] = {}
    for r in found.collect():
        out.setdefault((r.f, r.b), [0, 0, 0, 0])[2 * r.prune + r.bad] += r.n
    return out


def _best(rows: DataFrame, limits: dict[str, list[float]]) -> tuple[Condition | None, list[int], list[int]]:
    """The condition with the best gain on the growing part, what it covers and what there is."""
    counts = _counts(rows, limits)
    first = next(iter(FEATURES))
    total = [sum(c[i] for (f, _), c in counts.items() if f == first) for i in range(4)]
    best, score, covered = None, 1e-9, total
    for f, edges in limits.items():
        under = [0, 0, 0, 0]
        for b, edge in enumerate(edges):
            under = [x + y for x, y in zip(under, counts.get((f, b), [0, 0, 0, 0]))]
            for above in (False, True):
                inside = [t - u for t, u in zip(total, under)] if above else under
                gain = _gain(inside[1], inside[0], total[1], total[0])
                if gain > score:
                    best, score, covered = Condition(f, above, edge), gain, inside
    return best, covered, total


def learn(stats: DataFrame, labels: DataFrame, least_precision: float = PRECISION) -> list[Rule]:
    """Ordered rules that reject, from rows labelled with quality 0 or 1.

    Rows that the base rules reject teach nothing, nor do rows without label. A document with several
    labels counts as bad if one of them is 0. Without bad or good rows there are no rules.
    """
    marks = picked(labels, id="doc_id", quality="quality").dropna().groupBy("id").agg((F.min("quality") == 0).cast("int").alias("bad"))
    prune = (F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(3)) == 0).cast("int").alias("prune")
    needed = [c for c in stats.columns if c != "doc_id"]
    rows = cut(stats.where(~base_failed()).join(marks, F.col("doc_id") == F.col("id")).select("bad", prune, *needed), "labelled")
    limits = thresholds(rows)
    rules: list[Rule] = []
    while len(rules) < RULES:
        rule: Rule = ()
        steps: list[tuple[Rule, list[int]]] = []
        covered, total = rows, None
        while len(rule) < CONDITIONS:
            condition, inside, there = _best(covered, limits)
            total = total or there
            if condition is None:
                break
            rule = (*rule, condition)
            steps.append((rule, inside))
            if not inside[0]:
                break
            covered = rows.where(matches(rule))
        if not steps or not total[1]:
            break

        # Pruned: the shortest beginning of the rule that is as precise as any on the other rows.
        def precise(counts: list[int]) -> float:
            return (counts[3] + 0.5) / (counts[2] + counts[3] + 1)

        rule, inside = max(steps, key=lambda s: (round(precise(s[1]), 3), -len(s[0])))
        bad, good = inside[1] + inside[3], inside[0] + inside[2]
        if bad < max(4, SUPPORT * (total[1] + total[3])) or bad / (bad + good) < least_precision:
            break
        rules.append(rule)
        rows = rows.where(~matches(rule))
    return rules


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether a row is kept, and the number of the rule that rejects it (from 1; 0: a base rule)."""
    kept, number = F.when(base_failed(), F.lit(False)), F.when(base_failed(), F.lit(0))
    for i, rule in enumerate(rules, 1):
        kept, number = kept.when(matches(rule), F.lit(False)), number.when(matches(rule), F.lit(i))
    return kept.otherwise(F.lit(True)), number


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The base statistics and the verdict of every document; `rule` says which rule rejects it."""
    stats = cut(statistics(docs), "statistics")
    kept, rule = verdict(learn(stats, labels))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return stats.select(*base, base_failed().alias("base_failed"), kept.alias("kept"), rule.alias("rule"))
