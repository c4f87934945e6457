"""URL filter: rules on host and path, and for the rest a ratio of two character models.

URLs that a rule allows are the accepted examples, URLs that a rule blocks the rejected ones. Each
class has a Markov model of characters of variable order: the chance of a character after up to
``ORDER`` others is interpolated with that after one fewer, by Witten-Bell smoothing, down to the
uniform chance; so a context counts for as much as it was seen. A URL's score is the difference of
its log-likelihoods in the two models per character. One fifth of the examples (by digest) is kept
out of the counts; the limit is the point at which both classes of it lie equally many standard
deviations away.

Everything is a DataFrame expression. The counts cover all examples; scores are computed once for
each distinct sequence of ORDER + 1 characters and joined to the URLs' positions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitbars.llm.common import cut, picked

#: Characters of the longest context, and the number of equally likely characters below all contexts.
ORDER, ALPHABET = 4, 256

#: (rule, verdict): host, then the beginning of the path.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: len(x[0])):  # a longer one is asked before
        domain, _, start = r.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + start))
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def positions(urls: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram): each character of the text, and its end, with up to ORDER characters before it.
    The text begins and ends with marks of its own."""
    marked = F.concat(F.lit("\x02"), F.col(text), F.lit("\x03"))
    n = F.length(text)
    spot = F.explode(F.sequence(F.lit(2), n + 2))  # of the last character of each gram
    rows = urls.select(*([key] if key else []), marked.alias("m"), spot.alias("i"))
    start = F.greatest(F.lit(1), F.col("i") - ORDER)
    gram = F.substring(F.col("m"), start, F.col("i") - start + 1)
    return rows.select(*([key] if key else []), gram.alias("gram"))


def model(examples: DataFrame) -> DataFrame:
    """(gram, good, bad): how often each sequence of up to ORDER + 1 characters ends at a character of
    the accepted and of the rejected examples (text, good)."""
    long = positions(examples, "good", "text").groupBy("gram").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    n = F.length("gram")
    ends = long.select(F.explode(F.transform(F.sequence(F.lit(1), n), lambda k: F.substring("gram", -k, k))).alias("gram"), "good", "bad")
    return ends.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def gram_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, score): difference of the log chances of a gram's last character in the two models."""
    n = F.length("gram")
    levels = grams.select("gram", F.explode(F.sequence(F.lit(1), n)).alias("k")).withColumn("end", F.substring("gram", -F.col("k"), F.col("k")))
    levels = levels.withColumn("context", F.expr("substring(end, 1, k - 1)"))
    seen = counts.select(F.col("gram").alias("end"), F.col("good").alias("g"), F.col("bad").alias("b"))
    contexts = counts.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context")).agg(
        F.sum("good").alias("ng"), F.sum("bad").alias("nb"), F.count_if(F.col("good") > 0).alias("tg"), F.count_if(F.col("bad") > 0).alias("tb")
    )
    known = levels.join(contexts, "context").join(seen, "end", "left").select("gram", F.struct("k", F.coalesce("g", F.lit(0)).alias("g"), "ng", "tg", F.coalesce("b", F.lit(0)).alias("b"), "nb", "tb").alias("x"))
    rows = known.groupBy("gram").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # at most ORDER + 1

    def chance(c: str, n: str, t: str) -> Column:
        # Witten-Bell: a context's own share is n / (n + t).
        def step(p: Column, x: Column) -> Column:
            return F.when(x[n] + x[t] > 0, (x[c] + x[t] * p) / (x[n] + x[t])).otherwise(p)

        return F.aggregate("xs", F.lit(1.0 / ALPHABET), step)

    return rows.select("gram", (F.ln(chance("g", "ng", "tg")) - F.ln(chance("b", "nb", "tb"))).alias("score"))


def scores(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, score) for rows (key, text): the mean over all characters and the end."""
    spots = positions(urls, "key", "text")
    table = gram_scores(spots.select("gram").distinct(), counts)
    return spots.join(table, "gram").groupBy("key").agg(F.avg("score").alias("score"))


def limit(scored: DataFrame) -> float:
    """Where the two classes (good, score) lie equally many standard deviations away."""
    rows = {r.good: (r.m, r.s) for r in scored.groupBy("good").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect()}
    if len(rows) < 2:
        return 0.0
    (m, s), (w, t) = rows[True], rows[False]
    s, t = s + 1e-6, t + 1e-6
    return (m * t + w * s) / (s + t)


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score and limit of every page.

    Score and limit are null where a rule decides. A null URL or one without ``://`` has an empty host
    and path; the models judge the whole text of such URLs, and of all others without a rule. Repeated
    rows and null ids give a row each. Unless both classes have examples, what no rule decides is allowed.
    """
    rows = picked(pages, page_id="page_id", url="url")
    host, path = parts(F.col("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))

    # One row for each distinct URL; the text is the URL without its scheme.
    text = F.regexp_replace(F.coalesce("url", F.lit("")), "^[^:]*://", "")
    urls = rows.groupBy(F.md5(text).alias("key"), text.alias("text")).agg(F.min("ruled").alias("ruled"))
    urls = cut(urls, "urls")
    examples = urls.where("ruled is not null").select("key", "text", (F.col("ruled") == "allow").alias("good"))
    kept_out = F.substring("key", 1, 1).isin("0", "1", "2")
    counts = cut(model(examples.where(~kept_out)), "counts")
    asked = urls.where(F.col("ruled").isNull() | kept_out).select("key", "text")
    scored = cut(scores(asked, counts), "scores")
    classes = urls.groupBy("ruled").count().where("ruled is not null").count()
    at = limit(scored.join(examples.select("key", "good"), "key")) if classes == 2 else -math.inf
    free = scored.join(urls.where("ruled is null").select("key"), "key", "left_semi")
    done = rows.withColumn("key", F.md5(text)).join(free, "key", "left")
    own = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= F.lit(at), "allow").otherwise("block")
    decided = F.col("rule").isNotNull()
    return done.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        F.when(~decided, F.col("score")).alias("score"), F.when(~decided, F.lit(at)).alias("limit"),
    )


def _sql() -> str:
    cases = sorted(RULES, key=lambda x: -len(x[0]))

    def fits(rule: str) -> str:
        domain, _, start = rule.partition("/")
        return f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{start}'))"

    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in cases)
    ruled = " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in cases)

    steps, last = [], "wide"
    for k in range(1, ORDER + 2):
        before = (f"{1.0 / ALPHABET!r}::DOUBLE",) * 2 if k == 1 else ("pg", "pb")
        sides = ", ".join(
            f"CASE WHEN coalesce(n{c}{k} + t{c}{k}, 0) > 0 THEN ({c}{k} + t{c}{k} * {p}) / (n{c}{k} + t{c}{k}) ELSE {p} END AS p{c}" for c, p in zip("gb", before)
        )
        steps.append(f"step{k} AS (SELECT {'* EXCLUDE (pg, pb)' if k > 1 else '*'}, {sides} FROM {last})")
        last = f"step{k}"
    wide = ", ".join(f"max(CASE WHEN k = {k} THEN {v} END) AS {v}{k}" for k in range(1, ORDER + 2) for v in ("g", "ng", "tg", "b", "nb", "tb"))
    return f"""
WITH p0 AS (
    SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p1 AS (
    SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           regexp_replace(coalesce(url, ''), '^[^:]*://', '') AS text
    FROM p0
), p2 AS (SELECT *, md5(text) AS key, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM p1),
urls AS (SELECT key, text, min(ruled) AS ruled, left(key, 1) IN ('0', '1', '2') AS kept_out FROM p2 GROUP BY key, text),
spots AS (
    SELECT key, ruled, kept_out, substr(chr(2) || text || chr(3), greatest(1, i - {ORDER}), i - greatest(1, i - {ORDER}) + 1) AS gram
    FROM (SELECT *, unnest(range(2, length(text) + 3)) AS i FROM urls)
), fit AS (
    SELECT gram[-k:] AS gram, sum(good) AS good, sum(bad) AS bad
    FROM (SELECT gram, good, bad, unnest(range(1, length(gram) + 1)) AS k
          FROM (SELECT gram, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad
                FROM spots WHERE ruled IS NOT NULL AND NOT kept_out GROUP BY gram))
    GROUP BY 1
), contexts AS (
    SELECT left(gram, length(gram) - 1) AS context, sum(good) AS ng, sum(bad) AS nb,
           count(*) FILTER (good > 0) AS tg, count(*) FILTER (bad > 0) AS tb
    FROM fit GROUP BY 1
), levels AS (
    SELECT gram, k, gram[-k:] AS tail
    FROM (SELECT gram, unnest(range(1, length(gram) + 1)) AS k FROM (SELECT DISTINCT gram FROM spots WHERE ruled IS NULL OR kept_out))
), known AS (
    SELECT l.gram, l.k, coalesce(f.good, 0) AS g, c.ng, c.tg, coalesce(f.bad, 0) AS b, c.nb, c.tb
    FROM levels l JOIN contexts c ON c.context = left(l.tail, l.k - 1) LEFT JOIN fit f ON f.gram = l.tail
), wide AS (SELECT gram, {wide} FROM known GROUP BY gram),
{", ".join(steps)},
scored AS (
    SELECT key, avg(ln(pg) - ln(pb)) AS score FROM spots JOIN {last} USING (gram) WHERE ruled IS NULL OR kept_out GROUP BY key
), class AS (
    SELECT ruled, avg(score) AS m, stddev_pop(score) + 1e-6 AS s FROM scored JOIN urls USING (key) WHERE ruled IS NOT NULL GROUP BY ruled
), cut AS (
    SELECT CASE WHEN (SELECT count(DISTINCT ruled) FROM urls) < 2 THEN '-infinity'::DOUBLE
                WHEN (SELECT count(*) FROM class) < 2 THEN 0.0
                ELSE (SELECT (a.m * b.s + b.m * a.s) / (a.s + b.s) FROM class a, class b WHERE a.ruled = 'allow' AND b.ruled = 'block') END AS lim
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(score, 0) >= lim THEN 'allow' ELSE 'block' END) AS verdict
FROM p2 LEFT JOIN scored USING (key), cut
"""


SQL = _sql()

