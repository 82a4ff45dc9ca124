"""Quality rules with risk-controlled thresholds.

Every text gets counts (words, symbols, repeated lines and 5-word windows) and badness ratios.
A hard base rule fails very short or very repetitive texts.  Beyond it one badness score, a weighted
sum of the ratios, has one cutoff per stratum (language), chosen from labels.  Labelled texts are
taken once each, however many copies they have, and fall by a hash of the text into two halves:

* the first half fits: a ratio's weight is how far bad texts lie above good ones, in units of their
  variance (none if they lie below), and a ladder of cutoffs runs from quantiles of the bad texts over
  the middle between both down to quantiles of the stratum's good texts;
* the second half tests the ladder from the loosest step to the strictest.  A step is accepted
  while the exact binomial tail P(X <= false rejections | n, RISK) stays below ``DELTA`` divided by the
  number of strata; the first failing step ends its ladder (fixed sequence, so steps need no further
  correction).  Among accepted steps, all of which hold at once, the first half chooses the one that
  separates its bad texts best (ties: the loosest).

With confidence 1 - DELTA, in every stratum at once, at most the share RISK of good texts is rejected by
the cutoffs.  A stratum needs about ln(DELTA / strata) / ln(1 - RISK) good texts in its second half (86
with four strata); one with fewer gets no cutoff and rejects nothing beyond the base rule.

Defined results: null and wordless texts have zero counts and fail the base rule; null language is
a stratum of its own; a very long text is counted whole; rows repeat as given, and equal texts get equal
verdicts in a stratum; a text that any label calls good is good; ties at a cutoff stay; an empty table
gives no rows; missing or null labels only mean fewer tests; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.session import materialize

RISK, DELTA = 0.05, 0.05
RATIOS = ("symbols", "repeats", "dup_lines", "capitals", "marks")
LADDER = (0.9999, 0.999, 0.998, 0.995, 0.99, 0.985, 0.98, 0.97, 0.95)  # of good texts
BAD_LADDER = (0.5, 0.25, 0.1, 0.05, 0.01)  # of bad texts
MAX_BROADCAST_STRATA = 100_000

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")


def repeated_words(words: list) -> int:
    """Words covered by 5-word windows that occur twice or more."""
    n = len(words)
    if n < 6:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    if base == n:
        return 0
    key = ids[:n - 4]
    for j in range(1, 5):
        if int(key.max()) * base + base > 2 ** 62:  # exact keys: rank them before they overflow
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * base + ids[j:n - 4 + j]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice))
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 5, -1)
    return int((np.cumsum(cover)[:n] > 0).sum())


def count_text(text: str | None) -> tuple:
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split: space, \t \n \v \f \r
    lines = text.split("\n")
    dup = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line in seen:
                dup += 1
            elif line.strip(SPACE):
                seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup,
            repeated_words(words), len(lines), len(raw) - len(raw.translate(None, CAPITALS)), text.count("!"))


def text_counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([count_text(t) for t in texts], columns=list(COUNTS))


def ratios() -> dict:
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return {"symbols": F.col("n_symbols") / chars, "repeats": F.col("n_repeat_words") / words,
            "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "capitals": F.col("n_capitals") / chars, "marks": F.col("n_marks") / words}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, counts, ratios and base_failed of every row (written, so counted once)."""
    counts = F.pandas_udf(text_counts, ", ".join(f"{c} long" for c in COUNTS))
    counted = docs.select("doc_id", F.col("lang").alias("stratum"), F.xxhash64("text").alias("text_hash"), counts("text").alias("c")) \
        .select("doc_id", "stratum", "text_hash", "c.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return materialize(counted.withColumns(ratios() | {"base_failed": failed}), "quality-counts")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact terms."""
    if n <= 0 or k >= n * p:
        return 1.0
    i = np.arange(k + 1)
    logs = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i]) \
        + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs).sum()))


def labelled_texts(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled text that passes the base rule once: stratum, good, tune (first half) and its ratios."""
    named = measured.join(labels.where("quality is not null").select(F.col("doc_id").alias("__id"), "quality"),
                          F.col("doc_id") == F.col("__id")).where("not base_failed")
    return named.groupBy("stratum", "text_hash").agg(
        (F.max("quality") == 1).alias("good"), *[F.any_value(r).alias(r) for r in RATIOS]) \
        .withColumn("tune", F.pmod(F.xxhash64(F.lit("tune"), "text_hash"), F.lit(2)) == 0).drop("text_hash")


def weights_of(texts: DataFrame) -> dict[str, float]:
    """Weight of every ratio, from the first half: two rows of means and variances come back."""
    rows = {r["good"]: r for r in texts.where("tune").groupBy("good").agg(
        *[F.avg(r).alias(f"m_{r}") for r in RATIOS], *[F.var_pop(r).alias(f"v_{r}") for r in RATIOS]).collect()}
    if len(rows) < 2:
        return dict.fromkeys(RATIOS, 0.0)
    good, bad = rows[True], rows[False]
    return {r: max(0.0, bad[f"m_{r}"] - good[f"m_{r}"]) / (bad[f"v_{r}"] + good[f"v_{r}"] + 1e-9) for r in RATIOS}


def badness(weights: dict[str, float]):
    return sum((F.col(r) * F.lit(w) for r, w in weights.items()), F.lit(0.0))


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
               ladder=LADDER) -> tuple[DataFrame, dict[str, float]]:
    """One row per stratum (stratum, n_good, cutoff; null: none), and the weights of the ratios."""
    texts = materialize(labelled_texts(measured, labels), "quality-labelled")
    weights = weights_of(texts)
    texts = texts.select("stratum", "good", "tune", badness(weights).alias("score"))
    bad = texts.where("tune and not good").agg(F.percentile_approx("score", list(BAD_LADDER), F.lit(20_000)).alias("q")).first()["q"]
    of_bad = F.array(*[F.lit(float(x)) for x in bad or []]).cast("array<double>")
    of_good = F.percentile_approx("score", [float(q) for q in ladder], F.lit(20_000))
    above = F.filter(of_bad, lambda x: x > F.col("q")[0])
    steps = texts.where("tune and good").groupBy("stratum").agg(of_good.alias("q")).select(
        F.col("stratum").alias("__s"), F.sort_array(F.array_distinct(F.concat(
            of_bad, F.transform(above, lambda x: (x + F.col("q")[0]) / 2), "q")), asc=False).alias("steps"))
    over = F.col("score") > F.col("cut")

    def count(which: str):
        return F.count_if(F.expr(which)), F.count_if(F.expr(which) & over)

    parts = {"test": "good and not tune", "tune": "good and tune", "bad": "tune and not good"}
    counts = (texts.join(steps, F.col("stratum").eqNullSafe(F.col("__s")))
              .select("stratum", "good", "tune", "score", F.posexplode("steps").alias("step", "cut"))
              .groupBy("stratum", "step", "cut").agg(*[c.alias(f"{k}{i}") for k, w in parts.items() for i, c in zip("nk", count(w))]))
    names = [f"{k}{i}" for k in parts for i in "nk"]
    runs = materialize(counts.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("step", "cut", *names))).alias("run")),
                       "quality-ladder")  # some twenty steps a stratum
    level = delta / max(1, runs.count())

    @F.pandas_udf("double")
    def climb(series: pd.Series) -> pd.Series:
        return pd.Series([choose(run, risk, level) for run in series], dtype="float64")

    useful = any(weights.values())
    cutoff = climb("run") if useful else F.lit(None).cast("double")
    return materialize(runs.select("stratum", F.col("run")[0]["testn"].alias("n_good"), cutoff.alias("cutoff")), "quality-cutoffs"), weights


def choose(run, risk: float, level: float) -> float | None:
    """Best separating cutoff among the accepted steps of a ladder; None if not one is accepted."""
    best, top = None, 0.0
    for step in run:
        if binomial_tail(int(step["testk"]), int(step["testn"]), risk) > level:
            break
        gain = step["badk"] / max(1, step["badn"]) - step["tunek"] / max(1, step["tunen"])
        if best is None or gain > top:
            best, top = float(step["cut"]), gain
    return best


def judge(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Counts, base_failed and kept of every row of ``docs`` (doc_id, text, lang)."""
    measured = measure(docs)
    cuts, weights = thresholds(measured, labels.select("doc_id", "quality"), **kw)
    cuts = cuts.select(F.col("stratum").alias("__s"), "cutoff")
    if cuts.count() <= MAX_BROADCAST_STRATA:
        cuts = F.broadcast(cuts)
    over = F.coalesce(badness(weights) > F.col("cutoff"), F.lit(False))
    return (measured.join(cuts, F.col("stratum").eqNullSafe(F.col("__s")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~over)
            .select("doc_id", *COUNTS[:5], "base_failed", "kept"))
