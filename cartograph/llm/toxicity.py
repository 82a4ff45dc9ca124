"""Toxicity scores: a Levenshtein automaton intersected with a trie of learned terms.

Terms and weights come from a bounded sample of labelled rows (``SAMPLE_ROWS``): whole words and
word beginnings that toxic texts hold significantly more often than their length makes likely (a
long text holds more words of any kind).  The terms form a trie; the product
of the trie with Levenshtein automata (budget by term length) is determinised on demand and run
over each distinct word of a text, so misspelled terms are found without listing their variants.
Words with marks between their letters are also read without the marks, and runs of single
letters as one word.  Each hit is weighed by its context window: inside quotation marks or after a
reporting word it counts as a quotation.  A logistic curve of the sum of weights and the logarithm of the
text's words, fitted on the sample, gives the score: what one hit says is not drowned by a long text's
many chances, nor the other way round.

Defined results: null and wordless texts have no hits and get the score of a text without hits;
without labels of both classes every score is 0; repeated rows are scored alike; an empty table
gives no rows; language, source, ids and labels of the scored rows are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.session import materialize

SAMPLE_ROWS = 20_000  # labelled rows that terms and weights are fitted on, in expectation
SUPPORT = 0.02  # share of the distinct toxic texts that must hold a term: words of one copied text are none
MAX_TERMS, MAX_CANDIDATES = 400, 20_000
STEMS = (4, 5, 6)  # lengths of word beginnings that may become terms
QUOTED = 0.4  # share of a hit's weight that a quotation keeps
WINDOW = 80  # characters on either side that are read as context
KNOWN = 400_000  # harmless words a worker remembers before it starts afresh

WORD, RAW = re.compile(r"\w+"), re.compile(r"\S+")
MARKED = re.compile(r"\w+(?:[^\w\s]+\w+)+")  # letters with marks between them
SPACED = re.compile(r"(?<!\w)\w(?:[^\w\n]{1,2}\w(?!\w)){3,}")  # four single letters or more
JOINERS = re.compile(r"[\W_]+")
REPORT = re.compile(r"\b(said|says|quote[ds]?|called|wrote|dit|disait|sagte|schrieb|dijo|escribi\w+)\W*$")


def budget(term: str) -> int:
    """Edits allowed for a term: none for short ones and for word beginnings."""
    return 0 if term.endswith("*") or len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Product of the term trie with Levenshtein automata, determinised on demand.

    A state is the set of (trie node, edits so far); a missing transition means no term is within
    reach any more.  ``look(word)`` gives {term: edits}.
    """

    def __init__(self, terms):
        self.child, self.ends, self.reach = [{}], [None], [0]
        for term in sorted(terms):
            node, limit = 0, budget(term)
            self.reach[0] = max(self.reach[0], limit)
            for c in term.rstrip("*"):
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.ends.append(None)
                    self.reach.append(0)
                node = self.child[node][c]
                self.reach[node] = max(self.reach[node], limit)
            self.ends[node] = (*(self.ends[node] or ()), term)
        self.states: dict = {}
        self.keys: list = []
        self.moves: list[dict] = []
        self.accepts: list[dict] = []
        self.stems: list[dict] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs) -> int:
        best: dict = {}
        todo = list(pairs)
        while todo:  # close under deletions
            node, e = todo.pop()
            if e > self.reach[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            todo += [(k, e + 1) for k in self.child[node].values()]
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.moves)
            self.keys.append(key)
            self.moves.append({})
            full, stems = {}, {}
            for node, e in best.items():
                for term in self.ends[node] or ():
                    if term[-1] == "*":
                        if e == 0:
                            stems[term] = 0
                    elif e <= budget(term):
                        full[term] = min(e, full.get(term, 9))
            self.accepts.append(full)
            self.stems.append(stems)
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.keys[state]:
            out.add((node, e + 1))
            for d, k in self.child[node].items():
                out.add((k, e + (d != c)))
        to = self._state(out)
        self.moves[state][c] = to
        return to

    def look(self, word: str) -> dict:
        state, found = self.start, {}
        for i, c in enumerate(word):
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                return found
            if self.stems[state] and i + 1 < len(word):
                found = found | self.stems[state]
        return found | self.accepts[state]


def hits_of(text: str, automaton: Automaton, known: set) -> dict:
    """{(term, edits, quoted): occurrences} of a text; ``known`` collects harmless raw words."""
    low = text.lower()
    hot: dict = {}
    for raw in set(low.split()) - known:
        found = [(w.start(), w.end(), hit) for w in WORD.finditer(raw) if (hit := automaton.look(w[0]))]
        # marked words count as the term they hide, not as a word that begins like one
        found += [(w.start(), w.end(), hit) for w in MARKED.finditer(raw)
                  if (hit := {t: e for t, e in automaton.look(JOINERS.sub("", w[0])).items() if t[-1] != "*"})]
        if found:
            hot[raw] = found
        else:
            known.add(raw)
    if len(known) > KNOWN:
        known.clear()
    out: Counter = Counter()
    if hot:
        for m in RAW.finditer(low):
            for a, b, hit in hot.get(m[0], ()):
                quoted = quotation(low, m.start() + a, m.start() + b)
                for term, edits in hit.items():
                    out[term, edits, quoted] += 1
    for m in SPACED.finditer(low):
        for term, edits in automaton.look(JOINERS.sub("", m[0])).items():
            if term[-1] != "*":
                out[term, edits, quotation(low, m.start(), m.end())] += 1
    return out


def size_of(text: str | None) -> float:
    """Logarithm of the number of words, the curve's second input."""
    return math.log1p(len((text or "").split()))


def quotation(low: str, a: int, b: int) -> bool:
    """Is low[a:b] quoted: between quotation marks on its line, or after a reporting word?"""
    before, after = low[max(0, a - WINDOW):a].rpartition("\n")[2], low[b:b + WINDOW].partition("\n")[0]
    pairs = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"))
    inside = any((before.count(p) % 2 == 1 if p == q else before.rfind(p) > before.rfind(q)) and q in after for p, q in pairs)
    return inside or bool(REPORT.search(before))


def total(hits: dict, weights: dict) -> float:
    """Sum of the weights of a text's hits, each (term, edits) once, quotations discounted."""
    best: dict = {}
    for term, edits, quoted in hits:
        w = weights.get((term, edits), 0.0) * (QUOTED if quoted else 1.0)
        best[term, edits] = max(w, best.get((term, edits), w))
    return sum(best.values())


def features(text: str | None) -> tuple[set, set]:
    """Distinct words (4 letters or more) of a text and their beginnings."""
    words = {w for w in WORD.findall((text or "").lower()) if len(w) >= 4}
    return words, {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def tail(k: int, n: int, p: float) -> float:
    """log P(X >= k) for X ~ Binomial(n, p), by its largest term (an upper bound is not needed)."""
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of training rows, thinned by a hash of the id to about ``rows``."""
    train = labels.select(F.col("doc_id").alias("__id"), "toxic").where("toxic in (0, 1) and doc_id is not null") \
        .where(~held_out(F.col("doc_id")))
    n = train.count()
    picked = train.where(F.pmod(F.xxhash64("__id", F.lit("toxicity")), F.lit(1_000_000)) < int(1e6 * min(1.0, rows / max(n, 1))))
    return docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select("text", "toxic")


def document_counts(rows: DataFrame, wanted: set) -> dict:
    """Number of texts of ``rows`` that hold each of the wanted words and beginnings."""
    words = {f for f in wanted if f[-1] != "*"}
    stems = {k: {f[:-1] for f in wanted if f[-1] == "*" and len(f) == k + 1} for k in STEMS}

    @F.pandas_udf("array<string>")
    def present(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            held = {w for w in WORD.findall((t or "").lower()) if len(w) >= 4}
            found = held & words
            for k in STEMS:
                found |= {p + "*" for p in stems[k] & {w[:k] for w in held if len(w) > k}}
            out.append(sorted(found))
        return pd.Series(out, dtype=object)

    counted = rows.select(F.explode(present("text")).alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    return {r["f"]: r["n"] for r in counted.collect()}  # at most MAX_CANDIDATES rows


def toxic_counts(rows: DataFrame, least: int) -> tuple[dict, dict]:
    """The MAX_CANDIDATES words and beginnings that most texts of ``rows`` hold, ``least`` or more, with their number
    of texts; and of the beginnings the number of distinct words.  Counted by Spark, no text leaves it."""

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set().union(*features(t))) for t in texts], dtype=object)

    texts = materialize(rows.select(held("text").alias("f")), "toxicity-features").select(F.explode("f").alias("f"))
    top = materialize(texts.groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= least)
                      .orderBy(F.desc("n"), "f").limit(MAX_CANDIDATES), "toxicity-candidates")
    words = texts.where(~F.col("f").endswith("*")).distinct()
    stems = words.select(F.explode(F.array(*[F.when(F.length("f") > k, F.concat(F.substring("f", 1, k), F.lit("*"))) for k in STEMS])).alias("f"))
    kinds = stems.where("f is not null").groupBy("f").agg(F.count("*").alias("kinds"))
    got = top.join(kinds, "f", "left").collect()
    return {r["f"]: r["n"] for r in got}, {r["f"]: r["kinds"] or 0 for r in got}


def learn_terms(sample: DataFrame) -> tuple[list[str], int, int]:
    """Terms from a bounded sample, with its numbers of toxic and other texts."""
    per = {r["toxic"]: r for r in sample.groupBy("toxic").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    pos, neg = (per[k]["n"] if k in per else 0 for k in (1, 0))
    if not pos or not neg:
        return [], pos, neg
    least = max(3, math.ceil(SUPPORT * pos))
    hold, kinds = toxic_counts(sample.where("toxic = 1"), least)
    wanted = set(hold)
    # a text without the cause holds a rare feature in proportion to its length
    share = (per[1]["chars"] or 1) / ((per[1]["chars"] or 1) + (per[0]["chars"] or 1))

    def lift(f, b, n):
        return (hold[f] + 0.5) / (pos + 1) / ((b + 0.5) / (n + 1))

    # a tenth of the other texts settles the features that are common everywhere, the rest the few left
    n_tests, others = max(1, len(wanted)), Counter()
    part = F.pmod(F.xxhash64("text"), F.lit(10))
    for rows in (sample.where(part == 0), sample.where(part != 0)):
        others.update(document_counts(rows.where("toxic = 0"), wanted))
        wanted = {f for f in wanted if lift(f, others[f], neg) >= 20}
    level = math.log(0.01 / n_tests)
    scored = []
    for f in wanted:
        a, b = hold[f], others[f]
        if tail(a, a + b, share) <= level and (f[-1] != "*" or kinds[f] >= 5):
            scored.append((f, a))
    stems: list[str] = []
    for f, _ in sorted((x for x in scored if x[0][-1] == "*"), key=lambda x: (len(x[0]), x[0])):
        if not any(f.startswith(s[:-1]) for s in stems):
            stems.append(f)
    words = [f for f, _ in sorted(scored, key=lambda x: (-x[1], x[0])) if f[-1] != "*" and not any(f.startswith(s[:-1]) for s in stems)]
    return (stems + words)[:MAX_TERMS], pos, neg


def fit_curve(*inputs: np.ndarray) -> tuple[float, ...]:
    """Intercept and slopes of a ridge-damped logistic curve, by Newton steps; the last input is the class."""
    *xs, y = inputs
    design = np.stack([np.ones_like(y), *xs], 1)
    k = design.shape[1]
    beta = np.zeros(k)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - 0.01 * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(k)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Model: terms, weights by (term, edits), intercept and slope of the curve, its slope by length."""
    sample = materialize(labelled_sample(docs, labels, rows).dropDuplicates(["text"]), "toxicity-sample")
    terms, pos, neg = learn_terms(sample)
    if not pos or not neg:
        return {"terms": [], "weights": {}, "curve": (-30.0, 0.0), "length": 0.0}

    @F.pandas_udf("array<struct<t:string,e:int,q:boolean>>")
    def found(texts: pd.Series) -> pd.Series:
        automaton, known = Automaton(terms), set()
        return pd.Series([[{"t": t, "e": e, "q": q} for t, e, q in sorted(hits_of(s, automaton, known))] if s else [] for s in texts])

    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    seen = [(r["toxic"], {(h["t"], h["e"], h["q"]) for h in r["h"]}, math.log1p(r["w"]))
            for r in sample.select("toxic", found("text").alias("h"), words.alias("w")).collect()]  # hits of at most SAMPLE_ROWS texts
    counts = [Counter(), Counter()]
    for y, hits, _ in seen:
        counts[y].update({(t, e) for t, e, _ in hits})
    weights = {k: math.log((counts[1][k] + 0.5) / (pos + 1)) - math.log((counts[0][k] + 0.5) / (neg + 1))
               for k in counts[0] | counts[1]}
    for t in terms:  # variants the sample lacks: less sure with every edit
        for e in range(budget(t) + 1):
            weights.setdefault((t, e), max(0.0, weights.get((t, 0), 0.0)) / (1 + e))
    weights = {k: max(0.0, w) for k, w in weights.items()}
    x, y, size = (np.array(v, np.float64) for v in zip(*[(total(h, weights), c, n) for c, h, n in seen]))
    hit = x > 0
    if not hit.any():
        return {"terms": terms, "weights": weights, "curve": fit_curve(x, y), "length": 0.0}
    # texts with hits have the curve, the others their share of toxic texts in the sample
    a, b, c = fit_curve(x[hit], size[hit], y[hit])
    return {"terms": terms, "weights": weights, "curve": (a, b), "length": c, "no_hit": float((y[~hit].sum() + 0.5) / ((~hit).sum() + 1))}


def score(model: dict):
    """Column function: text -> score in [0, 1]."""
    terms, weights, (a, b), c, none = model["terms"], model["weights"], model["curve"], model["length"], model.get("no_hit")

    def chance(text: str | None, automaton: Automaton, known: set) -> float:
        x = total(hits_of(text, automaton, known), weights) if text and terms else 0.0
        if not x and none is not None:
            return none
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * size_of(text)))))

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton, known = Automaton(terms), set()
        for texts in parts:
            yield pd.Series([chance(t, automaton, known) for t in texts], dtype="float64")

    return scored


def rate(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` plus ``__score``."""
    model = train(docs, labels, rows)
    if not model["terms"]:
        a = model["curve"][0]
        return docs.withColumn("__score", F.lit(1 / (1 + math.exp(-max(a, -30.0)))))
    return docs.withColumn("__score", score(model)(F.col("text")))
