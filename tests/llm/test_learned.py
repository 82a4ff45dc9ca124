"""Toxicity and quality rules: brute force of the parts, held-out accuracy of the whole."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cartograph.llm import quality, toxicity
from tests.llm.conftest import clashing, prose, rows_of

SF = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = ["idiot", "moron", "scum", "worthless", "disgusting", "losers", "lowe*", "mor"]
    auto = toxicity.Automaton(terms)
    words = ["idiot", "id1ot", "idot", "idiiot", "iidot", "worthles", "wurthlass", "loweich", "lowe", "low", "disgustingly", "", "moroon"]
    for t in terms:
        for _ in range(200):
            w = list(t.rstrip("*"))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w) + 1)
                rng.choice([lambda: w.insert(k, rng.choice("abio")), lambda: w and w.pop(k - 1), lambda: w and w.__setitem__(k - 1, "z")])()
            words.append("".join(w))
    for w in words:
        want = {t: distance(w, t) for t in terms if t[-1] != "*" and distance(w, t) <= toxicity.budget(t)}
        want |= {t: 0 for t in terms if t[-1] == "*" and w.startswith(t[:-1]) and len(w) > len(t) - 1}
        assert auto.look(w) == want, w


def test_quotations_count_less():
    auto = toxicity.Automaton(["idiot"])
    plain = toxicity.hits_of("you idiot, go", auto, set())
    quoted = toxicity.hits_of('they were told "you idiot, go" once', auto, set())
    assert list(plain) == [("idiot", 0, False)] and list(quoted) == [("idiot", 0, True)]
    weights = {("idiot", 0): 3.0}
    assert toxicity.total(plain, weights) > toxicity.total(quoted, weights) > 0


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(20, 60)).split()
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grumphead", "snotling", "blargh" + rng.choice("abcdefgh") + rng.choice("xyz")]))
        rows.append((i, " ".join(text), "en", "a", 1))
        labels.append((i, 0 if bad else 1, int(bad)))
    return rows, labels


def test_toxicity_learns_terms_stems_and_misspellings(spark, odd_rows, no_docs):
    rows, labels = labelled(random.Random(4), 400)
    docs = spark.createDataFrame(rows + odd_rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab)
    assert {"grumphead", "snotling"} <= set(model["terms"]) and any(t.startswith("blar") for t in model["terms"])
    probe = spark.createDataFrame([(1, "a quiet gruumphead here"), (2, "a quiet river"), (3, None), (4, ""), (5, "oh blarghqq")], "doc_id long, text string")
    got = {r[0]: r[1] for r in probe.select("doc_id", toxicity.score(model)("text")).collect()}
    assert got[1] > 0.5 > got[2] and got[5] > 0.5 and got[3] == got[4] and all(0 <= v <= 1 for v in got.values())
    rated = toxicity.rate(clashing(docs), lab)
    assert rated.count() == len(rows) + len(odd_rows)
    assert toxicity.rate(no_docs, lab).count() == 0
    assert {r["__score"] for r in toxicity.rate(docs, lab.limit(0)).collect()} == {1 / (1 + math.exp(30))}


def test_marks_and_spaced_letters():
    auto = toxicity.Automaton(["idiot", "trash", "lowe*"])
    found = {t: {k[:2] for k in toxicity.hits_of(t, auto, set())} for t in (
        "tr*sh", "tr.ash!", "(t-r-a-s-h)", "t r a s h", "so t. r. a. s. h. it is", "i d i o t s", "a b c d", "tr ash", "l.o.w.e.n", "x_idiot_x")}
    assert found == {"tr*sh": {("trash", 1)}, "tr.ash!": {("trash", 0)}, "(t-r-a-s-h)": {("trash", 0)}, "t r a s h": {("trash", 0)},
                     "so t. r. a. s. h. it is": {("trash", 0)}, "i d i o t s": {("idiot", 1)}, "a b c d": set(), "tr ash": set(),
                     "l.o.w.e.n": set(), "x_idiot_x": set()}


def test_scores_by_recomputation(spark):
    """Every score from plain edit distances, the model's weights and its curve."""
    rows, labels = labelled(random.Random(4), 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab)
    (a, b), c = model["curve"], model["length"]

    def plain(text):
        best = {}
        for w in re.findall(r"\w+", text.lower()):
            for t in model["terms"]:
                if t[-1] == "*":
                    e = 0 if w.startswith(t[:-1]) and len(w) > len(t) - 1 else None
                else:
                    e = d if (d := distance(w, t)) <= toxicity.budget(t) else None
                if e is not None:
                    best[t, e] = model["weights"].get((t, e), 0.0)
        x = sum(best.values())
        return 1 / (1 + math.exp(-(a + b * x + c * math.log1p(len(text.split()))))) if x else model["no_hit"]

    probes = [r[1] for r in rows[:40]] + ["grumphead", "a grumphaed and a snotlig", "blarghzz blarghb", "quiet words " * 60, "grumphead " + "quiet words " * 200]
    got = spark.createDataFrame(list(enumerate(probes)), "i long, text string").select("i", toxicity.score(model)("text").alias("s")).collect()
    assert all(abs(r["s"] - plain(probes[r["i"]])) < 1e-9 for r in got)
    score = {probes[r["i"]]: r["s"] for r in got}
    assert score["grumphead"] > 0.5 > score["quiet words " * 60] and score["grumphead " + "quiet words " * 200] > model["no_hit"]


def test_length_alone_makes_no_term(spark):
    """Toxic texts are five times as long here: common words of long texts are no terms."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(300):
        words = prose(rng, 250 if i % 4 == 0 else 50).split()
        words += [f"filler{rng.randrange(400)}" for _ in range(len(words) // 5)]
        rows.append((i, " ".join(words + ["snotling"] * (i % 4 == 0)), "en", "a", 1))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert [t for t in model["terms"] if t[-1] != "*"] in ([], ["snotling"]) and not any(t.startswith("fill") for t in model["terms"])
    assert any("snotling".startswith(t.rstrip("*")) for t in model["terms"])


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_toxicity_held_out(spark):
    from cartograph.llm.queries import QUERIES

    got = QUERIES["op1_toxicity_automaton"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert right >= 0.95 * len(got)


def quality_brute(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by the plain definitions."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w in set(windows) if windows.count(w) > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
    lines = text.split("\n")
    dup = sum(1 for i, ln in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", ln) and ln in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts(odd_rows):
    texts = [r[1] for r in odd_rows if r[0] != 8] + ["a b c d e a b c d e", "a b c d e f", "# & <x>\n\n \nx y\nx y\n", "  nbsp word"]
    for t in texts:
        assert quality.count_text(t)[:5] == quality_brute(t), t


def test_repeats_without_overflow():
    words = [str(i) for i in range(9000)] + ["p", "q", "r", "s", "t"] * 2 + [str(i) for i in range(9000, 9900)]
    assert quality.repeated_words(words) == 10


def test_binomial_tail():
    for n, k, p in ((50, 3, 0.2), (10, 0, 0.1), (400, 2, 0.05)):
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(k, n, p) - want) < 1e-9


def test_rules_control_false_rejections(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(6000):
        good = i % 3 > 0
        text = prose(rng, 30) if good else " ".join(w + "%%%" for w in prose(rng, 30).split())
        rows.append((i, text, rng.choice(["en", None]), "a", 1))
        labels.append((i, int(good)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs, lab = spark.createDataFrame(rows, schema), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.judge(clashing(docs), lab).join(lab, "doc_id").where("quality is not null").groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("k")).collect()
    kept = {r["quality"]: r["k"] for r in got}
    assert kept[1] >= 1 - quality.RISK and kept[0] < 0.05
    none = quality.judge(odd_docs, lab.limit(0))
    assert none.count() == len(odd_rows) and none.where("kept = base_failed").count() == 0
    want = [(r[0], *quality_brute(r[1])) for r in odd_rows if r[0] != 8]
    assert rows_of(none.where("doc_id is null or doc_id <> 8").select("doc_id", *quality.COUNTS[:5])) == sorted(want, key=repr)
    assert quality.judge(no_docs, lab).count() == 0


def plain_verdicts(rows, labels):
    """kept by a recomputation of the whole method in plain Python, given the library's halves and quantile rule."""
    import numpy as np

    counts = {t: quality.count_text(t) for _, t, _ in rows}

    def ratios(t):
        c = dict(zip(quality.COUNTS, counts[t]))
        ch, w = max(c["word_chars"], 1), max(c["n_words"], 1)
        return np.array([c["n_symbols"] / ch, c["n_repeat_words"] / w, c["n_dup_lines"] / max(c["n_lines"], 1), c["n_capitals"] / ch, c["n_marks"] / w])

    def failed(t):
        return counts[t][0] < 10 or 100 * counts[t][4] > 20 * counts[t][0]

    seen = {}
    for i, t, lang in rows:
        if labels.get(i) is not None and not failed(t):
            seen[lang, t] = max(seen.get((lang, t), 0), labels[i])
    return ratios, failed, seen


def test_verdicts_by_recomputation(spark):
    """kept equals a plain recomputation; copies count once; the cutoff is a tested one."""
    import numpy as np

    rng = random.Random(8)
    rows, labels = [], {}
    for i in range(1200):
        lang, bad = rng.choice(["en", "de", None, "xx"]), rng.random() < 0.15
        words = prose(rng, rng.randint(12, 40)).split()
        for _ in range(rng.randint(2, 6) if bad else rng.random() < 0.05):
            words[rng.randrange(len(words))] += rng.choice("#*$%")
        text = " ".join(words)
        for c in range(30 if i == 3 else 1):  # one text with many copies
            rows.append((len(rows), text, lang))
            if lang != "xx" or i % 20 == 0:  # hardly any labels in a stratum
                labels[rows[-1][0]] = int(not bad)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    measured = quality.measure(docs)
    cuts, weights = quality.thresholds(measured, lab)
    cut = {r["stratum"]: r["cutoff"] for r in cuts.collect()}
    ratios, failed, seen = plain_verdicts(rows, labels)
    half = {(r["lang"], r["text"]): r["tune"] for r in docs.select("lang", "text", (F.pmod(F.xxhash64(F.lit("tune"), F.xxhash64("text")), F.lit(2)) == 0).alias("tune")).collect()}
    first = {k: g for k, g in seen.items() if half[k]}
    by = {g: np.array([ratios(t) for (_, t), q in first.items() if q == g]) for g in (0, 1)}
    want = np.maximum(0, by[0].mean(0) - by[1].mean(0)) / (by[0].var(0) + by[1].var(0) + 1e-9)
    assert np.allclose([weights[r] for r in quality.RATIOS], want, rtol=1e-9)
    assert cut["xx"] is None and all(cut[s] is not None for s in ("en", "de", None))
    for s in ("en", "de", None):
        test = [ratios(t) @ want for (lang, t), g in seen.items() if lang == s and g == 1 and not half[lang, t]]
        wrong = sum(x > cut[s] for x in test)
        assert quality.binomial_tail(wrong, len(test), quality.RISK) <= quality.DELTA / 4
        good = [ratios(t) @ want for (lang, t), g in first.items() if lang == s and g == 1]
        bad = [ratios(t) @ want for (lang, t), g in first.items() if lang == s and g == 0]
        assert np.mean([x > cut[s] for x in bad]) - np.mean([x > cut[s] for x in good]) > 0.7
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(docs, lab).collect()}
    for i, t, s in rows:
        over = cut[s] is not None and ratios(t) @ want > cut[s] + 1e-12
        assert got[i] == (failed(t), not failed(t) and not over)


def test_chosen_step():
    step = lambda cut, testk, badk, tunek: {"cut": cut, "testn": 100, "testk": testk, "badn": 10, "badk": badk, "tunen": 100, "tunek": tunek}
    run = [step(9.0, 0, 2, 0), step(5.0, 0, 9, 0), step(4.0, 0, 9, 0), step(1.0, 9, 10, 9)]
    assert quality.choose(run, 0.05, 0.0125) == 5.0 and quality.choose(run, 0.05, 1e-9) is None
