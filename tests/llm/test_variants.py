"""Spelling variants against a brute-force comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from cartograph.llm import variants as V
from tests.llm.conftest import clashing, rows_of


def vocabulary(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    return {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(rows):
    n = vocabulary(rows)
    out = {}
    for w in n:
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        out[w] = (best if best and n[best] >= 2 * n[w] else None, len(others))
    for w, (form, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        yield w, form, root, n[w], k, n.get(form)


@pytest.fixture(scope="module")
def texts():
    """Words of few letters, so that many are near, and chains of forms; a rare letter beyond ASCII."""
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcÿé") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaaaaaa", "ababab"]
    words = set(stems)
    for s in stems:
        for _ in range(6):
            i, c = rng.randrange(len(s) + 1), rng.choice("abcdÿ")
            words |= {s[:i] + c + s[i:], s[:i] + c + s[i + 1:], s[:i] + s[i + 1:]}
    chain = ["qqqqqqqq"[:8 - i] + "z" * i for i in range(8)]
    bag = [w for w in words for _ in range(rng.choice([1, 3, 4, 9, 30]))] + [w for i, w in enumerate(chain) for _ in range(3 * 2 ** i)]
    rng.shuffle(bag)
    return [(i if i % 9 else None, rng.choice([" ", "-", "1", "\n"]).join(w.upper() if i % 5 == 0 else w for w in bag[i * 40:i * 40 + 40]))
            for i in range(len(bag) // 40 + 1)]


@pytest.mark.parametrize("least,dictionary", [(32, 65_536), (0, 65_536), (1, 30), (10 ** 9, 65_536)])
def test_against_brute_force(spark, texts, monkeypatch, least, dictionary):
    """Whatever is frequent, the result is the same."""
    monkeypatch.setattr(V, "LIST", least)
    monkeypatch.setattr(V, "DICTIONARY", dictionary)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = rows_of(V.group(clashing(df, ("word", "n", "size", "p", "gram", "a", "form", "__key", "__run"))))
    want = sorted(brute(texts), key=repr)
    assert got == want and len(want) > 200
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of forms


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    assert rows_of(V.group(odd_docs)) == sorted(brute([r[:2] for r in odd_rows]), key=repr)
    assert V.group(no_docs).count() == 0
    few = spark.createDataFrame([(1, None), (2, ""), (3, "short one two")], "doc_id long, text string")
    assert V.group(few).count() == 0


def test_dictionary_is_bounded_and_closed(spark, texts, monkeypatch):
    monkeypatch.setattr(V, "LIST", 1)
    monkeypatch.setattr(V, "DICTIONARY", 40)
    words = V.vocabulary(spark.createDataFrame(texts, "doc_id long, text string"))
    grams = {r["gram"]: r["uses"] for r in V.frequent_grams(words).collect()}
    assert grams and max(Counter(map(len, grams)).values()) <= 40
    assert all(g[:-1] in grams and grams[g[:-1]] >= n for g, n in grams.items() if len(g) > V.SHORTEST)


def test_affected_grams_bound(spark, texts, monkeypatch):
    """Near words share all but ``bound`` grams of each, and a kept list."""
    monkeypatch.setattr(V, "LIST", 8)
    words = V.vocabulary(spark.createDataFrame(texts, "doc_id long, text string")).cache()
    grams = V.decompose(words, V.frequent_grams(words)).cache()
    spans, lists = {}, {}
    for r in grams.collect():
        spans.setdefault(r["word"], []).append((r["p"], r["take"]))
    for r in V.merged_lists(grams).collect():
        lists.setdefault(r["word"], set()).add(r["gram"])
    of = {w: Counter(f"^{w}$"[p - 1:p - 1 + k] for p, k in s) for w, s in spans.items()}
    bound = {w: max(sum(p <= i < p + k for p, k in s) for i in range(2, len(w) + 2)) for w, s in spans.items()}
    assert all(len(s) == len(w) + 1 > bound[w] for w, s in spans.items())
    for a in of:
        for b in of:
            if near(a, b):
                assert (of[a] & of[b]).total() >= max(of[a].total() - bound[a], of[b].total() - bound[b], 1) and lists[a] & lists[b]
