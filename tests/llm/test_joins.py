"""Near-duplicate joins against brute force."""

import math
import random
import re

import numpy as np
import pytest

from cartograph.llm import embedjoin, ngramjoin
from cartograph.llm.common import connected_components
from tests.llm.conftest import clashing, prose, rows_of


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def jaccard_brute(rows):
    """[(doc_id, class_id, n_links)] by all pairs."""
    sets = [shingles(r[1]) for r in rows]
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (rows[i][1] or "") == (rows[j][1] or "") or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9):
                pairs.append((i, j))
    comp = components(len(rows), pairs)
    least = {}
    for i, c in enumerate(comp):
        ids = [x for x in (least.get(c), rows[i][0]) if x is not None]
        least[c] = min(ids) if ids else None
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    return sorted(((r[0], least[c], n) for r, c, n in zip(rows, comp, links)), key=repr)


def test_jaccard_join(odd_docs, odd_rows):
    got = ngramjoin.classify(clashing(odd_docs))
    assert rows_of(got.select("doc_id", "class_id", "n_links")) == jaccard_brute(odd_rows)


def chain_rows():
    """Chains of small edits around a few bases, shared passages, one large group."""
    rng = random.Random(3)
    rows, passage = [], prose(rng, 30)
    for g in range(6):
        words = prose(rng, rng.choice([30, 60, 150])).split()
        for i in range(25):
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
            rows.append((len(rows), " ".join(words), None, None, None))
    rows += [(1000 + i, prose(rng, 60) + " " + passage + " " + prose(rng, 60), None, None, None) for i in range(40)]
    return rows


@pytest.mark.parametrize("leaf,chunk,alike", [(200, 512, 0.5), (4, 512, 2.0), (4, 3, 0.5)])
def test_jaccard_join_paths(spark, monkeypatch, leaf, chunk, alike):
    """Deep splits, blocks of chunks and broadcast-free joins give the same links."""
    monkeypatch.setattr(ngramjoin, "LEAF", leaf)
    monkeypatch.setattr(ngramjoin, "CHUNK", chunk)
    monkeypatch.setattr(ngramjoin, "ALIKE", alike)
    monkeypatch.setattr(ngramjoin, "OWN_CHUNK", 3)
    monkeypatch.setattr(ngramjoin, "MAX_BROADCAST_CLASSES", 0 if leaf == 4 else 200_000)
    rows = chain_rows()
    got = ngramjoin.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert rows_of(got) == jaccard_brute(rows)


def test_keep_one(odd_docs, odd_rows, no_docs):
    wide = clashing(odd_docs)
    kept = ngramjoin.keep_one(wide)
    want = {c for _, c, _ in jaccard_brute(odd_rows)}
    assert kept.columns == wide.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(c for c in want if c is not None)
    assert ngramjoin.classify(no_docs).count() == 0 and ngramjoin.keep_one(no_docs).count() == 0


def test_runs_for_recall():
    assert ngramjoin.n_runs(0.9) <= ngramjoin.n_runs(0.99999) <= 7


def vectors(rng, dims=64):
    def unit(v):
        return v / np.linalg.norm(v)

    out = [unit(rng.standard_normal(dims)) for _ in range(60)]
    for v in out[:12]:  # chains and balls around the threshold
        out += [unit(v + rng.normal(0, s, dims)) * rng.uniform(0.5, 3) for s in (0.005, 0.02, 0.024, 0.026, 0.03)]
    hub = out[20]
    out += [unit(hub + rng.normal(0, 0.01, dims)) for _ in range(40)] + [hub] * 15
    return [[float(np.float32(x)) for x in v] for v in out]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_embedding_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedjoin, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(rng))]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 64, 1), (1003, [math.nan] * 64, 1), (1004, [None] * 64, 1),
             (1005, rows[0][1], None), (1006, [1.0, 0.0], 1), (1007, [1.0, 0.001], 1), (1008, [1.0] * 11, 0), (None, rows[1][1], 1),
             (3, rows[3][1], 1)]
    good = [i for i, (_, v, lab) in enumerate(rows) if v and lab is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    pairs = []
    for x, i in enumerate(good):
        a = np.array(rows[i][1])
        for j in good[:x]:
            b = np.array(rows[j][1])
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.98:
                pairs.append((i, j))
    comp = components(len(rows), pairs)
    least, links = {}, [0] * len(rows)
    for i, c in enumerate(comp):
        ids = [x for x in (least.get(c), rows[i][0]) if x is not None]
        least[c] = min(ids) if ids else None
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    want = sorted(((r[0], n, least[c], r[0] is not None and r[0] == least[c]) for r, n, c in zip(rows, links, comp)), key=repr)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    assert rows_of(embedjoin.near_duplicates(clashing(df))) == want
    assert embedjoin.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(None, 1), (2, None), (7, 7)]
    edges += [(500, 501 + i) for i in range(50)]
    comp = components(600, [(a, b) for a, b in edges if a is not None and b is not None])
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: comp[n] for a, b in edges if a is not None and b is not None and a != b for n in (a, b)}
