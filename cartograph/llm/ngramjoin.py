"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed 5-word shingles.  In every run each set picks, by a hash that all sets
share, about BETA / (threshold * size) of its shingles and joins the bucket of each pick; a pair at
the threshold shares BETA picks on average (DEEPER below the first level, so that sets which only
share a passage thin out).  A bucket of at most LEAF sets, or one whose sets are
alike, is a leaf (every set has SIGNATURE one-bit min-hashes; how often two sets agree follows from
the number of ones a bit); other buckets are split again by picks with the
bucket's own hash, to DEPTH at most, where what is left is a leaf of any size.  Runs repeat until
the chance that a pair at the threshold misses every leaf is below 1 - RECALL (``n_runs``).

Leaves are compared by brute force, exactly, on the full shingle sets.  A pair is settled only in
the first leaf that both sets share (larger leaves first), so nothing is counted twice and pairs
are never written out: a task returns per set its number of links and a root of its local group.
Leaves above CHUNK sets are compared in blocks of two chunks.

Equal texts are one class from the start: a class is one row here, with its number of copies.

Defined results: a null text is the empty text; equal texts are always linked, also empty ones;
other wordless texts have no shingles and no links; a text of fewer than five words is one shingle;
null doc_ids form classes like others and never name one; repeated rows are copies; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import connected_components, keeps_columns
from cartograph.session import materialize

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99999
BETA, DEEPER, LEAF, CHUNK, OWN_CHUNK, DEPTH, SIGNATURE, ALIKE = 3.0, 1.5, 200, 1024, 256, 4, 64, 0.5
CHUNK_SHINGLES = 400_000
KNOWN_WORDS = 300_000
MAX_BROADCAST_CLASSES, MAX_BROADCAST_ENTRIES = 200_000, 2_000_000

WORD = re.compile(r"[^\W_]+")
U = np.uint64
MASK = 2 ** 64 - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


PICK_CELLS = 1 << 20
SIGNATURE_SEEDS = mix(np.arange(1, SIGNATURE + 1, dtype=U) * U(0x632BE59BD9B4E019))


class WordHashes(dict):
    """64-bit hash of a word, remembered for the last words met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self[word] = h
        return h


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""

    def __init__(self, n_words: int = WORDS):
        self.n, self.hash_of = n_words, WordHashes().__getitem__
        self.powers = [U(pow(0x9E3779B97F4A7C15, k + 1, 2 ** 64)) for k in range(n_words)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        if not words:
            return np.zeros(0, U)
        h = np.fromiter(map(self.hash_of, words), U, len(words))
        n = min(self.n, len(h))
        with np.errstate(over="ignore"):
            out = np.full(len(h) - n + 1, n, U)
            for k in range(n):
                out += h[k:len(h) - n + 1 + k] * self.powers[k]
            return distinct(mix(out))


def picks(shingles: np.ndarray, seeds: np.ndarray, threshold: float, beta: float = BETA) -> np.ndarray:
    """Distinct buckets (signed 64-bit) that a set joins under any of ``seeds``."""
    out = [np.zeros(0, U)]
    if len(shingles):
        share = beta / (threshold * len(shingles))
        step = max(1, PICK_CELLS // len(shingles))
        with np.errstate(over="ignore"):
            for a in range(0, len(seeds), step):
                some = seeds[a:a + step]
                h = mix(shingles[None, :] ^ some[:, None])
                row, at = np.nonzero(h < U(int(share * 2 ** 64))) if share < 1 else np.nonzero(np.ones(h.shape, bool))
                out.append(mix(h[row, at] * U(3) + some[row]))
    return distinct(np.concatenate(out).view(np.int64))


def signature(shingles: np.ndarray) -> int:
    """SIGNATURE one-bit min-hashes of a set in one signed 64-bit number."""
    least = np.full(SIGNATURE, MASK, U)
    for a in range(0, len(shingles), 4096):
        np.minimum(least, (SIGNATURE_SEEDS[:, None] ^ shingles[None, a:a + 4096]).min(axis=1), out=least)
    return int(np.bitwise_or.reduce(((least >> U(1)) & U(1)) << np.arange(SIGNATURE, dtype=U)).view(np.int64))


def n_runs(recall: float = RECALL, beta: float = BETA, deeper: float = DEEPER, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold meets in a leaf with chance ``recall`` (branching process)."""
    meet = 1.0
    for _ in range(depth - 1):
        meet = 1 - math.exp(-deeper * meet)
    meet = 1 - math.exp(-beta * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def run_seeds(runs: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.arange(1, runs + 1, dtype=U) * U(0xD1B54A32D192ED03)


def class_keys(docs: DataFrame, threshold: float, n_words: int, runs: int) -> DataFrame:
    """One row per distinct text: cls, h, first_doc, copies, n (shingles), sig, buckets."""

    @F.pandas_udf("struct<n:int,sig:long,buckets:array<long>>")
    def keys(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingle, seeds = Shingler(n_words), run_seeds(runs)
        for texts in parts:
            sets = map(shingle, texts)
            yield pd.DataFrame([(len(s), signature(s), picks(s, seeds, threshold)) for s in sets], columns=["n", "sig", "buckets"])

    body = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.md5(body).alias("h"), keys(body).alias("k"))
    return materialize(
        keyed.groupBy("h").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.any_value("k").alias("k"))
        .select(F.monotonically_increasing_id().alias("cls"), "h", "first_doc", "copies", "k.*"), "ngram-classes")


def with_text(docs: DataFrame, classes: DataFrame, entries: Column) -> DataFrame:
    """``classes`` (h, first_doc, ...) with their text: broadcast while their rows and the ``entries`` of their arrays
    are few (counted), a shuffle join beyond."""
    body = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").alias("__doc"), F.md5(body).alias("__h"), body.alias("text"))
    size = classes.agg(F.count("*").alias("rows"), F.coalesce(F.sum(entries), F.lit(0)).alias("entries")).first()
    few = size["rows"] <= MAX_BROADCAST_CLASSES and size["entries"] <= MAX_BROADCAST_ENTRIES
    side = F.broadcast(classes) if few else classes
    return texts.join(side, (F.col("__h") == F.col("h")) & F.col("__doc").eqNullSafe(F.col("first_doc"))) \
        .drop("__doc", "__h")


def leaves(docs: DataFrame, classes: DataFrame, threshold: float, n_words: int) -> DataFrame:
    """(leaf, cls): members of all leaves of all runs, redundant leaves left out."""
    nodes = classes.select(F.explode("buckets").alias("path"), "cls")
    done = None
    for depth in range(1, DEPTH + 1):
        nodes = materialize(nodes, "ngram-nodes")
        buckets = materialize(nodes.groupBy("path").agg(
            F.count("*").alias("m"), F.expr("bit_xor(xxhash64(cls))").alias("x"), F.sum("cls").alias("s"))
            .where("m > 1"), "ngram-buckets")
        big = buckets.where(F.col("m") > LEAF).select("path", "m")
        leaf, split = buckets, None
        if depth < DEPTH and not big.isEmpty():
            inside = materialize(nodes.join(big, "path"), "ngram-big")
            # two sets agree in a bit with chance (1 + resemblance) / 2; k ones among m sets are k^2 + (m - k)^2 agreeing pairs
            bits = [F.sum(F.shiftrightunsigned("sig", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(SIGNATURE)]
            ones = [F.col(f"b{i}").cast("double") for i in range(SIGNATURE)]
            agree = sum((k * k + (F.col("m") - k) * (F.col("m") - k) for k in ones), F.lit(0.0)) / F.lit(SIGNATURE)
            split = materialize(
                inside.join(classes.select("cls", "sig"), "cls").groupBy("path", "m").agg(*bits)
                .where(agree < (1 + ALIKE) / 2 * F.col("m") * F.col("m")).select("path"), "ngram-split")
            leaf = buckets.join(split, "path", "left_anti")
        # buckets with the same members are one leaf; a leaf's id puts larger ones first
        leaf = leaf.groupBy("m", "x", "s").agg(F.min("path").alias("path")).select(
            "path", (F.shiftleft(F.lit(2 ** 20 - 1) - F.least("m", F.lit(2 ** 20 - 1)), 43)
                     + F.shiftrightunsigned("path", 21)).alias("leaf"))
        members = nodes.join(leaf, "path").select("leaf", "cls")
        done = members if done is None else done.unionByName(members)
        if split is None:
            break
        nodes = split_nodes(docs, classes, inside.join(split, "path", "left_semi"), threshold, n_words)
    done = materialize(done.distinct(), "ngram-leaves")
    # a leaf whose members all have the same first leaf holds no pair of its own
    first = done.groupBy("cls").agg(F.min("leaf").alias("first"))
    own = (done.join(first, "cls").groupBy("leaf").agg(F.min("first").alias("a"), F.max("first").alias("b"))
           .where("a = leaf or a <> b").select("leaf"))
    return materialize(done.join(own, "leaf"), "ngram-leaves")


def split_nodes(docs: DataFrame, classes: DataFrame, inside: DataFrame, threshold: float, n_words: int) -> DataFrame:
    """Members of large buckets dealt to sub-buckets by new picks, hashed with the bucket's own seed."""

    @F.pandas_udf("array<long>")
    def deeper(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingle = Shingler(n_words)
        for texts, paths in parts:
            with np.errstate(over="ignore"):
                yield pd.Series([picks(shingle(t), np.asarray(p, np.int64).view(U) * U(0x9FB21C651E98DF25) + U(1), threshold, DEEPER)
                                 for t, p in zip(texts, paths)])

    todo = materialize(inside.groupBy("cls").agg(F.collect_list("path").alias("paths"))
                       .join(classes.select("cls", "h", "first_doc"), "cls"), "ngram-todo")
    return (with_text(docs, todo, F.size("paths")).select("cls", F.explode(deeper("text", "paths")).alias("path"))
            .select("path", "cls").distinct())


RESULT = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def overlap(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each row set with each column set (arrays of distinct values)."""
    a, b = np.concatenate(rows), np.concatenate(cols)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(rows), len(cols)), np.float32)
    if not len(shared):
        return out

    def place(values, sets):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, values)
        ok = at < len(shared)
        ok[ok] = shared[at[ok]] == values[ok]
        order = np.argsort(at[ok], kind="stable")
        return owner[ok][order], at[ok][order]

    (ra, ca), (rb, cb) = place(a, rows), place(b, cols)
    step = min(4096, len(shared))
    for lo in range(0, len(shared), step):
        i, j = np.searchsorted(ca, [lo, lo + step])
        k, m = np.searchsorted(cb, [lo, lo + step])
        left, right = np.zeros((len(rows), step), np.float32), np.zeros((len(cols), step), np.float32)
        left[ra[i:j], ca[i:j] - lo] = 1
        right[rb[k:m], cb[k:m] - lo] = 1
        out += left @ right.T
    return out


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest index of each index's group under ``pairs`` (k x 2)."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return root


def linked_pairs(sets: list, earlier: list, side: np.ndarray, threshold: float) -> np.ndarray:
    """Index pairs at or above the threshold that this leaf settles.

    ``earlier``: the sets' leaves before this one; ``side``: 0 compares all, else only 1 with 2.
    """
    both = bool((side > 0).any())
    r = np.flatnonzero(side == 1) if both else np.arange(len(sets))
    c = np.flatnonzero(side == 2) if both else r
    if not len(r) or not len(c):
        return np.zeros((0, 2), np.int64)
    size = np.array([len(s) for s in sets], np.float64)
    small, large = np.minimum.outer(size[r], size[c]), np.maximum.outer(size[r], size[c])
    open_ = (small >= threshold * large - 1e-6) & (overlap([earlier[i] for i in r], [earlier[i] for i in c]) == 0)
    if not both:
        open_ = np.triu(open_, 1)
    if not open_.any():
        return np.zeros((0, 2), np.int64)
    rr, cc = open_.any(axis=1), open_.any(axis=0)
    r, c, open_ = r[rr], c[cc], open_[np.ix_(rr, cc)]
    common = overlap([sets[i] for i in r], [sets[i] for i in c]).astype(np.float64)
    found = open_ & (common * (1 + threshold) >= threshold * np.add.outer(size[r], size[c]) - 1e-6)
    i, j = np.nonzero(found)
    return np.stack([r[i], c[j]], 1)


def compare(docs: DataFrame, classes: DataFrame, members: DataFrame, threshold: float, n_words: int) -> DataFrame:
    """(cls, links, root) contributions of every leaf block; links count copies of linked classes."""

    @F.pandas_udf("binary")
    def packed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingle = Shingler(n_words)
        for texts in parts:
            yield pd.Series([shingle(t).tobytes() for t in texts])

    of = members.groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    todo = materialize(of.join(classes.select("cls", "h", "first_doc", "copies", "n"), "cls"), "ngram-todo")
    # chunks: within a large leaf, sets are dealt by their first leaf and a hash, so that two chunks
    # of one earlier leaf (all their pairs are settled there) need not meet; sets of first leaves
    # with few members here share their chunks (-2), a small leaf is one chunk (-1)
    first = todo.select("cls", F.col("n").alias("size"), F.element_at("leaves", 1).alias("first"))
    plan = members.join(first, "cls")
    own = plan.groupBy("leaf", "first").agg(F.count("*").alias("own"))
    whole = plan.groupBy("leaf").agg(F.count("*").alias("lm"), F.sum("size").alias("lt"))
    plan = plan.join(own.join(whole, "leaf"), ["leaf", "first"]).withColumn(
        "first", F.when((F.col("lm") <= CHUNK) & (F.col("lt") <= CHUNK_SHINGLES), F.lit(-1))
        .when((F.col("first") == F.col("leaf")) | (F.col("own") >= OWN_CHUNK), F.col("first")).otherwise(F.lit(-2)).cast("long"))
    share = plan.groupBy("leaf", "first").agg(F.count("*").alias("m"), F.sum("size").alias("t")).select(
        "leaf", "first", F.greatest(F.ceil(F.col("m") / CHUNK), F.ceil(F.col("t") / CHUNK_SHINGLES)).cast("int").alias("k"))
    plan = materialize(plan.join(share, ["leaf", "first"]).select(
        "leaf", "cls", "first", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int").alias("c")), "ngram-plan")
    chunk = F.struct("first", "c")
    chunks = plan.groupBy("leaf", chunk.alias("chunk")).agg(F.count("*").alias("z")).drop("z")
    pairs = (chunks.alias("a").join(chunks.alias("b"), "leaf").where("a.chunk <= b.chunk")
             .where("a.chunk.first in (-1, -2, leaf) or a.chunk.first <> b.chunk.first")
             .select("leaf", F.col("a.chunk").alias("p"), F.col("b.chunk").alias("q")))
    pairs = pairs.withColumn("block", F.xxhash64("leaf", "p", "q"))
    sides = (pairs.where("p = q").select("leaf", F.col("p").alias("chunk"), "block", F.lit(0).alias("side"))
             .unionByName(pairs.where("p <> q").select("leaf", F.col("p").alias("chunk"), "block", F.lit(1).alias("side")))
             .unionByName(pairs.where("p <> q").select("leaf", F.col("q").alias("chunk"), "block", F.lit(2).alias("side"))))
    # a set goes from its text straight to its blocks: sets are neither written nor joined
    block = F.struct("leaf", "block", "side")
    at = (plan.select("leaf", "cls", chunk.alias("chunk")).join(sides, ["leaf", "chunk"])
          .groupBy("cls").agg(F.collect_list(block).alias("blocks")))
    todo = materialize(todo.drop("n").join(at, "cls"), "ngram-blocks")
    rows = (with_text(docs, todo, F.size("leaves") + F.size("blocks")).dropDuplicates(["cls"])
            .select("cls", "copies", "leaves", "blocks", packed("text").alias("shingles"))
            .select("cls", "copies", "leaves", "shingles", F.explode("blocks").alias("b"))
            .select("b.leaf", "b.block", "b.side", "cls", "copies", "shingles",
                    F.filter("leaves", lambda x: x < F.col("b.leaf")).alias("earlier")))

    def brute(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        copies = table.column("copies").to_numpy()
        pairs_ = linked_pairs([np.frombuffer(b.as_py(), U) for b in table.column("shingles")],
                              [np.array(e.as_py(), np.int64) for e in table.column("earlier")],
                              table.column("side").to_numpy(), threshold)
        links = np.zeros(len(cls), np.int64)
        np.add.at(links, pairs_[:, 0], copies[pairs_[:, 1]])
        np.add.at(links, pairs_[:, 1], copies[pairs_[:, 0]])
        at = np.flatnonzero(links)
        return pa.Table.from_arrays([pa.array(cls[at]), pa.array(links[at]), pa.array(cls[roots(len(cls), pairs_)[at]])],
                                    schema=RESULT)

    return materialize(rows.groupBy("leaf", "block").applyInArrow(brute, "cls long, links long, root long"), "ngram-links")


def join(docs: DataFrame, threshold: float = THRESHOLD, n_words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per distinct text: h (MD5), first_doc, copies, n_links (of one copy), class_id.

    class_id is the smallest doc_id of the texts that links connect.
    """
    docs = docs.select("doc_id", "text")
    classes = class_keys(docs, threshold, n_words, n_runs(recall))
    members = leaves(docs, classes, threshold, n_words)
    found = compare(docs, classes, members, threshold, n_words)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    group = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v"))) \
        .select(F.col("node").alias("cls"), "component")
    named = (classes.select("cls", "h", "first_doc", "copies").join(links, "cls", "left").join(group, "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))
    least = named.groupBy("component").agg(F.min("first_doc").alias("class_id"))
    return materialize(named.join(least, "component").select(
        "h", "first_doc", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "class_id",
        "component"), "ngram-result")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, **kw) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links."""
    found = join(docs, **kw)
    return (docs.select("doc_id", text_key(F.col("text")).alias("h")).join(found, "h")
            .select("doc_id", "class_id", "n_links"))


@keeps_columns
def keep_one(docs: DataFrame, **kw) -> DataFrame:
    """One row of each class, its smallest doc_id, with the columns of ``docs``."""
    found = join(docs, **kw).select(F.col("h").alias("__h"), F.col("component").alias("__group"),
                                    F.col("class_id").alias("__first"), F.col("first_doc").alias("__doc"))
    # classes whose own first document is the group's; copies of it are the rows left to thin
    heads = found.where(F.col("__doc").eqNullSafe(F.col("__first")))
    rows = docs.withColumn("__h0", text_key(F.col("text"))).join(
        heads, (F.col("__h0") == F.col("__h")) & F.col("doc_id").eqNullSafe(F.col("__doc")))
    return rows.dropDuplicates(["__group"]).select(*[F.col(f"`{c}`") for c in docs.columns])
