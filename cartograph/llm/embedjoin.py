"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated by one fixed random orthogonal matrix and cut into blocks of BLOCK
dimensions.  Cosine >= t is a squared distance of at most 2 (1 - t); a pair within it has at least
one block within the block's proportional share of that budget.  So each block is range-joined on
its own: a grid over its first GRID dimensions with cells twice the block radius wide brings
together every pair within the block radius; inside a cell pair the block distances are compared,
and candidates are verified exactly (cosine in double precision on the given components).  A pair
is settled only in its first block within budget and in one cell, so the union needs no de-duplication
and pairs are never written out: a task returns per vector its links and a root of its local group.

Equal vectors of one label are one class (one row with its copies).  Cells above CHUNK rows are
compared in blocks of two chunks.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing; vectors of different lengths never link; a null vec_id
never names a component; repeated rows are copies; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import connected_components
from cartograph.llm.ngramjoin import roots
from cartograph.session import materialize

COSINE, BLOCK, GRID, CHUNK, SEED = 0.98, 8, 2, 4096, 20_240_601
SLACK = 1e-9  # relative widening of every budget, far above rounding


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED + dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors; einsum keeps a row's result independent of the rows beside it."""
    v = vectors.astype(np.float64)
    v = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return np.einsum("nj,ij->ni", v, rotation(v.shape[1]))


def blocks(dims: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK, dims)) for a in range(0, dims, BLOCK)]


def budgets(dims: int, cosine: float) -> np.ndarray:
    """Squared-distance budget of each block: its share of the dimensions."""
    return np.array([2 * (1 - cosine) * (1 + SLACK) * (b - a) / dims for a, b in blocks(dims)])


CELLS = "cls long, block int, x int, y int, home boolean"


def cells_of(vectors: DataFrame, cosine: float) -> DataFrame:
    """Cells of every class and block: its own, and the later ones its block radius reaches."""

    def assign(batches):
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            sizes = batch.column("dims").to_numpy()
            flat = np.asarray(batch.column("vec").flatten())
            start = np.cumsum(sizes) - sizes
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                y = rotated(flat[start[at][:, None] + np.arange(dims)])
                for b, ((lo, hi), budget) in enumerate(zip(blocks(int(dims)), budgets(int(dims), cosine))):
                    radius = np.sqrt(budget)
                    grid = y[:, lo:min(lo + GRID, hi)] / (2 * radius)
                    if grid.shape[1] < 2:
                        grid = np.concatenate([grid, np.zeros((len(grid), 2 - grid.shape[1]))], 1)
                    own = np.floor(grid).astype(np.int64)
                    side = np.where(grid - own < 0.5, -1, 1)  # the only neighbour within the radius
                    out = [(at, own, True)]
                    for dx, dy in ((1, 0), (0, 1), (1, 1)):
                        cell = own + side * np.array([dx, dy])
                        later = (cell[:, 0] > own[:, 0]) | ((cell[:, 0] == own[:, 0]) & (cell[:, 1] > own[:, 1]))
                        out.append((at[later], cell[later], False))
                    for i, cell, home in out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cls[i]), pa.array(np.full(len(i), b, np.int32)), pa.array(cell[:, 0].astype(np.int32)),
                             pa.array(cell[:, 1].astype(np.int32)), pa.array(np.full(len(i), home))],
                            names=["cls", "block", "x", "y", "home"])

    return vectors.select("cls", "dims", "vec").mapInArrow(assign, CELLS)


def linked_pairs(vectors: np.ndarray, side: np.ndarray, block: int, cosine: float) -> np.ndarray:
    """Index pairs (row side 0/1, column side 0/2) linked and settled in this block."""
    dims = vectors.shape[1]
    y, budget, cuts = rotated(vectors), budgets(vectors.shape[1], cosine), blocks(vectors.shape[1])
    lo, hi = cuts[block]
    r = np.flatnonzero(side != 2)
    c = np.flatnonzero(side != 1)
    within = bool((side == 0).any())
    v = vectors.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    z = y[:, lo:hi]
    sq = np.einsum("ij,ij->i", z, z)
    found = []
    for a in range(0, len(r), 256):
        rows = r[a:a + 256]
        d = sq[rows][:, None] + sq[c][None, :] - 2 * z[rows] @ z[c].T
        i, j = np.nonzero(d <= budget[block] + 1e-12)
        i, j = rows[i], c[j]
        ok = i < j if within else np.ones(len(i), bool)
        for k in range(0, len(i), 100_000):
            p, q = i[k:k + 100_000][ok[k:k + 100_000]], j[k:k + 100_000][ok[k:k + 100_000]]
            part = np.stack([((y[p, s:e] - y[q, s:e]) ** 2).sum(axis=1) for s, e in cuts], 1) <= budget
            mine = part[:, block] & ~part[:, :block].any(axis=1)
            p, q = p[mine], q[mine]
            cos = np.einsum("ij,ij->i", v[p], v[q]) / (norm[p] * norm[q])
            found.append(np.stack([p[cos >= cosine], q[cos >= cosine]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def vector_classes(embeddings: DataFrame) -> DataFrame:
    """Distinct linkable vectors per label: cls, label, vec, dims, first_id, copies."""
    e = F.col("embedding").cast("array<double>")
    fine = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0))
    return materialize(
        embeddings.where(fine).groupBy("label", F.col("embedding").alias("vec"))
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("cls"), "label", "vec", F.size("vec").alias("dims"), "first_id", "copies"),
        "embed-classes")


RESULT = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def compare(classes: DataFrame, cosine: float) -> DataFrame:
    """(cls, links, root) contributions of every cell block."""
    cells = materialize(cells_of(classes, cosine).join(classes.select("cls", "label", "dims"), "cls"), "embed-cells")
    key = ["label", "dims", "block", "x", "y"]
    plan = cells.groupBy(*key, "home").agg(F.count("*").alias("m")) \
        .select(*key, "home", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / CHUNK).cast("int") - 1)).alias("c"),
                F.ceil(F.col("m") / CHUNK).cast("int").alias("k"))
    chunk = F.struct((~F.col("home")).cast("int").alias("probe"), "c")
    chunks = plan.select(*key, chunk.alias("chunk"))
    pairs = (chunks.alias("a").join(chunks.select(*key, F.col("chunk").alias("q")), key)
             .where("chunk.probe = 0 and chunk <= q").select(*key, F.col("chunk").alias("p"), "q")
             .withColumn("part", F.xxhash64(*key, "p", "q")))
    sides = (pairs.where("p = q").select(*key, F.col("p").alias("chunk"), "part", F.lit(0).alias("side"))
             .unionByName(pairs.where("p <> q").select(*key, F.col("p").alias("chunk"), "part", F.lit(1).alias("side")))
             .unionByName(pairs.where("p <> q").select(*key, F.col("q").alias("chunk"), "part", F.lit(2).alias("side"))))
    dealt = cells.join(plan.select(*key, "home", "k").distinct(), [*key, "home"]) \
        .withColumn("c", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int")).withColumn("chunk", chunk)
    rows = (dealt.select(*key, "cls", "chunk").join(sides, [*key, "chunk"])
            .join(classes.select("cls", "vec", "copies"), "cls")
            .select("block", "part", "side", "cls", "vec", "copies"))

    def brute(table: pa.Table) -> pa.Table:
        cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        vec = table.column("vec").combine_chunks()
        vectors = np.asarray(vec.flatten()).reshape(len(cls), -1)
        pairs_ = linked_pairs(vectors, table.column("side").to_numpy(), table.column("block")[0].as_py(), cosine)
        links = np.zeros(len(cls), np.int64)
        np.add.at(links, pairs_[:, 0], copies[pairs_[:, 1]])
        np.add.at(links, pairs_[:, 1], copies[pairs_[:, 0]])
        at = np.flatnonzero(links)
        return pa.Table.from_arrays([pa.array(cls[at]), pa.array(links[at]), pa.array(cls[roots(len(cls), pairs_)[at]])],
                                    schema=RESULT)

    return materialize(rows.groupBy("block", "part").applyInArrow(brute, "cls long, links long, root long"), "embed-links")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings`` (vec_id, embedding, label)."""
    embeddings = embeddings.select("vec_id", "embedding", "label")
    classes = vector_classes(embeddings)
    found = compare(classes, cosine)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    group = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v"))) \
        .select(F.col("node").alias("cls"), "component")
    named = classes.join(links, "cls", "left").join(group, "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "component").select(
        F.col("label").alias("__label"), F.col("vec").alias("__vec"), "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = embeddings.join(named, (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("__vec")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
