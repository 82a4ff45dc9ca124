"""Item co-occurrence: interaction edges, inverted index, baskets, item pairs.

Scale notes
-----------
* Edges are de-duplicated with a partial+final hash aggregate.
* Index and basket lists are one sorted list per key.  Only a key with more
  than ``max_list`` members (1M by default) is split, at sampled quantiles of
  its members into numbered segments, so no list outgrows a task and the
  segments in order are the sorted list.
* Pairs come from a self equi-join on ``(user_id, p, q)``.  A user whose
  basket exceeds ``block_size`` items is split into ``s = ceil(n/block_size)``
  hash blocks of items; each left row is replicated to the ``s`` blocks
  ``(p=h(a), q)`` and each right row to ``(p, q=h(b))``, so every item pair of
  the user meets in exactly one key, and no key produces more than about
  ``block_size**2`` pairs.  Light users keep ``s = 1`` (no replication).
* Pair counts do not move pairs: a user's basket gives every item one row with the
  later items as a list (:func:`pair_stripes`), offsets of 4 bytes where the ids
  allow it.  The rows go to the task of their item, which opens the lists and counts;
  the number of tasks follows the number of pairs (:data:`PAIRS_PER_TASK`), and an
  item with more pairs than that is cut by a hash of the other item.  Where the same
  few pairs come again and again (:data:`REPEATS`), lists are opened and counted
  before the shuffle instead.
* A total order of all pairs (:func:`ordered_pairs`) keeps and moves sorted stretches,
  packed as differences of neighbours: a byte or two a pair where a row has 36.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.operators.clean import deep_interactions
from cartograph.schema import TOP_PAIRS
from cartograph.session import materialize

DEFAULT_MAX_LIST = 1 << 20
DEFAULT_PAIR_BLOCK = 4096
# (key, nsplit) rows are 12 bytes: 1M rows is a ~12 MB broadcast
DEFAULT_BROADCAST_ROWS = 1_000_000
# a counted pair takes ~100 bytes of a task's hash table: 2M pairs are ~200 MB
PAIRS_PER_TASK = 2_000_000
# a small input's tasks hold at least so many pairs; beyond MAX_PAIR_TASKS tasks they grow instead
LEAST_PAIRS_PER_TASK = 50_000
MAX_PAIR_TASKS = 20_000
# pairs per possible pair from which on counting before the shuffle moves less than lists
REPEATS = 256
# pairs of an ordered partition, and sorted at a time before they move; a small table's partitions hold at least LEAST_PAIRS_PER_RUN
PAIRS_PER_RUN, LEAST_PAIRS_PER_RUN = 2_000_000, 1_000
# pairs of a packed stretch
PAIRS_PER_ROW = 4096
# sampled pairs a cut of the order, and in all
SAMPLE_PER_CUT, MAX_CUT_SAMPLE = 64, 1 << 18
# sampled members a segment of a split list, and cuts looked at in one run
SAMPLE_PER_SEGMENT, CUT_RUN = 64, 32


def interaction_edges(log: DataFrame, deep_only: bool = True) -> DataFrame:
    """Distinct ``(user_id, item_id)`` of the deep interactions."""
    src = deep_interactions(log) if deep_only else log
    return src.select("user_id", "item_id").distinct()


def _grouped_lists(edges: DataFrame, key: str, member: str, out: str, max_list: int) -> DataFrame:
    heavy, n_heavy = _heavy_keys(edges, key, max_list)
    block = F.lit(0)
    if n_heavy:
        cuts = materialize(segment_cuts(edges, heavy, key, member), "segment-cuts")
        # the cuts of all keys number at most edges / max_list
        edges = edges.join(F.broadcast(cuts) if n_heavy <= DEFAULT_BROADCAST_ROWS else cuts, key, "left")
        block = F.coalesce(_segment_of(F.col(member)), F.lit(0))
    return (edges.groupBy(key, block.cast("int").alias("block"))
            .agg(F.array_sort(F.collect_list(member)).alias(out)))


def segment_cuts(edges: DataFrame, heavy: DataFrame, key: str, member: str) -> DataFrame:
    """``(key, cuts, heads)`` of the keys in ``heavy`` (key, n, nsplit): the largest members of all segments but the last.

    Quantiles of a sample by hash, about SAMPLE_PER_SEGMENT members a segment,
    so segments are near equal.  Cuts come in runs of CUT_RUN, ``heads`` holds
    each run's last cut.
    """
    share = F.lit(float(SAMPLE_PER_SEGMENT)) * F.col("nsplit") / F.col("n")
    place = F.pmod(F.xxhash64(member, F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    side = F.broadcast(heavy) if heavy.count() <= DEFAULT_BROADCAST_ROWS else heavy
    sample = edges.join(side, key).where(place < share).groupBy(key, "nsplit").agg(F.sort_array(F.collect_list(member)).alias("s"))
    at = F.transform(F.sequence(F.lit(1), F.col("nsplit") - 1),
                     lambda i: F.get("s", (i * F.size("s") / F.col("nsplit")).cast("int") - F.lit(1)))
    cuts = sample.select(key, F.array_distinct(F.filter(at, lambda c: c.isNotNull())).alias("c")).where(F.size("c") > 0)
    runs = F.transform(F.sequence(F.lit(0), (F.size("c") - 1).cast("int"), F.lit(CUT_RUN)), lambda i: F.slice("c", i + 1, CUT_RUN))
    return cuts.select(key, runs.alias("cuts")).withColumn("heads", F.transform("cuts", lambda r: F.element_at(r, -1)))


def _segment_of(member: Column) -> Column:
    """Number of cuts below ``member``: the runs wholly below it, then within the next run."""
    runs = F.size(F.filter("heads", lambda h: h < member))
    return runs * CUT_RUN + F.coalesce(F.size(F.filter(F.get("cuts", runs), lambda c: c < member)), F.lit(0))


def inverted_index(edges: DataFrame, max_list: int = DEFAULT_MAX_LIST) -> DataFrame:
    """``(item_id, block, user_ids)``: ascending distinct users per item.

    One row per item (``block`` 0); an item with more than ``max_list`` users
    has them cut into about ``ceil(n / max_list)`` segments of near equal size, a
    row each: ``block`` numbers them, and in this order they are the sorted list.
    ``edges`` must be distinct (see :func:`interaction_edges`).
    """
    return _grouped_lists(edges, "item_id", "user_id", "user_ids", max_list)


def user_baskets(edges: DataFrame, max_list: int = DEFAULT_MAX_LIST) -> DataFrame:
    """``(user_id, block, item_ids)``: ascending distinct items per user, one row
    per user (blocks as in :func:`inverted_index`)."""
    return _grouped_lists(edges, "user_id", "item_id", "item_ids", max_list)


def basket_sizes(edges: DataFrame) -> DataFrame:
    """``(user_id, n_items)``."""
    return edges.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))


def _split_counts(edges: DataFrame, key: str, block_size: int,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Attach ``nsplit`` (hash blocks of the key's members) to each edge.

    No heavy key -> no join at all; up to ``broadcast_rows`` of them -> their
    table is broadcast, so the edges are not shuffled for it; beyond that -> a
    shuffle join whose skewed partitions AQE splits.
    """
    heavy, n_heavy = _heavy_keys(edges, key, block_size)
    if n_heavy == 0:
        return edges.withColumn("nsplit", F.lit(1))
    side = F.broadcast(heavy) if n_heavy <= broadcast_rows else heavy
    return (edges.join(side.drop("n"), key, "left")
            .withColumn("nsplit", F.coalesce(F.col("nsplit"), F.lit(1))))


def _heavy_keys(edges: DataFrame, key: str, block_size: int) -> tuple[DataFrame, int]:
    """``(key, n, nsplit)`` of the keys with more than ``block_size`` members, written once, and their
    number: at most ``|edges| / block_size``."""
    heavy = materialize(
        edges.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_size)
        .select(key, "n", F.ceil(F.col("n") / F.lit(block_size)).cast("int").alias("nsplit")), "heavy-keys")
    return heavy, heavy.count()


def item_pairs(edges: DataFrame, block_size: int = DEFAULT_PAIR_BLOCK) -> DataFrame:
    """``(user_id, item_a, item_b)`` with ``item_a < item_b`` for every pair of
    items one user holds (edges must be distinct)."""
    e = _split_counts(edges, "user_id", block_size)
    h = F.pmod(F.xxhash64("item_id"), F.col("nsplit")).cast("int")
    fan = F.explode(F.sequence(F.lit(0), F.col("nsplit") - 1))
    left = e.select("user_id", F.col("item_id").alias("item_a"), h.alias("p"), fan.alias("q"))
    right = e.select("user_id", F.col("item_id").alias("item_b"), fan.alias("p"), h.alias("q"))
    return (left.join(right, ["user_id", "p", "q"])
            .where(F.col("item_a") < F.col("item_b"))
            .select("user_id", "item_a", "item_b"))


def _pair_blocks(edges: DataFrame, block_size: int) -> DataFrame:
    """``(user_id, nsplit, p, items)``: sorted items of every basket, cut into the hash blocks of :func:`item_pairs`."""
    e = _split_counts(edges.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()), "user_id", block_size)
    h = F.pmod(F.xxhash64("item_id"), F.col("nsplit")).cast("int")
    return e.groupBy("user_id", "nsplit", h.alias("p")).agg(F.array_sort(F.collect_list("item_id")).alias("items"))


def pair_stripes(blocks: DataFrame, split: bool = True) -> DataFrame:
    """``(item_a, others)``: for every item of a block of :func:`_pair_blocks` the items of the same user that
    pair with it, all above it but for repeats of itself.  ``split``: is any basket cut into blocks?"""
    light = (blocks.where("nsplit = 1").select("items", F.posexplode("items").alias("pos", "item_a"))
             .where(F.col("pos") < F.size("items") - 1)
             .select("item_a", F.slice("items", F.col("pos") + 2, F.size("items")).alias("others")))
    if not split:
        return light
    heavy = blocks.where("nsplit > 1")
    fan = F.explode(F.sequence(F.lit(0), F.col("nsplit") - 1))
    left = heavy.select("user_id", F.col("items").alias("mine"), "p", fan.alias("q"))
    right = heavy.select("user_id", "items", F.col("p").alias("q"), fan.alias("p"))
    split = (left.join(right, ["user_id", "p", "q"]).select("items", F.explode("mine").alias("item_a"))
             .select("item_a", F.filter("items", lambda x: x > F.col("item_a")).alias("others")).where(F.size("others") > 0))
    return light.unionByName(split)


def item_cooccurrence(edges: DataFrame, block_size: int = DEFAULT_PAIR_BLOCK, pairs_per_task: int = PAIRS_PER_TASK,
                      repeats: int = REPEATS) -> DataFrame:
    """``(item_a, item_b, n_users)``: how many users hold both items (a < b)."""
    blocks = materialize(_pair_blocks(edges, block_size), "pair-blocks")
    # pairs an item is the smaller one of; all items of the user where its basket is split
    after = F.when(F.col("nsplit") == 1, F.size("items") - F.col("pos") - 1).otherwise(F.col("nsplit") * block_size)
    loads = materialize(
        blocks.select("items", "nsplit", F.posexplode("items").alias("pos", "item_a"))
        .groupBy("item_a").agg(F.sum(after.cast("long")).alias("load"), F.max("nsplit").alias("nsplit")), "pair-loads")
    n_pairs, n_items, low, high, split, n_heavy = loads.agg(
        F.coalesce(F.sum("load"), F.lit(0)), F.count(F.lit(1)), F.min("item_a"), F.max("item_a"),
        F.coalesce(F.max("nsplit") > 1, F.lit(False)), F.count_if(F.col("load") > pairs_per_task)).first()
    low = low if n_items and high - low < 1 << 31 else None  # base of 4-byte offsets
    if low is not None:
        blocks = blocks.withColumn("items", F.transform("items", lambda x: (x - F.lit(low)).cast("int")))
    stripes, key = pair_stripes(blocks, split), ["item_a"]
    if 2 * n_pairs < repeats * n_items * (n_items - 1):
        if n_heavy:
            heavy = loads.where(F.col("load") > pairs_per_task).select(  # at most n_pairs / pairs_per_task rows
                (F.col("item_a") - F.lit(low)).cast("int").alias("item_a") if low is not None else "item_a",
                F.ceil(F.col("load") / F.lit(pairs_per_task)).cast("int").alias("nsalt"))
            side = F.broadcast(heavy) if n_heavy <= DEFAULT_BROADCAST_ROWS else heavy
            salts = F.sequence(F.lit(0), F.coalesce("nsalt", F.lit(1)) - 1)
            cut = F.when(F.col("nsalt").isNull(), F.col("others")).otherwise(
                F.filter("others", lambda x: F.pmod(F.xxhash64(x), F.col("nsalt")) == F.col("salt")))
            key = ["item_a", "salt"]
            stripes = (stripes.join(side, "item_a", "left").withColumn("salt", F.explode(salts))
                       .select("item_a", cut.alias("others"), "salt").where(F.size("others") > 0))
        cores = edges.sparkSession.sparkContext.defaultParallelism
        wanted = max(-(-n_pairs // pairs_per_task), min(cores, -(-n_pairs // LEAST_PAIRS_PER_TASK)))
        stripes = stripes.repartition(min(MAX_PAIR_TASKS, max(1, wanted)), *key)
    # a pair has one salt: grouped with it, its count needs no second shuffle
    counts = (stripes.select(*key, F.explode("others").alias("item_b")).where(F.col("item_a") < F.col("item_b"))
              .groupBy(*key, "item_b").agg(F.count(F.lit(1)).alias("n_users")))
    if low is None:
        return counts.select("item_a", "item_b", "n_users")
    return counts.select(*[(F.col(c).cast("long") + F.lit(low)).alias(c) for c in ("item_a", "item_b")], "n_users")


def ordered_pairs(pairs: DataFrame, pairs_per_run: int = PAIRS_PER_RUN, pairs_per_row: int = PAIRS_PER_ROW,
                  form: Callable | None = None, schema: str = "item_a long, item_b long, n_users long") -> DataFrame:
    """``pairs`` (item_a, item_b, n_users) in one total order, partition after partition: most shared first, ties
    by ``item_a, item_b``.

    Pairs are neither kept nor moved as rows.  The tasks that have them, read once, sort
    ``pairs_per_run`` at a time and write sorted stretches packed, as differences
    of neighbours.  Partitions begin at quantiles of a sample of these, on the whole key, so a mass of
    equal counts is cut as well; stretches are cut there, and a
    partition opens its own and sorts once more.  A null in a pair is an error.
    ``form``: makes a record batch of ``schema`` of a run of ordered pairs, given as three arrays.
    """
    a, b, n = (F.col(c).cast("long") for c in ("item_a", "item_b", "n_users"))
    key = pairs.select(F.bitwise_not(n).alias("less"), a.alias("item_a"), b.alias("item_b"))  # less rises where n_users falls
    pack, pick, cut, unpack = _packers(pairs_per_run, pairs_per_row, form)
    packed = "n int, less binary, item_a binary, item_b binary"
    runs = materialize(key.mapInArrow(pack, packed), "pair-runs")
    n_pairs, cores = runs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], pairs.sparkSession.sparkContext.defaultParallelism
    n_parts = min(MAX_PAIR_TASKS, max(1, -(-n_pairs // pairs_per_run), min(cores, -(-n_pairs // LEAST_PAIRS_PER_RUN))))
    cuts = []
    if n_parts > 1:
        wanted = min(SAMPLE_PER_CUT * n_parts, MAX_CUT_SAMPLE)  # rows that come to the driver, or so
        sample = sorted(tuple(r) for r in runs.mapInArrow(pick(max(1, n_pairs // wanted)), key.schema).collect())
        cuts = sorted({sample[k * len(sample) // n_parts] for k in range(1, n_parts)}) if sample else []
    return (runs.mapInArrow(cut(cuts), f"part int, {packed}").repartitionById(len(cuts) + 1, F.col("part"))
            .mapInArrow(unpack, schema))


def _packers(pairs_per_run: int, pairs_per_row: int, form: Callable | None = None):
    """Functions of tasks: pairs to packed sorted stretches, every ``step``-th pair of such, stretches cut where
    partitions begin, and the sorted pairs of stretches."""
    names = ("less", "item_a", "item_b")

    def in_order(keys):
        least = [int(k.min()) for k in keys]
        bits = [(int(k.max()) - low).bit_length() for k, low in zip(keys, least)]
        if sum(bits) > 63:
            at = np.lexsort(keys[::-1])
            return [k[at] for k in keys]
        # small spans: one number a pair sorts faster
        shifts = (bits[1] + bits[2], bits[2], 0)
        whole = np.sort(sum((k - low) << shift for k, low, shift in zip(keys, least, shifts)))
        return [((whole >> shift) & ((1 << n) - 1)) + low for shift, n, low in zip(shifts, bits, least)]

    def squeezed(x):
        gaps = np.diff(x)  # wraps around beyond 64 bits, as the sum does
        kind = next(t for t in (np.int8, np.int16, np.int32, np.int64)
                    if not len(gaps) or np.iinfo(t).min <= gaps.min() and gaps.max() <= np.iinfo(t).max)
        return x[:1].tobytes() + zlib.compress(gaps.astype(kind).tobytes(), 1)

    def opened(raw, n):
        gaps = zlib.decompress(raw[8:])
        gaps = np.frombuffer(gaps, f"i{len(gaps) // (n - 1)}" if n > 1 else np.int8)
        return np.cumsum(np.concatenate([np.frombuffer(raw[:8], np.int64), gaps]), dtype=np.int64)

    def rows_of(batches):
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("n", *names))):
                n, *raw = (x.as_py() for x in row)
                yield n, raw

    def packed(rows, *more):
        kinds = [*more, pa.int32(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["part"] * len(more) + ["n", *names])

    def run(held):
        keys = in_order([np.concatenate(c) for c in zip(*held)])
        total = len(keys[0])
        return packed([(min(pairs_per_row, total - i), *(squeezed(k[i:i + pairs_per_row]) for k in keys)) for i in range(0, total, pairs_per_row)])

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("a pair to be ordered has a null")
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= pairs_per_run:
                yield run(held)
                held, n = [], 0
        if n:
            yield run(held)

    def pick(step):
        def some(batches):
            for n, raw in rows_of(batches):
                first = zlib.crc32(b"".join(raw)) % step
                if first < n:
                    yield pa.RecordBatch.from_arrays([pa.array(opened(x, n)[first::step]) for x in raw], list(names))
        return some

    def cut(cuts):
        def pieces(n, raw):
            keys = less, a, b = [opened(x, n) for x in raw]
            low, high = (bisect_right(cuts, (less[i], a[i], b[i])) for i in (0, -1))
            if low == high:
                return [(low, n, *raw)]
            ends = [0]
            for c in cuts[low:high]:
                ends.append(bisect_left(range(n), c, lo=ends[-1], key=lambda i: (less[i], a[i], b[i])))
            return [(part, j - i, *(squeezed(k[i:j]) for k in keys)) for part, (i, j) in enumerate(pairwise([*ends, n]), low) if i < j]

        def cut_rows(batches):
            for n, raw in rows_of(batches):
                yield packed(pieces(n, raw), pa.int32())
        return cut_rows

    def unpack(batches):
        held = [[opened(x, n) for x in raw] for n, raw in rows_of(batches)]
        if held:
            less, a, b = in_order([np.concatenate(c) for c in zip(*held)])
            held.clear()
            for i in range(0, len(less), 1 << 16):
                columns = [pa.array(x[i:i + (1 << 16)]) for x in (a, b, ~less)]
                yield form(*columns) if form else pa.RecordBatch.from_arrays(columns, ["item_a", "item_b", "n_users"])

    return pack, pick, cut, unpack


def top_item_pairs(cooccurrence: DataFrame, limit: int = TOP_PAIRS) -> DataFrame:
    """The ``limit`` most shared pairs; ties ordered by ``item_a, item_b``.

    Planned as a bounded per-partition top-k plus one merge (no global sort).
    """
    return (cooccurrence
            .orderBy(F.col("n_users").desc(), F.col("item_a"), F.col("item_b"))
            .limit(limit))


def item_degrees(edges: DataFrame) -> DataFrame:
    """``(item_id, n_users)`` over distinct edges."""
    return edges.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_users"))


def top_item_pairs_pruned(edges: DataFrame, limit: int = TOP_PAIRS,
                          block_size: int = DEFAULT_PAIR_BLOCK) -> DataFrame:
    """Exact top ``limit`` pairs in two passes.

    A pair's count is at most either item's user count.  The ``limit``-th
    count ``L`` among the pairs of the most shared items (a few hundred) is a
    lower bound of the true one, so every top pair, ties included, has both
    items at ``L`` users or more: only those items' pairs are counted.
    """
    if limit <= 0:
        return top_item_pairs(item_cooccurrence(edges.limit(0), block_size), limit)
    deg = materialize(item_degrees(edges), "item-degrees")
    k0 = 4 * math.ceil(math.sqrt(2 * limit))
    head = deg.orderBy(F.col("n_users").desc(), F.col("item_id")).limit(k0).select("item_id")
    hot = edges.join(F.broadcast(head), "item_id", "left_semi")  # k0 rows
    first = top_item_pairs(item_cooccurrence(hot, block_size), limit).agg(
        F.count(F.lit(1)).alias("n"), F.min("n_users").alias("least")).first()
    least = first["least"] if first["n"] == limit else 1
    if least > 1:
        edges = materialize(edges.join(deg.where(F.col("n_users") >= least).select("item_id"), "item_id", "left_semi"),
                            "pair-edges")
    return top_item_pairs(item_cooccurrence(edges, block_size), limit)


def metric_rows(one_row: DataFrame) -> DataFrame:
    """``(metric, value)`` rows from a single row of counts."""
    cols = one_row.columns
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in cols])
    return one_row.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")


def cooccurrence_stats(log: DataFrame, edges: DataFrame, cooccurrence: DataFrame) -> DataFrame:
    """``(metric, value)`` rows: deep rows, edges, indexed items, users, pairs.

    One aggregate per table (``edges`` should be a written table).
    """
    n_deep = deep_interactions(log).agg(F.count(F.lit(1)).alias("n_deep_rows"))
    e = edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct("item_id").alias("n_items"),
                  F.count_distinct("user_id").alias("n_users"))
    n_pairs = cooccurrence.agg(F.count(F.lit(1)).alias("n_pairs"))
    return metric_rows(n_deep).unionByName(metric_rows(e)).unionByName(metric_rows(n_pairs))
