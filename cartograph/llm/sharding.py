"""Minimax contiguous sharding (DataFrame functions only).

Atomic groups (equal texts) are put in order of their smallest doc_id; a contiguous run of groups
is a shard.  The smallest shard capacity that fits all groups into ``n_shards`` runs is found by
binary search, each probe checked greedily (every shard takes all groups that still fit).  The
cuts are then laid within that capacity as near to equal bytes as it allows.

Sizes and prefix sums live in written tables.  The driver holds a summary of the group ends of
fixed size and asks for a finer one only around positions where a greedy step needs it, for a
whole batch of probes at once (see Ends).  Groups are never gathered: a hot group's rows are
spread by range over (group, doc_id) and numbered by partition offsets.

Defined results: a null text is the empty text (size 1); null doc_ids come first; repeated rows
are rows of one group; fewer groups than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.llm.common import width
from cartograph.session import materialize

PROBES = 31  # capacities checked by one round
CELLS = 65_536  # cells of a summary held by the driver


def rows_in_order(docs: DataFrame) -> DataFrame:
    """doc_id, size, crc, ord, h, pre (bytes up to and with the row), idx (1-based): group order."""
    body = F.coalesce(F.col("text"), F.lit(""))
    base = materialize(docs.select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.md5(body).alias("h")), "shard-rows")
    groups = base.groupBy("h").agg(F.min("doc_id").alias("ord"))
    spark = docs.sparkSession
    laid = materialize(
        base.join(groups, "h").repartitionByRange(width(spark), "ord", "h", "doc_id")
        .withColumn("pid", F.spark_partition_id()), "shard-laid")
    whole = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (laid.groupBy("pid").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
               .select("pid", F.coalesce(F.sum("b").over(whole), F.lit(0)).alias("off_b"),
                       F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("off_n")))
    own = Window.partitionBy("pid").orderBy("ord", "h", "doc_id")
    ranked = laid.withColumns({"rn": F.row_number().over(own),
                               "cb": F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))})
    return materialize(ranked.join(offsets, "pid").select(
        "doc_id", "size", "crc", "ord", "h", (F.col("cb") + F.col("off_b")).alias("pre"),
        (F.col("rn") + F.col("off_n")).alias("idx")), "shard-ranked")


def group_ends(rows: DataFrame) -> DataFrame:
    """Where each group ends (pre, idx) and its size, sorted by position."""
    ends = rows.groupBy("ord", "h").agg(F.max("pre").alias("pre"), F.max("idx").alias("idx"), F.sum("size").alias("size"))
    return materialize(ends.select("pre", "idx", "size").repartitionByRange(width(rows.sparkSession), "pre")
                       .sortWithinPartitions("pre"), "shard-ends")


class Ends:
    """Look-up of group ends by position without holding them.

    The positions are cut into CELLS cells; the driver holds the first and last end of each
    (two longs a cell, whatever the data's size).  Only a bound between a cell's first and last
    end needs more: such cells are summarised the same way, at CELLS times the resolution, in one
    pass for a whole batch of bounds, and kept.
    """

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.steps = ends, [-(-total // CELLS)]
        while self.steps[-1] > 1:
            self.steps.append(-(-self.steps[-1] // CELLS))
        self.known: dict[tuple[int, int], tuple] = {}

    def _load(self, level: int, parents: list[int]) -> None:
        """Summaries of the cells of ``level`` inside ``parents``, cells of the level above."""
        above = self.steps[level - 1] if level else None
        inside, up = self.ends, F.lit(0).cast("long")
        if above:
            up = F.expr(f"pre div {above}")
            inside = inside.where(F.col("pre").between(min(parents) * above, (max(parents) + 1) * above)
                                  & up.isin(parents))
        rows = (inside.groupBy(up.alias("up"), F.expr(f"pre div {self.steps[level]}").alias("cell"))
                .agg(F.min("pre").alias("first"), F.max("pre").alias("last")).collect())
        got: dict[int, list] = {p: [] for p in parents}
        for r in rows:
            got[r["up"]].append((r["cell"], r["first"], r["last"]))
        for p, found in got.items():
            self.known[level, p] = tuple(zip(*sorted(found)))

    def _place(self, bound: int):
        """(cells, firsts, lasts, i): the last cell that starts at or below the bound; or (level, cell) to load."""
        parent = 0
        for level, step in enumerate(self.steps):
            if (level, parent) not in self.known:
                return level, parent
            cells, first, last = self.known[level, parent]
            i = bisect_right(first, bound) - 1
            if step == 1 or i < 0 or bound >= last[i]:
                return cells, first, last, i
            parent = cells[i]

    def _settle(self, bounds: list[int]) -> None:
        while missing := {m for m in map(self._place, bounds) if len(m) == 2}:
            for level in {lv for lv, _ in missing}:
                self._load(level, sorted(p for lv, p in missing if lv == level))

    def floor(self, bounds: list[int]) -> list[int]:
        """Largest end at or below each bound (0: none)."""
        self._settle(bounds)
        return [last[i] if i >= 0 else 0 for _, _, last, i in map(self._place, bounds)]

    def ceil(self, bound: int) -> int:
        """Smallest end at or above a bound that is at most the last end."""
        below = self.floor([bound])[0]
        if below == bound:
            return bound
        _, first, _, i = self._place(bound)
        if i + 1 < len(first):
            return first[i + 1]
        # the bound lies past the last end of its cell's table: the next table of the top level
        _, first, last = self.known[0, 0]
        return first[bisect_right(first, bound)]


def fits(ends: Ends, capacities: list[int], total: int, n_shards: int) -> list[bool]:
    """Greedy check of several capacities: do n_shards runs of at most that size hold all groups?"""
    at = [0] * len(capacities)
    for _ in range(n_shards):
        at = ends.floor([min(p + c, total) for p, c in zip(at, capacities)])
    return [p >= total for p in at]


def smallest_capacity(ends: Ends, total: int, largest: int, n_shards: int) -> int:
    """Binary search, PROBES capacities a round; total / n + largest always fits."""
    lo = max(-(-total // n_shards), largest)  # no less can fit
    hi = max(lo, -(-total // n_shards) + largest)
    while lo < hi:
        probes = sorted({lo + (hi - lo) * k // (PROBES + 1) for k in range(PROBES + 1)})
        ok = fits(ends, probes, total, n_shards)
        good = next((p for p, x in zip(probes, ok) if x), hi)
        lo = max((p + 1 for p, x in zip(probes, ok) if not x), default=lo)
        hi = good
    return hi


def cut_positions(ends: Ends, capacity: int, total: int, n_shards: int) -> list[int]:
    """n_shards - 1 group ends, every run within ``capacity``, each as near to its equal share as that allows."""
    earliest = [total] * (n_shards + 1)
    for j in range(n_shards - 1, 0, -1):
        earliest[j] = 0 if earliest[j + 1] <= capacity else ends.ceil(earliest[j + 1] - capacity)
    cuts, at = [], 0
    for j in range(1, n_shards):
        most = min(at + capacity, total)
        want = min(max(round(j * total / n_shards), earliest[j], at), most)
        at = min((p for p in (ends.floor([want])[0], ends.ceil(want)) if max(earliest[j], at) <= p <= most),
                 key=lambda p: (abs(p - want), p))
        cuts.append(at)
    return cuts


def shard(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and gapless slot, law ``bytes``."""
    rows = rows_in_order(docs.select("doc_id", "text"))
    ends = group_ends(rows)
    total, largest = ends.agg(F.max("pre"), F.max("size")).first()
    cuts, index = [], {0: 0}
    if total:
        look = Ends(ends, total)
        cuts = cut_positions(look, smallest_capacity(look, total, largest, n_shards), total, n_shards)
        index |= {r["pre"]: r["idx"] for r in ends.where(F.col("pre").isin(cuts)).select("pre", "idx").collect()}
    shard_no, before = F.lit(0), F.lit(0).cast("long")
    for j, c in enumerate(cuts, 1):
        past = F.col("pre") > c
        shard_no = F.when(past, j).otherwise(shard_no)
        before = F.when(past, F.lit(index[c]).cast("long")).otherwise(before)
    return rows.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                       shard_no.cast("int").alias("shard"), (F.col("idx") - 1 - before).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
