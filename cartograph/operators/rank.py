"""Personalised rank: random walk with restart on the user-item graph.

Graph: every distinct deep ``(user, item)`` pair gives the edges user->item
and item->user.  A node is ``(kind, id)`` with kind 0 = user, 1 = item.

One turn::

    r'(v) = [v = target] * ((1 - alpha) + alpha * dangling(r))
            + alpha * sum_{u -> v, deg(u) > 0} r(u) / deg(u)

where ``dangling(r)`` is the mass on nodes without out-edges.  The walk
stops after the first turn whose L-inf change is below ``tol`` (or after
``max_iter`` turns); the result is the vector after that turn.

Scale design (see :func:`walks`):

* the vectors are sparse (unreached nodes are exactly 0 and are not stored)
  and keyed by target, so one loop walks from several targets at once; a target
  whose walk has settled leaves the vector, its result stays in that turn's table;
* the graph is stored as adjacency blocks ``(src, salt, out_deg, [dst, ...])``:
  one grouped pass over the edges writes neighbours and degree together, with no
  join of edges with nodes.  A node with more than ``block_size`` out-edges has them
  spread over ``ceil(deg/block_size)`` salts by a broadcast list of such nodes,
  at most MAX_HEAVY by the choice of the block size; its score row is
  replicated to each salt, so no join key holds more than ``block_size`` edges;
* a node without out-edges has one block that leads back to the target: its
  mass restarts there with no bookkeeping in the turn;
* the blocks are bucketed on their ``place``, so each turn shuffles
  only the (smaller) vector into the buckets and the blocks stream through a
  shuffle-hash join without being re-sorted.  A block's place is a hash of its node;
  that of a salted node's block is its salt's remainder, hence a hash of the neighbours alone: all
  that salted nodes give to one neighbour is summed in one bucket, so a turn moves
  one row a neighbour and not one a neighbour and bucket;
* a turn is one job: join -> union with the old vector and the restart rows
  -> one ``groupBy(target, node)`` that yields the new and the old score; each
  target's change and row count are collected with an ``Observation`` while the
  vector is written to the shared checkpoint folder, which also cuts the
  lineage every turn;
* for ``alpha < 1`` a reached node keeps a positive score, so the reached sets
  only grow; after the first turn that adds no node they are closed, and the
  walks go on over the blocks that start in them, written once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cartograph.schema import RANK_ALPHA, RANK_DECIMALS, RANK_MAX_ITER, RANK_TOL, RANK_TOP_K
from cartograph.operators.cooccur import metric_rows
from cartograph.session import drop_folder, loop_session, materialize, scratch_path

USER, ITEM = 0, 1
DEFAULT_RANK_BLOCK = 1 << 16
# a stored edge takes ~10 bytes, a contribution ~45: 2M edges explode to ~90 MB a bucket
EDGES_PER_BUCKET = 2_000_000
# a small graph's buckets hold at least so many edges; Spark refuses more than
# 100,000 buckets, so beyond 10^11 edges the buckets grow instead
LEAST_EDGES_PER_BUCKET = 50_000
MAX_BUCKETS = 50_000
# vector rows are ~35 bytes: 1M rows is a ~35 MB broadcast
DEFAULT_BROADCAST_ROWS = 1_000_000
# nodes above the block size; the block size grows with the graph to keep them fewer
MAX_HEAVY = 1_000_000
# places a bucket (they fall into buckets by hash), and least edges a place of a salted node
PLACES_PER_BUCKET = 4
EDGES_PER_PLACE = 64
# targets of one loop: a turn observes two values for each
TARGETS_PER_WALK = 64
_NODE = ["kind", "id"]
_VEC_SCHEMA = "target long, kind int, id long, score double"
# kind of the block entry that stands for the target of whoever walks there
_RESTART = -1


def bipartite_edges(edges: DataFrame) -> DataFrame:
    """``(src_kind, src_id, dst_kind, dst_id)``, both directions of each edge.

    ``edges`` are distinct ``(user_id, item_id)``; the two directions never
    collide, so the result is distinct too.
    """
    fwd = edges.select(F.lit(USER).alias("src_kind"), F.col("user_id").alias("src_id"),
                       F.lit(ITEM).alias("dst_kind"), F.col("item_id").alias("dst_id"))
    rev = edges.select(F.lit(ITEM).alias("src_kind"), F.col("item_id").alias("src_id"),
                       F.lit(USER).alias("dst_kind"), F.col("user_id").alias("dst_id"))
    return fwd.unionByName(rev)


def directed_edges(edges: DataFrame) -> DataFrame:
    """User -> item only (items become dangling nodes)."""
    return edges.select(F.lit(USER).alias("src_kind"), F.col("user_id").alias("src_id"),
                        F.lit(ITEM).alias("dst_kind"), F.col("item_id").alias("dst_id"))


def out_degree(graph: DataFrame) -> DataFrame:
    """``(kind, id, out_deg)`` for nodes with out-edges."""
    return (graph.groupBy(F.col("src_kind").alias("kind"), F.col("src_id").alias("id"))
            .agg(F.count(F.lit(1)).alias("out_deg")))


def graph_nodes(graph: DataFrame) -> DataFrame:
    """Distinct endpoints ``(kind, id)``."""
    src = graph.select(F.col("src_kind").alias("kind"), F.col("src_id").alias("id"))
    dst = graph.select(F.col("dst_kind").alias("kind"), F.col("dst_id").alias("id"))
    return src.union(dst).distinct()


def graph_stats(graph: DataFrame) -> DataFrame:
    """``(metric, value)``: nodes, users, items, edges; one pass over the edges, see :func:`node_table`."""
    return node_stats(node_table(graph))


def node_stats(nodes: DataFrame) -> DataFrame:
    """:func:`graph_stats` from a node table."""
    return metric_rows(nodes.agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("kind") == USER).alias("n_users"),
        F.count_if(F.col("kind") == ITEM).alias("n_items"), F.coalesce(F.sum("out_deg"), F.lit(0)).alias("n_edges")))


def node_table(graph: DataFrame, block_size: int = DEFAULT_RANK_BLOCK) -> DataFrame:
    """``(kind, id, out_deg, nsalt)`` for every node (out_deg 0 when dangling)."""
    # every edge gives its two endpoints; a node's degree is the number of those that start there
    ends = graph.select(F.explode(F.array(
        F.struct(F.col("src_kind").alias("kind"), F.col("src_id").alias("id"), F.lit(1).alias("out")),
        F.struct(F.col("dst_kind").alias("kind"), F.col("dst_id").alias("id"), F.lit(0).alias("out")))).alias("e"))
    return (ends.groupBy("e.kind", "e.id").agg(F.sum("e.out").alias("out_deg"))
            .withColumn("nsalt", _salts(block_size)))


def _salts(block_size: int):
    return F.greatest(F.lit(1), F.ceil(F.col("out_deg") / F.lit(block_size))).cast("int")


def adjacency_blocks(graph: DataFrame, nodes: DataFrame, block_size: int = DEFAULT_RANK_BLOCK,
                     heavy: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """``(src_kind, src_id, salt, out_deg, dsts)``: the neighbours of every node, at most about
    ``block_size`` (ascending) a block, with the node's degree.

    One grouped pass: a node's degree is the length of its list.  Only nodes in
    ``heavy`` (those above ``block_size``, see :func:`heavy_nodes`) bring theirs
    and their salts along, as a broadcast.  A node of ``nodes`` without
    out-edges has the restart entry as its only neighbour.
    """
    dst = F.struct(F.col("dst_kind").alias("kind"), F.col("dst_id").alias("id"))
    e = graph.withColumns({"salt": F.lit(0), "total": F.lit(None).cast("long")})
    if heavy is not None:
        side = F.broadcast(heavy.select(F.col("kind").alias("src_kind"), F.col("id").alias("src_id"),
                                        F.col("out_deg").alias("total"), "nsalt"))
        salt = F.pmod(F.xxhash64("dst_kind", "dst_id"), F.coalesce("nsalt", F.lit(1))).cast("int")
        e = graph.join(side, ["src_kind", "src_id"], "left").withColumn("salt", salt)
    if partitions:
        e = e.repartition(partitions, "src_kind", "src_id", "salt")
    blocks = e.groupBy("src_kind", "src_id", "salt").agg(
        F.sort_array(F.collect_list(dst)).alias("dsts"), F.max("total").alias("total"))
    ends = nodes.where("out_deg = 0").select(
        F.col("kind").alias("src_kind"), F.col("id").alias("src_id"), F.lit(0).alias("salt"),
        F.lit(1).cast("long").alias("out_deg"),
        F.array(F.struct(F.lit(_RESTART).alias("kind"), F.lit(0).cast("long").alias("id"))).alias("dsts"))
    return blocks.select("src_kind", "src_id", "salt", F.coalesce("total", F.size("dsts").cast("long")).alias("out_deg"),
                         "dsts").unionByName(ends)


def heavy_nodes(nodes: DataFrame, block_size: int) -> DataFrame | None:
    """``(kind, id, out_deg, nsalt)`` of the nodes above ``block_size``, written; None when there are none.

    They number at most edges / block_size.
    """
    heavy = materialize(nodes.where(F.col("out_deg") > block_size).select(*_NODE, "out_deg", _salts(block_size).alias("nsalt")),
                        "rank-heavy")
    return None if heavy.isEmpty() else heavy


def rank_init(graph: DataFrame, target: int) -> DataFrame:
    """``(kind, id, score)``: 1.0 at the target user when it is in the graph."""
    return (graph_nodes(graph).where((F.col("kind") == USER) & (F.col("id") == F.lit(target)))
            .select("kind", "id", F.lit(1.0).alias("score")))


def dangling_mass(rank: DataFrame, graph: DataFrame) -> DataFrame:
    """One row ``dangling``: total score on nodes without out-edges."""
    return (rank.join(out_degree(graph), _NODE, "left_anti")
            .agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("dangling")))


def rank_step(graph: DataFrame, rank: DataFrame, target: int, alpha: float = RANK_ALPHA,
              block_size: int = DEFAULT_RANK_BLOCK) -> DataFrame:
    """One turn from a sparse vector ``(kind, id, score)``; sparse result.

    The same salted turn as :func:`walks` runs (``_TURN_SQL``).
    """
    spark = graph.sparkSession
    nodes = materialize(node_table(graph, block_size), "rank-nodes")
    heavy = heavy_nodes(nodes, block_size)
    known = not nodes.where((F.col("kind") == USER) & (F.col("id") == F.lit(target))).isEmpty()
    tag = scratch_path(spark, "rank").rsplit("/", 1)[1].replace("-", "_")
    views = {f"{tag}_edges": adjacency_blocks(graph, nodes, block_size, heavy),
             f"{tag}_vec": rank.join(nodes, _NODE, "left_semi").select(F.lit(target).cast("long").alias("target"), *_NODE, "score")}
    if heavy is not None:
        views[f"{tag}_heavy"] = heavy
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        new = spark.sql(_turn_sql(tag, f"{tag}_edges", [target] if known else [], alpha, "SHUFFLE_HASH", heavy is not None))
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
    return new.where(F.col("score") != 0).select("kind", "id", "score")


def rank_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row ``max_change``: L-inf distance of two sparse vectors."""
    j = old.select(*_NODE, F.col("score").alias("a")).join(
        new.select(*_NODE, F.col("score").alias("b")), _NODE, "full")
    return j.agg(F.coalesce(F.max(F.abs(F.coalesce("b", F.lit(0.0)) - F.coalesce("a", F.lit(0.0)))),
                            F.lit(0.0)).alias("max_change"))


@dataclass
class RankResult:
    scores: DataFrame          # (kind, id, score), non-zero entries only
    nodes: DataFrame           # (kind, id, out_deg, nsalt), all nodes
    iterations: int
    converged: bool
    target_in_graph: bool
    changes: list[float] = field(default_factory=list)


@dataclass
class WalksResult:
    scores: DataFrame          # (target, kind, id, score), non-zero entries only
    nodes: DataFrame           # (kind, id, out_deg, nsalt), all nodes
    iterations: dict[int, int]           # turns of each target
    converged: dict[int, bool]
    in_graph: dict[int, bool]
    changes: dict[int, list[float]]

    def of(self, target: int) -> RankResult:
        """One target's walk."""
        return RankResult(scores=self.scores.where(F.col("target") == F.lit(target)).select("kind", "id", "score"),
                          nodes=self.nodes, iterations=self.iterations[target], converged=self.converged[target],
                          target_in_graph=self.in_graph[target], changes=self.changes[target])


# One turn of all walks: contributions along out-edges (score replicated to
# every salt of its node), the old vector (for the change) and the restart
# rows, summed per target and node in one aggregation.
_TURN_SQL = """
SELECT target, kind, id, sum(rst) + {alpha} * sum(inc) AS score, sum(old) AS old
FROM (
  SELECT target, if(d.kind < 0, {user}, d.kind) AS kind, if(d.kind < 0, target, d.id) AS id, inc, 0D AS rst, 0D AS old
  FROM (SELECT /*+ {join_hint}(v) */ v.target, v.score / CAST(e.out_deg AS DOUBLE) AS inc, explode(e.dsts) AS d
        FROM {edges} e JOIN ({sent}) v ON e.src_kind = v.kind AND e.src_id = v.id AND e.salt = v.salt{same_place})
  UNION ALL
  SELECT target, kind, id, 0D, 0D, score FROM {vec}
  {restart}
) GROUP BY target, kind, id
"""


def _place(kind: str, node: str, salt: str, nsalt: str, places: int) -> str:
    """Where a block lies: by its neighbours for a salted node (``nsalt`` not null), else by the node."""
    return f"if({nsalt} IS NULL, hash({kind}, {node}), {salt} % {places})"


def _turn_sql(tag: str, edges: str, targets: list[int], alpha: float, join_hint: str, salted: bool, places: int = 0) -> str:
    """A turn from ``<tag>_vec`` for the ``targets`` that are in the graph; ``<tag>_heavy`` names the salts.
    ``places``: those of salted nodes in a bucketed table, 0 for blocks without places."""
    sent = f"SELECT target, kind, id, score, 0 AS salt FROM {tag}_vec"
    if salted:
        sent = (f"SELECT /*+ BROADCAST(h) */ target, kind, id, score, nsalt, explode(sequence(0, coalesce(nsalt, 1) - 1)) AS salt "
                f"FROM {tag}_vec LEFT JOIN {tag}_heavy h USING (kind, id)")
    if places:
        nsalt = "nsalt" if salted else "NULL"
        sent = f"SELECT target, kind, id, score, salt, {_place('kind', 'id', 'salt', nsalt, places)} AS place FROM ({sent})"
    restart = ""
    if targets:
        rows = ", ".join(f"CAST({t} AS BIGINT)" for t in targets)
        restart = (f"UNION ALL SELECT t, {USER}, t, 0D, CAST({1.0 - alpha!r} AS DOUBLE), 0D "
                   f"FROM (SELECT explode(array({rows})) AS t)")
    return _TURN_SQL.format(alpha=repr(float(alpha)), user=USER, edges=edges, vec=f"{tag}_vec", sent=sent, restart=restart,
                            join_hint=join_hint, same_place=" AND e.place = v.place" if places else "")


def bucket_count(n_edges: int, parallelism: int) -> int:
    """Buckets of the edge table: by edge count, one per core where that still
    leaves LEAST_EDGES_PER_BUCKET, never above MAX_BUCKETS."""
    wanted = max(-(-n_edges // EDGES_PER_BUCKET), min(parallelism, -(-n_edges // LEAST_EDGES_PER_BUCKET)))
    return min(MAX_BUCKETS, max(1, wanted))


def personal_rank(graph: DataFrame, target: int, alpha: float = RANK_ALPHA,
                  max_iter: int = RANK_MAX_ITER, tol: float = RANK_TOL,
                  block_size: int = DEFAULT_RANK_BLOCK, partitions: int | None = None,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS, keep_turns: bool = True) -> RankResult:
    """Run the walk from user ``target`` over ``graph`` (src/dst edge table), see :func:`walks`."""
    return walks(graph, [target], alpha, max_iter, tol, block_size, partitions, broadcast_rows, keep_turns).of(target)


def walks(graph: DataFrame, targets: Iterable[int], alpha: float = RANK_ALPHA, max_iter: int = RANK_MAX_ITER,
          tol: float = RANK_TOL, block_size: int = DEFAULT_RANK_BLOCK, partitions: int | None = None,
          broadcast_rows: int = DEFAULT_BROADCAST_ROWS, keep_turns: bool = True) -> WalksResult:
    """Run the walks from all user ids in ``targets`` over ``graph`` (src/dst edge table).

    Each target stops by its own change, as if it walked alone.  Targets go
    through the loop TARGETS_PER_WALK at a time, over the same blocks.

    The rows that a turn's join replicates the vector to are known after the
    turn before (a row per salt of each node): up to ``broadcast_rows`` they
    are broadcast to the block scan, beyond that shuffled into the
    blocks' buckets (shuffle-hash join, blocks stream).
    ``keep_turns=False`` deletes vectors that no later turn reads.
    """
    spark = graph.sparkSession
    targets = list(dict.fromkeys(int(t) for t in targets))
    nodes = materialize(node_table(graph, block_size), "rank-nodes")
    n_edges = nodes.agg(F.coalesce(F.sum("out_deg"), F.lit(0))).first()[0]
    block_size = max(block_size, -(-n_edges // MAX_HEAVY))
    parts = partitions or bucket_count(n_edges, spark.sparkContext.defaultParallelism)
    places = PLACES_PER_BUCKET * parts
    # salted for its size, or because its neighbours hear from many nodes; salts a multiple of the places
    least = min(block_size, max(EDGES_PER_PLACE * places, -(-n_edges // MAX_HEAVY)))
    heavy = heavy_nodes(nodes, least)
    extra = 0
    if heavy is not None:
        spread = places * F.ceil(F.col("out_deg") / F.lit(block_size * places)).cast("int")
        heavy = materialize(heavy.withColumn("nsalt", spread), "rank-heavy")
        extra = heavy.agg(F.sum(F.col("nsalt") - 1)).first()[0]
    own = loop_session(spark, parts)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # buckets by place serve the whole join key
    tag = scratch_path(spark, "rank").rsplit("/", 1)[1].replace("-", "_")
    edges_table = f"spark_catalog.default.{tag}_edges"
    loop = _Loop(own, tag, edges_table, alpha, max_iter, tol, parts, broadcast_rows, keep_turns, heavy is not None, extra, places)
    out = WalksResult(scores=spark.createDataFrame([], _VEC_SCHEMA), nodes=nodes, iterations={}, converged={},
                      in_graph={t: False for t in targets}, changes={})
    try:
        blocks = adjacency_blocks(graph, nodes, block_size, heavy, parts)
        nsalt = "NULL" if heavy is None else f"if(out_deg > {least}, 1, NULL)"
        blocks = blocks.withColumn("place", F.expr(_place("src_kind", "src_id", "salt", nsalt, places)))
        _write_bucketed(blocks.repartition(parts, "place"), edges_table, parts, scratch_path(spark, "rank-edges"))
        if heavy is not None:
            own.read.schema(heavy.schema).parquet(*heavy.inputFiles()).createOrReplaceTempView(f"{tag}_heavy")
        for i in range(0, len(targets), TARGETS_PER_WALK):
            loop.run(targets[i:i + TARGETS_PER_WALK], nodes, out)
    finally:
        own.sql(f"DROP TABLE IF EXISTS {edges_table}")
        for view in (f"{tag}_vec", f"{tag}_heavy"):
            own.catalog.dropTempView(view)
    return out


@dataclass
class _Loop:
    """The turns of one group of targets."""

    session: SparkSession
    tag: str
    edges_table: str
    alpha: float
    max_iter: int
    tol: float
    parts: int
    broadcast_rows: int
    keep_turns: bool
    salted: bool
    extra_salts: int
    places: int

    def run(self, targets: list[int], nodes: DataFrame, out: WalksResult) -> None:
        own, spark = self.session, nodes.sparkSession
        known = {r["id"] for r in nodes.where((F.col("kind") == USER) & F.col("id").isin(targets)).select("id").collect()}
        rows = {t: int(t in known) for t in targets}  # of each walk's vector
        for t in targets:
            out.in_graph[t], out.changes[t], out.converged[t], out.iterations[t] = t in known, [], False, 0
        vec = own.createDataFrame([(t, USER, t, 1.0) for t in targets if t in known], _VEC_SCHEMA)
        base, closed_table = scratch_path(spark, "rank-vector"), f"{self.edges_table}_closed"
        active, edges, closed, path, kept = targets, self.edges_table, False, None, {}
        try:
            for turn in range(1, self.max_iter + 1):
                vec.createOrReplaceTempView(f"{self.tag}_vec")
                hint = "BROADCAST" if sum(rows[t] for t in active) + self.extra_salts * len(active) <= self.broadcast_rows else "SHUFFLE_HASH"
                new = own.sql(_turn_sql(self.tag, edges, [t for t in active if t in known], self.alpha, hint, self.salted, self.places))
                live, obs = F.col("score") != 0, Observation(f"rank-turn-{turn}")
                mine = {t: F.col("target") == F.lit(t) for t in active}
                new = new.observe(obs, *[F.max(F.when(w, F.abs(F.col("score") - F.col("old")))).alias(f"change_{i}")
                                         for i, w in enumerate(mine.values())],
                                  *[F.count_if(live & w).alias(f"rows_{i}") for i, w in enumerate(mine.values())])
                last, path = path, f"{base}/turn-{turn}"
                new.where(live).drop("old").write.parquet(path)
                seen = obs.get
                grown, done = False, []
                for i, t in enumerate(active):
                    change, n = seen.get(f"change_{i}") or 0.0, seen.get(f"rows_{i}") or 0
                    out.changes[t].append(change)
                    out.iterations[t] = turn
                    out.converged[t] = change < self.tol
                    grown, rows[t] = grown or n > rows[t], n
                    if change < self.tol or turn == self.max_iter:
                        done.append(t)
                if last and not self.keep_turns and last not in kept:
                    drop_folder(spark, last)
                if done:
                    kept[path] = done
                active = [t for t in active if t not in done]
                if not active:
                    break
                vec = own.read.schema(_VEC_SCHEMA).parquet(path).where(F.col("target").isin(active))
                if not grown and not closed and 0 < self.alpha < 1 and known:
                    closed = True
                    reached = vec.select(F.col("kind").alias("src_kind"), F.col("id").alias("src_id"))
                    if sum(rows[t] for t in active) <= self.broadcast_rows:
                        reached = F.broadcast(reached)
                    inside = own.table(self.edges_table).join(reached, ["src_kind", "src_id"], "left_semi")
                    _write_bucketed(inside.repartition(self.parts, "place"), closed_table, self.parts,
                                    scratch_path(spark, "rank-edges"))
                    edges = closed_table
        finally:
            own.sql(f"DROP TABLE IF EXISTS {closed_table}")
        for path, done in kept.items():  # each target's vector after its last turn
            out.scores = out.scores.unionByName(spark.read.schema(_VEC_SCHEMA).parquet(path).where(F.col("target").isin(done)))


def _write_bucketed(blocks: DataFrame, table: str, parts: int, path: str) -> None:
    """Blocks as an external table in the shared folder, bucketed on the join
    keys' place: a turn reads it already partitioned and moves only the vector."""
    blocks.write.bucketBy(parts, "place").option("path", path).saveAsTable(table)


def seen_items(edges: DataFrame, target: int) -> DataFrame:
    """Distinct items the target user interacted with (deep edges)."""
    return edges.where(F.col("user_id") == F.lit(target)).select("item_id").distinct()


def recommend_top_k(result: RankResult, edges: DataFrame, target: int, k: int = RANK_TOP_K) -> DataFrame:
    """``(target_id, rank, item_id, score)``: best ``k`` unseen items.

    Every item node takes part, unreached ones with score 0; order is score
    descending at full precision, then the item id as text.
    """
    items = result.nodes.where(F.col("kind") == ITEM).select(F.col("id").alias("item_id"))
    scores = result.scores.where(F.col("kind") == ITEM).select(F.col("id").alias("item_id"), "score")
    cand = (items.join(seen_items(edges, target), "item_id", "left_anti")
            .join(scores, "item_id", "left")
            .select("item_id", F.coalesce("score", F.lit(0.0)).alias("score")))
    top = cand.orderBy(F.col("score").desc(), F.col("item_id").cast("string")).limit(k)
    # number the (at most k) rows per target from one sorted list
    key = F.struct((-F.col("score")).alias("neg"), F.col("item_id").cast("string").alias("txt"),
                   F.col("item_id").alias("item_id"), F.col("score").alias("score"))
    ranked = (top.groupBy(F.lit(target).cast("long").alias("target_id"))
              .agg(F.array_sort(F.collect_list(key)).alias("top"))
              .select("target_id", F.posexplode("top").alias("pos", "e")))
    return ranked.select("target_id", (F.col("pos") + 1).cast("int").alias("rank"),
                         F.col("e.item_id").alias("item_id"), F.col("e.score").alias("score"))


def recommend_many(result: WalksResult, edges: DataFrame, k: int = RANK_TOP_K) -> DataFrame:
    """``(target_id, rank, item_id, score)``: :func:`recommend_top_k` of every target of ``result``.

    Reached items are ranked per target, map tasks keep ``k`` of each.  A
    target with fewer than ``k`` reached, unseen items is filled up by unreached
    ones (score 0, by id text): as many of the first items by text as it
    knows items, plus ``k``, are sure to hold them, so items and targets are
    never multiplied out.
    """
    targets = list(result.in_graph)
    order = [F.col("score").desc(), F.col("item_id").cast("string")]
    best = Window.partitionBy("target_id").orderBy(*order)
    reached = result.scores.where(F.col("kind") == ITEM).select(F.col("target").alias("target_id"), F.col("id").alias("item_id"), "score")
    seen = edges.where(F.col("user_id").isin(targets)).select(F.col("user_id").alias("target_id"), "item_id").distinct()
    key = ["target_id", "item_id"]
    top = materialize(reached.join(seen, key, "left_anti").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                      .select("target_id", "rank", "item_id", "score"), "rank-top")
    full = {r["target_id"] for r in top.groupBy("target_id").count().where(F.col("count") >= k).collect()}
    short = [t for t in targets if t not in full]
    if not short:
        return top
    known = materialize(reached.select(*key).union(seen).where(F.col("target_id").isin(short)).distinct(), "rank-known")
    most = known.groupBy("target_id").count().agg(F.max("count")).first()[0] or 0
    first = (result.nodes.where(F.col("kind") == ITEM).select(F.col("id").alias("item_id"))
             .orderBy(F.col("item_id").cast("string")).limit(k + most))
    spare = first.select(F.explode(F.array(*[F.lit(t).cast("long") for t in short])).alias("target_id"), "item_id",
                         F.lit(0.0).alias("score")).join(known, key, "left_anti")
    return (top.drop("rank").unionByName(spare).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("target_id", "rank", "item_id", "score"))


def recommend_stats(recs: DataFrame, low: float = 0.0005) -> DataFrame:
    """Per target: ``top_score``, ``low_score`` (top score prints as 0.000 at
    three decimals) and the number of recommended items."""
    return recs.groupBy("target_id").agg(
        F.coalesce(F.max("score"), F.lit(0.0)).alias("top_score"),
        (F.coalesce(F.max("score"), F.lit(0.0)) < F.lit(low)).alias("low_score"),
        F.count(F.lit(1)).alias("n_recommended"))


def recommendation_line(recs: DataFrame, decimals: int = RANK_DECIMALS) -> DataFrame:
    """``value``: ``target<TAB>item:score,item:score,...`` per target (k entries at most)."""
    entry = F.struct("rank", F.concat(F.col("item_id").cast("string"), F.lit(":"),
                                      F.format_string(f"%.{decimals}f", "score")).alias("txt"))
    return (recs.groupBy("target_id")
            .agg(F.array_sort(F.collect_list(entry)).alias("e"))
            .select(F.concat(F.col("target_id").cast("string"), F.lit("\t"),
                             F.array_join(F.transform("e", lambda x: x["txt"]), ",")).alias("value")))
