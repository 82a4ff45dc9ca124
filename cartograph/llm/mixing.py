"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Documents are counted into cells (source, language, topic) by tokens; raking scales the cells'
weights to one marginal after the other until every marginal meets its target.  A document's
probability is min(1, scale * factor) of its cell (factor: raked weight over tokens), with the scale
that keeps ``SHARE`` of all tokens in expectation: a rare cell that is wanted more often than it
occurs is kept whole and does not thin out the others.  A hash of id and text decides whether a
document is in the sample.  Every document is counted; no cell or row is dropped from the counts.

Defined results: null source, language and text are values of their own (text: no tokens); a cell
without tokens is kept whole; targets that the sweeps do not reach are met as well as they can be, with a
warning that names the largest gap; marginals without a target keep their share; equal rows get equal
draws; an empty table gives no rows; extra columns pass through untouched.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartograph.llm.common import WORD_RE, keeps_columns
from cartograph.session import materialize

DIMS = ("source", "lang", "topic")
SHARE = 0.5  # of all tokens that the sample keeps, in expectation
SMOOTHING = 0.7  # target share ~ share ** SMOOTHING: below 1 it lifts small values
SWEEPS, BATCH, TOLERANCE = 200, 10, 1e-9


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """Form of the text as its topic: empty, table, note, block, article or book."""
    n = F.length(text)
    return (F.when(text.isNull() | (n == 0), "empty").when(F.instr(text, " | ") > 0, "table")
            .when(F.instr(text, "\n") == 0, F.when(n < 600, "note").otherwise("block"))
            .when(n < 2000, "article").otherwise("book"))


def cells(docs: DataFrame, topic_of=topic) -> DataFrame:
    """Token weight and document count of every (source, lang, topic)."""
    return (docs.select("source", "lang", topic_of(F.col("text")).alias("topic"), tokens(F.col("text")).alias("tokens"))
            .groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs")))


def smoothed_targets(table: DataFrame, dim: str, smoothing: float = SMOOTHING) -> DataFrame:
    """Target share of every value of ``dim``: its token share to the power ``smoothing``, normed."""
    one = table.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    raised = one.select(dim, F.when(F.col("t") > 0, F.pow("t", F.lit(smoothing))).otherwise(0.0).alias("t"))
    total = raised.agg(F.sum("t")).first()[0] or 1.0
    return raised.select(dim, (F.col("t") / F.lit(total)).alias("target"))


def rake(table: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight`` (tokens wanted) such that each dimension's marginal meets its target.

    ``targets``: dimension -> DataFrame (dimension, target share).  One row per cell; a batch of
    sweeps is a chain of window sums, written to the shared folder, and one number comes back.
    """
    work = table
    for d, t in targets.items():
        work = work.join(t.select(F.col(d).alias("__v"), F.col("target").alias(f"target_{d}")),
                         F.col(d).eqNullSafe(F.col("__v")), "left").drop("__v")
    total = table.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    work = materialize(work.withColumn("weight", F.col("tokens").cast("double")), "mix-cells")
    if not total:
        return work.drop(*[f"target_{d}" for d in targets])
    few = work.count() <= MAX_BROADCAST_CELLS  # then every window of a batch runs in one small task, unshuffled
    # a dimension's own share stays where it has no target
    done = 0
    while done < sweeps:
        work = work.coalesce(1) if few else work
        for _ in range(BATCH):
            for d in targets:
                has = F.sum("weight").over(Window.partitionBy(d))
                want = F.col(f"target_{d}") * total
                work = work.withColumn("weight", F.when((has > 0) & want.isNotNull(), F.col("weight") * want / has)
                                       .otherwise(F.col("weight")))
        work = materialize(work, "mix-cells")
        done += BATCH
        gaps = [F.max(F.abs(F.col(f"m_{d}") - F.col(f"target_{d}") * total)) for d in targets]
        marg = (work.coalesce(1) if few else work).select(*[F.sum("weight").over(Window.partitionBy(d)).alias(f"m_{d}") for d in targets],
                           *[f"target_{d}" for d in targets])
        off = max(x or 0.0 for x in marg.agg(*gaps).first())
        if off <= tolerance * total:
            break
    else:
        # targets that no weights on these cells can meet, or not in so many sweeps
        warnings.warn(f"a marginal is off its target by {off / total:.3g} of all tokens after {done} sweeps", stacklevel=2)
    return work.drop(*[f"target_{d}" for d in targets])


def scale_of(raked: DataFrame, share: float) -> float | None:
    """Scale c with sum(tokens * min(1, c * factor)) = share * tokens; None if only whole cells reach it.

    Each round keeps the cells whole that the last scale saturates and solves for the others; the
    scale only grows, so the rounds end when no further cell saturates.
    """
    full = F.col("tokens").cast("double")
    wanted = share * (raked.agg(F.sum(full)).first()[0] or 0.0)
    scale, whole = 0.0, -1
    while True:
        is_whole = (F.col("weight") > 0) & (F.lit(scale) * F.col("weight") >= full)
        r = raked.where("tokens > 0").agg(F.sum(F.when(is_whole, full)), F.sum(F.when(~is_whole, F.col("weight"))),
                                          F.count(F.when(is_whole, 1))).first()
        if r[2] == whole:
            return scale
        if not r[1]:
            return None
        scale, whole = max(scale, (wanted - (r[0] or 0.0)) / r[1]), r[2]


def probabilities(raked: DataFrame, share: float = SHARE) -> DataFrame:
    """Cells with ``prob``: min(1, scale * weight / tokens) such that ``share`` of the tokens is expected to
    stay; 1 for cells without tokens."""
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    scale = scale_of(raked, share)
    prob = F.when(factor > 0, F.lit(1.0)).otherwise(factor) if scale is None else F.least(F.lit(1.0), factor * F.lit(scale))
    return raked.withColumn("prob", F.when(F.col("tokens") > 0, prob).otherwise(1.0))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """Uniform in [0, 1) from id and text, the same in any run."""
    hexed = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(hexed, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: str = "mix", topic_of=topic,
        share: float = SHARE) -> DataFrame:
    """``docs`` plus ``__topic``, ``__tokens``, ``__prob`` and ``__sampled``; ``share`` as in ``probabilities``.

    The cell table has one row per (source, lang, topic) and is joined on those keys: broadcast
    while its counted rows stay below MAX_BROADCAST_CELLS, by a shuffle beyond.
    """
    table = materialize(cells(docs, topic_of), "mix-counts")
    if targets is None:
        targets = {d: materialize(smoothed_targets(table, d), "mix-targets") for d in DIMS}
    prob = materialize(probabilities(rake(table, targets), share), "mix-probs")
    right = prob.select(*[F.col(d).alias(f"__k_{d}") for d in DIMS], F.col("prob").alias("__prob"))
    if prob.count() <= MAX_BROADCAST_CELLS:
        right = F.broadcast(right)
    base = docs.withColumns({"__topic": topic_of(F.col("text")), "__tokens": tokens(F.col("text"))})
    on = None
    for d in DIMS:
        same = base["__topic" if d == "topic" else d].eqNullSafe(right[f"__k_{d}"])
        on = same if on is None else on & same
    joined = base.join(right, on, "left").drop(*[f"__k_{d}" for d in DIMS])
    return joined.withColumn("__sampled", draw(F.col("doc_id"), F.col("text"), seed) < F.col("__prob"))


MAX_BROADCAST_CELLS = 100_000


@keeps_columns
def sample(docs: DataFrame, **kw) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    return mix(docs, **kw).where("__sampled").select(*[F.col(f"`{c}`") for c in docs.columns])
