"""Secret scans by an incremental blob ledger (DataFrame and SQL functions only).

Every historical version of a path is content-addressed (SHA-256 of its text).  The ledger holds
one row per scanned (blob, rule, rule version) with the spans found; a scan takes only pairs that
the ledger does not hold, so a blob that many paths or versions share is scanned once, and a new
rule version re-scans blobs for that rule alone.  Findings are joined back to all paths.

Spans are found with three built-ins per rule: ``regexp_extract_all`` gives the matches, ``split``
on the same pattern the gaps between them, and a fold over both the code-point offsets.

Defined results: a null text is the empty text; texts without a match give no spans; equal rows
give equal rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import keeps_columns
from cartograph.session import materialize

SPANS = "array<struct<s:int,e:int>>"
MAX_BROADCAST_BLOBS = 100_000  # blobs with findings; more meet their paths by a shuffle


@dataclass(frozen=True)
class Rule:
    """``group``/``least``: a match counts if that group has at least so many characters."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# fixed values: the three base kinds, in listed order
BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
EXTRA = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[opsur]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + EXTRA


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans (s, e) of ``rule`` in ``text``: code points, end exclusive, leftmost non-overlapping."""
    pat = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pat, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pat, F.lit(rule.group)).alias("val"))
    start = F.struct(F.lit(0).alias("pos"), F.expr(f"cast(array() as {SPANS})").alias("out"))

    def step(acc, x):
        s = acc["pos"] + F.length(x["gap"])
        e = s + F.coalesce(F.length(x["hit"]), F.lit(0))
        keep = x["hit"].isNotNull() & (F.length(x["val"]) >= rule.least)
        one = F.array(F.struct(s.alias("s"), e.alias("e")))
        return F.struct(e.alias("pos"), F.when(keep, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.expr(f"cast(array() as {SPANS})"))


def address(versions: DataFrame, path: str, version: str | None, text: str) -> DataFrame:
    """(path, version, blob_id, text): null text is the empty blob."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return versions.select(F.col(f"`{path}`").alias("path"),
                           (F.col(f"`{version}`") if version else F.lit(0)).alias("version"),
                           F.sha2(body, 256).alias("blob_id"), body.alias("text"))


def unseen_pairs(addressed: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Distinct blobs with the rules the ledger has no row for: blob_id, text, todo (rule names)."""
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = addressed.groupBy("blob_id").agg(F.any_value("text").alias("text"))
    if ledger is None:
        return blobs.withColumn("todo", names)
    want = " or ".join(f"(rule = '{r.name}' and rule_version = {r.version})" for r in rules)
    seen = ledger.where(want).groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
    return (blobs.join(seen, "blob_id", "left")
            .select("blob_id", "text",
                    F.array_except(names, F.coalesce("seen", F.expr("cast(array() as array<string>)"))).alias("todo"))
            .where(F.size("todo") > 0))


def scan(versions: DataFrame, path: str = "path", text: str = "text", version: str | None = None,
         ledger: DataFrame | None = None, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of every path and version, and the new ledger rows (written to the shared folder).

    Returns ``(findings, news)``: findings has path, version, blob_id and one span array per rule;
    news has blob_id, rule, rule_version, spans for the pairs scanned now.  Append news to the
    ledger before the next scan.
    """
    addressed = address(versions, path, version, text)
    todo = unseen_pairs(addressed, ledger, rules)
    scanned = todo.select("blob_id", *[
        F.when(F.array_contains("todo", r.name), spans_of(F.col("text"), r)).alias(r.name) for r in rules])
    wide = materialize(scanned, "secret-ledger")
    news = wide.select("blob_id", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"),
                 F.col(r.name).alias("spans")) for r in rules])).alias("x")) \
        .select("blob_id", "x.*").where("spans is not null")
    if ledger is None:
        by_blob = wide
    else:
        want = " or ".join(f"(rule = '{r.name}' and rule_version = {r.version})" for r in rules)
        by_blob = (ledger.select(*news.columns).unionByName(news).where(want)
                   .groupBy("blob_id").agg(*[F.any_value(F.when(F.col("rule") == r.name, F.col("spans")),
                                                         F.lit(True)).alias(r.name) for r in rules]))
    hits = by_blob.where(" or ".join(f"size({r.name}) > 0" for r in rules))
    findings = (addressed.drop("text").join(hits, "blob_id", "left")
                .select("path", "version", "blob_id",
                        *[F.coalesce(r.name, F.expr(f"cast(array() as {SPANS})")).alias(r.name) for r in rules]))
    return findings, news


def digest(rules) -> Column:
    """``kind:start:end`` of the rules' span arrays by start, then kind as listed, comma-joined."""
    def tag(i, name):
        return lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("i"), x["e"].alias("e"), F.lit(name).alias("n"))

    tagged = F.concat(*[F.transform(r.name, tag(i, r.name)) for i, r in enumerate(rules)])
    return F.array_join(F.transform(F.array_sort(tagged), lambda x: F.concat_ws(":", x["n"], x["s"], x["e"])), ",")


@keeps_columns
def redact(docs: DataFrame, text: str = "text", rules=RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span found replaced by ``mask``; all rows and columns kept.

    Blobs are scanned once through the ledger; only rows whose blob has findings meet a span list.
    ``n_chars`` follows the new text where the table has it.  A null text stays null.
    """
    _, news = scan(docs.select(F.lit(0).alias("path"), F.col(f"`{text}`").alias("text")), rules=rules)
    hits = materialize(news.where("size(spans) > 0").groupBy("blob_id")
                       .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("__spans")), "secret-hits")
    if hits.count() <= MAX_BROADCAST_BLOBS:
        hits = F.broadcast(hits)
    body = F.col(f"`{text}`")
    # overlapping spans of different rules are cut as one
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc, x):
        gap = F.substring(body, acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0)))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"),
                        F.when(x["s"] >= acc["pos"], F.concat(acc["out"], gap, F.lit(mask)))
                        .otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("__spans", start, step,
                      lambda acc: F.concat(acc["out"], F.substring(body, acc["pos"] + 1, F.length(body))))
    keyed = docs.withColumn("__blob", F.sha2(F.coalesce(body, F.lit("")), 256)) \
        .join(hits.withColumnRenamed("blob_id", "__blob"), "__blob", "left")
    out = keyed.withColumn(text, F.when(F.col("__spans").isNotNull(), cut).otherwise(body))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNotNull(), F.length(F.col(f"`{text}`")).cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
