"""Scalar column functions.

Each helper returns a :class:`pyspark.sql.Column` built from built-in
functions so that it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartograph.schema import BEHAVIOR_WEIGHTS, CONSTANT_SCALE_VALUE, SECONDS_PER_DAY

# Characters removed by a JVM String.trim(): every code point <= U+0020.
_EDGE_CONTROL = "".join(map(chr, range(0x21)))
# Spellings of special values that a lenient cast reads and a JVM parseDouble
# refuses: it takes only ``NaN`` and ``Infinity``, in this case, with a sign.
_SPECIAL_DOUBLES = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
_EXACT_BELOW = 1e9
_JVM_SPECIAL_DOUBLES = ("NaN", "Infinity", "+Infinity", "-Infinity")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip leading/trailing characters <= U+0020 (spaces, tabs, control chars)."""
    return F.btrim(_col(c), F.lit(_EDGE_CONTROL))


def split_field(parts: Column | str, index: int) -> Column:
    """0-based element of a split array, null when past the end (ANSI-safe)."""
    return F.get(_col(parts), index)


def parse_long(c: Column | str) -> Column:
    """Lenient BIGINT parse: null unless the trimmed text is a plain integer in range."""
    return java_trim(c).try_cast("bigint")


def parse_int(c: Column | str) -> Column:
    """Lenient INT parse: null unless the trimmed text is a plain integer in range."""
    return java_trim(c).try_cast("int")


def parse_double(c: Column | str) -> Column:
    """Lenient DOUBLE parse: null unless a JVM Double.parseDouble takes the trimmed text."""
    s = java_trim(c)
    refused = F.lower(s).isin(*_SPECIAL_DOUBLES) & ~s.isin(*_JVM_SPECIAL_DOUBLES)
    return F.when(~refused, s.try_cast("double"))


def behavior_weight(c: Column | str, weights: Mapping[str, float] | None = None) -> Column:
    """Weight of a behaviour type; unknown types weigh 0."""
    weights = BEHAVIOR_WEIGHTS if weights is None else weights
    expr = None
    for name, w in weights.items():
        expr = (F.when(_col(c) == name, F.lit(w)) if expr is None
                else expr.when(_col(c) == name, F.lit(w)))
    return F.lit(0) if expr is None else expr.otherwise(F.lit(0))


def day_difference(later: Column | str, earlier: Column | str) -> Column:
    """(later - earlier) epoch seconds expressed in days."""
    return (_col(later) - _col(earlier)) / F.lit(SECONDS_PER_DAY)


def min_max_scale(c: Column | str, lo: Column, hi: Column) -> Column:
    """(v - lo) / (hi - lo); a constant column (hi == lo) scales to 0.5."""
    v = _col(c).cast("double")
    return F.when(hi == lo, F.lit(CONSTANT_SCALE_VALUE)).otherwise(
        (v - lo) / (hi - lo))


def euclidean_distance(xs: Sequence[Column], ys: Sequence[Column]) -> Column:
    """sqrt(sum((x - y)^2)) over paired columns."""
    total = None
    for x, y in zip(xs, ys, strict=True):
        d = (x - y) * (x - y)
        total = d if total is None else total + d
    return F.sqrt(total)


def exact_sum(c: Column | str) -> Column:
    """Sum (aggregate) of a DOUBLE column that does not depend on the order of the rows.

    Every value enters as the decimal that its shortest text names (18 decimals), so partial sums
    are exact and one rounding to DOUBLE ends the sum.  Values that are NaN, infinite or of
    10^9 and more are summed as doubles beside it.
    """
    v = _col(c)
    plain = ~F.isnan(v) & (F.abs(v) < F.lit(_EXACT_BELOW))
    exact = F.coalesce(F.sum(F.when(plain, v).cast("decimal(28,18)")).cast("double"), F.lit(0.0))
    return F.when(F.count(v) > 0, exact + F.coalesce(F.sum(F.when(~plain, v)), F.lit(0.0)))


def format_fixed(c: Column | str, decimals: int) -> Column:
    """Fixed-point text with HALF_UP rounding, no grouping separators."""
    return F.format_string(f"%.{decimals}f", _col(c))


def node_name(kind: Column | str, node_id: Column | str) -> Column:
    """Text node key ``U_<id>`` (kind 0, user) or ``I_<id>`` (kind 1, item)."""
    prefix = F.when(_col(kind) == 0, F.lit("U_")).otherwise(F.lit("I_"))
    return F.concat(prefix, _col(node_id).cast("string"))


def node_kind_id(name: Column | str) -> tuple[Column, Column]:
    """Inverse of :func:`node_name`: (kind, id) from ``U_<id>`` / ``I_<id>``."""
    n = _col(name)
    kind = F.when(n.startswith("U_"), F.lit(0)).when(n.startswith("I_"), F.lit(1))
    return kind, parse_long(F.substring(n, 3, 1 << 30))
