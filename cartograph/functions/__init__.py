"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from cartograph.functions.columns import (  # noqa: F401
    behavior_weight,
    day_difference,
    euclidean_distance,
    format_fixed,
    java_trim,
    min_max_scale,
    node_kind_id,
    node_name,
    parse_double, parse_int,
    parse_long,
    split_field,
)
