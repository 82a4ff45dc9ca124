"""Sources: behaviour-log text files and adapters over tabular inputs."""

from cartograph.sources.adapters import (  # noqa: F401
    damaged_log_lines,
    events_behavior_log,
    lineitem_behavior_log,
    log_lines,
)
from cartograph.sources.text import (  # noqa: F401
    line_stats,
    parse_behavior_lines,
    parse_user_features,
    parse_user_ids,
    read_behavior_log,
    read_lines,
    read_user_features,
    read_user_ids,
    rejected_lines,
)
