"""Column-level helpers (all built-in Spark expressions)."""

from lanecast.functions.compat import (  # noqa: F401
    as_date, concat_text, dq_ok, duck_round, file_stem, lane_label, like_or_all,
    optional_eq, percent, safe_day_series, table_name_from_file,
)
