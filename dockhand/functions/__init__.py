"""Scalar functions: Column in, Column out (all JVM-side, codegen friendly)."""

from dockhand.functions.timefmt import (  # noqa: F401
    business_date, compact_ts, hour_label, hour_path, iso_date, iso_instant,
    iso_wall_clock, run_date_resolution, wall_clock_parts, with_wall_clock,
)
from dockhand.functions.names import snake_case, snake_case_name  # noqa: F401
from dockhand.functions.maps import map_subset, select_subset  # noqa: F401
from dockhand.functions.jsonflat import json_flatten, flat_columns  # noqa: F401
