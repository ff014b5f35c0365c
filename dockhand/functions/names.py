"""snake_case for values and for column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The snake_case rule.  An underscore goes between a lower-case
# letter or digit and the upper-case letter after it; runs of underscores
# collapse to one; the result is lower-cased.
CAMEL_BOUNDARY = "([a-z0-9])([A-Z])"
UNDERSCORE_RUN = "_+"


def snake_case(c: Column | str) -> Column:
    """F9 on a string column (JVM regex, one pass per row)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.regexp_replace(F.regexp_replace(c, CAMEL_BOUNDARY, r"$1_$2"), UNDERSCORE_RUN, "_"))


def snake_case_name(name: str) -> str:
    """F9 on a name held by the driver (schema field names)."""
    return re.sub(UNDERSCORE_RUN, "_", re.sub(CAMEL_BOUNDARY, r"\1_\2", name)).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column with F9 (a pure projection)."""
    return df.select(*[F.col(f"`{n}`").alias(snake_case_name(n)) for n in df.columns])
