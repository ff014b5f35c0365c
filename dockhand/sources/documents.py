"""Document scans (S6, S7): JSON hits -> parsed records -> files.

A scan reads hits (``_id`` plus a ``_source`` object), parses each hit with a
Column expression that yields a struct or NULL, drops the NULLs, forces some
columns to text and writes Parquet files capped at a row count.  Corrupt
hits are either kept aside (tolerant) or fail the job (strict).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.functions.timefmt import hour_path_text
from dockhand.operators.conform import force_string

CORRUPT = "_corrupt_record"
# Default page size and pages per file of a scan.
PAGE_SIZE = 10_000
PAGES_PER_FILE = 30


def hit_schema(source: T.StructType, with_corrupt: bool = True) -> T.StructType:
    fields = [T.StructField("_id", T.StringType()), T.StructField("_source", source)]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def read_hits(spark: SparkSession | None, source_schema: T.StructType, *, path: str | None = None,
              text: DataFrame | None = None, text_col: str = "value", tolerant: bool = True) -> DataFrame:
    """Hits from JSON-lines files at ``path`` or from a text column.

    Tolerant: unreadable hits keep their text in ``_corrupt_record`` and NULL
    elsewhere; strict (FAILFAST): the first one fails the job.
    """
    schema = hit_schema(source_schema, tolerant)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if tolerant else {"mode": "FAILFAST"}
    if path is not None:
        r = spark.read.schema(schema)
        for k, v in opts.items():
            r = r.option(k, v)
        return r.json(path)
    if text is None:
        raise ValueError("give path or text")
    return text.select(F.from_json(F.col(text_col), schema, opts).alias("__h")).select("__h.*")


def scan_documents(hits: DataFrame, parse: Callable[[DataFrame], Column],
                   force_str_cols: Sequence[str] = ()) -> DataFrame:
    """Parse every readable hit, drop those parsed to NULL, force text columns."""
    readable = hits.where(F.col(CORRUPT).isNull()) if CORRUPT in hits.columns else hits
    rec = parse(readable)
    out = readable.select(rec.alias("__rec")).where(F.col("__rec").isNotNull()).select("__rec.*")
    return force_string(out, list(force_str_cols)) if force_str_cols else out


def scan_counts(hits: DataFrame, parse: Callable[[DataFrame], Column]) -> DataFrame:
    """Q4 for a scan: ``source_rows, parsed_rows, dropped_rows, corrupt_rows``
    in one aggregate pass over the hits."""
    has_corrupt = CORRUPT in hits.columns
    corrupt = F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False)
    parsed = F.when(~corrupt, parse(hits)).isNotNull()
    return hits.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(parsed).alias("parsed_rows"),
                    F.count_if(~parsed).alias("dropped_rows"), F.count_if(corrupt).alias("corrupt_rows"))


def scan_output_path(root: str, run_date: str) -> str:
    """``<root>/YYYY/MM/DD/HH-00-00`` from the wall clock of an ISO run date
    (offset kept as written, not converted), the layout of scan exports."""
    return "/".join([root.rstrip("/"), *hour_path_text(run_date)])


def write_scan(records: DataFrame, path: str, page_size: int = PAGE_SIZE,
               pages_per_file: int = PAGES_PER_FILE, compression: str = "gzip") -> str:
    """Parquet files of at most ``page_size * pages_per_file`` rows each."""
    (records.write.mode("overwrite").option("compression", compression)
     .option("maxRecordsPerFile", page_size * pages_per_file).parquet(path))
    return path
