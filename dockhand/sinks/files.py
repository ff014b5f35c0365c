"""File exports."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Snapshot formats accepted by the snapshot export.
SNAPSHOT_FORMATS = ("csv", "parquet")
TS_NTZ_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, sep: str = ",",
              compression: str | None = None) -> str:
    """CSV as other readers expect it: doubled quotes, microseconds kept, no
    codec unless asked for."""
    w = (df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).option("escape", '"')
         .option("timestampNTZFormat", TS_NTZ_TEXT).option("timestampFormat", TS_NTZ_TEXT + "XXX"))
    (w.option("compression", compression) if compression else w).csv(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite", delimiter: str = ",", null_text: str = "null",
               compression: str | None = None) -> str:
    """Delimited text lines without header or quoting; NULL is ``null_text``."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)) for c in df.columns]
    w = df.select(F.concat_ws(delimiter, *cells).alias("value")).write.mode(mode)
    (w.option("compression", compression) if compression else w).text(path)
    return path


def export_parquet(df: DataFrame, path: str, compression: str = "snappy",
                   max_records_per_file: int | None = None, partition_by: Sequence[str] = (),
                   mode: str = "overwrite") -> str:
    """Parquet with a codec and an optional rows-per-file cap.

    ``mode='overwrite'`` replaces the folder (W19).  Executors write in
    parallel; nothing passes through the driver.
    """
    w = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def snapshot_path(store_dir: str, run_date: str, name: str | None = None) -> str:
    base = store_dir.rstrip("/")
    return f"{base}/{name}/run_date={run_date}" if name else f"{base}/run_date={run_date}"


def export_snapshot(df: DataFrame, store_dir: str, run_date: str, file_format: str = "csv",
                    name: str | None = None, single_file: bool = False) -> str:
    """CSV (with header) or Parquet snapshot in a folder named by run date.

    ``single_file`` folds the output into one file (only for small reports:
    it funnels the rows through one task).
    """
    if file_format not in SNAPSHOT_FORMATS:
        raise ValueError(f"unsupported snapshot format {file_format!r}; use one of {SNAPSHOT_FORMATS}")
    path = snapshot_path(store_dir, run_date, name)
    out = df.coalesce(1) if single_file else df
    if file_format == "csv":
        write_csv(out, path)
    else:
        out.write.mode("overwrite").parquet(path)
    return path


def fan_out_write(frames: DataFrame | Sequence[DataFrame], store_dir: str, name: str,
                  file_format: str = "parquet", run_date: str | None = None) -> list[str]:
    """Write one frame, or each of a list as ``name_<i>``.

    Callers deriving the frames from one parent should persist or checkpoint
    the parent first, so it is computed once.
    """
    if isinstance(frames, DataFrame):
        frames = [frames]
        names = [name]
    else:
        names = [f"{name}_{i}" for i in range(len(frames))]
    out = []
    for f, n in zip(frames, names):
        if run_date is not None:
            out.append(export_snapshot(f, store_dir, run_date, file_format, name=n))
        else:
            p = f"{store_dir.rstrip('/')}/{n}"
            write_csv(f, p) if file_format == "csv" else f.write.mode("overwrite").parquet(p)
            out.append(p)
    return out


def truncate_path(spark: SparkSession, path: str, fmt: str = "parquet") -> str:
    """W17 for a folder table: no rows left, schema kept (an empty overwrite).

    The schema is read from the files' metadata; the empty frame is built
    from it, so nothing is read while the folder is rewritten.
    """
    schema = spark.read.format(fmt).load(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").format(fmt).save(path)
    return path


def truncate_table(spark: SparkSession, name: str) -> None:
    """W17 for a catalog table."""
    spark.sql(f"TRUNCATE TABLE {name}")
