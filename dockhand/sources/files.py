"""File sets: filtered recursive reads and inventories."""

from __future__ import annotations

from typing import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, root: str, fmt: str = "parquet", *, glob: str | None = None,
               name_predicate: Callable[[Column], Column] | None = None,
               file_filter: Callable[[str], bool] | None = None, recursive: bool = True,
               schema=None, **options: str) -> DataFrame:
    """Read every file under ``root`` whose base name passes the filters.

    ``glob`` is Spark's ``pathGlobFilter``; ``name_predicate`` is a Column
    predicate on ``_metadata.file_name`` that Spark applies to the file list
    before reading (files are pruned, not rows): prefer it.  ``file_filter`` is a plain
    Python predicate on base names; Spark cannot run it while planning, so it
    picks among the files of the relation's own listing, which the driver
    holds for planning anyway.
    """
    r = spark.read.format(fmt).option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    if file_filter is not None:
        paths = [p for p in r.load(root).inputFiles() if file_filter(unquote(p.rsplit("/", 1)[1]))]
        if not paths:
            raise FileNotFoundError(f"no file under {root} passes the filter")
        df = r.load(paths)
    else:
        df = r.load(root)
    if name_predicate is not None:
        df = df.where(name_predicate(F.col("_metadata.file_name")))
    return df


def file_inventory(spark: SparkSession, root: str, *, glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """``path, file_name, modified, length`` for every file under ``root``.

    The ``content`` column is never selected, so no file body is read.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     F.col("modificationTime").alias("modified"), "length")


def file_row_counts(spark: SparkSession, root: str, fmt: str = "parquet", *, glob: str | None = None,
                    recursive: bool = True) -> DataFrame:
    """``file_name, rows`` of every file that holds rows, read from the files themselves."""
    r = spark.read.format(fmt).option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))


def inventory_with_rows(spark: SparkSession, root: str, fmt: str = "parquet", *, glob: str | None = None,
                        recursive: bool = True) -> DataFrame:
    """``path, file_name, modified, length, rows`` of every file; files without rows have 0.

    Both reads name a file by its full path, so equal names in several folders stay apart.
    """
    def reader(kind: str):
        r = spark.read.format(kind).option("recursiveFileLookup", str(recursive).lower())
        return (r.option("pathGlobFilter", glob) if glob else r).load(root)

    files = reader("binaryFile").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("modificationTime").alias("modified"), "length")
    rows = reader(fmt).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return files.join(rows, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
