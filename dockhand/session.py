"""Session and shared scratch locations.

Jobs never use a machine-local temporary folder on a cluster: scratch output
(staging tables, lineage cuts, exports made by the registered queries) goes
under the shared folder named by ``spark.checkpoint.dir``.  Only when that
setting is absent (unit tests, a laptop) do we pick a local folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}  # by application, where no folder is configured


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "dockhand", **conf: str) -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
               cores: int | None = None) -> dict[str, str]:
    """Settings that keep every task's share of a shuffle within memory.

    Initial shuffle partitions are sized from the input (AQE then coalesces
    small ones and splits skewed ones), scans read ``partition_bytes`` per
    task, and the advisory size matches, so a 100 TB input starts at about
    400,000 shuffle partitions of 256 MB each.
    """
    parts = max(1, -(-int(input_bytes) // int(partition_bytes)))
    if cores:
        parts = max(parts, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Read from the session; set our own only where the cluster names none.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(_CKPT_KEY, None) or spark.conf.get(_CKPT_KEY, None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that driver and executors share")
        # Unset (tests, a laptop): choose our own once; clusters always name one.
        root = _LOCAL_ROOTS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="dockhand-ckpt-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder under the shared root."""
    return f"{checkpoint_root(spark)}/dockhand/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under this application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Drop this application's scratch (staged inputs, lineage cuts, exports
    made by the registered queries).  Call it when the job's results are
    published: frames still reading scratch data fail afterwards."""
    return remove_path(spark, scratch_root(spark))


def cut_lineage(df: DataFrame, eager: bool = True, as_table: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` in the shared folder (survives executor loss).

    ``as_table``: write it as a Parquet table under the shared scratch root
    and read it back (columnar, fast); otherwise a reliable ``checkpoint()``.
    Never a local checkpoint.
    """
    spark = df.sparkSession
    if as_table:
        path = scratch_path(spark, "cut")
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    checkpoint_root(spark)
    return df.checkpoint(eager=eager)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop FileSystem of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its Hadoop FileSystem; raises when it does not happen."""
    jvm = spark.sparkContext._jvm
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_paths(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time) of what matches a glob pattern, in the path's Hadoop FileSystem."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return [(f.getPath().toString(), f.getModificationTime()) for f in found or []]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
