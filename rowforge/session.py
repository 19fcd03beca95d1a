"""Session construction and the shared scratch folder.

Intermediate files (rendered fixtures, checkpoints, stream state, written
tables) always go below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (tests, a laptop) do we
create a local one and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "rowforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    On a cluster ``master`` stays None and the deployment supplies it; in
    tests it is ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE sizes shuffle partitions from real data: start high, coalesce
        # to ~256 MB each (a 1000-executor cluster sets shuffle.partitions
        # in the thousands; tests pass a small number).
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediates.

    Read from the session (``spark.checkpoint.dir`` or a directory set on the
    SparkContext); set a local one only where neither exists.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach; "
                           "a machine-local temporary folder is only used in local mode")
    local = tempfile.mkdtemp(prefix="rowforge-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "rowforge", *parts, uuid.uuid4().hex])


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as the cluster sees them, for listings of folders."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if there is no folder."""
    fs, p = hadoop_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file that is there wholly or not at all: a mark that something
    beside it is complete."""
    fs, p = hadoop_path(spark, path)
    _, hidden = hadoop_path(spark, f"{p.getParent().toString()}/.{p.getName()}.new")
    fs.create(hidden, True).close()
    if not fs.rename(hidden, p) and not fs.exists(p):
        raise OSError(f"cannot create {path}")


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Name, size and time of every file below the paths: changes when the
    data there does.  A listing only."""
    out = []
    for path in paths:
        fs, p = hadoop_path(spark, path)
        if not fs.exists(p):
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
