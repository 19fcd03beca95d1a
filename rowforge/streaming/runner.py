"""Run-to-completion helpers for streaming queries.

Every query has its own checkpoint below the shared checkpoint folder and is
started with ``availableNow``: it processes what is there (in as many
micro-batches as the source limits ask for) and stops, so reruns on the same
checkpoint only see new files and file sinks stay exactly-once.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rowforge.session import path_exists, remove_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """Session default: keep large state (an unbounded vocabulary) off the
    JVM heap.  Must be set before a query first starts on its checkpoint;
    the runners' ``rocksdb=True`` does the same for one query only."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _finish(q, timeout_s: int | None):
    """Wait to the end of what is there, or at most ``timeout_s`` seconds."""
    done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
    if q.exception():
        raise q.exception()
    if not done:
        q.stop()
        raise TimeoutError(f"streaming query {q.id} did not finish in {timeout_s}s")
    return q


def run_append_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                        timeout_s: int | None = None):
    """Append rows to a file sink (exactly-once through its commit log)."""
    q = (df.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return _finish(q, timeout_s)


@contextmanager
def stream_start_conf(spark, n_state: int | None = None, rocksdb: bool = False):
    """Settings for a stateful stream, applied only while it starts: the
    state partition count and the state store.  A stream runs on a clone of
    the session taken at start (and records both in its checkpoint on the
    first run), so the caller's session settings are restored right after."""
    conf = {}
    if n_state:
        conf["spark.sql.shuffle.partitions"] = str(n_state)
    if rocksdb:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _completed(path: str) -> str:
    return path.rstrip("/") + "__completed"


def run_complete_to_versions(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                             timeout_s: int | None = None, n_state: int | None = None,
                             rocksdb: bool = False, keep: int = 2):
    """Complete-mode result (an aggregate without watermark): every
    micro-batch writes the whole current table as a version of its own,
    ``path/batch_id=<n>``, and then its number to a list of completed
    versions beside it.  Readers take the newest completed one, so a running,
    failed or replayed batch never shows; the newest ``keep`` versions stay."""
    spark = df.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
        batch.sparkSession.range(batch_id, batch_id + 1).coalesce(1).write.mode("overwrite").parquet(
            f"{_completed(path)}/{batch_id}")
        for name in [] if batch_id < keep else [f"{_completed(path)}/{batch_id - keep}",
                                                f"{path}/batch_id={batch_id - keep}"]:
            remove_path(spark, name)

    with stream_start_conf(spark, n_state, rocksdb):
        q = (df.writeStream.outputMode("complete").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return _finish(q, timeout_s)


def read_newest_version(spark, path: str, schema, fmt: str = "parquet", ran=None) -> DataFrame:
    """The newest completed version (``ran``: see ``read_result``)."""
    done = read_result(spark, _completed(path) + "/*", "id long", ran=ran)
    newest = done.agg(F.max("id").alias("m")).first()["m"]
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(f"{path}/batch_id={newest}")


def read_result(spark, path: str, schema, fmt: str = "parquet", ran=None) -> DataFrame:
    """A sink's output as a batch frame with a fixed schema.  A missing output
    is an error, unless the query that ``ran`` reports that it had no input
    rows: then the result is empty."""
    try:
        df = spark.read.schema(schema).format(fmt).load(path)
        df.limit(0).collect()  # resolve the path now
        return df
    except AnalysisException as e:
        missing = "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)
        if not missing or ran is None or any(p["numInputRows"] for p in ran.recentProgress):
            raise
        return spark.createDataFrame([], schema)


def run_to_table(df: DataFrame, table: str, checkpoint: str, timeout_s: int | None = None):
    """Append a stream into a catalog table readable by name afterwards."""
    q = (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).toTable(table))
    return _finish(q, timeout_s)


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None):
    """Driver-memory sink, for tests and small previews only."""
    w = df.writeStream.format("memory").outputMode(mode).queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    q = w.start()
    q.processAllAvailable()
    q.stop()
    return q


def run_update_to_versions(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                           timeout_s: int | None = None, n_state: int | None = None,
                           rocksdb: bool = False):
    """Update-mode aggregate: each micro-batch writes only the keys it
    changed, into ``path/batch_id=<n>`` (overwritten if the batch is
    replayed, so it stays exactly-once).  Unlike complete mode, the write per
    batch is proportional to the batch, not to the whole state."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    with stream_start_conf(df.sparkSession, n_state, rocksdb):
        q = (df.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return _finish(q, timeout_s)


def _snapshots(path: str) -> str:
    return path.rstrip("/") + "__snapshots"


def _with(schema, name: str) -> StructType:
    return StructType(list(schema.fields) + [StructField(name, LongType())])


def _latest_snapshot(spark, path: str, schema, fmt: str):
    """(upto, rows) of the newest compacted snapshot, or (None, None)."""
    if not path_exists(spark, _snapshots(path)):
        return None, None
    snaps = read_result(spark, _snapshots(path), _with(schema, "upto"), fmt)
    m = snaps.agg(F.max("upto").alias("m")).first()["m"]
    if m is None:
        return None, None
    return m, snaps.where(F.col("upto") == m).drop("upto")


def _versions(spark, path: str, schema, fmt: str, upto: int | None = None) -> DataFrame:
    """All versions still needed: the newest snapshot (as its batch id) plus
    the batches after it, optionally only those up to ``upto``."""
    df = read_result(spark, path, _with(schema, "batch_id"), fmt)
    base, snap = _latest_snapshot(spark, path, schema, fmt)
    if base is not None:
        df = df.where(F.col("batch_id") > base).unionByName(
            snap.withColumn("batch_id", F.lit(base).cast("long")))
    if upto is not None:
        df = df.where(F.col("batch_id") <= upto)
    return df


def _newest_per_key(df: DataFrame, schema, keys: list[str]) -> DataFrame:
    values = [c for c in schema.fieldNames() if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def read_latest_versions(spark, path: str, schema, keys: list[str],
                         fmt: str = "parquet") -> DataFrame:
    """Current value per key from ``run_update_to_versions`` output: the row
    of the highest batch id (one shuffle on the keys, partial max_by).  After
    ``compact_versions`` only the newest snapshot and the batches after it
    are read (partition pruning skips the older folders)."""
    return _newest_per_key(_versions(spark, path, schema, fmt), schema, keys)


def compact_versions(spark, path: str, schema, keys: list[str], fmt: str = "parquet") -> int | None:
    """Fold every version up to the newest batch ``m`` into one snapshot,
    written beside the versions (``<path>__snapshots/upto=<m>``).  Versions
    are never rewritten or deleted: a stream still running, or replaying an
    old batch, only writes deltas that readers either still read (> m) or
    that the snapshot already covers (<= m).  Returns ``m``, or None when
    there is nothing to compact."""
    m = (read_result(spark, path, _with(schema, "batch_id"), fmt)
         .agg(F.max("batch_id").alias("m")).first()["m"])
    base, _ = _latest_snapshot(spark, path, schema, fmt)
    if m is None or (base is not None and base >= m):
        return base
    snap = _newest_per_key(_versions(spark, path, schema, fmt, upto=m), schema, keys)
    snap.write.mode("overwrite").format(fmt).save(f"{_snapshots(path)}/upto={m}")
    return m
