"""One pass over a stream, several outputs that always stand at the same batch.

Two streaming queries over one source read and parse it twice, and after a
failure their outputs can stand at different files.  Here one query reads the
source.  Each micro-batch is written once, as the first output; further outputs
(counts, for example) are made from what was written, so the source is read and
parsed once.  When all outputs of a batch are complete, its number goes into a
ledger, and only batches in the ledger are read:

* a batch that fails between two outputs is not seen; its replay overwrites what
  it left;
* a batch that failed after its entry was made is replayed by Spark, and skipped.

Counts are kept as sums per batch (``read_sums`` adds them up, ``compact_sums`` folds
them into a snapshot), so a batch writes as much as it has read, not the whole
table so far, and no state store is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowforge.session import create_file, names_in, path_exists, remove_path
from rowforge.streaming.runner import _finish, _with

#: Entries that stay in the ledger; the newest says all, as batches run in order.
KEPT_ENTRIES = 2


def committed(spark: SparkSession, path: str) -> int:
    """The newest batch all of whose outputs are complete; -1 if there is none."""
    return max((int(n) for n in names_in(spark, f"{path}/_ledger") if n.isdigit()), default=-1)


def _commit(spark: SparkSession, path: str, batch_id: int) -> None:
    create_file(spark, f"{path}/_ledger/{batch_id}")
    if batch_id >= KEPT_ENTRIES:
        remove_path(spark, f"{path}/_ledger/{batch_id - KEPT_ENTRIES}")


def run_to_ledger(df: DataFrame, path: str, checkpoint: str, first: str,
                  derived: dict[str, Callable[[DataFrame], DataFrame]],
                  each: Callable[[DataFrame, int], DataFrame] | None = None,
                  formats: dict[str, str] | None = None, timeout_s: int | None = None):
    """Run the stateless stream ``df`` to the end of what is there.

    Every batch (after ``each(batch, batch_id)``, if given) becomes the output
    ``first``; every output of ``derived`` is its function of the rows written
    there.  Outputs are folders ``path/<name>/batch_id=<n>``, Parquet unless
    ``formats`` says otherwise."""
    spark, formats = df.sparkSession, formats or {}
    if committed(spark, path) >= 0 and not path_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} holds the output of another checkpoint than {checkpoint}: this run would skip "
                         "batches that its ledger has as done; pass that checkpoint or another folder")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id <= committed(session, path):
            return

        def write(rows: DataFrame, name: str) -> DataFrame:
            fmt, place = formats.get(name, "parquet"), f"{path}/{name}/batch_id={batch_id}"
            rows.write.mode("overwrite").format(fmt).save(place)
            return session.read.schema(rows.schema).format(fmt).load(place)

        written = write(each(batch, batch_id) if each else batch, first)
        for name, make in derived.items():
            write(make(written), name)
        _commit(session, path, batch_id)

    q = (df.writeStream.outputMode("append").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return _finish(q, timeout_s)


def _schema(schema) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_rows(spark: SparkSession, path: str, name: str, schema, fmt: str = "parquet",
              upto: int | None = None) -> DataFrame:
    """An output's rows of the batches in the ledger, or up to batch ``upto``:
    give all outputs the same number of ``committed`` to see them at one batch
    while the stream runs on."""
    upto, schema = committed(spark, path) if upto is None else upto, _schema(schema)
    if upto < 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(_with(schema, "batch_id")).format(fmt).load(f"{path}/{name}")
    return rows.where(F.col("batch_id") <= upto).drop("batch_id")


def _snapshots(path: str, name: str) -> str:
    return f"{path}/{name}__snapshots"


def _newest_snapshot(spark: SparkSession, path: str, name: str, upto: int) -> int:
    done = [int(n) for n in names_in(spark, f"{_snapshots(path, name)}/_ledger") if n.isdigit()]
    return max((n for n in done if n <= upto), default=-1)


def read_sums(spark: SparkSession, path: str, name: str, schema, keys: list[str], fmt: str = "parquet",
              upto: int | None = None) -> DataFrame:
    """The sums per key over the batches in the ledger (or up to ``upto``): the
    newest snapshot before it and the batches after that."""
    upto, schema = committed(spark, path) if upto is None else upto, _schema(schema)
    if upto < 0:
        return spark.createDataFrame([], schema)
    base = _newest_snapshot(spark, path, name, upto)
    rows = spark.read.schema(_with(schema, "batch_id")).format(fmt).load(f"{path}/{name}")
    rows = rows.where((F.col("batch_id") > base) & (F.col("batch_id") <= upto)).select(*schema.names)
    if base >= 0:
        rows = rows.union(spark.read.schema(schema).parquet(f"{_snapshots(path, name)}/upto={base}"))
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in schema.names if c not in keys]).select(*schema.names)


def compact_sums(spark: SparkSession, path: str, name: str, schema, keys: list[str], fmt: str = "parquet") -> int:
    """Fold the sums up to the newest batch of the ledger into a snapshot beside
    the batches, which stay as they are.  Returns that batch."""
    upto = committed(spark, path)
    if upto > _newest_snapshot(spark, path, name, upto):
        rows = read_sums(spark, path, name, schema, keys, fmt, upto)
        rows.write.mode("overwrite").parquet(f"{_snapshots(path, name)}/upto={upto}")
        create_file(spark, f"{_snapshots(path, name)}/_ledger/{upto}")
    return upto
