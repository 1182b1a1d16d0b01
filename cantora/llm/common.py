"""What the training-data operators share: table reading, shared-folder tables, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; where it is unset, as in
    tests, the checkpoint folder of the context, or one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = own.get() if own.isDefined() else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. This cuts the lineage, survives the
    loss of any executor and, unlike ``checkpoint()``, doesn't run the plan a second time."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table behind a ``materialize()`` result that no later plan reads."""
    spark, path = df.sparkSession, getattr(df, "_shared_path", None)
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Rows of a few numbers that are broadcast at most: some tens of megabytes.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table of a few numeric columns, with a hint to broadcast it if it has at most ``most`` rows; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def crc_mod(column: str, n: int):
    """crc32 of the id's decimal text, modulo n: the fixed folds of the classifiers."""
    return F.crc32(F.col(column).cast("string")) % n


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task set-up: ``make()`` gives the batch function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for part in slices(b):
                out = f(part)
                if out is not None:
                    yield out
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers go on to other tasks, and idle ones would keep it."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batch: pa.RecordBatch, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Split a batch by rows so that a piece holds about ``most_bytes`` (or a single row)."""
    n = batch.num_rows
    step = max(1, int(n * most_bytes / max(1, batch.nbytes)))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return batch.column(name).cast(pa.binary()).to_pylist()
