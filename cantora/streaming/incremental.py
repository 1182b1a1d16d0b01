"""Resumable processing of directories: what is done is remembered, a restart goes on with the rest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cantora.operators.joins import remaining


def work_folder(spark: SparkSession) -> str:
    """A folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def process_available(files: DataFrame, out: str, checkpoint: str) -> None:
    """Run a streaming frame over all files that the checkpoint hasn't seen, append to ``out`` as Parquet, and stop."""
    files.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()


def load_available(spark: SparkSession, path: str, schema: StructType, folder: str | None = None) -> DataFrame:
    """Take in what is new below ``path``; all that was ever taken in. With the same ``folder``, files are taken in once."""
    folder = folder or work_folder(spark)
    # a single file is read through its parent, as the stream lists directories
    parent, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(schema).format("parquet").option("pathGlobFilter", name).option("recursiveFileLookup", "false").load(parent) if _is_file(spark, path) else spark.readStream.schema(schema).parquet(path)
    process_available(stream, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/out")


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def first_seen(stream: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """An extension: the first event of each key within a watermark, for streams."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def pending(inputs: DataFrame, log: DataFrame) -> DataFrame:
    """Batch form: inputs (input, ...) that the done log lacks."""
    return remaining(inputs, log, ["input"])


def logged(inputs: DataFrame) -> DataFrame:
    """Done-log rows for what was processed."""
    return inputs.select("input", "output", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("done_at"))
