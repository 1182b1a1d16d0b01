"""JSON files of segment rows: arrays, single objects, envelopes, and line-delimited rows.

An array file holds the segments of one part of a recording (some 20 minutes), so a file is a row at first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEW_LINE = r"\r\n|\r|\n"


def _kind(v: Column) -> Column:
    """``list``, ``dict``, ``str``, or null for other roots and malformed texts."""
    shape = F.schema_of_variant(v)
    return F.when(shape.startswith("ARRAY"), "list").when(shape.startswith("OBJECT"), "dict").when(shape == "STRING", "str")


def type_name(v: Column) -> Column:
    """What a row is, by the names that Python has for it."""
    shape = F.schema_of_variant(v)
    return F.coalesce(_kind(v), F.when(shape == "BOOLEAN", "bool").when(shape == "BIGINT", "int").when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float").when(shape == "VOID", "NoneType"))


def rows_of(v: Column, strict: bool = False, envelope: str | None = None) -> Column:
    """The rows of a parsed file as an array of variants: the list itself; of an object the list under ``envelope``, if it has one, else the
    object alone. Strict: lists only. Null for all else."""
    listed = F.when(_kind(v) == "list", F.try_variant_get(v, "$", "array<variant>"))
    if strict:
        return listed
    single = F.when(_kind(v) == "dict", F.array(v))
    if envelope:
        inner = F.try_variant_get(v, f"$.{envelope}", "variant")
        single = F.when(_kind(inner) == "list", F.try_variant_get(inner, "$", "array<variant>")).otherwise(single)
    return F.coalesce(listed, single)


def hidden_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(source_file, value) of the files of a folder whose names begin with an underscore, which Spark's own readers pass over. The driver lists the folder; executors open files
    by path, through Arrow's file systems."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"_{pattern}")) if fs.exists(folder) else []
    paths = [(x.getPath().toString(),) for x in found if x.isFile()]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as arrow

        for f in frames:
            values = []
            for uri in f["source_file"]:
                store, name = arrow.FileSystem.from_uri(uri)
                with store.open_input_file(name) as file:
                    values.append(file.read().decode("utf-8", "replace"))
            yield f.assign(value=values)

    listed = spark.createDataFrame(paths, "source_file string").repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism)))
    return listed.mapInPandas(read, "source_file string, value string")


def read_files(spark: SparkSession, path: str, strict: bool = False, envelope: str | None = None, hidden: bool = False) -> DataFrame:
    """(source_file, rows, file_error) per JSON file below ``path``: rows as an array of variants; file_error is READ_ERROR for malformed texts, BAD_FORMAT for roots that
    are no rows, EMPTY_FILE for no rows, else null. ``hidden``: those of the folder whose names begin with an underscore, too."""
    whole = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    if hidden:
        whole = whole.unionAll(hidden_files(spark, path, "*.json"))
    files = whole.select("source_file", F.try_parse_json("value").alias("v"))
    broken = F.col("v").isNull()
    if not strict:  # a text that holds JSON in turn
        files = files.withColumn("v", F.when(_kind(F.col("v")) == "str", F.try_parse_json(F.try_variant_get("v", "$", "string"))).otherwise(F.col("v")))
    files = files.withColumn("rows", rows_of(F.col("v"), strict, envelope))
    error = F.when(broken, "READ_ERROR").when(F.col("rows").isNull(), "BAD_FORMAT").when(F.size("rows") == 0, "EMPTY_FILE")
    return files.select("source_file", "rows", error.alias("file_error"))


def row_files(files: DataFrame) -> DataFrame:
    """(source_file, source_index, row, rows_in_file) of the rows of ``read_files``, of whatever kind."""
    return files.where("file_error is null").select("source_file", F.size("rows").alias("rows_in_file"), F.posexplode("rows").alias("source_index", "row"))


def typed(rows: DataFrame, schema: str) -> list[Column]:
    """The fields of ``schema`` from the variant column ``row``; missing ones and those of another type are null."""
    fields = rows.sparkSession.createDataFrame([], schema).schema.fields
    return [F.try_variant_get("row", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]


def read_array_files(spark: SparkSession, path: str, schema: str, strict: bool = False, envelope: str | None = None) -> DataFrame:
    """(source_file, source_index, then the fields of ``schema``) per row of the JSON files below ``path``. Malformed files and rows that aren't
    objects give nothing here (``read_files`` has them with their reasons), but keep their index."""
    rows = row_files(read_files(spark, path, strict, envelope)).where(_kind(F.col("row")) == "dict")
    return rows.select("source_file", "source_index", *typed(rows, schema))


def read_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Line-delimited rows; blank lines are passed over. A malformed line is dropped, or fails the job if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_numbered_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(source_file, line_no, fields, line_error) of line-delimited rows: numbers count from 1, and blank lines too, though they give no row. line_error is the line
    itself where it is no JSON object, else null."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.posexplode(F.split("value", NEW_LINE)).alias("at", "line"))
    rows = files.where(F.col("line").rlike(r"\S")).select("source_file", (F.col("at") + 1).alias("line_no"), "line", F.try_parse_json("line").alias("row"))
    bad = F.coalesce(_kind(F.col("row")) != "dict", F.lit(True))
    return rows.select("source_file", "line_no", *typed(rows, schema), F.when(bad, F.col("line")).alias("line_error"))


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Line-delimited rows, nulls included, one file for each partition. Mode ``overwrite`` is a full refresh, ``append`` adds to what is there."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_arrays(df: DataFrame, path: str, job: str, order: str, mode: str = "overwrite") -> None:
    """One JSON array for each ``job``, below ``path`` in a folder of its name; its rows by ``order``. A job is a recording, so its rows fit in one row."""
    columns = [c for c in df.columns if c != job]
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*columns).alias("_r")))), lambda x: x["_r"])
    df.groupBy(job).agg(F.to_json(rows, {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).write.mode(mode).partitionBy(job).text(path)


def write_each(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    """A file for each row, in a folder by its ``name``."""
    columns = [c for c in df.columns if c != name]
    df.select(name, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).partitionBy(name).text(path)


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Kept rows without the reason, and rejected rows with it."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())
