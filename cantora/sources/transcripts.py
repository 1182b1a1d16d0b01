"""Caption files, part files of recognized speech, the map between them, and older text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.functions.text import basename, clock, job_name, parse_caption, part_index, seconds_of, stem, strip
from cantora.operators.order import keep_first
from cantora.operators.quality import PART_SECONDS, global_time
from cantora.sources.json_files import NEW_LINE, read_files, row_files, typed

ALIGN_MAP = "version int, items array<struct<source_youtube_path:string,whisper_prefix:string,whisper_folder_path:string>>"
SEGMENT = "start double, end double, text string"


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(source_file) of the files below ``path`` whose name fits ``pattern``; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select(F.col("path").alias("source_file"))


def lines_of(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(source_file, idx, line) of text files, which are small; idx counts from 0."""
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("source_file"), F.posexplode(F.split("value", NEW_LINE)).alias("idx", "line"))


def read_captions(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(source_file, job, idx, start, text) of cleaned caption files, ``HH:MM:SS text``; other lines are passed over."""
    form = r"(?U)^(\d{2}:\d{2}:\d{2})\s+(.*)$"
    line = strip(F.col("line"))
    rows = lines_of(spark, path, pattern).withColumn("line", line).where(F.col("line").rlike(form))
    return rows.select("source_file", job_name(F.col("source_file")).alias("job"), "idx", seconds_of(F.regexp_extract("line", form, 1)).alias("start"), F.regexp_extract("line", form, 2).alias("text"))


def clean_captions(lines: DataFrame, single: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of raw caption lines (source_file, idx, line) the cleaned ones -- (source_file, idx, time, text), each (time, text) of a file once, at its first place -- and the
    rejected ones (source_file, idx, line)."""
    parsed = lines.withColumn("c", parse_caption(F.col("line"), single))
    good = parsed.where("c is not null").select("source_file", "idx", "c.time", "c.text")
    return keep_first(good, ["source_file", "time", "text"], "idx"), parsed.where("c is null and line <> ''").select("source_file", "idx", strip(F.col("line")).alias("line"))


def write_captions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A text for each source_file, in a folder by its name: lines ``HH:MM:SS text`` in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.concat_ws(" ", "time", "text").alias("l")))), lambda x: x["l"]), "\n")
    df.groupBy(stem(F.col("source_file")).alias("name")).agg(joined.alias("value")).write.mode(mode).partitionBy("name").text(path)


def write_rejected_lines(df: DataFrame, path: str, mode: str = "overwrite", with_file: bool = True) -> None:
    """Lines ``file | line``, or lines alone."""
    value = F.concat_ws(" | ", "source_file", "line") if with_file else F.col("line")
    df.orderBy("source_file", "idx").select(value.alias("value")).write.mode(mode).text(path)


def read_parts(spark: SparkSession, path: str, schema: str = SEGMENT) -> DataFrame:
    """Recognized segments of part files ``{prefix}_{part}.json``: (source_file, prefix, part_index, time_offset, source_index, fields of ``schema``, global_start, global_end). The first and
    last row of each part are cut speech and go; parts of two or fewer rows give nothing. Names may begin with an underscore."""
    rows = row_files(read_files(spark, path, strict=True, hidden=True)).where("rows_in_file > 2 and source_index > 0 and source_index < rows_in_file - 1")
    part = part_index(F.col("source_file"))
    out = rows.select("source_file", F.regexp_extract(basename(F.col("source_file")), r"^(.*)_\d+\.json$", 1).alias("prefix"), part.alias("part_index"), (PART_SECONDS * (part - 1)).alias("time_offset"), "source_index", *typed(rows, schema))
    return out.withColumns({f"global_{c}": global_time(F.col(c), F.col("part_index")) for c in ("start", "end")})


def read_align_map(spark: SparkSession, path: str) -> DataFrame:
    """(job, source_youtube_path, whisper_prefix, whisper_folder_path) per item."""
    items = spark.read.schema(ALIGN_MAP).option("multiLine", "true").json(path).select(F.inline("items"))
    return items.select(job_name(F.col("source_youtube_path")).alias("job"), "source_youtube_path", "whisper_prefix", "whisper_folder_path")


def jobs_from_map(align_map: DataFrame, segments: DataFrame) -> DataFrame:
    """``segments`` with the job of their prefix."""
    return segments.join(align_map.select("job", F.col("whisper_prefix").alias("prefix")), "prefix")


def jobs_from_folders(captions: DataFrame, segments: DataFrame) -> DataFrame:
    """``segments`` with the job of the caption file whose name, after an underscore, is their prefix."""
    jobs = captions.select("job", F.concat(F.lit("_"), stem(F.col("source_file"))).alias("prefix")).distinct()
    return segments.join(jobs, "prefix")


def caption_jobs(align_map: DataFrame, listing: DataFrame) -> DataFrame:
    """(job, source_file, clean_name) of the caption files of a map that are there, with the name that the cleaned file gets."""
    wanted = align_map.select("job", stem(F.col("source_youtube_path")).alias("stem")).distinct()
    there = listing.withColumn("stem", stem(F.col("source_file")))
    return wanted.join(there, "stem").select("job", "source_file", F.concat("stem", F.lit("_clean.txt")).alias("clean_name"))


def aligned_line(line: Column) -> Column:
    """struct(start, end, score, text) of ``[start - end] (score=x) text``; null for other lines and for fields that are no numbers."""
    form = r"(?U)^\[(.*?)\s*-\s*(.*?)\]\s*\(score=(.*?)\)\s*(.*)$"
    at = lambda k: strip(F.regexp_extract(line, form, k))
    numbers = [at(k).try_cast("double") for k in (1, 2, 3)]
    known = numbers[0].isNotNull() & numbers[1].isNotNull() & numbers[2].isNotNull()
    return F.when(line.rlike(form) & known, F.struct(*(n.alias(x) for n, x in zip(numbers, ("start", "end", "score"), strict=True)), at(4).alias("text")))


def caption_text(seconds: Column, text: Column) -> Column:
    return F.concat_ws(" ", clock(seconds), text)
