"""Operators on positions: numbering, slices, trimming, keeping the first, order and union of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.functions.text import part_index


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each combination of ``keys``. Map-side partial maxima, no window over large groups."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*").select(df.columns)


def trim_ends(df: DataFrame, key: str, pos: str) -> DataFrame:
    """Rows but one first and one last of each ``key`` (of repeated positions one goes); none of keys with two or fewer. A key is a file of bounded length."""
    up = Window.partitionBy(key).orderBy(pos)
    numbered = df.withColumn("_at", F.row_number().over(up)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return numbered.where((F.col("_at") > 1) & (F.col("_at") < F.col("_n"))).drop("_at", "_n")


def chunked(df: DataFrame, order: str, out: str, chunk: int = 65_536, most: int = 1024) -> DataFrame:
    """``df`` with the number of the range of ``order`` (a number, a date or a time) that a row lies in. Ranges hold about ``chunk`` rows each, or there are ``most`` of them;
    their bounds are quantiles, so sparse and skewed values are no matter. Nulls are in the first."""
    count = min(most, df.count() // chunk + 1)
    if count == 1:
        return df.withColumn(out, F.lit(0))
    marks = df.agg(F.percentile_approx(order, [k / count for k in range(1, count)], 4 * most)).first()[0]
    return df.withColumn(out, F.coalesce(F.size(F.filter(F.array(*map(F.lit, sorted(set(marks)))), lambda m: m < F.col(order))), F.lit(0)))


def number_rows(df: DataFrame, order: str, out: str, chunk: int = 65_536) -> DataFrame:
    """Dense numbers from 0 by a unique column (nulls first), without sorting all rows in one task, whatever the values are: positions within ranges of
    the column, plus the counts of the ranges before. The only window over all has one row for each range."""
    df = chunked(df, order, "_c", chunk)
    counts = df.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return df.join(F.broadcast(starts), "_c").withColumn(out, F.row_number().over(Window.partitionBy("_c").orderBy(order)) - 1 + F.col("_start")).drop("_c", "_start")


def slice_rows(df: DataFrame, order: str, first: int, stop: int, out: str = "position") -> DataFrame:
    """Rows ``first`` to ``stop`` (exclusive) by ``order``, with their position among all."""
    return number_rows(df, order, out).where((F.col(out) >= first) & (F.col(out) < stop))


def clip_name(number: Column) -> Column:
    return F.format_string("%06d.wav", number)


def chunks_of(df: DataFrame, duration: str, length: int, index: str, start: str) -> DataFrame:
    """A row for each chunk of ``length`` seconds that a duration takes."""
    n = F.ceil(F.col(duration) / length).cast("int")
    return df.where(n > 0).withColumn(index, F.explode(F.sequence(F.lit(0), n - 1))).withColumn(start, F.col(index) * length)


def sort_files(df: DataFrame, path: str) -> DataFrame:
    """Files by the code points of their paths."""
    return df.orderBy(path)


def sort_parts(df: DataFrame, path: str) -> DataFrame:
    """Files by the number of their part, then by path."""
    return df.orderBy(part_index(F.col(path)), path)


def number_files(df: DataFrame, path: str, out: str, prefix: int = 8) -> DataFrame:
    """Numbers from 0 of all files in the order of ``sort_parts``; those of a repeated path are in any order. Positions are counted among the files of a part whose paths
    begin alike, after the counts of those before; the only window over all has a row for each such group. Paths aren't null."""
    df = df.withColumns({"_part": part_index(F.col(path)), "_begin": F.substring(path, 1, prefix)})
    counts = df.groupBy("_part", "_begin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part", "_begin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", "_begin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part", "_begin").orderBy(path)
    return df.join(starts, ["_part", "_begin"]).withColumn(out, F.row_number().over(inside) - 1 + F.col("_start")).drop("_part", "_begin", "_start")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of several tables; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
