"""Reports on corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_file(df: DataFrame, file: str, duration: Column, score: Column, pace: Column) -> DataFrame:
    zero = F.lit(0.0)
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.avg(duration).alias("avg_duration"), F.avg(F.coalesce(score, zero)).alias("avg_score"), F.avg(F.coalesce(pace, zero)).alias("avg_pace"))


def mean_of_means(files: DataFrame) -> DataFrame:
    """Every file counts alike."""
    return files.agg(F.count(F.lit(1)).alias("files"), *(F.avg(c).alias(c) for c in ("avg_duration", "avg_score", "avg_pace")))


def nearest_rank(df: DataFrame, group: str, value: str, percents: tuple[int, ...] = (50, 90, 95)) -> DataFrame:
    """Per group the value at position min(int(n p / 100), n - 1) of the sorted values. Equal values are counted first and positions follow from running
    counts, so that a group's sort holds its different values only."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_k"))
    upto = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_k").over(upto)).withColumn("_n", F.sum("_k").over(Window.partitionBy(group)))
    place = lambda p: F.least(F.floor(F.col("_n") * p / 100), F.col("_n") - 1)
    return ranked.groupBy(group).agg(*(F.min(F.when(F.col("_upto") > place(p), F.col(value))).alias(f"p{p}") for p in percents))


def char_histogram(df: DataFrame, text: str) -> DataFrame:
    """Characters and their counts over all texts."""
    return df.select(F.explode(F.split(text, "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def ordered_join(order: str, text: str, by: str = " ") -> Column:
    """An aggregate: texts joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), by)


def global_stats(df: DataFrame, **values: Column) -> DataFrame:
    """Least, largest and mean of each value; nulls don't count."""
    return df.agg(*(f(c).alias(f"{name}_{word}") for name, c in values.items() for word, f in (("low", F.min), ("high", F.max), ("mean", F.avg))))


def most_common(df: DataFrame, text: str, order: str, n: int | None = None) -> DataFrame:
    """(ch, n) of ``char_histogram``, the most frequent first; of equals the one that comes first in ``order`` and in the text."""
    at = df.select(order, F.posexplode(F.split(text, "")).alias("at", "ch")).where("ch <> ''")
    counts = at.groupBy("ch").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "at")).alias("first")).orderBy(F.desc("n"), "first")
    return (counts.limit(n) if n else counts).select("ch", "n")


def counters(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def render(sections: dict[str, DataFrame], most: int = 50) -> str:
    """A report as text: a heading for each section, and up to ``most`` rows of it."""
    lines = []
    for title, df in sections.items():
        lines += [f"== {title} ==", " | ".join(df.columns)]
        lines += [" | ".join("" if x is None else str(x) for x in r) for r in df.limit(most).collect()]
    return "\n".join(lines) + "\n"
