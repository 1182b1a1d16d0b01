"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Sources get weights by code point order (null last); targets share all words by
weight and stop at three times a source's size, the excess being shared again (water filling). A
source whose target is f times its size gives each document floor(f) certain whole copies. The rest,
R words, is one further copy of some documents: document i has the inclusion probability
p_i = min(1, R sqrt(s_i) / sum floor(s_j sqrt(s_j))), so that the expected words are R; documents are ranked by (u/(1-u)) / (p/(1-p)) with a
random u from a hash of the id and text. The sample is the longest beginning of this order that holds no more than R words. What is then
missing is made up, as far as it can be, by the one further rank near the cut whose words come closest to it.

No source is ranked in one task: ranks are mapped into about n/INTERVAL intervals, whose sums show where R falls, and only that interval's different ranks are put in order. So
a source's plan is a row of a few numbers -- whole copies, the last rank and the further one -- and each document finds its copies from its own columns and this
row: texts are read twice, and never shuffled. All sums are of whole numbers, so reruns agree however the table is partitioned.

Copies never exceed 3. Null texts count as empty, and documents without words are taken with their source's whole copies only. A null source is one
of its own. Rows that repeat an id and text have equal ranks and go together. An empty table gives no rows. Columns besides doc_id, text and source are kept by ``mixed``
and not read, whatever they are called. The one row for each source meets in one task, twice: sources are taken to be few next to documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantora.llm.common import broadcast_if_small, materialize, table

WEIGHTS, MOST_COPIES = (1, 2, 3), 3
#: Documents in an interval of ranks, about.
INTERVAL = 1000
SEED = 10


def size_of(text: Column) -> Column:
    """Runs of other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def lot_of(doc_id: Column, text: Column) -> Column:
    """u between 0 and 1, the same in each run: 52 bits of an MD5."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, size) with weight and target. The one row for each source is all that meets in one task."""
    ranked = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS) + 1))
    limit = MOST_COPIES * F.col("size")
    before = Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # with the sources before at their limits, so much is left for a unit of weight; it rises up to the first that isn't at its limit
    levels = ranked.withColumn("ratio", limit / F.col("weight")).withColumn("level", level)
    return levels.select(*sources.columns, "weight", F.least(limit.cast("double"), F.col("weight") * F.max("level").over(every)).alias("target"))


def plan(sized: DataFrame) -> DataFrame:
    """What each source of ``sized`` (source, size) takes: source_size, target, whole, rest, spread, n."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.floor(F.col("size") * F.sqrt("size"))).alias("spread"), F.count(F.lit(1)).alias("n"))
    out = targets(sums.withColumnRenamed("source_size", "size")).withColumnRenamed("size", "source_size")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(share + 1e-9), F.lit(MOST_COPIES))
    return out.withColumn("whole", whole.cast("int")).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))


def with_plan(sized: DataFrame, takes: DataFrame) -> DataFrame:
    """Rows of ``sized`` (source, size, lot, ...) with their source's plan."""
    return sized.join(broadcast_if_small(takes.withColumnRenamed("source", "_its")), F.col("source").eqNullSafe(F.col("_its"))).drop("_its")


def ranked(planned: DataFrame) -> DataFrame:
    """Rows with their place (0 to 1, by rank) and interval."""
    p = F.when(F.col("spread") > 0, F.col("rest") * F.sqrt("size") / F.col("spread")).otherwise(0.0)
    p = F.least(F.lit(1.0), p)
    # odds u/(1-u) over p/(1-p), as a place between 0 and 1: x / (1 + x)
    place = F.when(p <= 0, 1.0).when(p >= 1, 0.0).otherwise(F.col("lot") * (1 - p) / (F.col("lot") * (1 - p) + (1 - F.col("lot")) * p))
    intervals = F.greatest(F.lit(1), F.ceil(F.col("n") / INTERVAL))
    return planned.withColumn("place", place).withColumn("interval", F.least(F.floor(F.col("place") * intervals), intervals - 1))


def cuts(placed: DataFrame) -> DataFrame:
    """(source, last, upto, further) of sources that don't take all their ranks: the interval where the sample ends, the last rank (place, lot, size) of this interval that it holds
    (null: none), and the further one (null: none)."""
    sums = placed.groupBy("source", "interval").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    # a row for each interval of about INTERVAL documents
    reached = sums.withColumn("after", F.sum("words").over(Window.partitionBy("source").orderBy("interval"))).where("after > rest")
    ends = reached.groupBy("source").agg(F.min(F.struct("interval", (F.col("rest") - (F.col("after") - F.col("words"))).alias("left"))).alias("e"))
    ends = materialize(ends.select(F.col("source").alias("_its"), F.col("e.interval").alias("last"), F.col("e.left").alias("left")))
    edge = placed.join(broadcast_if_small(ends), F.col("source").eqNullSafe(F.col("_its")) & (F.col("interval") == F.col("last")))
    # rows of one rank, however many, are one row here
    ranks = edge.groupBy("source", "last", "left", "place", "lot", "size").agg(F.sum("size").alias("words"))
    rank = F.struct("place", "lot", "size")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("place", "lot", "size"))
    ranks = ranks.withColumn("after", upto).withColumn("held", F.col("after") <= F.col("left"))
    gap = F.col("left") - F.coalesce(F.max(F.when(F.col("held"), F.col("after"))).over(Window.partitionBy("source")), F.lit(0))
    ranks = ranks.withColumn("gap", gap).withColumn("miss", F.abs(F.col("gap") - F.col("words")))
    closer = ~F.col("held") & (F.col("miss") < F.col("gap"))
    return ranks.groupBy("source", "last").agg(F.max(F.when(F.col("held"), rank)).alias("upto"), F.min(F.when(closer, F.struct("miss", "place", "lot", "size"))).alias("f")).select(
        "source", "last", "upto", F.when(F.col("f").isNotNull(), F.struct("f.place", "f.lot", "f.size")).alias("further")
    )


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` (doc_id, text, source, ...) with size, source_size, target and copies (0 to 3)."""
    sized = docs.select(*dict.fromkeys((*keep, "source")), size_of(F.col("text")).alias("size"), lot_of(F.col("doc_id"), F.col("text")).alias("lot"))
    small = materialize(sized.select("source", "size", "lot"))
    takes = materialize(plan(small))
    ends = cuts(ranked(with_plan(small, takes)))
    takes = materialize(takes.join(ends.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of"))
    placed = ranked(with_plan(sized, takes))
    rank = F.struct("place", "lot", "size")
    held = F.coalesce(rank <= F.col("upto"), F.lit(False)) | F.coalesce(rank == F.col("further"), F.lit(False))
    more = F.when((F.col("rest") <= 0) | (F.col("size") == 0), 0).when(F.col("last").isNull() | (F.col("interval") < F.col("last")), 1).when(F.col("interval") > F.col("last"), 0).otherwise(held.cast("int"))
    return placed.select(*keep, "size", "source_size", "target", (F.col("whole") + more).cast("int").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    packed = docs.select("doc_id", "text", "source", F.struct("*").alias("_row"))
    taken = mix(packed, ("_row",)).where(F.col("copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


OP10_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}::DOUBLE AS lot
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(floor(size * sqrt(size))::BIGINT)::BIGINT AS spread, count(*) AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM (SELECT *, (3 * source_size)::DOUBLE / weight AS ratio FROM sums) WINDOW b AS (ORDER BY ratio, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT *, least((3 * source_size)::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), plan AS (
  SELECT *, greatest(0.0::DOUBLE, target - whole * source_size) AS rest
  FROM (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size + 1e-9::DOUBLE), 3)::INT ELSE 0 END AS whole FROM shares)
), odds AS (
  SELECT s.*, source_size, target, whole, rest, n, CASE WHEN spread > 0 THEN least(1.0::DOUBLE, rest * sqrt(size) / spread) ELSE 0.0::DOUBLE END AS p
  FROM sized s JOIN plan ON s.source IS NOT DISTINCT FROM plan.source
), placed AS (
  SELECT *, least(floor(place * greatest(1, ceil(n / {INTERVAL}.0)))::BIGINT, greatest(1, ceil(n / {INTERVAL}.0))::BIGINT - 1) AS cell
  FROM (SELECT *, CASE WHEN p <= 0 THEN 1.0::DOUBLE WHEN p >= 1 THEN 0.0::DOUBLE ELSE lot * (1 - p) / (lot * (1 - p) + (1 - lot) * p) END AS place FROM odds)
), ranks AS (
  SELECT source, cell, place, lot, size, any_value(rest) AS rest, sum(size) AS words FROM placed GROUP BY source, cell, place, lot, size
), running AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place, lot, size) AS after, sum(words) OVER (PARTITION BY source, cell) AS cell_words FROM ranks
), reached AS (
  SELECT *, max(after) OVER (PARTITION BY source, cell) AS cell_after FROM running
), ends AS (
  SELECT source, min(cell) AS last FROM reached WHERE cell_after > rest GROUP BY source
), near AS (
  SELECT r.*, after <= rest AS held, rest - coalesce(max(CASE WHEN after <= rest THEN after END) OVER (PARTITION BY r.source), 0) AS gap
  FROM reached r JOIN ends ON r.source IS NOT DISTINCT FROM ends.source
), further AS (
  SELECT source, place, lot, size FROM near JOIN ends USING (source) WHERE cell = last AND NOT held AND abs(gap - words) < gap
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(gap - words), place, lot, size) = 1
  UNION ALL
  SELECT near.source, place, lot, size FROM near JOIN ends ON near.source IS NULL AND ends.source IS NULL WHERE cell = last AND NOT held AND abs(gap - words) < gap
  QUALIFY row_number() OVER (ORDER BY abs(gap - words), place, lot, size) = 1
)
SELECT d.doc_id, d.size, d.source_size, d.target, (d.size * (d.whole + CASE WHEN d.rest <= 0 OR d.size = 0 THEN 0 WHEN r.after <= d.rest THEN 1 WHEN f.place IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed d JOIN running r ON d.source IS NOT DISTINCT FROM r.source AND d.place = r.place AND d.lot = r.lot AND d.size = r.size
LEFT JOIN further f ON d.source IS NOT DISTINCT FROM f.source AND d.place = f.place AND d.lot = f.lot AND d.size = f.size
"""
