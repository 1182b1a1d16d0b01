"""WARC records and their Merkle fixity audit.

``to_records`` frames pages as WARC response records. ``audit`` compares two replicas of records: each record is
hashed by SHA-256; equal records of one id are one run with a count. Runs are laid out by id within segments of SEGMENT ids, and by digest
within an id. Each node of the tree hashes its children in this order: what they are called, the offset range that each takes in the node,
and their hashes. The lowest nodes are the bins of an id (by the first hexadecimal digits of the digests), over them
are the ids (leaves), the segments, and up to FANOUT nodes a level. Ranges count from the node's own beginning, so that a lost record
changes the nodes above it and no others. Starting from the roots, only children of nodes that differ are
compared further, down to the bins whose records are damaged or missing. All of it is DataFrame operations, a shuffle a level.

Null ids are spread over negative leaf numbers by content, so no leaf gathers them all. An id with very many different records is spread
over its bins: a leaf has 16 ** BIN_DIGITS of them at most. Repeated records are counted. Empty tables give no rows. Only page_id, record, and
where replicas have them path and offset are read, whatever other columns are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cantora.llm.common import materialize, table

FANOUT_BITS = 10
#: Ids of a segment, which is the node above its leaves.
SEGMENT = FANOUT = 1 << FANOUT_BITS
BIN_DIGITS = 4
#: Leaf numbers for null ids: -1 to -NULL_LEAVES.
NULL_LEAVES = 1 << 16


def record_text(url: Column, payload: Column) -> Column:
    """One WARC/1.0 response record. Null url or payload: empty."""
    payload, url = F.coalesce(payload, F.lit("")), F.coalesce(url, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha256:"), F.sha2(payload, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, payload, F.lit("\r\n\r\n"))


def to_records(pages: DataFrame) -> DataFrame:
    """(page_id, record) with the record as binary."""
    return pages.select("page_id", F.encode(record_text(F.col("url"), F.col("html")), "UTF-8").alias("record"))


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of the records of a plain or gzipped WARC file. What is no whole record, up to the next one's
    beginning, comes as a record without headers, so that harm to one record costs no others."""
    if data[:2] == b"\x1f\x8b":
        import gzip

        data = gzip.decompress(data)
    at = 0
    while len(data) - at > 16 or data[at:].strip():
        end = data.find(b"\r\n\r\n", at)
        if end > 0 and data.startswith(b"WARC/", at):
            lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            length = headers.get("content-length", "")
            stop = end + 4 + int(length) if re.fullmatch("[0-9]{1,18}", length) else len(data) + 1
            if stop == len(data) or data[stop : stop + 4] == b"\r\n\r\n":
                yield at, min(stop + 4, len(data)) - at, headers, data[end + 4 : stop]
                at = stop + 4
                continue
        following = data.find(b"\r\n\r\nWARC/", at)
        stop = following + 4 if following >= 0 else len(data)
        yield at, stop - at, {}, data[at:stop]
        at = stop


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(path, offset, length, url, payload, broken) of the records of the WARC files below a path that Spark can read. broken: the bytes between
    whole records. A file is one value of Spark's reader, so at most 2 GB."""

    def run(frames):
        import pandas as pd

        for f in frames:
            for p, content in zip(f["path"], f["content"], strict=True):
                rows = [(p, at, n, h.get("warc-target-uri"), body, not h) for at, n, h, body in parse(content)]
                yield pd.DataFrame(rows, columns=["path", "offset", "length", "url", "payload", "broken"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, offset long, length long, url string, payload binary, broken boolean")


def runs(records: DataFrame) -> DataFrame:
    """(leaf, page_id, length, sha256, copies, places): equal records of an id together. places: hashes of their paths and offsets, summed; null if ``records`` has none."""
    at = [F.coalesce(F.col(c), F.lit(-1)) if c == "offset" else F.col(c) for c in ("path", "offset") if c in records.columns]
    place = F.xxhash64(*at) if "offset" in records.columns else F.lit(None).cast("long")
    hashed = records.select("page_id", place.alias("place"), F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"))
    leaf = F.coalesce(F.col("page_id"), -1 - F.pmod(F.xxhash64("sha256"), F.lit(NULL_LEAVES)))
    return hashed.groupBy("page_id", "sha256", "length").agg(F.count(F.lit(1)).alias("copies"), F.sum(F.col("place").cast("decimal(38,0)")).alias("places")).withColumn("leaf", leaf)


def under(rows: DataFrame, up: list[str], name: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (up, name, bytes, hash), each with the offset at which it starts in its node ``up``, and the nodes (up, bytes, hash)."""
    before = Window.partitionBy(*up).orderBy(*name).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    children = F.array_sort(F.collect_list(F.struct(*name, "start", "bytes", "hash")))
    entry = lambda x: F.concat_ws(":", *[F.coalesce(x[n].cast("string"), F.lit("")) for n in name], x["start"], x["start"] + x["bytes"], x["hash"])
    return placed, placed.groupBy(*up).agg(F.sum("bytes").alias("bytes"), F.sha2(F.concat_ws(",", F.transform(children, entry)), 256).alias("hash"))


def tree(found: DataFrame, levels: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Of ``runs``: they with their bin and start in it, the bins (leaf, bin, start, hash), and the nodes (node, start, hash) of each level. Level 0: a leaf for each id."""
    content = F.concat_ws(":", "sha256", "copies", F.coalesce(F.col("places").cast("string"), F.lit("")))
    rows = found.select("*", F.substring("sha256", 1, BIN_DIGITS).alias("bin"), (F.col("length") * F.col("copies")).alias("bytes"), content.alias("hash"))
    placed, bins = under(rows, ["leaf", "bin"], ["sha256", "page_id"])
    bins = materialize(under(bins, ["leaf"], ["bin"])[0])
    level = under(bins.drop("start"), ["leaf"], ["bin"])[1].withColumnRenamed("leaf", "node")
    nodes = []
    for _ in range(levels):
        nodes.append(materialize(under(level.withColumn("up", F.shiftright("node", FANOUT_BITS)), ["up"], ["node"])[0]))
        level = under(nodes[-1].drop("start"), ["up"], ["node"])[1].withColumnRenamed("up", "node")
    return placed, bins, [*nodes, materialize(level.withColumn("start", F.lit(0)))]


def different(a: DataFrame, b: DataFrame, name: list[str]) -> DataFrame:
    """The nodes that one side lacks or has with another hash."""
    both = a.select(*name, "hash").join(b.select(*name, F.col("hash").alias("other")), name, "full")
    return both.where(~F.col("hash").eqNullSafe(F.col("other"))).select(*name)


def descend(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """Leaves that differ, found from the roots through differing nodes only."""
    differ = different(a[-1], b[-1], ["node"])
    for x, y in zip(a[-2::-1], b[-2::-1], strict=True):
        up = differ.select(F.col("node").alias("up"))
        differ = different(x.join(up, "up", "left_semi"), y.join(up, "up", "left_semi"), ["node"])
    return differ


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """A row for each different record (page_id, content) of either replica of (page_id, record): its segment, the offset in
    the replica that has it, length, sha256, copies, and status: intact, damaged (the second has the id, but not this
    record as often), missing (it lacks the id), extra (only the second has the record). Replicas that both have a stored offset (and path, as seen from the replica's
root) are held to them too: moved (the second has the record as often, but at other offsets); the offset given is always that of the layout by id."""
    if ("offset" in first.columns, "path" in first.columns) != ("offset" in second.columns, "path" in second.columns):
        raise ValueError("only one of the replicas has stored offsets or paths")
    a, b = materialize(runs(first)), materialize(runs(second))
    most = a.unionAll(b).agg(F.max(F.abs("leaf"))).first()[0] or 0
    levels = max(1, -(-int(most).bit_length() // FANOUT_BITS))
    (runs_a, bins_a, nodes_a), (runs_b, bins_b, nodes_b) = tree(a, levels), tree(b, levels)
    leaves = descend(nodes_a, nodes_b).withColumnRenamed("node", "leaf")
    bad = different(bins_a.join(leaves, "leaf", "left_semi"), bins_b.join(leaves, "leaf", "left_semi"), ["leaf", "bin"])
    ids = nodes_b[0].select(F.col("node").alias("leaf"), F.lit(True).alias("id_there"))
    bad = materialize(bad.withColumn("differs", F.lit(True)).join(ids, "leaf", "left"))
    key = ["leaf", "bin"]

    def laid_out(placed: DataFrame, bins: DataFrame, nodes: list[DataFrame]) -> DataFrame:
        """Runs with the offset in their segment, from the ranges of the nodes above them."""
        at = bins.join(nodes[0].select(F.col("node").alias("leaf"), F.col("start").alias("leaf_start")), "leaf").select(*key, (F.col("start") + F.col("leaf_start")).alias("bin_start"))
        return placed.join(at, key).withColumn("segment", F.shiftright("leaf", FANOUT_BITS)).withColumn("offset", F.col("start") + F.col("bin_start"))

    marked = laid_out(runs_a, bins_a, nodes_a).join(bad, key, "left").withColumn("known", F.coalesce("page_id", F.lit(0))).withColumn("no_id", F.isnull("page_id"))
    # only what lies in differing bins is compared record by record
    record = [*key, "sha256", "known", "no_id"]
    binned = lambda t: t.select("*", F.substring("sha256", 1, BIN_DIGITS).alias("bin"), F.coalesce("page_id", F.lit(0)).alias("known"), F.isnull("page_id").alias("no_id")).join(bad, key, "left_semi")
    same = binned(b).select(*record, "copies", F.lit(True).alias("same"), F.col("places").alias("other"))
    out = marked.join(same, [*record, "copies"], "left")
    status = F.when(F.col("differs").isNull() | F.col("same").isNotNull() & F.col("places").eqNullSafe(F.col("other")), "intact").when(F.col("same").isNotNull(), "moved").when(F.col("id_there").isNotNull(), "damaged").otherwise("missing")
    columns = ["page_id", "segment", "offset", "length", "sha256", "copies"]
    only = binned(b).join(binned(a).select(*record), record, "left_anti").select(*key, "sha256", "page_id")
    there = laid_out(runs_b.join(bad, key, "left_semi"), bins_b, nodes_b)
    extra = there.alias("t").join(only.alias("o"), F.expr("t.leaf = o.leaf AND t.bin = o.bin AND t.sha256 = o.sha256 AND t.page_id <=> o.page_id"), "left_semi")
    return out.select(*columns, status.alias("status")).unionAll(extra.select(*columns, F.lit("extra").alias("status")))


def drill(records: DataFrame) -> DataFrame:
    """A replica with known harm: ids divisible by 211 are lost, the others divisible by 101 end in another byte."""
    hurt = F.concat(F.substring("record", 1, F.octet_length("record") - 1), F.encode(F.lit("!"), "UTF-8"))
    return records.where(F.coalesce(F.col("page_id") % 211 != 0, F.lit(True))).withColumn("record", F.when(F.col("page_id") % 101 == 0, hurt).otherwise(F.col("record")))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of all ``pages`` as WARC records against a replica with known harm."""
    records = to_records(table(spark, sf_dir, "pages"))
    return audit(records, drill(records))


OP7_SQL = r"""
WITH framed AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'WARC-Payload-Digest: sha256:' || sha256(coalesce(html, '')) || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) AS head
  FROM pages
), a AS (
  SELECT page_id, sha256(head || chr(10)) AS sha256, strlen(head) + 1 AS length, count(*) AS copies, 0 AS which FROM framed GROUP BY ALL
), b AS (
  SELECT page_id, sha256(head || CASE WHEN page_id % 101 = 0 THEN '!' ELSE chr(10) END) AS sha256, strlen(head) + 1 AS length, count(*) AS copies, 1 AS which
  FROM framed WHERE page_id % 211 <> 0 GROUP BY ALL
), placed AS (
  SELECT *, page_id // 1024 AS segment,
    coalesce(sum(length * copies) OVER (PARTITION BY which, page_id // 1024 ORDER BY page_id, sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
)
SELECT page_id, segment, "offset", length, sha256, copies,
  CASE WHEN which = 1 THEN 'extra' WHEN page_id % 211 = 0 THEN 'missing' WHEN page_id % 101 = 0 THEN 'damaged' ELSE 'intact' END AS status
FROM placed WHERE which = 0 OR page_id % 101 = 0
"""
