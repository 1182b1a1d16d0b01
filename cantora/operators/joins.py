"""Interval and as-of joins without nested loops, and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_max(df: DataFrame, key: str, idx: str, value: str, out: str, chunk: int = 4096) -> DataFrame:
    """Largest ``value`` up to each row in ``idx`` order within ``key``, in two levels: inside chunks of about ``chunk`` rows and over the chunks. Chunks are ranges of ``idx`` between
    its quantiles in the key, so that a key with very many rows is no single task, however far apart its indices are."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.where(F.col("_n") > chunk)
    if large.isEmpty():  # every key is one chunk
        return df.withColumn(out, F.max(value).over(Window.partitionBy(key).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)))
    steps = [k / 256 for k in range(1, 256)]
    marks = df.join(large.select(key), key, "left_semi").groupBy(key).agg(F.percentile_approx(idx, steps, 2000).alias("_marks"))
    df = df.join(marks, key, "left").withColumn("_chunk", F.coalesce(F.size(F.filter("_marks", lambda m: m < F.col(idx))), F.lit(0))).drop("_marks")
    tops = df.groupBy(key, "_chunk").agg(F.max(value).alias("_top"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(key, "_chunk", F.max("_top").over(before).alias("_before"))
    inside = Window.partitionBy(key, "_chunk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(tops, [key, "_chunk"]).withColumn(out, F.greatest(F.max(value).over(inside), "_before")).drop("_chunk", "_before")


def asof_previous(probes: DataFrame, captions: DataFrame, key: str, at: str, start: str, idx: str, shift: float, out: str, bucket: float = 86_400.0) -> DataFrame:
    """``probes`` with the ``idx`` of the previous caption, or null: captions are gone through in ``idx`` order while they start before ``at - shift``;
    the last one counts. For captions out of order this is the last whose running maximum lies before the bound.

    Probes and captions are united and sorted by time within (key, time bucket); what earlier buckets hold comes from one
    row for each bucket."""
    timed = running_max(captions.select(key, idx, start), key, idx, start, "_t")
    both = probes.select("*", (F.col(at) - shift).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(captions.schema[idx].dataType).alias("_idx")).unionByName(
        timed.select(key, "_t", F.lit(1).alias("_side"), F.col(idx).alias("_idx")), allowMissingColumns=True
    )
    both = both.withColumn("_b", F.floor(F.col("_t") / bucket))
    # a caption at the bound itself is too late, so it sorts after the probe
    inside = Window.partitionBy(key, "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(key, "_b").agg(F.max("_idx").alias("_last")).select(key, "_b", F.max("_last").over(earlier).alias("_carried"))
    seen = both.withColumn("_seen", F.max("_idx").over(inside)).where("_side = 0").join(carried, [key, "_b"], "left")
    return seen.select(*probes.columns, F.greatest("_seen", "_carried").alias(out))


def contained(intervals: DataFrame, points: DataFrame, key: str, start: str, end: str, at: str, bucket: float = 3600.0) -> DataFrame:
    """Pairs of an interval and a point of the same key with ``start <= at <= end``, by an equi-join on time buckets. Columns must have
    different names but for the key."""
    spread = intervals.where(F.col(start) <= F.col(end)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket))))
    return spread.join(points.withColumn("_b", F.floor(F.col(at) / bucket)), [key, "_b"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_b")


def overlap_seconds(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(e1, e2) - F.greatest(s1, s2))


def overlap_first(spans: DataFrame, segments: DataFrame, key: str, bucket: float = 3600.0) -> DataFrame:
    """Each segment (key, seg, s, e, ...) with the lowest-numbered span (key, span, vs, ve) that it overlaps. A segment is used once, so this is what
    going through the spans in order and taking all unused segments gives. The overlap must be longer than nothing."""
    buckets = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bucket), F.floor(F.col(e) / bucket)))
    a = segments.where("s <= e").select(key, "seg", "s", "e").withColumn("_b", buckets("s", "e"))
    b = spans.where("vs <= ve").withColumn("_b", buckets("vs", "ve"))
    first = a.join(b, [key, "_b"]).where(F.least("e", "ve") > F.greatest("s", "vs")).groupBy(key, "seg").agg(F.min("span").alias("span"))
    return segments.join(first, [key, "seg"])


def greedy_overlap(spans: DataFrame, segments: DataFrame, key: str, least: float = 0.0) -> DataFrame:
    """(key, span, seg): for each span in order the unused segment of largest overlap (the first of equals), if it is over nothing and at
    least ``least``. Sequential only where spans compete: a key is cut wherever no interval reaches over, and a piece between two such cuts is matched by itself.
    Rows stream through a task by key and time; it holds one batch and one piece."""
    from bisect import bisect_left, bisect_right
    from itertools import accumulate

    import numpy as np
    import pyarrow as pa

    both = spans.select(key, F.col("vs").alias("_s"), F.col("ve").alias("_e"), F.lit(True).alias("_span"), F.col("span").cast("long").alias("_id")).unionAll(
        segments.select(key, F.col("s").alias("_s"), F.col("e").alias("_e"), F.lit(False).alias("_span"), F.col("seg").cast("long").alias("_id"))
    )
    # what has no length overlaps nothing
    timed = both.withColumns({c: F.col(c).cast("double") for c in ("_s", "_e")}).where("_s < _e and not isnan(_e)").repartition(key).sortWithinPartitions(key, "_s")
    wide = 256

    def match(s: list, e: list, is_span: list, ident: list, at: list[int], out: list) -> None:
        """Of the rows ``at`` of one piece, by start: adds (row of the segment, span, segment) to ``out``."""
        segs = [i for i in at if not is_span[i]]
        starts, ends = [s[i] for i in segs], [e[i] for i in segs]
        tops, free = list(accumulate(ends, max)), [True] * len(segs)
        if len(segs) > wide:
            start_of, end_of, number, unused = np.array(starts), np.array(ends), np.array([ident[i] for i in segs]), np.ones(len(segs), bool)
        for v in sorted((i for i in at if is_span[i]), key=lambda i: (ident[i], s[i])):
            vs, ve, best, most = s[v], e[v], -1, 0.0
            low, high = bisect_right(tops, vs), bisect_left(starts, ve)
            if high - low > wide:
                shared = np.where(unused[low:high], np.minimum(end_of[low:high], ve) - np.maximum(start_of[low:high], vs), 0.0)
                if (most := float(shared.max())) > 0:
                    equal = low + np.flatnonzero(shared == most)
                    best = int(equal[number[equal].argmin()])
            else:
                for k in range(low, high):
                    if free[k] and (length := min(ends[k], ve) - max(starts[k], vs)) >= most and length > 0 and (length > most or ident[segs[k]] < ident[segs[best]]):
                        best, most = k, length
            if best >= 0 and most >= least:
                free[best] = False
                if len(segs) > wide:
                    unused[best] = False
                out.append((segs[best], ident[v], ident[segs[best]]))

    def run(batches):
        fields = ("_s", "_e", "_span", "_id")
        held, last, top = [], None, 0.0

        def matched(rows: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            columns, out = [rows[c].to_pylist() for c in fields], []
            for a, b in zip(cuts, [*cuts[1:], rows.num_rows], strict=True):
                if b - a > 1:
                    match(*columns, range(a, b), out)
            which, span, seg = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([rows[key].combine_chunks().take(pa.array(which, pa.int64())), pa.array(span, pa.int64()), pa.array(seg, pa.int64())], [key, "span", "seg"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = []
            for i, (k, s, e) in enumerate(zip(batch[key].to_pylist(), batch["_s"].to_pylist(), batch["_e"].to_pylist(), strict=True)):
                if k != last or s >= top or (not held and not i):
                    cuts.append(i)
                    last, top = k, e
                elif e > top:
                    top = e
            if cuts:
                # all pieces before the batch's last one are whole
                before = [*held, *([batch.slice(0, cuts[-1])] if cuts[-1] else [])]
                if before:
                    shift = sum(h.num_rows for h in held)
                    inner = [shift + c for c in cuts[:-1]]
                    yield matched(pa.Table.from_batches(before), ([0] if held else []) + inner)
                held = [batch.slice(cuts[-1])]
            else:
                held.append(batch)
        if held:
            yield matched(pa.Table.from_batches(held), [0])

    kind = segments.schema[key].dataType.simpleString()
    return timed.mapInArrow(run, f"{key} {kind}, span long, seg long")


def lookup(rows: DataFrame, dimension: DataFrame, key: str, order: str) -> DataFrame:
    """Left join with a dimension of which, for repeated keys, the last row in ``order`` counts. Its size decides whether it is broadcast."""
    values = [c for c in dimension.columns if c not in (key, order)]
    last = dimension.groupBy(key).agg(F.max_by(F.struct(*values), order).alias("_v")).select(key, "_v.*")
    return rows.join(last, key, "left")


def remaining(inputs: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    return inputs.join(done.select(*on), on, "left_anti")


def existing(rows: DataFrame, listing: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(listing.select(*on), on, "left_semi")


def first_existing(rows: DataFrame, listing: DataFrame, candidates: list[str], path: str, out: str) -> DataFrame:
    """The first of several candidate paths that is listed, or null."""
    for n, c in enumerate(candidates):
        rows = rows.join(listing.select(F.col(path).alias(f"_p{n}")).distinct(), F.col(c) == F.col(f"_p{n}"), "left")
    found = [f"_p{n}" for n in range(len(candidates))]
    return rows.withColumn(out, F.coalesce(*found)).drop(*found)
