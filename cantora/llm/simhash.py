"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly in tiles.

Fingerprints: A-Z is lower-cased, words are runs of other than ASCII white space, shingles of WIDTH
words (repeats included) are hashed by XXH64 (seed 42); a bit is set if it is set in over half the
hashes. A text of fewer words is one shingle, one without words has fingerprint zero. Null: as empty.

Links (``links``): equal fingerprints collapse to one row first, so copies cost nothing. Two fingerprints within the
radius agree wholly in one of radius + 1 blocks of bits, so a fingerprint goes to one tile for each
block -- radius + 1 copies, however many rows there are -- and numpy xors and counts bits of all pairs of a tile whose population counts differ by no more than
the radius. A block's first bits, as many as give tiles of about TILE / 4, are the tile's key; what still exceeds TILE
is cut by population count and hash, and pairs of such tiles beyond the radius are skipped. A group gives out only the edges
of a spanning forest of its links: connections are kept, and a thick group doesn't emit all its pairs.

Similar texts (``similar_groups``, the pipeline's stage): fingerprints of distinct shingles, compared with a wide radius where they share some bits of a block and a band of
alike shingle counts, join texts into families that may hold links. All links that this doesn't find are found by first shingles: in any order of all shingles, two sets as similar
as asked share one of the first n - ceil(similarity * n) + 1 of each. Families that such a shingle may link are joined, by bounds that hold in every case.
Inside each family the Jaccard similarity of whole shingle sets decides. No link is lost. A text goes to TABLES groups of fingerprints, however many there are.

Components: up to EDGES_AT_ONCE edges in one task; more by large-star and small-star steps until nothing moves, cutting the lineage by
tables in the shared folder.

Nulls: a null text is an empty one; a null id takes part and is none in the results. Texts without words are alike. Repeated rows, equal texts and equal
fingerprints are one node; of ties the smallest id counts. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import broadcast_if_small, give_back, map_batches, materialize, release, table, texts

SEED, WIDTH, RADIUS = 42, 3, 3
#: Fingerprints in a tile.
TILE = 8192
#: Bytes of one comparison block.
BLOCK = 1 << 20
BITS_AT_ONCE = 1 << 16
#: At a Jaccard similarity of 0.8 about 10 bits are expected to differ. The radius decides which of two exact ways finds a link, not whether it is found.
SIMILAR_RADIUS, SIMILAR_TILE = 18, 8192
#: Blocks of bits by which texts meet for the comparison with the wide radius.
TABLES = 4
#: Edges whose components are found in one task; beyond that by steps over tables.
EDGES_AT_ONCE = 1 << 21
#: Numbers in a sketch, and pairs whose sketches are compared in one go.
BINS, PAIRS_AT_ONCE = 256, 1 << 14
#: Shingles of a family that are compared in one group at most.
FAMILY_SHINGLES = 1 << 21
#: Documents in which common shingles are looked for, how many of them a common shingle is in, and how many are kept. They change the order of work, not the links.
COMMON_SAMPLE, COMMON_LEAST, COMMON_MOST = 25_000, 8, 1 << 17
#: First shingles that are held in one group, about: packed, and as rows with sketches.
PREFIX_ROWS, MET_ROWS = 1 << 18, 1 << 15


def shingle_hashes(raw: bytes | None, width: int = WIDTH) -> np.ndarray:
    """XXH64 of each shingle, in text order, repeats included. Empty for a text without words."""
    words = (raw or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[: n - width] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return np.fromiter([h(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64, n - width + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        part = hashes[at : at + BITS_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(raw: bytes | None, width: int = WIDTH) -> int:
    return majority(shingle_hashes(raw, width))


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long."""

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            fp = np.array([fingerprint(t, width) for t in texts(b)], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, fp long")


class Forest:
    """Union-find over array positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def spanning_links(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """Positions (into a, into b) of a spanning forest of the links between ``a`` and ``b``; b None: within ``a``. Rows go by population count, so that
    a block of rows meets only those whose counts are within the radius."""
    other = a if b is None else b
    rows_by, columns_by = (np.argsort(np.bitwise_count(x), kind="stable") for x in (a, other))
    x, y = a[rows_by], other[columns_by]
    ones = np.bitwise_count(y).astype(np.int64)
    forest = Forest(len(a) + (0 if b is None else len(b)))
    shift = 0 if b is None else len(a)
    left, right = [], []
    at = 0
    while at < len(x):
        # so many rows that rows times columns is a block
        stop = min(len(x), at + max(1, BLOCK // (8 * max(1, len(y)))))
        low, high = np.searchsorted(ones, int(np.bitwise_count(x[at])) - radius), np.searchsorted(ones, int(np.bitwise_count(x[stop - 1])) + radius, "right")
        if high > low:
            near = np.bitwise_count(x[at:stop, None] ^ y[None, low:high]) <= radius
            rows, columns = np.divmod(np.flatnonzero(near), high - low)
            for i, j in zip(rows_by[rows + at].tolist(), columns_by[columns + low].tolist(), strict=True):
                if (b is not None or i < j) and forest.join(i, j + shift):
                    left.append(i)
                    right.append(j)
        at = stop
    return left, right


def deal(celled: DataFrame, cells: DataFrame, reach: DataFrame, tile: int) -> DataFrame:
    """Deal rows of ``celled`` (p, q: the cell; fp, ...) to pairs of tiles. ``cells``: (p, q, n: its rows); a cell is cut into tiles of about ``tile`` rows. ``reach``: (p, q, r, s), each
    pair of cells to compare, in one order. Adds p0, q0, p1, q1, t0, t1 (the group) and side (0: first tile, 1: second)."""
    cut = cells.select("p", "q", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    pairs = reach.join(cut.withColumnRenamed("tiles", "tiles0"), ["p", "q"]).join(cut.select(F.col("p").alias("r"), F.col("q").alias("s"), F.col("tiles").alias("tiles1")), ["r", "s"])
    named = pairs.select(F.col("p").alias("p0"), F.col("q").alias("q0"), F.col("r").alias("p1"), F.col("s").alias("q1"), "tiles0", "tiles1")
    twice = named.where("p0 <> p1 or q0 <> q1").select(F.col("p1").alias("p"), F.col("q1").alias("q"), F.lit(1).alias("side"), *named.columns)
    plan = named.select(F.col("p0").alias("p"), F.col("q0").alias("q"), F.lit(0).alias("side"), *named.columns).unionAll(twice)
    mine = F.when(F.col("side") == 0, F.col("tiles0")).otherwise(F.col("tiles1"))
    others = F.when(F.col("side") == 0, F.col("tiles1")).otherwise(F.col("tiles0"))
    # a row goes to each tile of the other cell; within one cell, to the tiles from its own on, and to those before as second side
    dealt = celled.join(broadcast_if_small(materialize(plan)), ["p", "q"]).withColumn("t", F.pmod(F.xxhash64("fp"), mine).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), others - 1)))
    same = (F.col("p0") == F.col("p1")) & (F.col("q0") == F.col("q1"))
    first = F.when(same, F.least("t", "o")).when(F.col("side") == 0, F.col("t")).otherwise(F.col("o"))
    second = F.when(same, F.greatest("t", "o")).when(F.col("side") == 0, F.col("o")).otherwise(F.col("t"))
    side = F.when(same, (F.col("t") > F.col("o")).cast("int")).otherwise(F.col("side"))
    return dealt.withColumns({"t0": first, "t1": second, "side": side}).drop("p", "q", "t", "o", "tiles0", "tiles1")


GROUP = ("p0", "q0", "p1", "q1", "t0", "t1")


def sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray | None]:
    """Row positions of both tiles of a group; None as the second if a tile is compared with itself."""
    p0, q0, p1, q1, t0, t1 = (group[c].iat[0] for c in GROUP)
    if (p0, q0, t0) == (p1, q1, t1):
        return np.arange(len(group)), None
    side = group["side"].to_numpy()
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, bits) of radius + 1 blocks that make up the 64 bits."""
    ends = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(s, e - s) for s, e in zip(ends, ends[1:], strict=False)]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between ids of ``nodes`` (rep, fp: distinct) that connect all within the radius of each other."""
    rows = nodes.count()
    # as many bits of a block as bring tiles down to a fourth of the bound, if they are dealt evenly
    wanted = max(0, (4 * rows // tile).bit_length())
    keys = []
    for k, (shift, bits) in enumerate(blocks(radius)):
        used = min(bits, wanted)
        value = F.shiftrightunsigned("fp", shift + bits - used).bitwiseAND(F.lit((1 << used) - 1)) if used else F.lit(0).cast("long")
        keys.append(value + (k << 48))
    # p: block and value
    keyed = nodes.select("rep", "fp", F.explode(F.array(*keys)).alias("p"))
    # at most (radius + 1) << wanted of them, of which those above the bound are few
    large = materialize(keyed.groupBy("p").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select("p"))
    schema, any_large = "u long, v long", not large.isEmpty()

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fp, rep = group["fp"].to_numpy().view(np.uint64), group["rep"].to_numpy()
        a, b = sides(group) if "t0" in group else (np.arange(len(group)), None)
        i, j = spanning_links(fp[a], None if b is None else fp[b], radius)
        return pd.DataFrame({"u": rep[a[i]], "v": rep[a[j] if b is None else b[j]]})

    if not any_large:
        return keyed.groupBy("p").applyInPandas(compare, schema)
    whole = keyed.join(broadcast_if_small(large), "p", "left_anti").groupBy("p").applyInPandas(compare, schema)
    celled = keyed.join(broadcast_if_small(large), "p", "left_semi").withColumn("q", F.bit_count("fp").cast("int"))
    cells = materialize(celled.groupBy("p", "q").agg(F.count(F.lit(1)).alias("n")))
    reach = cells.select("p", "q", F.col("p").alias("r"), F.explode(F.sequence(F.col("q"), F.col("q") + radius)).alias("s"))
    return whole.unionAll(deal(celled, cells, reach, tile).groupBy(*GROUP).applyInPandas(compare, schema))


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the edges, and the smallest id that each of them reaches."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(ids))
    while True:
        x, y = up[a], up[b]
        apart = x != y
        if not apart.any():
            return ids, ids[up]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(top := up[up], up):
            up = top


def components(edges: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches, but for those that reach no smaller one. A written table."""
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    if e.count() <= at_once:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [(np.empty(0, np.int64), np.empty(0, np.int64)), *((b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches)]
            node, root = least_reached(*(np.concatenate(x) for x in zip(*held, strict=True)))
            node, root = node[node != root], root[node != root]
            for k in range(0, len(node), BITS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([pa.array(node[k : k + BITS_AT_ONCE]), pa.array(root[k : k + BITS_AT_ONCE])], ["node", "root"])
            give_back()

        found = materialize(e.coalesce(1).mapInArrow(run, "node long, root long"))
        release(e)
        return found
    before = None
    while True:
        # large star: every larger neighbour goes to the least of the neighbourhood
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node itself go to the least
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        new = materialize(small.where("u <> v").distinct())
        after = new.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20)")), F.lit(0))).first()
        release(e)
        e = new
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) per row. Rows whose doc_id is null have their group's id, null if the group has none."""
    prints = materialize(fingerprints(docs, width))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # a group without any id still links others; it takes a negative stand-in from its fingerprint
    stand_in = F.coalesce("rep", -F.abs(F.xxhash64("fp") / 2).cast("long") - (1 << 61))
    named = nodes.withColumn("node", stand_in)
    roots = components(links(named.select(F.col("node").alias("rep"), "fp"), radius, tile))
    grouped = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # stand-ins are the smallest of their components; the least real id is what counts
    real = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    return prints.join(grouped.join(real, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def sketch(distinct: np.ndarray) -> bytes:
    """Of sorted distinct hashes the least in each of BINS ranges, by its low bits as 1 to 255; 0 for an empty range."""
    out = np.zeros(BINS, np.uint8)
    if len(distinct):
        bins = (distinct >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        out[bins[first]] = distinct[first] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def loose_links(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...] | None, radius: int, similarity: float) -> tuple[list[int], list[int]]:
    """Positions of a spanning forest of the pairs of ``a`` and ``b`` -- each (fingerprints, shingle counts, sketches) -- that may be as similar
    as asked: fingerprints within the radius, counts in proportion, and sketches that agree up to four standard errors below."""
    (fp, size, marks), (fp2, size2, marks2) = a, b or a
    shift = 0 if b is None else len(fp)
    forest, left, right = Forest(len(fp) + (len(fp2) if b else 0)), [], []
    step = max(1, BLOCK // (8 * max(1, len(fp2))))
    roots = np.arange(len(forest.up))
    for at in range(0, len(fp), step):
        near = np.bitwise_count(fp[at : at + step, None] ^ fp2[None, :]) <= radius
        rows, columns = np.divmod(np.flatnonzero(near), max(1, len(fp2)))
        rows += at
        fits = np.minimum(size[rows], size2[columns]) >= similarity * np.maximum(size[rows], size2[columns]) - 1e-9
        if b is None:
            fits &= rows < columns
        rows, columns = rows[fits], columns[fits]
        for k in range(0, len(rows), PAIRS_AT_ONCE):
            i, j = rows[k : k + PAIRS_AT_ONCE], columns[k : k + PAIRS_AT_ONCE]
            apart = roots[i] != roots[j + shift]
            i, j = i[apart], j[apart]
            x, y = marks[i], marks2[j]
            used = np.maximum(1, ((x | y) != 0).sum(1))
            share = ((x == y) & (x != 0)).sum(1) / used
            # the ranges sample the union without putting back; of texts of few shingles they take most of it
            union = np.maximum((size[i] + size2[j]) / (1 + similarity), used)
            error = np.sqrt(similarity * (1 - similarity) / used * np.maximum((union - used) / union, 1 / union))
            take = share >= similarity - 4 * error
            joined = False
            for r, c in zip(i[take].tolist(), j[take].tolist(), strict=True):
                if forest.join(r, c + shift):
                    joined = True
                    left.append(r)
                    right.append(c)
            if joined:
                roots = np.array([forest.root(k) for k in range(len(roots))])
    return left, right


def candidate_keys(n: Column, fp: Column, similarity: float) -> Column:
    """An array of TABLES structs (k, band, block): the k-th block of bits of the fingerprint, and a band of shingle counts. Bands are as wide as four steps
    of the similarity, and each table's begin elsewhere, so that alike counts share a band in most of them."""
    width = 4 * F.log(F.lit(1 / similarity))
    bits = 64 // TABLES
    band = lambda k: F.floor(F.log(n.cast("double")) / width + k / TABLES).cast("int")
    block = lambda k: F.shiftrightunsigned(fp, k * bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    return F.array(*(F.struct(F.lit(k).alias("k"), band(k).alias("band"), block(k).alias("block")) for k in range(TABLES)))


def similar_candidates(nodes: DataFrame, radius: int, similarity: float, tile: int) -> DataFrame:
    """Pairs (u, v) of ids of ``nodes`` (rep, fp, n, sketch) that ``loose_links`` finds in groups of rows which share a table's band of counts and as many first bits of its block as
    bring a band down to groups of about half a tile. A row goes to TABLES groups, at any size of the input. Not all links meet in a group; ``prefix_links`` finds the others."""
    schema = "u long, v long"
    if radius < 0:
        return nodes.sparkSession.createDataFrame([], schema)
    keyed = nodes.where("n > 0").withColumn("t", F.explode(candidate_keys(F.col("n"), F.col("fp"), similarity))).select("rep", "fp", "n", "sketch", "t.*")
    # bands are logarithms of counts: some dozens for texts of any length
    counts = keyed.groupBy("k", "band").agg(F.count(F.lit(1)).alias("c")).collect()
    if not counts:
        return nodes.sparkSession.createDataFrame([], schema)
    most = 64 // TABLES
    used = {r["k"] + TABLES * r["band"]: min(most, (2 * r["c"] // tile).bit_length()) for r in counts}
    bits = F.element_at(F.create_map(*(F.lit(x) for pair in used.items() for x in pair)), F.col("k") + TABLES * F.col("band"))
    grouped = keyed.withColumn("bits", bits).withColumn("g", F.expr(f"shiftright(block, {most} - bits)")).drop("block", "bits")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        # a group that its bits don't cut goes in windows along its fingerprints, the table's block first
        turned = group["fp"].to_numpy().view(np.uint64)
        k = np.uint64(int(group["k"].iat[0]) * most)
        if len(group) > tile:
            group = group.iloc[np.argsort(turned >> k | turned << (np.uint64(64) - k) if k else turned, kind="stable")]
        fp, n, rep = group["fp"].to_numpy().view(np.uint64), group["n"].to_numpy(), group["rep"].to_numpy()
        left, right = [rep[:0]], [rep[:0]]
        for at in range(0, max(1, len(group) - tile // 2), max(1, tile // 2)):
            part = slice(at, at + tile)
            marks = np.frombuffer(b"".join(group["sketch"].iloc[part]), np.uint8).reshape(-1, BINS)
            i, j = loose_links((fp[part], n[part], marks), None, radius, similarity)
            left.append(rep[part][i])
            right.append(rep[part][j])
        return pd.DataFrame({"u": np.concatenate(left), "v": np.concatenate(right)})

    return grouped.groupBy("k", "band", "g").applyInPandas(compare, schema)


def common_hashes(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of the shingles that many of some COMMON_SAMPLE documents hold."""

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [np.unique(shingle_hashes(t, width)) for t in texts(b)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64), pa.int64())], ["hash"])

        return run

    every = max(1, docs.count() // COMMON_SAMPLE)
    found = map_batches(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text"), make, "hash long").groupBy("hash").agg(F.count(F.lit(1)).alias("c"))
    top = found.where(F.col("c") >= COMMON_LEAST).orderBy(F.desc("c"), "hash").limit(COMMON_MOST).select("hash")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column("hash").to_numpy().tobytes()], pa.binary())], ["hashes"])

    # packed: as rows of their own they take some hundred bytes each in the driver
    return np.sort(np.frombuffer(b"".join(r["hashes"] for r in top.mapInArrow(pack, "hashes binary").collect()), np.uint64))


def first_hashes(distinct: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(similarity * n) + 1 of sorted distinct hashes, common ones last."""
    last = common[np.minimum(np.searchsorted(common, distinct), len(common) - 1)] == distinct if len(common) else np.zeros(len(distinct), bool)
    return np.concatenate([distinct[~last], distinct[last]])[: len(distinct) - int(np.ceil(similarity * len(distinct) - 1e-9)) + 1]


def meetings(token: np.ndarray, family: np.ndarray, n: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of the pairs of rows, sorted by token and family, that share a token but no family, with counts in proportion."""
    new = np.r_[True, token[1:] != token[:-1]]
    ends = lambda starts: np.repeat(np.r_[starts[1:], len(token)], np.diff(np.r_[starts, len(token)]))
    stop, j = ends(np.flatnonzero(new)), ends(np.flatnonzero(new | np.r_[True, family[1:] != family[:-1]]))
    i = np.arange(len(token))
    while True:
        more = j < stop[i]
        i, j = i[more], j[more]
        if not len(i):
            return
        fits = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
        yield i[fits], j[fits]
        j = j + 1


def most_apart(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """How many hashes may be in only one of two sets that are as similar as asked and have so many hashes together."""
    return sizes * ((1 - similarity) / (1 + similarity)) + 1e-6


def shared_firsts(owned: DataFrame, total: int) -> DataFrame:
    """(token, rep, n): the first hashes that more than one row of ``owned`` (rep, n, first: as bytes) holds. ``total``: how many there are, about. Hashes travel as packed
    arrays, one row for each batch and bucket, and not as rows of their own. Of a hash the bucket and 32 more bits are kept: hashes that share them count as one,
    which brings up more candidates and loses none."""
    buckets = min(1 << 30, max(1, -(-total // PREFIX_ROWS), int(owned.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
            held = [np.frombuffer(x, np.uint64) for x in b.column("first").to_pylist()]
            times = [len(x) for x in held]
            tokens = np.concatenate([*held, np.empty(0, np.uint64)])
            if not len(tokens):
                return None
            spread = lambda name: np.repeat(b.column(name).to_numpy(zero_copy_only=False), times)
            g = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(g, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(g[order]) > 0])
            cut = lambda x: pa.array([p.tobytes() for p in np.split(x[order], starts[1:])], pa.binary())
            columns = [pa.array(g[order][starts], pa.int64()), cut(tokens.astype(np.uint32)), cut(spread("rep")), cut(spread("n").astype(np.uint32))]
            return pa.RecordBatch.from_arrays(columns, ["g", "token", "rep", "n"])

        return run

    def met(group: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
        token, rep, n = whole("token", np.uint32), whole("rep", np.int64), whole("n", np.uint32)
        order = np.argsort(token, kind="stable")
        same = token[order][1:] == token[order][:-1]
        keep = order[np.r_[same, False] | np.r_[False, same]] if len(order) else order
        named = (group.column("g")[0].as_py() << 32) + token[keep].astype(np.int64)
        return pa.table({"token": named, "rep": rep[keep], "n": n[keep].astype(np.int64)})

    packed = map_batches(owned.select("rep", "n", "first"), make, "g long, token binary, rep binary, n binary")
    return packed.groupBy("g").applyInArrow(met, "token long, rep long, n long")


def prefix_links(nodes: DataFrame, firsts: DataFrame, families: DataFrame, similarity: float) -> DataFrame:
    """Edges (u, v) between ids of ``nodes`` (rep, n, sketch) that join all families (``families``: node, family; others stand alone) between which texts may be as
    similar as asked. ``firsts``: (rep, n, first) for each of ``nodes``. No link is missed: counts, sketches and the number of first hashes shared only exclude what can't be similar."""
    spark = nodes.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = nodes.agg(F.sum((F.col("n") * (1 - similarity)).cast("long") + 1)).first()[0] or 0
    shared = shared_firsts(firsts.where("n > 0"), total)
    rows = shared.join(families.withColumnRenamed("node", "rep"), "rep", "left").withColumn("family", F.coalesce("family", "rep")).select("token", "rep", "family", "n")
    ordered = lambda group: group.iloc[np.lexsort((group["family"].to_numpy(), group["token"].to_numpy()))]
    columns = ("token", "family", "n")

    def meeting(group: pd.DataFrame) -> pd.DataFrame:
        group = ordered(group)
        keep = np.zeros(len(group), bool)
        for i, j in meetings(*(group[c].to_numpy() for c in columns), similarity):
            keep[i] = keep[j] = True
        kept = group[["token", "rep", "family", "n"]][keep]
        token = kept["token"].to_numpy()
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
        if len(starts):
            # the rows that hold a hash, as one number
            holders = np.add.reduceat(pd.util.hash_array(kept["rep"].to_numpy()), starts)
            kept["token"] = np.repeat(holders, np.diff(np.r_[starts, len(token)])).view(np.int64)
        return kept

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = ordered(group)
        marks = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, BINS)
        n, rep, times = group["n"].to_numpy(), group["rep"].to_numpy(), group["times"].to_numpy()
        pairs, shared = [np.empty((0, 4), np.int64)], [np.empty(0, np.int64)]
        for i, j in meetings(*(group[c].to_numpy() for c in columns), similarity):
            for k in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE]
                # where the least hashes of a range differ, one of them is in only one of the sets
                take = (marks[a] != marks[b]).sum(1) <= most_apart(n[a] + n[b], similarity)
                a, b = a[take], b[take]
                a, b = np.where(rep[a] < rep[b], a, b), np.where(rep[a] < rep[b], b, a)
                pairs.append(np.stack([rep[a], rep[b], n[a], n[b]], 1))
                shared.append(np.minimum(times[a], times[b]))
        found, which = np.unique(np.concatenate(pairs), axis=0, return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, which.ravel(), np.concatenate(shared))
        return pd.DataFrame({**dict(zip(("u", "v", "nu", "nv"), found.T, strict=True)), "times": sums})

    dealt = lambda df, count: df.withColumn("g", F.pmod(F.xxhash64("token"), F.lit(max(partitions, -(-count // MET_ROWS))))).groupBy("g")
    # the groups of the first pass hold no sketches, so rows of some ten times as many hashes fit
    kept = dealt(rows, total // 10).applyInPandas(meeting, "token long, rep long, family long, n long")
    # hashes that the same rows hold (a passage's, or those of near copies) become one that counts so many times; sets that meet in one number bring up more pairs and lose none
    met = materialize(kept.groupBy("token", "rep", "family", "n").agg(F.count(F.lit(1)).alias("times")))
    marked = met.join(nodes.select("rep", "sketch"), "rep")
    pairs = dealt(marked, met.count()).applyInPandas(link, "u long, v long, nu long, nv long, times long").groupBy("u", "v", "nu", "nv").agg(F.sum("times").alias("times"))
    # sets so similar share this many hashes; of those, the first hashes of the set whose last one comes first can lack only as many as that set has unshared
    both = F.ceil((F.col("nu") + F.col("nv")) * (similarity / (1 + similarity)) - 1e-6)
    return pairs.where(F.col("times") >= both + 1 - F.ceil(F.greatest("nu", "nv") * similarity - 1e-9)).select("u", "v")


def exact_links(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """Positions of a spanning forest of all pairs of ``sets`` (sorted distinct hashes) whose Jaccard similarity is at least as asked. Each set is
    held once against those not yet reached, by the lists of sets that hold each hash; sets reached leave the lists."""
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, word = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)
    starts = np.r_[0, np.cumsum(size)]
    waiting, left, right, queue = np.ones(len(sets), bool), [], [], []

    def lists() -> tuple[np.ndarray, np.ndarray]:
        live = np.flatnonzero(waiting[owner])
        order = live[np.argsort(word[live], kind="stable")]
        return owner[order], np.r_[0, np.cumsum(np.bincount(word[order], minlength=int(word.max()) + 1))]

    if not len(word):
        return left, right
    holders, first = lists()
    rest = listed = len(sets)
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        rest -= 1
        queue.append(seed)
        while queue:
            i = queue.pop()
            mine = word[starts[i] : starts[i + 1]]
            runs = first[mine + 1] - first[mine]
            total = int(runs.sum())
            if not total:
                continue
            at = np.arange(total) + np.repeat(first[mine] - np.r_[0, np.cumsum(runs)[:-1]], runs)
            others, both = np.unique(holders[at], return_counts=True)
            good = waiting[others] & (both >= similarity * (size[i] + size[others] - both) - 1e-9)
            found = others[good].tolist()
            left += [i] * len(found)
            right += found
            waiting[found] = False
            queue += found
            rest -= len(found)
            if 2 * rest < listed:
                holders, first = lists()
                listed = rest
    return left, right


def confirmed(families: DataFrame, docs: DataFrame, width: int, similarity: float, most: int = FAMILY_SHINGLES) -> DataFrame:
    """Edges (u, v) that connect all texts of a family (``families``: node, family, n shingles) whose shingle sets are as similar as asked, by
    whole texts (``docs``: node, text). Small families share a group; one of more than ``most`` shingles is cut into parts, and each two parts are a group."""
    spark = families.sparkSession
    totals = families.groupBy("family").agg(F.sum("n").alias("all"))
    shingles = totals.agg(F.sum("all")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * shingles // most))
    large = totals.where(F.col("all") > most).select("family", F.ceil(2 * F.col("all") / most).cast("int").alias("parts"))
    placed = families.join(large, "family", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int"))
    # a part meets every other; one alone in its family meets itself
    dealt = placed.withColumn("other", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part")))))
    keyed = dealt.select(
        "node", F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(F.col("family")).alias("g"),
        F.when(F.col("parts").isNull(), -1).otherwise(F.least("part", "other")).alias("one"), F.greatest("part", "other").alias("two"),
    )

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [np.unique(shingle_hashes(t, width)).tobytes() for t in texts(b)]
            return pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])

        return run

    sets = map_batches(docs.join(broadcast_if_small(families.select("node").distinct()), "node", "left_semi").select("node", "text"), make, "node long, hashes binary")

    def link(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["node"].to_numpy()
        i, j = exact_links([np.frombuffer(h, np.uint64) for h in group["hashes"]], similarity)
        return pd.DataFrame({"u": ids[i], "v": ids[j]})

    return keyed.join(sets, "node").groupBy("g", "one", "two").applyInPandas(link, "u long, v long")


def stand_in(digest: Column) -> Column:
    """A negative id below -(1 << 61) for a text whose own id won't do."""
    return -F.shiftrightunsigned(digest, 2) - (1 << 61)


def rooted(docs: DataFrame, width: int, similarity: float, radius: int = SIMILAR_RADIUS, tile: int = SIMILAR_TILE) -> DataFrame:
    """(doc_id, digest, root) per row of ``docs``: ``digest`` of its text, and a number for its group. A written table. Ids are above -(1 << 61)."""
    common = common_hashes(docs, width)

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            fp, n, marks, first = [], [], [], []
            for t in texts(b):
                distinct = np.unique(shingle_hashes(t, width))
                fp.append(majority(distinct))  # of the set, as the similarity is
                n.append(len(distinct))
                marks.append(sketch(distinct))
                first.append(first_hashes(distinct, common, similarity).tobytes())
            columns = [b.column("doc_id"), b.column("digest"), pa.array(np.array(fp, np.uint64).view(np.int64), pa.int64()), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), pa.array(first, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "fp", "n", "sketch", "first"])

        return run

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    prints = materialize(map_batches(hashed, make, "doc_id long, digest long, fp long, n long, sketch binary, first binary"))
    # a node is an id; ids of several texts, and rows without one, go by their text instead
    ids = prints.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count(F.lit(1)).alias("c"))
    odd = materialize(ids.where("c > 1 or doc_id is null").select("doc_id", (F.col("a") != F.col("b")).alias("many")))
    repeats = not odd.isEmpty()

    def noded(rows: DataFrame) -> DataFrame:
        rows = rows.join(odd, "doc_id", "left") if repeats else rows.withColumn("many", F.lit(None).cast("boolean"))
        return rows.withColumn("node", F.when(F.col("doc_id").isNull() | F.col("many"), stand_in(F.col("digest"))).otherwise(F.col("doc_id"))).drop("many")

    once = lambda rows: rows.dropDuplicates(["node"]) if repeats else rows

    own = noded(prints)
    nodes = materialize(own.groupBy("fp", "n", "sketch").agg(F.min("node").alias("rep")))
    loose = components(similar_candidates(nodes, radius, similarity, tile))
    members = lambda found: found.select("node", F.col("root").alias("family")).unionAll(found.select(F.col("root").alias("node"), F.col("root").alias("family")).distinct())
    firsts = own.join(broadcast_if_small(nodes.select(F.col("rep").alias("node"))), "node", "left_semi")
    firsts = once(firsts).select(F.col("node").alias("rep"), "n", "first")
    extra = prefix_links(nodes, firsts, members(loose), similarity)
    loose = components(loose.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(extra))
    families = materialize(members(loose).join(nodes.select(F.col("rep").alias("node"), "n"), "node"))
    roots = components(confirmed(families, once(noded(hashed)), width, similarity))
    grouped = nodes.join(roots, nodes["rep"] == roots["node"], "left").select("fp", "n", "sketch", F.coalesce("root", "rep").alias("root"))
    return materialize(prints.select("doc_id", "digest", "fp", "n", "sketch").join(grouped, ["fp", "n", "sketch"]).select("doc_id", "digest", "root"))


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = SIMILAR_RADIUS, tile: int = SIMILAR_TILE) -> DataFrame:
    """(doc_id, component_id) per row of ``docs``: groups of texts linked by a Jaccard similarity of their shingle sets of at least ``similarity``, by their smallest id (null
    if no row of a group has one). Fingerprints and sketches, then first shingles, find families that may hold links, whole texts decide."""
    rows = rooted(docs, width, similarity, radius, tile)
    return rows.join(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """Of each group of ``similar_groups`` one row, with all columns: the one with the smallest doc_id (rows without an id come last), and of different texts
    under this id the one with the smallest digest. Of rows that repeat both, one stays."""
    rows = rooted(docs, width, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    marked = rows.join(rows.groupBy("root").agg(first.alias("stay")), "root")
    stays = F.col("doc_id").eqNullSafe(F.col("stay.doc_id")) & (F.col("digest") == F.col("stay.digest"))
    go = marked.where(~stays).select("doc_id", "digest").distinct()
    lost = broadcast_if_small(materialize(go.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))))
    left = docs.withColumn("_own", F.xxhash64("text")).join(lost, (F.col("_own") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    again = materialize(marked.where(stays).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("_digest")))
    if again.isEmpty():
        return left.select(docs.columns)
    repeats = broadcast_if_small(again.distinct())
    once = left.join(repeats, F.col("_own") == F.col("_digest"), "left_semi").dropDuplicates(["doc_id", "_own"])
    return left.join(repeats, F.col("_own") == F.col("_digest"), "left_anti").select(docs.columns).unionAll(once.select(docs.columns))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
