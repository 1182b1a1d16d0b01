"""Media columns: payloads cut by content, chunks stored once, media put together again and verified.

A text's UTF-8 bytes, filled up with zeros to a positive multiple of 64, are the 8-bit samples of a WAV
file (mono, 16 kHz): 44 bytes of header and the payload. A gear hash of the last 32 bytes rolls
over the file; a chunk ends where its highest MASK_BITS bits are zero (not before LEAST bytes, at MOST in any case).

Chunks are keyed by SHA-256. The store keeps the bytes of each digest once (compressed), recipes keep
the digests in order. Media come back by joining recipes with the store; each chunk's digest and the whole file's are
checked before features are computed. Equal texts share one recipe, so a large group of copies
is put together once. Null: as the empty text (64 zero bytes). Texts of any length are chunked whole. Rows that repeat, and null ids, have a row each. An empty table gives no rows. Only doc_id
and text are read, whatever other columns are called.

The store is what the digests' aggregation holds: its shuffle files are the stored bytes, from which media are read back. It is not written as a table of its own.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import map_batches, materialize, table, texts

RATE, HEADER = 16_000, 44
LEAST, MASK_BITS, MOST = 2048, 12, 32_768
LEVEL = 9
#: The compression dictionary of the store: from at most so many texts, and so many bytes of each. It changes sizes, not results.
DICTIONARY_ROWS, DICTIONARY_PIECE, DICTIONARY_BYTES = 2000, 4096, 65_536
GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)


def payload_of(raw: bytes) -> bytes:
    return raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)


def wav(payload: bytes) -> bytes:
    """8-bit mono PCM."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload


def samples(media: bytes) -> bytes:
    """The payload of a file that ``wav`` made."""
    (length,) = struct.unpack_from("<I", media, 40)
    if media[:4] != b"RIFF" or media[36:40] != b"data" or len(media) != HEADER + length:
        raise ValueError("not a stored payload")
    return media[HEADER:]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n]
    h = GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # h[i] = sum of gear[i - j] << j, for j from 0 to 31
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    places = (np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1).tolist()
    out, start = [], 0
    for p in [*places, n]:
        while p - start > MOST:
            start += MOST
            out.append(start)
        if p - start >= LEAST and p < n:
            out.append(p)
            start = p
    if start < n:
        out.append(n)
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media_key, digests) per row of ``docs``; media_key: SHA-256 of the file."""

    def make() -> Callable:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = [t or b"" for t in texts(b)]
            media = [wav(payload_of(t)) for t in raw]
            digests = [[hashlib.sha256(c).digest() for c in chunks(m)] for m in media]
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array([hashlib.sha256(m).digest() for m in media], pa.binary()), pa.array(digests, pa.list_(pa.binary()))], ["doc_id", "n_bytes", "media_key", "digests"]
            )

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_bytes long, media_key binary, digests array<binary>")


def dictionary(docs: DataFrame) -> bytes:
    """A compression dictionary from a bounded sample of all rows, chosen by a hash of the id; empty if there is too little text."""
    every = max(1, docs.count() // DICTIONARY_ROWS)
    lot = F.xxhash64(F.lit("dictionary"), "doc_id")
    some = docs.where(F.pmod(lot, F.lit(every)) == 0).select(lot.alias("lot"), F.substring("text", 1, DICTIONARY_PIECE).alias("t")).where("t <> ''")
    rows = some.orderBy("lot", "t").limit(DICTIONARY_ROWS).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r["t"].encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def store(docs: DataFrame, words: bytes) -> DataFrame:
    """(digest, packed): each different chunk once, compressed."""

    def make() -> Callable:
        more = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        pack = zstandard.ZstdCompressor(level=LEVEL, write_dict_id=False, write_checksum=False, **more)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[bytes, bytes] = {}
            for t in texts(b):
                for c in chunks(wav(payload_of(t or b""))):
                    d = hashlib.sha256(c).digest()
                    if d not in found:
                        found[d] = pack.compress(c)
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], ["digest", "packed"])

        return run

    return map_batches(docs.select("text"), make, "digest binary, packed binary").groupBy("digest").agg(F.first("packed").alias("packed"))


def reassembled(recipe: DataFrame, chunk_store: DataFrame, words: bytes, use: Callable[[bytes], tuple], names: str) -> DataFrame:
    """(media_key, *names) for each different media_key of ``recipe``: ``use`` of the verified file."""
    once = recipe.groupBy("media_key").agg(F.first("digests").alias("digests"))
    refs = once.select("media_key", F.size("digests").alias("n"), F.posexplode("digests").alias("at", "digest"))
    rows = refs.join(chunk_store, "digest").select("media_key", "n", "at", "digest", "packed")
    # a medium of one chunk is whole already and needn't move again
    several = rows.where("n > 1").repartition("media_key").sortWithinPartitions("media_key", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        unpack = zstandard.ZstdDecompressor(**more)
        key, parts = None, []
        for b in batches:
            out = []
            for k, n, at, d, packed in zip(*(b.column(c).to_pylist() for c in ("media_key", "n", "at", "digest", "packed")), strict=True):
                if k != key:
                    key, parts = k, []
                piece = unpack.decompress(packed)
                if at != len(parts) or hashlib.sha256(piece).digest() != d:
                    raise ValueError(f"chunk {at} of {k.hex()} isn't what was stored")
                parts.append(piece)
                if len(parts) == n:
                    media = b"".join(parts)
                    if hashlib.sha256(media).digest() != k:
                        raise ValueError(f"{k.hex()} isn't what was stored")
                    out.append((k, *use(media)))
                    key, parts = None, []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], columns)

    spec = [x.split() for x in names.split(", ")]
    types = [pa.binary()] + [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t] for _, t in spec]
    columns = ["media_key", *(n for n, _ in spec)]
    schema = f"media_key binary, {names}"
    return several.mapInArrow(run, schema).unionAll(rows.where("n = 1").mapInArrow(run, schema))


def digest_features(media: bytes) -> tuple:
    payload = samples(media)
    x = np.frombuffer(payload, np.uint8)
    ends = cuts(media)
    centred = x.astype(np.int16) - 128
    feature = f"chunks={len(ends)};mean={x.mean():.4f};crossings={int(((centred[1:] >= 0) != (centred[:-1] >= 0)).sum())}"
    return len(payload), hashlib.sha256(payload).digest(), zlib.crc32(payload[-64:]), len(media), feature


def store_and_read(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: digests of the payload and the file that came back from the chunk store."""
    words = dictionary(docs)
    recipe = materialize(recipes(docs))
    names = "payload_bytes long, payload_digest binary, tail_crc32 long, media_bytes long, feature string"
    found = reassembled(recipe, store(docs, words), words, digest_features, names)
    text = lambda c: F.lower(F.hex(c))
    return recipe.select("doc_id", "n_bytes", "media_key").join(found, "media_key").select(
        "doc_id", "n_bytes", "payload_bytes", text("payload_digest").alias("payload_sha256"), "tail_crc32", "media_bytes", text("media_key").alias("media_sha256"), "feature"
    )  # the key is the digest that was verified


def op8_chunked_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as stored media."""
    return store_and_read(table(spark, sf_dir, "documents"))
