"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of 1- to 3-grams of the lower-cased text, hashed into a fixed number of buckets, are learned
from a sample of about ``PER_LANGUAGE`` documents of each language (each is taken with the share that makes this many expected), chosen by a hash of the id. The
matrix of log probabilities has BUCKETS rows and a column for each language; it is broadcast to the
executors, in groups of at most LANGUAGES columns. There a batch of documents becomes one sparse matrix of counts (document, bucket), whose product with
the log probabilities gives all scores of the batch.

A text that is null or has no letter is ``und`` with score 0. Without any labelled document all are
``und``. Texts are read whole, in pieces that overlap by two characters. Ties go to the smaller language by code point. Rows that repeat are
scored each; equal texts get equal results. An empty table gives no rows. Columns besides doc_id, text and lang are not read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import broadcast_if_small, crc_mod, map_batches, materialize, slices, table

BUCKETS = 1 << 14
#: The bound of the sample: documents of a language that are learned from, as expected.
PER_LANGUAGE = 4000
#: Languages whose log probabilities are broadcast together: 16 MB.
LANGUAGES = 128
SMOOTHING = 0.5
#: Characters that are counted in one go.
PIECE = 1 << 14
#: Products that are summed in one go.
PRODUCTS = 1 << 20


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, text's number, whether it was counted in the piece before), about PIECE characters at a time."""
    points, owners, seen, held = [], [], [], 0
    for k, text in enumerate(texts):
        text = text.lower()
        for at in range(0, len(text), PIECE):
            before = min(at, 2)
            c = np.frombuffer(text[at - before : at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
            points.append(c)
            owners.append(np.full(len(c), k))
            seen.append(np.arange(len(c)) < before)
            held += len(c)
            if held >= PIECE:
                yield np.concatenate(points), np.concatenate(owners), np.concatenate(seen)
                points, owners, seen, held = [], [], [], 0
    if points:
        yield np.concatenate(points), np.concatenate(owners), np.concatenate(seen)


def sparse_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's number, bucket, count), by number: the counts of the texts' 1- to 3-grams. A text in several pieces has several counts of a bucket, which add up."""
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for c, k, seen in pieces(texts):
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        # a gram counts where its last character is new, and all are of one text
        found = [(k[n:] * BUCKETS + (g >> np.uint32(18)))[~seen[n:] & (k[n:] == k[: len(k) - n])] for n, g in enumerate((one, two, three))]
        new, n = np.unique(np.concatenate(found), return_counts=True)
        keys.append(new)
        counts.append(n)
    every = np.concatenate(keys)
    return every // BUCKETS, every % BUCKETS, np.concatenate(counts)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the text's 1- to 3-grams by bucket."""
    _, bucket, n = sparse_counts([text])
    return np.bincount(bucket, n, BUCKETS).astype(np.int64)


def products(rows: tuple[np.ndarray, np.ndarray, np.ndarray], texts: int, weights: np.ndarray) -> np.ndarray:
    """The sparse counts times ``weights`` (bucket x language), a row for each of ``texts``."""
    owner, bucket, n = rows
    out = np.zeros((texts, weights.shape[1]))
    firsts = np.searchsorted(owner, np.arange(texts + 1))
    step = max(1, PRODUCTS // max(1, weights.shape[1]))
    for k in range(texts):
        for s in range(firsts[k], firsts[k + 1], step):
            e = min(s + step, firsts[k + 1])
            out[k] += n[s:e] @ weights[bucket[s:e]]
    return out


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages by code point, and log probabilities (bucket x language). Rows of ``docs``: doc_id, text, lang."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # a row for each language
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((BUCKETS, 0))
    shares = docs.sparkSession.createDataFrame([(lang, k, min(1.0, per_language / sizes[lang])) for k, lang in enumerate(languages)], "lang string, number int, share double")
    lot = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(broadcast_if_small(shares), "lang").where(lot < F.col("share")).select("text", "number")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                owner, bucket, n = sparse_counts(part.column("text").to_pylist())
                lang = part.column("number").to_numpy()[owner].astype(np.int64)
                keys, back = np.unique(lang * BUCKETS + bucket, return_inverse=True)
                sums = np.bincount(back, n, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys // BUCKETS, pa.int32()), pa.array(keys % BUCKETS, pa.int32()), pa.array(sums, pa.int64())], ["number", "bucket", "n"])

    # a language's counts as one row
    counted = sample.mapInArrow(count, "number int, bucket int, n long").groupBy("number", "bucket").agg(F.sum("n").alias("n"))
    matrix = np.zeros((BUCKETS, len(languages)), np.float32 if len(languages) > LANGUAGES else np.float64)
    for r in counted.groupBy("number").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).toLocalIterator():
        counts = np.zeros(BUCKETS)
        counts[[x["bucket"] for x in r["c"]]] = [x["n"] for x in r["c"]]
        matrix[:, r["number"]] = np.log(counts + SMOOTHING) - np.log(counts.sum() + SMOOTHING * BUCKETS)
    return languages, matrix


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def classify(docs: DataFrame, languages: list[str], matrix: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``; score is the posterior of the language under equal priors. More than LANGUAGES languages are scored in
    turns: each turn hands on the best language so far and the sum of all likelihoods."""
    state = "doc_id long, lang_pred string, best double, mass double"
    rows = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("best"), F.lit(0.0).alias("mass"))
    firsts = range(0, len(languages), LANGUAGES)
    for first in firsts:
        last = first == firsts[-1]
        rows = map_batches(rows, _turn(docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix[:, first : first + LANGUAGES])), languages[first : first + LANGUAGES], last), state + ("" if last else ", text string"))
        if not last:  # one turn's matrix in a worker at a time
            rows = materialize(rows)
    # mass is the sum of all likelihoods over the best one
    return rows.select("doc_id", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.when(F.col("lang_pred").isNull(), 0.0).otherwise(1 / F.col("mass")).alias("score"))


def _turn(weights, languages: list[str], last: bool) -> Callable:
    def make() -> Callable:
        w = weights.value.astype(np.float64, copy=False)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column("text").to_pylist()
            judged = [k for k, t in enumerate(texts) if t is not None and has_letter(t)]
            scores = products(sparse_counts([texts[k] for k in judged]), len(judged), w)
            lang, best, mass = (b.column(c).to_pylist() for c in ("lang_pred", "best", "mass"))
            for k, s in zip(judged, scores, strict=True):
                top = int(np.argmax(s))
                here = float(np.exp(np.maximum(s - s[top], -745)).sum())
                if lang[k] is None or s[top] > best[k]:
                    here += mass[k] * float(np.exp(max(best[k] - s[top], -745))) if lang[k] is not None else 0.0
                    lang[k], best[k], mass[k] = languages[top], float(s[top]), here
                else:
                    mass[k] += here * float(np.exp(max(s[top] - best[k], -745)))
            columns = [b.column("doc_id"), pa.array(lang, pa.string()), pa.array(best, pa.float64()), pa.array(mass, pa.float64())]
            return pa.RecordBatch.from_arrays(columns + ([] if last else [b.column("text")]), ["doc_id", "lang_pred", "best", "mass"] + ([] if last else ["text"]))

        return run

    return make


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``; learned where crc32 of the id modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    # a null id is in no fold that learns
    languages, matrix = learn(docs.where(crc_mod("doc_id", 4) != 2))
    return classify(docs, languages, matrix).select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
