"""The jobs, from files to tables: alignment, factory, metadata, speech groups, span adjustment, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.functions.numbers_vi import clean_text
from cantora.functions.text import round_half_even as rounded
from cantora.operators import joins, match, quality, report, span
from cantora.sources.json_files import row_files, type_name

PREVIOUS_SHIFT = 1.0


def align(segments: DataFrame, captions: DataFrame, limits: quality.Limits = quality.Limits(), shift: float = PREVIOUS_SHIFT) -> DataFrame:
    """A row for each of ``segments`` (job, source_file, source_index, start, end, global_start, global_end, text) with the words of ``captions`` (job, idx, start, text) that it says: reason (null: accepted; else
    NO_CANDIDATE, STRUCTURE_FAIL or LOW_SCORE), score, chars_per_sec, whisper_text, matched_text. The context is the caption before the segment and those that begin in it, each text once. Limits are
    held against exact values; what is shown is rounded, halves to even. Local and global times are both kept, whatever the reason."""
    key = F.struct("job", "source_file", "source_index")
    probes = segments.select(key.alias("seg"), "job", F.col("global_start").alias("s"), F.col("global_end").alias("e"))
    lines = captions.select("job", F.col("idx").cast("long").alias("idx"), F.col("start").cast("double").alias("start"), F.col("text").alias("caption"))
    before = joins.asof_previous(probes.select("seg", "job", "s"), lines.select("job", "idx", "start"), "job", "s", "start", "idx", shift, "previous")
    previous = before.where("previous is not null").join(lines, (before["job"] == lines["job"]) & (F.col("previous") == F.col("idx"))).select("seg", "caption", F.lit(-1).cast("long").alias("at"))
    inside = joins.contained(probes, lines, "job", "s", "e", "start").select("seg", "caption", F.col("idx").alias("at"))
    once = previous.unionAll(inside).groupBy("seg", "caption").agg(F.min("at").alias("at"))
    context = once.groupBy("seg").agg(report.ordered_join("at", "caption").alias("context"))
    rows = segments.withColumn("seg", key).join(context, "seg", "left")
    found = rows.withColumn("m", F.when(F.col("context").isNotNull(), match.best_substring("text", F.coalesce("context", F.lit("")))))
    text, score = F.col("m.matched_text"), F.col("m.score")
    duration = F.col("global_end") - F.col("global_start")
    pace = quality.chars_per_second(text, duration)
    structure = match.structure_pass(match.chunk_sizes(F.col("text")), match.chunk_sizes(text))
    reason = quality.route(F.col("context").isNotNull(), F.coalesce(structure, F.lit(False)), quality.accepted(score, duration, pace, limits))
    shown = F.coalesce(structure, F.lit(False))
    return found.select(
        "job", "source_file", "source_index", "start", "end", rounded(F.col("global_start"), 3).alias("global_start"), rounded(F.col("global_end"), 3).alias("global_end"), reason.alias("reason"),
        rounded(score, 1).alias("score"), F.when(shown, rounded(pace, 2)).alias("chars_per_sec"), F.col("text").alias("whisper_text"), text.alias("matched_text"),
    )


def factory(files: DataFrame) -> DataFrame:
    """All rows of ``files`` (``json_files.read_files``) with reject_reason -- READ_ERROR, BAD_FORMAT, EMPTY_FILE for files, BAD_ROW_TYPE, VALIDATE_FAIL, CLEAN_TEXT_EMPTY for rows, null for kept
    ones -- source_json, source_index, row_type, row (the whole as JSON), the text as it was and cleaned, and audio_path."""
    get = lambda name, kind: F.try_variant_get("row", f"$.{name}", kind)
    rows = row_files(files).withColumn("kind", type_name(F.col("row")))
    original = get("matched_text", "string")
    cleaned = clean_text(original)
    valid = quality.valid_segment(original, get("start", "double"), get("end", "double"))
    reason = F.when(F.coalesce(F.col("kind") != "dict", F.lit(True)), "BAD_ROW_TYPE").when(~valid, "VALIDATE_FAIL").when(cleaned == "", "CLEAN_TEXT_EMPTY")
    numbers = ("start", "end", "global_start", "global_end", "score", "chars_per_sec")
    out = rows.select(
        reason.alias("reject_reason"), F.col("source_file").alias("source_json"), "source_index", F.col("kind").alias("row_type"), F.to_json("row").alias("row"), original.alias("original_matched_text"),
        cleaned.alias("matched_text"), *(get(n, "double").alias(n) for n in numbers), get("whisper_text", "string").alias("whisper_text"), quality.default_audio(get("audio_path", "string"), get("source_file", "string")).alias("audio_path"),
    )
    failed = files.where("file_error is not null").select(F.col("file_error").alias("reject_reason"), F.col("source_file").alias("source_json"))
    return out.unionByName(failed, allowMissingColumns=True)


def factory_counters(rows: DataFrame) -> DataFrame:
    """One row: FILES, KEEP, REJECT (rows), READ_ERROR and BAD_FORMAT (files; an empty one has a bad format). Each file has a row at least."""
    reason = F.col("reject_reason")
    return rows.agg(
        F.count_distinct("source_json").alias("FILES"), F.count_if(reason.isNull()).alias("KEEP"), F.count_if(reason.isin("BAD_ROW_TYPE", "VALIDATE_FAIL", "CLEAN_TEXT_EMPTY")).alias("REJECT"),
        F.count_if(reason == "READ_ERROR").alias("READ_ERROR"), F.count_if(reason.isin("BAD_FORMAT", "EMPTY_FILE")).alias("BAD_FORMAT"),
    )


def metadata(rows: DataFrame, least: float = 82.0) -> DataFrame:
    """Rows of the factory that a training set takes."""
    return rows.where(quality.metadata_ok(F.col("score"), F.col("matched_text"), F.col("audio_path"), least)).select("audio_path", F.col("matched_text").alias("text"), "start", "end", "score", "chars_per_sec", "source_json")


def clip_plan(rows: DataFrame, durations: DataFrame, pad: float = 1.5) -> DataFrame:
    """Clips of ``rows`` (audio_path, text, matched_text, start, end, score, chars_per_sec, source_index) with padding; ``durations``: (path, duration). Rows that fail the guard or whose
    padded interval is empty go."""
    text = quality.clip_text(F.col("text"), F.col("matched_text"))
    good = rows.where(quality.clip_ok(F.col("audio_path"), text, F.col("start"), F.col("end"))).withColumn("text", text)
    timed = good.join(durations.select(F.col("path").alias("audio_path"), F.col("duration").alias("total")), "audio_path", "left")
    start, end = quality.padded(F.col("start"), F.col("end"), F.col("total"), pad)
    cut = timed.withColumns({"cut_start": start, "cut_end": end}).where("cut_end > cut_start")
    return cut.select(
        F.col("audio_path").alias("source_audio_path"), "text", rounded(F.col("cut_end") - F.col("cut_start"), 3).alias("duration"), F.col("start").alias("original_start"), F.col("end").alias("original_end"),
        rounded(F.col("cut_start"), 3).alias("cut_start"), rounded(F.col("cut_end"), 3).alias("cut_end"), F.lit(pad).alias("padding_seconds"), "score", "chars_per_sec", "source_index",
    )


def with_alignment(audio: DataFrame, aligned: DataFrame, name: str) -> DataFrame:
    """Audio files with the alignment of the same ``name``; those without get the reason NO_ALIGNMENT."""
    found = aligned.withColumn("_found", F.lit(True))
    return audio.join(found, name, "left").withColumn("reject_reason", F.when(F.col("_found").isNull(), "NO_ALIGNMENT")).drop("_found")


def speech_groups(spans: DataFrame, segments: DataFrame, key: str, least: int = 2) -> DataFrame:
    """(key, span, start, end, text): recognized ``segments`` (key, seg, s, e, text) that the speech ``spans`` (key, span, vs, ve) of 1 to 20 seconds take, each by the first that it overlaps; groups under ``least`` words go."""
    long_enough = spans.where(quality.speech_length_ok(F.col("vs"), F.col("ve")))
    groups = joins.overlap_first(long_enough, segments, key).groupBy(key, "span").agg(
        rounded(F.min("s"), 2).alias("start"), rounded(F.max("e"), 2).alias("end"), F.trim(report.ordered_join("seg", "text")).alias("text")
    )
    return groups.where(quality.enough_words(F.col("text"), least))


def adjust(rows: DataFrame, how: span.SpanSearch = span.CURRENT, limits: quality.SpanLimits = quality.SpanLimits()) -> DataFrame:
    """New times of clips: ``rows`` (index, audio, text_expected, original_start, original_end, cut_start, segments or words) with the best span's columns, old_, new_ and delta_ times, status and reject_reason. Status
    OK, REJECT (by the judge, or without a span, when the times stay as they were) or NO_WORDS (times unknown)."""
    flat = match.flatten_words(F.col("segments"))
    words = F.when(F.size(F.coalesce("segments", F.array())) > 0, flat).otherwise(F.transform("words", match.word_struct))
    w = rows.withColumn("w", words)
    s, e = F.col("original_start") - F.col("cut_start"), F.col("original_end") - F.col("cut_start")
    found = w.withColumn("m", span.span_udf(how)("text_expected", F.col("w.word"), F.col("w.start"), F.col("w.end"), F.col("w.probability"), s, e))
    none, lost = F.coalesce(F.size("w") == 0, F.lit(True)), F.col("m.reason").isNotNull()
    new = lambda old, at: F.when(none, F.lit(None)).when(lost, F.col(old)).otherwise(rounded(F.col("cut_start") + F.col(f"m.{at}"), 3))
    timed = found.withColumns({"old_start": F.col("original_start"), "old_end": F.col("original_end"), "new_start": new("original_start", "relative_start"), "new_end": new("original_end", "relative_end")})
    d_start, d_end = quality.deltas(F.col("old_start"), F.col("old_end"), F.col("new_start"), F.col("new_end"))
    timed = timed.withColumns({"delta_start": d_start, "delta_end": d_end})
    apart = F.abs(F.col("m.word_count") - F.col("m.expected_word_count"))
    judged = quality.span_reasons(F.col("m.score"), F.col("m.text_score"), F.col("m.avg_word_probability"), F.col("m.max_word_gap"), apart, F.col("delta_start"), F.col("delta_end"), limits)
    reason = F.when(none, "NO_WORDS").when(lost, F.col("m.reason")).otherwise(judged)
    status = F.when(none, "NO_WORDS").when(reason == "OK", "OK").otherwise("REJECT")
    columns = ["index", "audio", "text_expected", "cut_start", "old_start", "old_end", "new_start", "new_end", "delta_start", "delta_end"]
    return timed.select(*columns, status.alias("status"), reason.alias("reject_reason"), *(F.col(f"m.{n}").alias(n) for n, _ in span.FIELDS if n != "reason"))


def aligned_status(score: Column, reason: Column, least: float = 70.0) -> Column:
    """Statuses of the search over forced alignments: OK, LOW_SCORE, NO_GOOD_SPAN, NO_WORDS."""
    return F.when(reason == "NO_WORDS", "NO_WORDS").when(reason.isNotNull(), "NO_GOOD_SPAN").when(score < least, "LOW_SCORE").otherwise("OK")


def validate(rows: DataFrame, durations: DataFrame) -> DataFrame:
    """One row of counts and figures over ``rows`` (audio, text, duration): empty_text, missing_audio, bad_duration, duration_mismatch, minutes and bounds of the real ``durations`` (path, duration)."""
    real = rows.join(durations.select(F.col("path").alias("audio"), F.col("duration").alias("real")), "audio", "left")
    flags = quality.validation_flags(F.col("text"), F.col("audio"), F.col("real"), F.col("duration"))
    return real.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in flags.items()), (F.sum("real") / 60).alias("minutes"), F.min("real").alias("shortest"), F.max("real").alias("longest"), F.avg("real").alias("mean"))
