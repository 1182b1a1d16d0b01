"""Quality gates: each gives a status or reason column, rows are routed by filters on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cantora.functions.text import round_half_even, strip, word_count


@dataclass(frozen=True)
class Limits:
    """Inclusive bounds of an accepted segment."""

    score: float = 82.0
    shortest: float = 1.0
    longest: float = 20.0
    slowest: float = 3.0
    fastest: float = 35.0


FIRST_VERSION = Limits(score=75.0)
PART_SECONDS = 1200.015
NO_PACE = 999.0


def chars_per_second(text: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.length(text) / duration).otherwise(NO_PACE)


def accepted(score: Column, duration: Column, pace: Column, limits: Limits = Limits()) -> Column:
    return (score >= limits.score) & duration.between(limits.shortest, limits.longest) & pace.between(limits.slowest, limits.fastest)


def route(has_candidate: Column, structure: Column, good: Column) -> Column:
    """The first reason that holds, or null for an accepted row."""
    return F.when(~has_candidate, "NO_CANDIDATE").when(~structure, "STRUCTURE_FAIL").when(~good, "LOW_SCORE")


def blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def valid_segment(text: Column, start: Column, end: Column) -> Column:
    return ~blank(text) & start.isNotNull() & end.isNotNull()


def metadata_ok(score: Column, text: Column, audio: Column, least: float = 82.0) -> Column:
    return (F.coalesce(score, F.lit(0.0)) >= least) & ~blank(text) & (F.coalesce(audio, F.lit("")) != "")


def legacy_ok(duration: Column, score: Column) -> Column:
    return duration.between(1, 20) & (score >= 85)


def quality_bucket(score: Column) -> Column:
    return F.when(score >= 95, "good").when(score >= 85, "medium").otherwise("bad")


def verdict(confidence: Column, alignment: Column) -> Column:
    mean = (confidence + alignment) / 2
    return F.when(mean >= 0.85, "KEEP").when(mean >= 0.65, "REVIEW").otherwise("REJECT")


def clip_text(text: Column, matched: Column) -> Column:
    """The first text that isn't empty, stripped."""
    return strip(F.coalesce(F.nullif(text, F.lit("")), F.nullif(matched, F.lit("")), F.lit("")))


def clip_ok(audio: Column, text: Column, start: Column, end: Column) -> Column:
    return (F.coalesce(audio, F.lit("")) != "") & (text != "") & F.coalesce(end > start, F.lit(False))


def padded(start: Column, end: Column, total: Column, pad: float = 1.5) -> tuple[Column, Column]:
    """The interval with padding, kept within the audio; an unknown length sets no limit."""
    return F.greatest(F.lit(0.0), start - pad), F.least(total, end + pad)


def padded_ms(start: Column, end: Column, pad: float = 0.2) -> tuple[Column, Column]:
    """Whole milliseconds, cut towards zero."""
    return F.greatest(F.lit(0), ((start - pad) * 1000).cast("long")), ((end + pad) * 1000).cast("long")


def validation_flags(text: Column, audio: Column, real: Column, stated: Column) -> dict[str, Column]:
    """``audio`` is a path, ``real`` its measured duration (null: unreadable)."""
    missing = (F.coalesce(audio, F.lit("")) == "") | real.isNull()
    return {
        "empty_text": blank(text),
        "missing_audio": missing,
        "bad_duration": ~missing & ~real.between(1, 15),
        "duration_mismatch": ~missing & F.coalesce(F.abs(real - stated) > 0.2, F.lit(False)),
    }


def edge_status(first: Column, last: Column, total: Column, kept: Column, edge: float = 0.2) -> Column:
    """Where speech lies within a clip; the first reason wins. ``first`` and ``last`` are null without speech."""
    return (
        F.when(first.isNull(), "no_speech").when(first < edge, f"speech_in_first_{int(edge * 1000)}ms").when(last > total - edge, f"speech_in_last_{int(edge * 1000)}ms")
        .when(kept < 0.8, "too_short").when(kept > 20, "too_long").otherwise("accept")
    )


def trim_window(first: Column, last: Column, total: Column, keep: Column) -> tuple[Column, Column]:
    return F.greatest(F.lit(0), first - keep), F.least(total, last + keep)


@dataclass(frozen=True)
class SpanLimits:
    score: float = 60.0
    text_score: float = 65.0
    probability: float = 0.55
    gap: float = 0.8
    start: float = 1.2
    end: float = 1.2
    count_words: bool = True


OLD_SPANS = SpanLimits(score=70.0, text_score=75.0, count_words=False)


def span_reasons(score: Column, text_score: Column, probability: Column, gap: Column, word_diff: Column, d_start: Column, d_end: Column, limits: SpanLimits = SpanLimits()) -> Column:
    """All reasons against a span, joined by ``|`` in a fixed order; ``OK`` without any. Unknown values give no reason."""
    reasons = [
        F.when(score < limits.score, "LOW_MATCH_SCORE"),
        F.when(text_score < limits.text_score, "LOW_TEXT_SCORE"),
        F.when(probability < limits.probability, "LOW_WORD_PROBABILITY"),
        F.when(gap > limits.gap, "LARGE_WORD_GAP"),
        F.when(F.lit(limits.count_words) & (word_diff > 0), F.concat(F.lit("WORD_COUNT_DIFF="), word_diff.cast("string"))),
        F.when(F.abs(d_start) > limits.start, "DELTA_START_TOO_LARGE"),
        F.when(F.abs(d_end) > limits.end, "DELTA_END_TOO_LARGE"),
    ]
    joined = F.concat_ws("|", *reasons)
    return F.when(joined == "", "OK").otherwise(joined)


def global_time(start: Column, part: Column, length: float = PART_SECONDS) -> Column:
    return start + length * (part - 1)


def floor_div(x: Column, d: float) -> Column:
    """Python's ``//`` for x >= 0: the quotient of what is left without the remainder, which rounding can't lift."""
    return F.round((x - x % F.lit(d)) / d).cast("long")


def part_of(start: Column, length: float = PART_SECONDS) -> Column:
    return floor_div(start, length) + 1


def lookup_error(prefix: Column, start: Column) -> Column:
    return F.when(prefix.isNull(), "MISSING_WHISPER_PREFIX").when(start.isNull(), "MISSING_GLOBAL_START")


def speech_length_ok(start: Column, end: Column, shortest: float = 1.0, longest: float = 20.0) -> Column:
    """Speech intervals that are worth recognizing."""
    return (end - start).between(shortest, longest)


def enough_words(text: Column, least: int = 2) -> Column:
    return word_count(text) >= least


def default_audio(audio: Column, source_file: Column) -> Column:
    """The audio path, else the source file, else nothing."""
    return F.coalesce(audio, source_file, F.lit(""))


def deltas(old_start: Column, old_end: Column, new_start: Column, new_end: Column) -> tuple[Column, Column]:
    return round_half_even(new_start - old_start, 3), round_half_even(new_end - old_end, 3)
