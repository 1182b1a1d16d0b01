"""WAV files: durations, decoding, and clips."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DURATION = T.StructType([T.StructField("duration", T.DoubleType()), T.StructField("rate", T.IntegerType()), T.StructField("error", T.StringType())])


def read_audio(spark: SparkSession, path: str, pattern: str = "*.wav", recursive: bool = False) -> DataFrame:
    """(path, content) of audio files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "content")


def duration_of(content: bytes) -> tuple[float | None, int | None, str | None]:
    """(seconds by the header, rate, error)."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            return w.getnframes() / w.getframerate(), w.getframerate(), None
    except (wave.Error, EOFError, ZeroDivisionError) as e:
        return None, None, f"{type(e).__name__}: {e}"


@F.pandas_udf(DURATION)
def wav_duration(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([duration_of(bytes(c or b"")) for c in content], columns=["duration", "rate", "error"]).astype({"rate": "Int32"})


def samples_of(content: bytes, rate: int = 16_000) -> np.ndarray:
    """Mono samples from -1 to 1 at ``rate``: channels are averaged, and rates are changed by linear interpolation."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, own, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(float) / 128 - 1
    elif width in (2, 4):
        x = np.frombuffer(raw, f"<i{width}").astype(float) / (1 << 8 * width - 1)
    else:
        raise wave.Error(f"{8 * width} bits a sample")
    x = x.reshape(-1, channels).mean(1)
    if own == rate or not len(x):
        return x
    n = int(round(len(x) * rate / own))
    return np.interp(np.arange(n) * own / rate, np.arange(len(x)), x)


def wav_of(samples: np.ndarray, rate: int = 16_000) -> bytes:
    """16-bit mono."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def clips(audio: DataFrame, rows: DataFrame, rate: int = 16_000) -> DataFrame:
    """(audio, duration, content) of the clips of ``rows`` (source_audio_path, audio: the clip's name, cut_start, cut_end), cut from ``audio`` (path, content). Audio that can't be decoded gives clips
    without content. A file is decoded once for all its clips; what is written where is up to the caller."""
    cuts = rows.groupBy(F.col("source_audio_path").alias("path")).agg(F.collect_list(F.struct("audio", "cut_start", "cut_end")).alias("cuts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content, wanted in zip(f["content"], f["cuts"], strict=True):
                out = []
                try:
                    x = samples_of(bytes(content), rate)
                except (wave.Error, EOFError):
                    x = None
                for c in wanted:
                    part = None if x is None else x[int(c["cut_start"] * rate) : int(c["cut_end"] * rate)]
                    out.append((c["audio"], None if part is None else len(part) / rate, None if part is None else wav_of(part, rate)))
                yield pd.DataFrame(out, columns=["audio", "duration", "content"])

    return audio.join(cuts, "path").select("content", "cuts").mapInPandas(run, "audio string, duration double, content binary")
