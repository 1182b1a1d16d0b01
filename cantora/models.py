"""Models as table functions: speech detection, recognition, word timing. The engine has no models; it runs those that it is given.

A model is made once for each Python worker by a factory, and is a function of a file's bytes (for word timing, of its bytes and text) that returns rows. A file that
fails is a row with an error, or fails the job, as the policy says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cantora.sources.audio import samples_of

#: Kinds of models and what they give: intervals of speech, segments, words of a clip, words aligned to a known text.
INTERVALS = "start double, end double"
SEGMENTS = "start double, end double, text string"
WORDS = "word string, start double, end double, probability double"
STOP, GO_ON = "stop", "continue"

_MADE: dict[int, tuple[Callable, Callable]] = {}


def made(factory: Callable[[], Callable]) -> Callable:
    """The worker's model of this factory."""
    key = hash((factory.__module__, factory.__qualname__))
    if key not in _MADE:
        _MADE[key] = factory, factory()
    return _MADE[key][1]


def run_model(files: DataFrame, factory: Callable[[], Callable], schema: str, on_error: str = STOP) -> DataFrame:
    """(path, position, fields of ``schema``, error) per row that the model gives for ``files`` (path, content and, if the model takes it, text). With ``GO_ON`` a file that fails is one row with the
    error and nothing else; a file without rows gives none."""
    names = [f.split()[0] for f in schema.split(", ")]
    with_text = "text" in files.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = made(factory)
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                try:
                    found: Iterable[tuple] = model(bytes(row.content), row.text) if with_text else model(bytes(row.content))
                    out += [(row.path, k, *r, None) for k, r in enumerate(found)]
                except Exception as e:
                    if on_error == STOP:
                        raise
                    out.append((row.path, None, *[None] * len(names), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "position", *names, "error"]).astype({"position": "Int32"})

    return files.mapInPandas(run, f"path string, position int, {schema}, error string")


def speech_by_energy(threshold: float = 0.02, silence: float = 0.3, rate: int = 16_000, frame: float = 0.02) -> Callable[[bytes], list[tuple[float, float]]]:
    """A simple detector, for tests and as a fallback: frames whose root mean square is over the threshold, joined over silences shorter than ``silence``."""

    def detect(content: bytes) -> list[tuple[float, float]]:
        x = samples_of(content, rate)
        step = int(frame * rate)
        loud = np.flatnonzero(np.sqrt((x[: len(x) // step * step].reshape(-1, step) ** 2).mean(1)) > threshold) if len(x) >= step else np.empty(0, int)
        if not len(loud):
            return []
        starts = np.r_[True, np.diff(loud) * frame > silence]
        first, last = loud[starts], loud[np.r_[starts[1:], True]]
        return [(float(a * frame), float((b + 1) * frame)) for a, b in zip(first, last, strict=True)]

    return detect
