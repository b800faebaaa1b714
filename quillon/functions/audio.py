"""Audio cells: WAV bytes to mono samples, padding, resampling, confidences of decoders."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the fewest samples that a recogniser takes.
MIN_SAMPLES = 1600

_TYPE = pa.struct([("samples", pa.list_(pa.float32())), ("rate", pa.int32())])


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(mean of the channels as float32 in -1 to 1, sample rate) of PCM WAV bytes."""
    with wave.open(io.BytesIO(data)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << 8 * width - 1)
    return x.reshape(-1, channels).mean(axis=1, dtype=np.float32), rate


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation to another rate; as it is where the rates agree."""
    if rate == target or not len(x):
        return x
    n = int(round(len(x) * target / rate))
    return np.interp(np.arange(n) * rate / target, np.arange(len(x)), x).astype(np.float32)


def _decoder(target: int | None, at_least: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for cells in batches:
            rows = []
            for data in cells.to_pylist():
                if not data:
                    rows.append(None)
                    continue
                x, rate = decode_wav(data)
                if target:
                    x, rate = resample(x, rate, target), target
                rows.append({"samples": np.pad(x, (0, max(0, at_least - len(x)))), "rate": rate})
            yield pa.array(rows, _TYPE)

    return run


def decode_audio(data: Column, target_rate: int | None = None, at_least: int = 0) -> Column:
    """struct<samples, rate> of WAV bytes: mono, at target_rate if given, padded with zeros to at_least samples. Null for no bytes."""
    return F.arrow_udf(_decoder(target_rate, at_least), "samples array<float>, rate int")(data)


def mono(channels: Column) -> Column:
    """Mean over the first axis of an array of channels."""
    first = F.transform(channels[0], lambda x: x.cast("double"))
    rest = F.slice(channels, 2, F.greatest(F.size(channels) - 1, F.lit(0)))
    added = F.aggregate(rest, first, lambda acc, c: F.zip_with(acc, c, lambda a, b: a + b))
    return F.transform(added, lambda x: (x / F.size(channels)).cast("float"))


def pad_samples(samples: Column, at_least: int = MIN_SAMPLES) -> Column:
    return F.concat(samples, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(0), F.lit(at_least) - F.size(samples))))


def log_confidence(log_probs: Column) -> Column:
    """exp of the mean log probability, 1 at most; null for none."""
    n = F.size(log_probs)
    total = F.aggregate(log_probs, F.lit(0.0), lambda a, x: a + x)
    return F.when(n > 0, F.exp(F.least(F.lit(0.0), total / n)))
