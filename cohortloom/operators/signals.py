"""Multi-channel signals held as ``array<array<float>>``, one array per channel."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.rules import LEAD_ORDER


def _finite(sample: Column) -> Column:
    sample = sample.cast("double")
    infinite = F.abs(sample) == F.lit(float("inf"))
    return F.when(sample.isNull() | F.isnan(sample) | infinite, F.lit(0.0)).otherwise(sample)


def _z_score(channel: Column) -> Column:
    """Zero mean, unit population variance, as two passes over one array."""
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda so_far, x: so_far + x)

    mean = F.try_divide(total(channel), F.size(channel))
    centred = F.transform(channel, lambda x: x - mean)
    squares = F.transform(centred, lambda x: x * x)
    sd = F.sqrt(F.try_divide(total(squares), F.size(channel))) + F.lit(1e-8)
    return F.transform(centred, lambda x: (x / sd).cast("float"))


def normalise_signal(
    df: DataFrame, names: str, signal: str, leads: Sequence[str] = LEAD_ORDER,
    out: str = "normalised",
) -> DataFrame:
    """Channels in a fixed order, cleaned of NaN/Inf and z-scored one by one.

    Names match whatever their case or padding; a channel that is absent is
    all zeros, as long as the longest channel that is there.
    """
    known = F.transform(F.col(names), lambda n: F.upper(F.trim(n)))
    length = F.greatest(F.coalesce(F.array_max(F.transform(
        F.col(signal), lambda c: F.coalesce(F.size(c), F.lit(0)))), F.lit(0)), F.lit(0))
    wanted = F.array(*[F.lit(lead.upper()) for lead in leads])

    def pick(lead: Column) -> Column:
        found = F.get(F.col(signal), (F.array_position(known, lead) - 1).cast("int"))
        silent = F.array_repeat(F.lit(0.0), length)
        return F.coalesce(F.transform(found, _finite), silent)

    ordered = df.withColumn("_ordered", F.transform(wanted, pick))
    return ordered.withColumn(out, F.transform("_ordered", _z_score)).drop("_ordered")


def fourier_resample(samples: np.ndarray, length: int) -> np.ndarray:
    """Rows of ``samples`` resampled to ``length`` points by their spectrum."""
    present = samples.shape[-1]
    if present == length:
        return samples
    shared = min(present, length)
    spectrum = np.fft.rfft(samples, axis=-1)[..., : shared // 2 + 1]
    if shared % 2 == 0:
        # The bin at the shorter length's Nyquist frequency stands for a pair
        # of bins in the longer one.
        spectrum[..., -1] *= 2.0 if length < present else 0.5
    return np.fft.irfft(spectrum, length, axis=-1) * (length / present)


def resample_signal(df: DataFrame, signal: str, length: int) -> DataFrame:
    """Every channel brought to ``length`` samples.

    Channels of one length in an Arrow batch go through one transform together. A
    null signal or channel stays null; an empty channel becomes silence.
    """
    kind = T.ArrayType(T.ArrayType(T.FloatType()))
    schema = T.StructType(
        [T.StructField(f.name, kind) if f.name == signal else f for f in df.schema.fields]
    )

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            resized = [None if rows is None else [None] * len(rows) for rows in frame[signal]]
            by_length: dict[int, list] = {}
            for i, rows in enumerate(frame[signal]):
                for k, channel in enumerate(() if rows is None else rows):
                    if channel is not None:
                        by_length.setdefault(len(channel), []).append((i, k, channel))
            for present, own in by_length.items():
                stack = np.array([c for _, _, c in own], "float64").reshape(len(own), present)
                done = fourier_resample(stack, length) if present else np.zeros((len(own), length))
                for (i, k, _), samples in zip(own, done.astype("float32"), strict=True):
                    resized[i][k] = samples
            yield frame.assign(**{signal: resized})

    return df.mapInPandas(batches, schema)
