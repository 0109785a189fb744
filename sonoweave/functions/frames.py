"""Time slices of frame arrays, as higher-order functions on one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once.

    Catalyst copies an expression to each place it is used; inside a lambda it would run for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hop_length(sr: Column, hop_ms: int = 10) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(hop_ms) * sr / 1000).cast("int"))


def fft_length(sr: Column, frame_ms: int) -> Column:
    """Power of two nearest (in its exponent, half up) to the frame's samples."""
    samples = F.floor(F.lit(frame_ms) * sr / 1000)
    return F.pow(F.lit(2.0), F.floor(F.log2(samples) + 0.5)).cast("int")


def frame_index(seconds: Column, sr: Column, hop: Column) -> Column:
    """Frame of a time, truncated toward zero; the operands keep this order since the product is rounded.

    Times beyond any recording are cut to a bound that no frame number reaches.
    """
    return F.greatest(F.lit(-1e15), F.least(F.lit(1e15), seconds * (sr / hop))).cast("bigint")


def time_slice(frames: Column, start: Column, end: Column, sr: Column, hop: Column) -> Column:
    """Frames of ``start..end``; empty for empty, reversed or null spans and for null frames.

    A negative index counts from the end, as array slices do.
    """
    n = F.size(frames)
    index = lambda t: frame_index(t, sr, hop)
    clip = lambda i: F.least(F.when(i < 0, F.greatest(i + n, F.lit(0))).otherwise(i), n)
    a, b = clip(index(start)), clip(index(end))
    empty = F.array().cast("array<double>")
    ok = frames.isNotNull() & start.isNotNull() & end.isNotNull() & ~F.isnan(start) & ~F.isnan(end)
    part = F.slice(frames, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")).cast("array<double>")
    return F.when(ok, part).otherwise(empty)


def mean(values: Column) -> Column:
    """Mean of an array; null if it is empty."""
    return let(values, lambda v: F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)))


def mean_or_zero(values: Column) -> Column:
    """Mean of an array; 0.0 if it is empty."""
    return F.coalesce(mean(values), F.lit(0.0))


def voiced(f0: Column) -> Column:
    """Positive frames (0 marks an unvoiced one)."""
    return F.filter(f0, lambda x: (x > 0) & ~F.isnan(x))


def speaker_baseline(f0: Column, least_frames: int = 5, least_std: float = 10.0) -> Column:
    """``struct(mean, std)`` of all voiced frames, sample deviation of at least ``least_std``; null under ``least_frames``.

    One pass over the frames, with the running mean and squares about it.
    """
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1
        new = acc["mean"] + (x - acc["mean"]) / n
        return F.struct(n.alias("n"), new.alias("mean"), (acc["m2"] + (x - acc["mean"]) * (x - new)).alias("m2"))

    def finish(acc: Column) -> Column:
        std = F.greatest(F.sqrt(acc["m2"] / (acc["n"] - 1)), F.lit(least_std))
        return F.when(acc["n"] >= least_frames, F.struct(acc["mean"].alias("mean"), std.alias("std")))

    return F.aggregate(voiced(f0.cast("array<double>")), start, add, finish)


def percentile_10(values: Column) -> Column:
    """Linearly interpolated tenth percentile of an array; null if it is empty."""

    def pick(ordered: Column) -> Column:
        at = (F.size(ordered) - 1) * F.lit(0.1)
        lo = F.floor(at).cast("int")
        low = F.get(ordered, lo)
        high = F.coalesce(F.get(ordered, lo + 1), low)
        return F.when(F.size(ordered) > 0, low + (high - low) * (at - lo))

    return let(F.sort_array(values), pick)


def trim_silence(frames: Column, start: Column, end: Column, sr: Column, hop: Column, floor: float = 0.002) -> Column:
    """``struct(start, end)`` of a word moved to its first and last frame above ``max(10th percentile, floor)``.

    The end is the last loud frame's own time.  Unchanged if there is no frame or none is loud.
    """
    first, rate = frame_index(start, sr, hop), sr / hop

    def move(loud: Column) -> Column:
        moved = F.struct(
            ((first + F.get(loud, F.lit(0))) / rate).alias("start"), ((first + F.get(loud, F.size(loud) - 1)) / rate).alias("end")
        )
        return F.when(F.size(loud) > 0, moved).otherwise(F.struct(start.alias("start"), end.alias("end")))

    def loud_frames(part: Column) -> Column:
        above = lambda limit: F.filter(F.transform(part, lambda x, i: F.when(x > limit, i)), lambda i: i.isNotNull())
        return let(F.greatest(percentile_10(part), F.lit(floor)), above)

    return let(let(time_slice(frames, start, end, sr, hop), loud_frames), move)
