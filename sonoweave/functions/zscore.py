"""Z-scores against population statistics, their clamp, threshold and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label vocabularies, edges of the five levels, the clamp and the annotation threshold.
LEVELS = ("xlow", "low", "normal", "high", "xhigh")
SPEED_LEVELS = ("xslow", "slow", "normal", "fast", "xfast")
VOLUME_LEVELS = ("whisper", "soft", "normal", "loud", "shout")
EDGES = (-1.5, -0.5, 0.5, 1.5)
CLAMP = 3.0
THRESHOLD = 0.5
# Pause levels, each up to its bound in seconds; longer pauses are of the last.
PAUSE_LEVELS = (("none", 0.2), ("short", 0.5), ("medium", 0.9), ("long", 1.5), ("xlong", None))


def clean(x: Column) -> Column:
    """Null for NaN, which would otherwise compare as greater than any number."""
    return F.when(~F.isnan(x), x)


def population_z(value: Column, mean: Column, std: Column) -> Column:
    """``(value - mean) / std``; null unless ``std`` is positive (absent statistics are null after a left join)."""
    return F.when(std > 0, (clean(value) - clean(mean)) / std)


def annotated(z: Column, threshold: float = THRESHOLD) -> Column:
    """Is the score beyond the threshold (strictly)?  Never for null and NaN."""
    return F.coalesce(F.abs(clean(z)) > F.lit(threshold), F.lit(False))


def clamped(z: Column) -> Column:
    return F.when(z.isNotNull(), F.greatest(F.lit(-CLAMP), F.least(F.lit(CLAMP), z)))


def level(z: Column, labels: Sequence[str] = LEVELS) -> Column:
    """One of five labels; an edge belongs to the level nearer to normal.  Null for null and NaN."""
    z = clean(z)
    a, b, c, d = EDGES
    return (
        F.when(z < a, labels[0]).when(z < b, labels[1]).when(z <= c, labels[2]).when(z <= d, labels[3]).when(z.isNotNull(), labels[4])
    )


def shown(z: Column, labels: Sequence[str] = LEVELS, as_number: bool = False) -> Column:
    """The label, or the clamped score with two decimals, as a string."""
    return number(F.round(clamped(clean(z)), 2)) if as_number else level(z, labels)


def number(x: Column) -> Column:
    """Shortest decimal form of a double: ``2.7``, ``-3.0``, without an exponent for large numbers."""
    plain = F.regexp_replace(x.try_cast("decimal(30,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(x) < 1e7, x.cast("string")).otherwise(F.coalesce(plain, x.cast("string")))


def pause_level(gap: Column, levels: Sequence[tuple[str, float | None]] = PAUSE_LEVELS) -> Column:
    """The first level whose bound the gap is below, else the last; null for null and NaN."""
    gap = clean(gap)
    out = F.when(gap.isNull(), F.lit(None).cast("string"))
    for name, bound in levels:
        if bound is not None:
            out = out.when(gap < F.lit(bound), name)
    return out.otherwise(levels[-1][0])


# Emotion labels in the order of the score vectors, those that are never shown.
EMOTIONS = ("angry", "disgusted", "fearful", "happy", "neutral", "other", "sad", "surprised", "unknow")
SILENT_EMOTIONS = ("neutral", "other", "unknow")


def top_emotions(scores: Column, least: float = 0.3, most: int = 2) -> Column:
    """The best-scored labels joined by ``+``: at least ``least``, never a silent one, ties in label order; null if none.

    Null and NaN scores do not count; a vector shorter than the labels lacks the rest.
    """
    labels = F.array(*[F.lit(e) for e in EMOTIONS])
    pairs = F.transform(labels, lambda name, i: F.struct((-F.get(scores, i)).alias("s"), i.alias("i"), name.alias("name")))
    kept = F.filter(
        pairs, lambda p: ~p["name"].isin(*SILENT_EMOTIONS) & p["s"].isNotNull() & ~F.isnan(p["s"]) & (p["s"] <= F.lit(-least))
    )
    names = F.transform(F.slice(F.array_sort(kept), 1, most), lambda p: p["name"])
    return F.when(F.size(names) > 0, F.array_join(names, "+"))
