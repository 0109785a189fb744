"""Covered periods and gaps of intervals, by a sweep over boundary events.

Each interval becomes a ``+1`` event at its start and a ``-1`` event at its end.
Events of one instant are summed first, so repeated rows and hot instants
collapse before they are shuffled.  The prefix sum of the events is the number
of intervals open after an instant; where it is zero and another event follows,
there is a gap.

The prefix sum runs in two levels.  Events are split into time buckets per key;
a bucket's total and first instant (one row per bucket) give the count carried
into it and the instant that follows it.  A key that holds a third of all rows
is therefore swept by as many tasks as it has buckets, not by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest magnitude, in ms, that still counts as a time (about 31,700 years).
MAX_MS = 1e15


def to_ms(seconds: Column) -> Column:
    """Whole milliseconds, half away from zero; null for null, NaN and times no clock can hold."""
    ms = F.round(seconds * F.lit(1000.0))
    return F.when(~F.isnan(seconds) & (F.abs(ms) < F.lit(MAX_MS)), ms).cast("bigint")


def active_counts(
    df: DataFrame, keys: Sequence[str], start_ms: str = "start_ms", end_ms: str = "end_ms", bucket_ms: int = 600_000
) -> DataFrame:
    """One row per key and distinct boundary: ``at``, ``active`` (open after it), ``next_at``.

    Rows with a null boundary or an end not after the start are ignored; keys
    may be null (null is a key of its own).  Other columns are not read.
    """
    keys = list(keys)
    boundary = F.explode(
        F.array(
            F.struct(F.col(start_ms).alias("at"), F.lit(1).cast("bigint").alias("d")),
            F.struct(F.col(end_ms).alias("at"), F.lit(-1).cast("bigint").alias("d")),
        )
    )
    events = (
        df.where(F.col(end_ms) > F.col(start_ms))
        .select(*keys, boundary.alias("_e"))
        .select(*keys, F.floor(F.col("_e.at") / F.lit(bucket_ms)).alias("_b"), F.col("_e.at").alias("at"), F.col("_e.d").alias("d"))
        .groupBy(*keys, "_b", "at")
        .agg(F.sum("d").alias("d"))
    )
    by_bucket = Window.partitionBy(*keys, "_b").orderBy("at")
    by_key = Window.partitionBy(*keys).orderBy("_b")
    carried = (
        events.groupBy(*keys, "_b")
        .agg(F.sum("d").alias("_d"), F.min("at").alias("_first"))
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_b").alias("_kb"),
            F.coalesce(F.sum("_d").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry"),
            F.lead("_first").over(by_key).alias("_after"),
        )
    )
    swept = events.select(
        *keys, "_b", "at",
        F.sum("d").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)).alias("_open"),
        F.lead("at").over(by_bucket).alias("_next"),
    )
    same = (F.col("_b") == F.col("_kb"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return swept.join(carried, same).select(
        *keys, "at", (F.col("_open") + F.col("_carry")).alias("active"), F.coalesce("_next", "_after").alias("next_at")
    )


def gaps(df: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Uncovered stretches between intervals of one key: ``gap_from_ms``, ``gap_to_ms``."""
    counts = active_counts(df, keys, **options)
    return counts.where((F.col("active") == 0) & F.col("next_at").isNotNull()).select(
        *keys, F.col("at").alias("gap_from_ms"), F.col("next_at").alias("gap_to_ms")
    )


def covered_periods(df: DataFrame, keys: Sequence[str], bucket_ms: int = 600_000, **options) -> DataFrame:
    """Merged continuous periods of one key: ``from_ms``, ``to_ms``; touching intervals are continuous.

    A period ends at an instant after which the count is zero and starts at the first one or where such a
    stretch ends.  Starts and ends alternate, so the start of a period is the latest at or before its end; it is
    looked for in the end's bucket, and beyond among the buckets' last starts, a row for each.
    """
    keys = list(keys)
    counts = active_counts(df, keys, bucket_ms=bucket_ms, **options)
    ends = counts.where(F.col("active") == 0)
    # each end with what follows it: the start of the next period, if there is one
    marks = F.explode(F.array(F.struct(F.col("at"), F.lit(False).alias("starts")), F.struct(F.col("next_at").alias("at"), F.lit(True).alias("starts"))))
    start, end = options.get("start_ms", "start_ms"), options.get("end_ms", "end_ms")
    first = df.where(F.col(end) > F.col(start)).groupBy(*keys).agg(F.min(start).alias("at")).select(*keys, F.struct("at", F.lit(True).alias("starts")).alias("m"))
    events = ends.select(*keys, marks.alias("m")).unionByName(first).select(*keys, "m.at", "m.starts").where("at IS NOT NULL")
    events = events.withColumn("_b", F.floor(F.col("at") / F.lit(bucket_ms)))
    own = F.when(F.col("starts"), F.col("at"))
    inside = Window.partitionBy(*keys, "_b").orderBy("at", F.desc("starts")).rowsBetween(Window.unboundedPreceding, 0)
    near = events.withColumn("from_ms", F.last(own, ignorenulls=True).over(inside)).where(~F.col("starts"))
    before = Window.partitionBy(*keys).orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    far = (
        events.groupBy(*keys, F.col("_b").alias("_kb")).agg(F.max(own).alias("_last"))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_kb", F.max("_last").over(before).alias("_far"))
    )
    same = F.col("_b") == F.col("_kb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return near.join(far, same).select(*keys, F.coalesce("from_ms", "_far").alias("from_ms"), F.col("at").alias("to_ms"))


def segment_gaps(segments: DataFrame, kinds: Sequence[str] = ("clause", "sentence"), **options) -> DataFrame:
    """Gaps of the clause rows and of the sentence rows of each utterance.

    Columns ``utt_id, seg_type, gap_from_ms, gap_to_ms``.  Redelivered rows add
    the same interval again and change nothing.  A row with a null or
    non-finite time covers nothing.  An empty table gives no row.
    """
    return gaps(_typed(segments, kinds), ["utt_id", "seg_type"], **options)


def segment_periods(segments: DataFrame, kinds: Sequence[str] = ("clause", "sentence"), **options) -> DataFrame:
    """Merged continuous periods, columns ``utt_id, seg_type, from_ms, to_ms``; see :func:`segment_gaps`."""
    return covered_periods(_typed(segments, kinds), ["utt_id", "seg_type"], **options)


def _typed(segments: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return segments.where(F.col("type").isin(*kinds)).select(
        "utt_id", F.col("type").alias("seg_type"), to_ms(F.col("start")).alias("start_ms"), to_ms(F.col("end")).alias("end_ms")
    )
