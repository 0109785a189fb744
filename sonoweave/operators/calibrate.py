"""Population statistics of speech features per language and style."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoweave.operators import controls as C
from sonoweave.operators import segments as G

# The features of a calibration.
FEATURES = ("speed", "energy", "loudness_lufs", "duration", "word_duration", "word_energy")


def group_name(lang: Column, style: Column) -> Column:
    """``lang_style`` as given, languages not folded; a null style is ``read``, a null language ``unknown``."""
    return F.concat_ws("_", F.coalesce(lang, F.lit("unknown")), F.coalesce(style, F.lit("read")))


def _long(df: DataFrame, *features: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return df.select("utt_id", F.explode(each).alias("_f")).select("utt_id", "_f.feature", "_f.value")


def clause_spans(words: DataFrame) -> DataFrame:
    """The clauses that last, with ``start, end, duration`` as calibration takes them."""
    own = lambda c, word: F.when(F.col("closed"), F.col(c)).otherwise(F.col(word))
    rows = G.clauses(words).withColumns({"start": own("start", "first_start"), "end": own("end", "last_end")})
    return rows.withColumn("duration", F.col("end") - F.col("start")).where(F.col("duration") > 0)


def clause_features(words: DataFrame, frames: DataFrame | None = None, loudness: DataFrame | None = None) -> DataFrame:
    """``utt_id, feature, value``: duration and speed of each clause, its mean energy if there are frames, its
    loudness if there is ``loudness(utt_id, clause_id, lufs)`` of the clauses of :func:`clause_spans`.

    A clause has the times of its clause row; words after the last one count from their first start to their
    last end.  Clauses that do not last are skipped as a whole; the speed needs a positive effective duration,
    the energy a frame.
    """
    rows = clause_spans(words)
    effective = G.effective_duration(clamp=True)
    out = _long(rows.withColumn("speed", F.when(effective > 0, F.col("n_words") / effective)), "duration", "speed")
    if frames is not None:
        out = out.unionByName(_frame_feature(rows, frames, "energy", ["clause_id"], "first_pos"))
    if loudness is not None:
        out = out.unionByName(_long(loudness.withColumnRenamed("lufs", "loudness_lufs"), "loudness_lufs"))
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def word_features(words: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """``utt_id, feature, value``: duration of each word that lasts, and its mean energy if there are frames."""
    rows = G.only_words(words).withColumn("word_duration", F.col("end") - F.col("start")).where(F.col("word_duration") > 0)
    out = _long(rows, "word_duration")
    if frames is not None:
        out = out.unionByName(_frame_feature(rows, frames, "word_energy", ["wi"], "pos"))
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _frame_feature(spans: DataFrame, frames: DataFrame, feature: str, keep: list[str], at: str) -> DataFrame:
    from sonoweave.functions import frames as A

    mean = lambda s, e: A.mean(A.time_slice(F.col("energy"), s, e, F.col("sr"), F.col("hop")))
    return C.span_values(spans, frames, keep, mean, at).select("utt_id", F.lit(feature).alias("feature"), F.col("v").alias("value"))


def statistics(features: DataFrame, about: DataFrame) -> DataFrame:
    """``lang_style, feature, n, mean, std``: sample deviation, 0 for one value.  One partial aggregation, whatever the group's size."""
    rows = features.join(about, "utt_id", "left").select(group_name(F.col("lang"), F.col("style")).alias("lang_style"), "feature", "value")
    return rows.groupBy("lang_style", "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std")
    )


def full_grid(stats: DataFrame) -> DataFrame:
    """Every group with every feature; absent ones have ``n = 0, mean = 0, std = 0``."""
    groups = stats.select("lang_style").distinct().select("lang_style", F.explode(F.array(*[F.lit(f) for f in FEATURES])).alias("feature"))
    zero = lambda c, z: F.coalesce(c, F.lit(z)).alias(c)
    return groups.join(stats, ["lang_style", "feature"], "left").select("lang_style", "feature", zero("n", 0), zero("mean", 0.0), zero("std", 0.0))


def calibrate(words: DataFrame, utterances: DataFrame, frames: DataFrame | None = None, loudness: DataFrame | None = None) -> DataFrame:
    """Statistics of all features over all words; each utterance counts all or nothing."""
    features = clause_features(words, frames, loudness).unionByName(word_features(words, frames))
    return full_grid(statistics(features, C.about_utterances(utterances)))


def merge(*parts: DataFrame) -> DataFrame:
    """Statistics of the union of samples from the statistics of each, by their moments.

    The squares about the mean are ``std**2 * (n - 1)`` in each part; those of the union add what the parts'
    means differ from the common one.  Parts with null or no ``n`` add nothing.
    """
    from sonoweave.operators.compose import union

    rows = union([p.select("lang_style", "feature", "n", "mean", "std") for p in parts]).where(F.col("n") > 0)
    n, mean = F.col("n"), F.col("mean")
    sums = rows.groupBy("lang_style", "feature").agg(
        F.sum("n").alias("n"), (F.sum(n * mean) / F.sum(n)).alias("mean"),
        F.sum(F.col("std") * F.col("std") * (n - 1)).alias("inside"), F.sum(n * mean * mean).alias("square"),
    )
    between = F.greatest(F.col("square") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    std = F.when(F.col("n") > 1, F.sqrt((F.col("inside") + between) / (F.col("n") - 1))).otherwise(0.0)
    return sums.select("lang_style", "feature", "n", "mean", std.alias("std"))


def compare(found: DataFrame, shipped: DataFrame) -> DataFrame:
    """Groups and features that both have, side by side with the difference of their means."""
    a = found.select("lang_style", "feature", F.col("n").alias("n_found"), F.col("mean").alias("mean_found"), F.col("std").alias("std_found"))
    b = shipped.select("lang_style", "feature", F.col("n").alias("n_shipped"), F.col("mean").alias("mean_shipped"), F.col("std").alias("std_shipped"))
    return a.join(b, ["lang_style", "feature"]).withColumn("mean_diff", F.col("mean_found") - F.col("mean_shipped"))
