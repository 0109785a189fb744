"""Quality of control runs: density, distribution, clamped scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoweave.operators.segments import only_words

SCORED = ("speed", "volume", "pitch", "emphasis")


def density(controls: DataFrame, words: DataFrame, about: DataFrame) -> DataFrame:
    """``lang, utt_id, n_controls, n_words, n_clauses, per_word, per_clause``: per utterance, language and in all (nulls).

    Style controls do not count.
    """
    counted = controls.where(F.col("type") != "style").groupBy("utt_id").agg(F.count("*").alias("c"))
    size = only_words(words).groupBy("utt_id").agg(F.count("*").alias("w"), F.countDistinct("clause_id").alias("cl"))
    rows = size.join(counted, "utt_id", "left").join(about.select("utt_id", "lang"), "utt_id", "left")
    rows = rows.select(F.coalesce("lang", F.lit("unknown")).alias("lang"), "utt_id", "w", "cl", F.coalesce("c", F.lit(0)).alias("c"))
    total = rows.rollup("lang", "utt_id").agg(F.sum("c").alias("n_controls"), F.sum("w").alias("n_words"), F.sum("cl").alias("n_clauses"))
    return total.select(
        "lang", "utt_id", "n_controls", "n_words", "n_clauses",
        F.round(F.try_divide(F.col("n_controls"), F.col("n_words")), 6).alias("per_word"),
        F.round(F.try_divide(F.col("n_controls"), F.col("n_clauses")), 6).alias("per_clause"),
    )


def label_counts(controls: DataFrame) -> DataFrame:
    """``type, value, n``, with ``value`` null for a type's total and both null for all."""
    rows = controls.select("type", F.coalesce("value", F.lit("None")).alias("value"))
    return rows.rollup("type", "value").agg(F.count("*").alias("n"))


def clamp_rates(controls: DataFrame, clamp: float = 3.0) -> DataFrame:
    """``type, n, n_clamped, rate, mean_z, sd_z`` of scored controls with a number."""
    rows = controls.where(F.col("type").isin(*SCORED) & F.col("value_num").isNotNull() & ~F.isnan("value_num"))
    hit = (F.abs("value_num") >= clamp).cast("bigint")
    return rows.groupBy("type").agg(
        F.count("*").alias("n"), F.sum(hit).alias("n_clamped"), F.round(F.avg(hit), 6).alias("rate"),
        F.round(F.avg("value_num"), 6).alias("mean_z"), F.round(F.coalesce(F.stddev_samp("value_num"), F.lit(0.0)), 6).alias("sd_z"),
    )
