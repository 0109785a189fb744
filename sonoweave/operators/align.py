"""Model outputs as pluggable providers, and what is derived from them.

No model is part of this package.  A provider turns utterances into the table a
model would give; the default reads such a table.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoweave.functions import text as T
from sonoweave.operators import segments as G


class Provider(Protocol):
    """``rows(utterances) -> DataFrame`` with ``utt_id`` and the provider's own columns."""

    def rows(self, utterances: DataFrame) -> DataFrame: ...


class TableProvider:
    """A table of model outputs made elsewhere, restricted to the utterances asked for."""

    def __init__(self, table: DataFrame):
        self.table = table

    def rows(self, utterances: DataFrame) -> DataFrame:
        return self.table.join(utterances.select("utt_id").distinct(), "utt_id", "left_semi")


class SyntheticAligner:
    """Alignment items by the fixed rule of :func:`segments.synthetic_times`; not an alignment of anything."""

    def rows(self, utterances: DataFrame) -> DataFrame:
        words = G.synthetic_times(G.text_words(utterances, "utt_id"), "utt_id", F.lit(0))
        return words.select("utt_id", F.col("wi").alias("item_idx"), (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"))


def with_text_and_language(utterances: DataFrame, recogniser: Provider) -> DataFrame:
    """Fill what is missing of ``text`` and ``lang`` from the recogniser (``utt_id, text, language``); languages in lower case.

    Only utterances that lack either reach the recogniser.
    """
    whole = F.col("text").isNotNull() & F.col("lang").isNotNull()
    heard = recogniser.rows(utterances.where(~whole)).select("utt_id", F.col("text").alias("_t"), F.col("language").alias("_l"))
    filled = utterances.where(~whole).join(heard, "utt_id", "left").withColumn("text", F.coalesce("text", "_t")).withColumn("lang", F.coalesce("lang", "_l")).drop("_t", "_l")
    return utterances.where(whole).unionByName(filled).withColumn("lang", F.lower("lang"))


def detected_languages(utterances: DataFrame, recogniser: Provider) -> DataFrame:
    """``utt_id, lang``: the recogniser's language of every utterance, lower case."""
    return recogniser.rows(utterances).select("utt_id", F.lower("language").alias("lang"))


def align(utterances: DataFrame, aligner: Provider, recogniser: Provider | None = None, frames: DataFrame | None = None) -> DataFrame:
    """Words with times, clauses and sentences of utterances: ``utt_id, wi, pos, clause_id, sent_id, text, start, end``.

    Texts must be there or come from the recogniser; a language that the aligner does not know raises when the
    rows are computed.  With ``frames``, silence is trimmed off the words.
    """
    if recogniser is not None:
        utterances = with_text_and_language(utterances, recogniser)
    checked = utterances.where(F.col("text").isNotNull()).withColumn("_l", T.language_name(F.col("lang"), strict=True))
    checked = checked.where(F.col("_l").isNotNull() | F.col("lang").isNull()).drop("_l")
    words = G.attach_times(G.text_tokens(checked, "utt_id", "ti"), aligner.rows(checked))
    if frames is not None:
        words = G.trimmed_words(words, frames)
    return G.with_groups(words).select("utt_id", "wi", "pos", "clause_id", "sent_id", "text", "start", "end")
