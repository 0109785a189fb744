"""Control extractors: ``words`` (and frames, scores, statistics) to rows of controls.

Every extractor returns ``utt_id, ext_order, type, value, value_num, pos, info``.
``value`` is a label, or a number where ``as_number`` is set; ``value_num`` is
always the number.  ``pos`` is the first word of what is annotated.

``words`` are a table of words or listed rows (words with their clause rows, see
``segments.listed_rows``); clauses then have the times of their rows, and words
after the last clause row are in none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoweave.functions import frames as A
from sonoweave.functions import text as T
from sonoweave.functions import zscore as Z
from sonoweave.operators import segments as G

#: Order of extraction by type.
ORDER = {t: i for i, t in enumerate(("style", "break", "speed", "volume", "pitch", "emphasis", "emotion"))}


def about_utterances(utterances: DataFrame) -> DataFrame:
    """``utt_id, lang, style`` once per utterance, in lower case without padding; null style is ``read``."""
    return utterances.groupBy("utt_id").agg(
        F.min(F.lower(F.trim("lang"))).alias("lang"), F.coalesce(F.min(F.lower(F.trim("style"))), F.lit("read")).alias("style")
    )


def _control(kind: str, value: Column, number: Column, pos: str, info: Column) -> list[Column]:
    return [
        F.col("utt_id"), F.lit(ORDER[kind]).alias("ext_order"), F.lit(kind).alias("type"), value.alias("value"),
        number.cast("double").alias("value_num"), F.col(pos).cast("int").alias("pos"), info.alias("info"),
    ]


def _with_stats(df: DataFrame, about: DataFrame, stats: DataFrame, feature: str, suffix: str = "") -> DataFrame:
    """Add ``mean, std`` of a feature for the row's language and style; null where there are none.

    An utterance that ``about`` does not know counts as one without language and style.
    """
    group = about.select("utt_id", F.col("lang").alias("_l"), F.col("style").alias("_s"))
    known = stats.where(F.col("feature") == feature).groupBy("lang_style").agg(F.max("mean").alias(f"mean{suffix}"), F.max("std").alias(f"std{suffix}"))
    known = known.withColumnRenamed("lang_style", "_k")
    joined = df.join(group, "utt_id", "left").withColumn("_g", T.lang_style(F.col("_l"), F.col("_s")))
    return joined.join(known, F.col("_g") == F.col("_k"), "left").drop("_g", "_k", "_l", "_s")


def _scored(df: DataFrame, kind: str, labels: Sequence[str], as_number: bool, info: Column) -> DataFrame:
    """Rows with a ``z`` beyond the threshold as controls."""
    number = F.round(Z.clamped(F.col("z")), 2)
    return df.where(Z.annotated(F.col("z"))).select(*_control(kind, Z.shown(F.col("z"), labels, as_number), number, "first_pos", info))


def style_controls(words: DataFrame, about: DataFrame) -> DataFrame:
    """The utterance's style at its first word."""
    first = G.only_words(words).groupBy("utt_id").agg(F.min("pos").alias("pos"))
    rows = first.join(about.select("utt_id", "style"), "utt_id", "left").withColumn("style", F.coalesce("style", F.lit("read")))
    return rows.select(*_control("style", F.col("style"), F.lit(None), "pos", F.concat(F.lit("style="), F.col("style"))))


def pause_controls(words: DataFrame, as_number: bool = False, levels=Z.PAUSE_LEVELS) -> DataFrame:
    """A pause before a word, unless it is of the first level (overlaps and null times are)."""
    rows = G.pauses(G.only_words(words)).withColumn("level", Z.pause_level(F.col("gap"), levels)).where(F.col("level") != levels[0][0])
    rounded = F.round("gap", 1)
    where = F.when(F.col("inter_clause"), "inter_clause").otherwise("intra_clause")
    info = F.format_string("duration=%.2fs, %s", F.col("gap"), where)
    return rows.select(*_control("break", Z.number(rounded) if as_number else F.col("level"), rounded, "pos", info))


def clause_speeds(words: DataFrame) -> DataFrame:
    """``utt_id, clause_id, first_pos, n_words, duration, speed`` of clauses with a positive effective duration."""
    rows = G.clauses(words).where("closed").withColumn("duration", G.effective_duration())
    return rows.where(F.col("duration") > 0).select(
        "utt_id", "clause_id", "first_pos", "n_words", "duration", (F.col("n_words") / F.col("duration")).alias("speed")
    )


def speed_controls(words: DataFrame, about: DataFrame, stats: DataFrame, as_number: bool = False) -> DataFrame:
    rows = _with_stats(clause_speeds(words), about, stats, "speed")
    rows = rows.withColumn("z", Z.population_z(F.col("speed"), F.col("mean"), F.col("std")))
    return _scored(rows, "speed", Z.SPEED_LEVELS, as_number, F.format_string("speed=%.2fword/s, z=%.2f", "speed", "z"))


#: Spans of one utterance that meet its frames at once.
SPANS = 1024


def span_values(spans: DataFrame, frames: DataFrame, keep: Sequence[str], value, at: str = "first_pos") -> DataFrame:
    """``utt_id``, the ``keep`` columns and ``v = value(frames row, start, end)`` per span.

    The spans of an utterance meet its frames as arrays of those that lie in one stretch of positions (``at``),
    so a row holds a bounded number of them and frames are copied per stretch, not per span.
    """
    bounds = [c for c in ("start", "end") if c not in keep]
    stretch = F.floor(F.coalesce(F.col(at), F.lit(0)) / F.lit(SPANS)).alias("_at")
    grouped = spans.groupBy("utt_id", stretch).agg(F.collect_list(F.struct(*keep, *bounds)).alias("_spans"))
    rows = grouped.join(frames, "utt_id")
    each = F.transform("_spans", lambda s: F.struct(*[s[k].alias(k) for k in keep], value(s["start"], s["end"]).alias("v")))
    return rows.select("utt_id", F.explode(each).alias("_x")).select("utt_id", *[F.col(f"_x.{k}").alias(k) for k in keep], F.col("_x.v").alias("v"))


def _energy(start: Column, end: Column) -> Column:
    return A.mean_or_zero(A.time_slice(F.col("energy"), start, end, F.col("sr"), F.col("hop")))


def clause_energies(words: DataFrame, frames: DataFrame) -> DataFrame:
    """``utt_id, clause_id, first_pos, text, v``: mean energy of each clause, 0 where it has no frame."""
    return span_values(G.clauses(words).where("closed"), frames, ["clause_id", "first_pos", "text"], _energy)


def volume_controls(words: DataFrame, frames: DataFrame, about: DataFrame, stats: DataFrame, as_number: bool = False) -> DataFrame:
    rows = _with_stats(clause_energies(words, frames), about, stats, "energy")
    rows = rows.withColumn("z", Z.population_z(F.col("v"), F.col("mean"), F.col("std")))
    return _scored(rows, "volume", Z.VOLUME_LEVELS, as_number, F.format_string("[%s] energy=%.4f, z=%.2f", F.coalesce("text", F.lit("")), "v", "z"))


def _pitch_z(start: Column, end: Column, least: int) -> Column:
    """Speaker-relative score of a span's mean pitch; null without a baseline or with fewer than ``least`` voiced frames."""

    def score(part: Column) -> Column:
        z = lambda m: F.struct(
            F.when(F.size(part) >= least, (m - F.col("_base.mean")) / F.col("_base.std")).alias("z"), m.alias("f0"), F.col("_base").alias("base")
        )
        return A.let(A.mean(part), z)

    return A.let(A.voiced(A.time_slice(F.col("f0"), start, end, F.col("sr"), F.col("f0_hop"))), score)


def _with_baseline(frames: DataFrame) -> DataFrame:
    return frames.withColumn("_base", A.speaker_baseline(F.col("f0")))


def clause_pitches(words: DataFrame, frames: DataFrame) -> DataFrame:
    rows = span_values(G.clauses(words).where("closed"), _with_baseline(frames), ["clause_id", "first_pos"], lambda s, e: _pitch_z(s, e, 5))
    return rows.select("utt_id", "clause_id", "first_pos", F.col("v.f0").alias("f0"), F.col("v.z").alias("z"), F.col("v.base").alias("base"))


def pitch_controls(words: DataFrame, frames: DataFrame, as_number: bool = False) -> DataFrame:
    """Clauses with at least five voiced frames whose mean pitch stands out for the speaker."""
    info = F.format_string("f0=%.1fHz, speaker=%.1f±%.1fHz, z=%.2f", F.col("f0"), F.col("base.mean"), F.col("base.std"), F.col("z"))
    return _scored(clause_pitches(words, frames), "pitch", Z.LEVELS, as_number, info)


def emphasis_scores(
    words: DataFrame, frames: DataFrame, about: DataFrame, stats: DataFrame, w_energy: float = 0.4, w_duration: float = 0.3, w_pitch: float = 0.3
) -> DataFrame:
    """``utt_id, wi, pos, clause_id, text, ze, zd, zp, z``: the scores, and the weighted mean of those of energy, duration and pitch that the word has."""
    value = lambda s, e: F.struct(_energy(s, e).alias("energy"), _pitch_z(s, e, 3)["z"].alias("zp"))
    rows = span_values(G.only_words(words), _with_baseline(frames), ["wi", "pos", "clause_id", "text", "start", "end"], value, at="pos")
    rows = _with_stats(rows, about, stats, "word_energy", "_e")
    rows = _with_stats(rows, about, stats, "word_duration", "_d")
    parts = [
        (w_energy, Z.population_z(F.col("v.energy"), F.col("mean_e"), F.col("std_e"))),
        (w_duration, Z.population_z(F.col("end") - F.col("start"), F.col("mean_d"), F.col("std_d"))),
        (w_pitch, Z.clean(F.col("v.zp"))),
    ]
    total = sum((F.coalesce(F.lit(w) * z, F.lit(0.0)) for w, z in parts), F.lit(0.0))
    weight = sum((F.when(z.isNotNull(), w).otherwise(0.0) for w, z in parts), F.lit(0.0))
    scores = [z.alias(name) for (_, z), name in zip(parts, ("ze", "zd", "zp"), strict=True)]
    return rows.select("utt_id", "wi", "pos", "clause_id", "text", *scores, F.try_divide(total, weight).alias("z"))


def emphasis_controls(
    words: DataFrame, frames: DataFrame, about: DataFrame, stats: DataFrame, as_number: bool = False, threshold: float = 1.0, **weights
) -> DataFrame:
    """Words whose composite score is above the threshold (only upward)."""
    rows = emphasis_scores(words, frames, about, stats, **weights).where(F.coalesce(F.col("z") > threshold, F.lit(False)))
    number = F.round(Z.clamped(F.col("z")), 2)
    known = F.concat_ws(", ", *[F.when(F.col(f"z{k}").isNotNull(), F.format_string(f"{k}=%.2f", f"z{k}")) for k in "edp"])
    info = F.format_string("[%s] composite_z=%.2f (%s)", F.coalesce("text", F.lit("")), F.col("z"), known)
    return rows.select(*_control("emphasis", Z.number(number) if as_number else F.lit("emphasis"), number, "pos", info))


def emotion_controls(words: DataFrame, scores: DataFrame, least: float = 0.3, most: int = 2) -> DataFrame:
    """The best emotions of a sentence at its first word; scores of sentences without words are ignored."""
    first = G.only_words(words).groupBy("utt_id", "sent_id").agg(F.min("pos").alias("pos"))
    best = scores.select("utt_id", "sent_id", Z.top_emotions(F.col("scores"), least, most).alias("value")).where("value IS NOT NULL").distinct()
    info = F.concat(F.lit("emo="), F.col("value"))
    return first.join(best, ["utt_id", "sent_id"]).select(*_control("emotion", F.col("value"), F.lit(None), "pos", info))
