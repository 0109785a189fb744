"""Control text in one pass over the words.

All seven extractors are computed from one lineage.  The segment list is read
(in blocks), grouped into clauses, and clauses into stretches of an utterance; a
stretch meets the utterance's facts and frames once and becomes a piece of text.
A row never holds more than a stretch, except the result.  The result is that of
extracting, uniting, limiting and rendering controls one after another
(``operators.compose``), which reads and moves the words once per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoweave.functions import frames as A
from sonoweave.functions import text as T
from sonoweave.functions import zscore as Z
from sonoweave.functions.frames import let
from sonoweave.operators import controls as C
from sonoweave.operators import segments as G
from sonoweave.operators.compose import PRIORITY
from sonoweave.operators.controls import ORDER

#: Statistics that the extractors need.
SCORED = ("speed", "energy", "word_duration", "word_energy")
WEIGHTS = {"energy": 0.4, "duration": 0.3, "pitch": 0.3}


def _utterance_facts(about: DataFrame, stats: DataFrame, frames: DataFrame | None) -> DataFrame:
    """One row per utterance: its style, the statistics of its language and style, and its frames if there are any."""
    of = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"{f}_{c}")
    known = stats.groupBy(F.col("lang_style").alias("_k")).agg(*[of(f, c) for f in SCORED for c in ("mean", "std")])
    named = about.withColumn("_g", T.lang_style(F.col("lang"), F.col("style")))
    facts = named.join(known, F.col("_g") == F.col("_k"), "left").drop("_g", "_k", "lang")
    if frames is None:
        return facts
    own = frames.select("utt_id", "sr", "hop", "energy", "f0_hop", "f0", A.speaker_baseline(F.col("f0")).alias("_base"))
    return facts.join(own, "utt_id", "outer")


def _control(kind: str, when: Column, value: Column, pos: Column) -> Column:
    """The control as ``(priority, order, pos, value, tag)`` if the condition holds and there is a value, else null."""
    entry = F.struct(
        F.lit(PRIORITY[kind]).alias("p"), F.lit(ORDER[kind]).alias("e"), pos.alias("pos"), value.alias("value"), T.render_tag(F.lit(kind), value).alias("tag")
    )
    return F.when(F.coalesce(when, F.lit(False)) & value.isNotNull(), entry)


def clause_words(rows: DataFrame) -> DataFrame:
    """One row per clause: ``utt_id, clause_id, sent_id, n, first, start, end, paused, words``; times are null if it is not closed.

    ``sent_id`` is the sentence that opens in the clause, null if none does.
    """
    rows = G.with_previous(rows)
    stored = "type" in rows.columns
    word = F.col("type") == "word" if stored else F.lit(True)
    gap = F.when(word, F.col("start") - F.col("prev.end"))
    opens = word & F.coalesce(F.col("prev.sent_id") != F.col("sent_id"), F.lit(True))
    inner = F.when((F.col("prev.clause_id") == F.col("clause_id")) & (F.col("gap") > 0.2), F.col("gap"))
    entry = F.struct("wi", "pos", "text", "start", "end", "gap", "opens")
    own = F.max(F.when(~word, F.struct("start", "end"))) if stored else F.struct(F.min_by("start", "pos").alias("start"), F.max_by("end", "pos").alias("end"))
    clause = rows.withColumns({"gap": gap, "opens": opens}).groupBy("utt_id", "clause_id").agg(
        F.min(F.when(F.col("opens"), F.col("sent_id"))).alias("sent_id"), F.sum(word.cast("int")).alias("n"), F.min(F.when(word, F.col("pos"))).alias("first"),
        F.coalesce(F.sum(inner), F.lit(0.0)).alias("paused"), F.sort_array(F.collect_list(F.when(word, entry))).alias("words"), own.alias("own"),
    )
    return clause.where("n > 0").select("utt_id", "clause_id", "sent_id", "n", "first", "own.start", "own.end", "paused", "words")


def _clause_controls(c: Column, framed: bool, as_number: bool, emphasis: float) -> Column:
    """All controls of a clause in an array, those that do not hold null."""
    none = Z.PAUSE_LEVELS[0][0]
    scored = lambda kind, z, labels: let(z, lambda v: _control(kind, Z.annotated(v), Z.shown(v, labels, as_number), c["first"]))
    lasts = c["end"] - c["start"] - c["paused"]
    speed = Z.population_z(F.when(lasts > 0, c["n"] / lasts), F.col("speed_mean"), F.col("speed_std"))
    of_clause = [scored("speed", speed, Z.SPEED_LEVELS)]
    if framed:
        volume = F.when(F.col("energy").isNotNull(), Z.population_z(C._energy(c["start"], c["end"]), F.col("energy_mean"), F.col("energy_std")))
        of_clause += [scored("volume", volume, Z.VOLUME_LEVELS), scored("pitch", C._pitch_z(c["start"], c["end"], 5)["z"], Z.LEVELS)]

    def of_word(w: Column) -> Column:
        level = Z.pause_level(w["gap"])
        pause = Z.number(F.round(w["gap"], 1)) if as_number else level
        found = [
            _control("style", w["wi"] == 0, F.coalesce("style", F.lit("read")), w["pos"]), _control("break", level != none, pause, w["pos"]),
            _control("emotion", w["opens"], c["mood"], w["pos"]),
        ]
        if framed:
            parts = {
                "energy": F.when(F.col("energy").isNotNull(), Z.population_z(C._energy(w["start"], w["end"]), F.col("word_energy_mean"), F.col("word_energy_std"))),
                "duration": F.when(F.col("energy").isNotNull(), Z.population_z(w["end"] - w["start"], F.col("word_duration_mean"), F.col("word_duration_std"))),
                "pitch": Z.clean(C._pitch_z(w["start"], w["end"], 3)["z"]),
            }

            def score(v: Column) -> Column:
                total = sum((F.coalesce(F.lit(x) * v[k], F.lit(0.0)) for k, x in WEIGHTS.items()), F.lit(0.0))
                return F.try_divide(total, sum((F.when(v[k].isNotNull(), x).otherwise(0.0) for k, x in WEIGHTS.items()), F.lit(0.0)))

            shown = lambda z: Z.number(F.round(Z.clamped(z), 2)) if as_number else F.lit("emphasis")
            z = let(F.struct(*[v.alias(k) for k, v in parts.items()]), score)
            found.append(let(z, lambda z: _control("emphasis", z > emphasis, shown(z), w["pos"])))
        return F.array(*found)

    return F.concat(F.array(*of_clause), F.flatten(F.transform(c["words"], of_word)))


def control_text(
    rows: DataFrame, about: DataFrame, stats: DataFrame, scores: DataFrame | None, most: int | None, frames: DataFrame | None = None, as_number: bool = False,
    emphasis: float = 1.0,
) -> DataFrame:
    """``utt_id, text``: the words with at most ``most`` tags per clause (``None``: all).

    Arguments as for the single extractors; without ``frames`` there is no volume, pitch and emphasis, without
    ``scores`` no emotion.  A null word is empty, an utterance without words does not appear, one that ``about``
    does not know is of style ``read`` and counts as without language, one without frames has no controls of them.
    Of several sentences that open in one clause (never in a sound list) the first gets its emotion.
    """
    if most is not None and most < 0:
        raise ValueError("the number of controls per clause cannot be negative")
    clause = clause_words(rows)
    if scores is not None:
        moods = scores.select("utt_id", "sent_id", Z.top_emotions(F.col("scores")).alias("mood")).where("mood IS NOT NULL")
        clause = clause.join(moods.groupBy("utt_id", "sent_id").agg(F.min("mood").alias("mood")), ["utt_id", "sent_id"], "left")
    else:
        clause = clause.withColumn("mood", F.lit(None).cast("string"))
    entry = F.struct("clause_id", "n", "first", "start", "end", "paused", "mood", "words")
    stretch = F.floor(F.col("first") / F.lit(C.SPANS)).alias("at")
    stretches = clause.groupBy("utt_id", stretch).agg(F.sort_array(F.collect_list(entry)).alias("c"))
    met = stretches.join(_utterance_facts(about, stats, frames), "utt_id", "left")

    def render(c: Column, kept: Column) -> Column:
        tags = lambda w: F.array_join(F.transform(F.filter(kept, lambda x: x["pos"] == w["pos"]), lambda x: x["tag"]), "")
        return F.array_join(F.transform(c["words"], lambda w: F.concat(tags(w), F.coalesce(w["text"], F.lit("")))), " ")

    def of_clause(c: Column) -> Column:
        found = F.array_sort(F.filter(_clause_controls(c, frames is not None, as_number, emphasis), lambda x: x.isNotNull()))
        return let(found if most is None else F.slice(found, 1, most), lambda kept: render(c, kept))

    pieces = met.select("utt_id", "at", F.array_join(F.transform("c", of_clause), " ").alias("t"))
    whole = pieces.groupBy("utt_id").agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("p"))
    return whole.select("utt_id", F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))
