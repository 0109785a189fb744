"""Queries over the standard tables: name -> callable(spark, data directory).  Each reads whole tables.

Doubles that come out are rounded to six decimals, so that the order of additions does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoweave.functions import frames as A
from sonoweave.functions import text as T
from sonoweave.functions import zscore as Z
from sonoweave.functions.wer import word_error_rate
from sonoweave.operators import align, calibrate, compose, controls, intervals, quality, segments, spikes
from sonoweave.plans import flagship
from sonoweave.plans.builder import ControlBuilder, Inputs, Options
from sonoweave.session import table
from sonoweave.sources import config, sinks, tree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- implausible readings and intervals


@query
def p2_found(spark, d):
    """Words that cannot be real; the factor of five is part of the definition, the fit decides what is usual."""
    return spikes.flagged_words(table(spark, d, "segments"), table(spark, d, "utterances"))


@query
def p2_by_source(spark, d):
    """How many word rows of each source are flagged, and why; bounds widened to what each source's tail warrants."""
    flags = spikes.word_flags(table(spark, d, "segments"), table(spark, d, "utterances"), min_factor=3.0, max_factor=8.0)
    count = lambda c: F.sum(F.col(c).cast("bigint")).alias(f"n_{c}")
    return flags.groupBy("source").agg(F.count("*").alias("n"), count("impossible"), count("spike"), count("stuck"))


@query
def p5_found(spark, d):
    return intervals.segment_gaps(table(spark, d, "segments"))


@query
def p5_periods(spark, d):
    return intervals.segment_periods(table(spark, d, "segments"))


# --- text functions


@query
def tokens(spark, d):
    return segments.text_words(table(spark, d, "documents"), "doc_id").select("doc_id", "wi", F.col("text").alias("token"))


@query
def token_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).cast("bigint").alias("n_tokens"))


@query
def normalized(spark, d):
    return table(spark, d, "utterances").select("utt_id", T.normalize(F.col("text")).alias("normalized")).distinct()


@query
def denormalized(spark, d):
    return table(spark, d, "utterances").select("utt_id", T.denormalize(T.normalize(F.col("text"))).alias("denormalized")).distinct()


@query
def word_properties(spark, d):
    """How often each distinct word occurs, its clean form and what it holds."""
    words = table(spark, d, "segments").where("type = 'word' AND text IS NOT NULL").groupBy("text").agg(F.count("*").alias("n"))
    return words.select(
        "text", "n", T.clean_word(F.col("text")).alias("clean"), T.has_cjk(F.col("text")).alias("cjk"), T.ends_clause(F.col("text")).alias("clause_end"),
        T.ends_sentence(F.col("text")).alias("sentence_end"), T.is_punctuation(F.col("text")).alias("punctuation"),
    )


@query
def languages(spark, d):
    rows = table(spark, d, "utterances").select("utt_id", "lang", "style").distinct()
    return rows.select(
        "utt_id", T.language_name(F.col("lang")).alias("language"), T.lang_style(F.lower("lang"), F.col("style")).alias("lang_style"),
        T.language_of_directory(F.col("lang")).alias("dir_language"),
    )


@query
def error_rates(spark, d):
    """Word error rate of each utterance's stored transcript against the text of its sentence rows."""
    sentence = F.struct("pos", "text")
    spoken = table(spark, d, "segments").where("type = 'sentence' AND text IS NOT NULL").groupBy("utt_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(sentence)), lambda s: s["text"]), " ").alias("ref")
    )
    said = table(spark, d, "utterances").groupBy("utt_id").agg(F.max("text").alias("hyp"))
    return said.join(spoken, "utt_id").select("utt_id", r6(word_error_rate(F.col("ref"), F.col("hyp"))).alias("wer"))


@query
def mean_error_rate(spark, d):
    return error_rates(spark, d).agg(F.count("*").alias("n"), F.round(F.coalesce(F.avg("wer"), F.lit(0.0)), 4).alias("mean_wer"))


@query
def error_report(spark, d):
    """A line per utterance with its rate, transcript and recognised text, then the mean rate."""
    said = table(spark, d, "utterances").groupBy("utt_id").agg(F.max("text").alias("hyp"))
    both = said.join(_heard(spark, d).select("utt_id", F.col("text").alias("ref")), "utt_id")
    rows = both.select("utt_id", "ref", "hyp", word_error_rate(F.col("ref"), F.col("hyp")).alias("wer"))
    return sinks.wer_lines(rows).select("value")


# --- sources


@query
def paired_datasets(spark, d):
    """Utterances with the dataset they come from and the transcript path its extension gives."""
    sets = config.with_default_ext(table(spark, d, "datasets")).select(F.col("name").alias("source"), F.col("style").alias("set_style"), "text_ext")
    rows = table(spark, d, "utterances").where("path IS NOT NULL").select("utt_id", "source", "path").distinct()
    with_parts = tree.with_parts(rows.select("path").distinct())
    return rows.join(sets, "source").join(with_parts, "path").select(
        "utt_id", "source", "set_style", "lang_dir", "stem", F.concat("dir", F.lit("/"), "stem", "text_ext").alias("transcript"),
        T.utterance_label(F.col("lang_dir"), F.col("stem")).alias("label"),
    )


@query
def unpaired_utterances(spark, d):
    """Utterances without a transcript that a pairing skips."""
    have = table(spark, d, "utterances").where("text IS NOT NULL").select("utt_id").distinct()
    return table(spark, d, "utterances").select("utt_id", "source").distinct().join(have, "utt_id", "left_anti")


# --- segments


def _document_words(spark, d):
    return segments.text_words(table(spark, d, "documents"), "doc_id")


@query
def document_words(spark, d):
    return _document_words(spark, d).select("doc_id", "wi", "pos", "clause_id", "sent_id", "text")


def _document_segments(spark, d):
    timed = segments.synthetic_times(_document_words(spark, d), "doc_id", F.col("doc_id"))
    return segments.interleave(timed, "doc_id", "start_ms", "end_ms")


@query
def document_segments(spark, d):
    return _document_segments(spark, d)


def _items(spark, d) -> DataFrame:
    """The stored words' times as the items of an aligner."""
    return segments.listed_words(table(spark, d, "segments")).select("utt_id", F.col("wi").alias("item_idx"), "start", "end")


@query
def attached_times(spark, d):
    said = table(spark, d, "utterances").groupBy("utt_id").agg(F.max("text").alias("text"))
    words = segments.attach_times(segments.text_tokens(said, "utt_id", "ti"), _items(spark, d))
    return words.select("utt_id", "wi", "text", r6("start").alias("start"), r6("end").alias("end"))


@query
def aligned_words(spark, d):
    """Alignment by a table-backed aligner of all utterances that have a text, however their language is spelled."""
    words = align.align(_spelled(spark, d), align.TableProvider(_items(spark, d)))
    return words.select("utt_id", "wi", "pos", "clause_id", "sent_id", "text", r6("start").alias("start"), r6("end").alias("end"))


def _spelled(spark, d) -> DataFrame:
    said = table(spark, d, "utterances").groupBy("utt_id").agg(F.max("text").alias("text"), F.max(F.trim("lang")).alias("lang"))
    return said.withColumn("lang", T.spelled_language(F.col("lang")))


def _heard(spark, d) -> DataFrame:
    """The stored sentence rows as the texts of a recogniser."""
    sentences = table(spark, d, "segments").where("type = 'sentence' AND text IS NOT NULL").groupBy("utt_id")
    texts = sentences.agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("pos", "text"))), lambda s: s["text"]), " ").alias("text"))
    return texts.withColumn("language", T.written_language(F.col("text")))


@query
def aligned_utterances(spark, d):
    """Alignment of all utterances by a table-backed aligner and recogniser, which gives the texts and languages that are missing.

    A language that the aligner lacks raises; :func:`unsupported_languages` lists those.
    """
    words = align.align(_spelled(spark, d), align.TableProvider(_items(spark, d)), align.TableProvider(_heard(spark, d)))
    return words.select("utt_id", "wi", "pos", "clause_id", "sent_id", "text", r6("start").alias("start"), r6("end").alias("end"))


@query
def detected_languages(spark, d):
    """The language of every utterance as the stand-in recogniser hears it."""
    return align.detected_languages(_spelled(spark, d), align.TableProvider(_heard(spark, d)))


@query
def alignment_report(spark, d):
    """A line per row of the stored segment lists with known times."""
    rows = segments._delivered(table(spark, d, "segments"))
    return sinks.alignment_lines(rows.withColumns({c: segments.usable(F.col(c)) for c in ("start", "end")}))


@query
def analysis(spark, d):
    """One row per utterance: control text of an earlier run's controls, segment table and controls on the time axis."""
    return sinks.analysis_rows(given_control_text(spark, d), segment_table(spark, d), control_spans(spark, d))


@query
def unsupported_languages(spark, d):
    """Languages of utterances that the aligner does not know, and of how many."""
    rows = _spelled(spark, d).where(~F.coalesce(F.col("lang").isin(*T.LANGUAGES.values()), F.lit(True)))
    return rows.groupBy("lang").agg(F.count("*").alias("n"))


def _rows(spark, d):
    """Words with their clause rows."""
    return segments.listed_rows(table(spark, d, "segments"))


def _words(spark, d):
    return segments.listed_words(table(spark, d, "segments"))


@query
def listed_words(spark, d):
    return _words(spark, d).select("utt_id", "source", "wi", "pos", "clause_id", "sent_id", "text", r6("start").alias("start"), r6("end").alias("end"))


@query
def clauses(spark, d):
    rows = segments.clauses(_rows(spark, d))
    return rows.select(
        "utt_id", "clause_id", "n_words", "first_pos", r6("start").alias("start"), r6("end").alias("end"),
        r6(segments.effective_duration()).alias("effective"), r6(segments.effective_duration(clamp=True)).alias("effective_clamped"),
    )


@query
def pauses(spark, d):
    rows = segments.pauses(_words(spark, d))
    return rows.select("utt_id", "wi", "pos", r6("gap").alias("gap"), "inter_clause", Z.pause_level(r6("gap")).alias("level"))


# --- frames: embeddings stand in for frame arrays


def _vectors(spark, d) -> DataFrame:
    """``utt_id, e``: an embedding for every utterance, by its number; all embeddings are used in turn."""
    vectors = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    number = F.regexp_extract("utt_id", r"(\d+)$", 1).cast("bigint") % max(vectors.count(), 1)
    named = table(spark, d, "utterances").select("utt_id").distinct().withColumn("vec_id", number).join(vectors, "vec_id").select("utt_id", "e")
    # ids are small and end up in few partitions, what is made of the embeddings is not
    return named.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "utt_id")


def _frames(spark, d) -> DataFrame:
    """Stand-in frames, ten a second: energy and pitch made from an embedding by a fixed rule."""
    return _vectors(spark, d).select(
        "utt_id", F.lit(16000).alias("sr"), F.lit(1600).alias("hop"), F.transform("e", lambda x: F.abs(x) * 0.2).alias("energy"),
        F.lit(1600).alias("f0_hop"), F.transform("e", lambda x: F.when(x > -0.05, 200.0 + 100.0 * x).otherwise(0.0)).alias("f0"),
    )


@query
def frame_means(spark, d):
    rows = controls.clause_energies(_rows(spark, d), _frames(spark, d))
    return rows.select("utt_id", "clause_id", r6("v").alias("energy"))


@query
def speaker_baselines(spark, d):
    rows = _frames(spark, d).select("utt_id", A.speaker_baseline(F.col("f0")).alias("b"))
    return rows.where("b IS NOT NULL").select("utt_id", r6("b.mean").alias("f0_mean"), r6("b.std").alias("f0_std"))


@query
def clause_pitches(spark, d):
    rows = controls.clause_pitches(_rows(spark, d), _frames(spark, d))
    return rows.select("utt_id", "clause_id", r6("f0").alias("f0"), r6("z").alias("z"))


@query
def trimmed_words(spark, d):
    rows = segments.trimmed_words(_words(spark, d), _frames(spark, d))
    return rows.select("utt_id", "wi", r6("start").alias("start"), r6("end").alias("end"))


# --- controls


def _about(spark, d):
    return controls.about_utterances(table(spark, d, "utterances"))


def _stats(spark, d):
    return table(spark, d, "population_stats")


def _plain(df: DataFrame) -> DataFrame:
    return df.select("utt_id", "ext_order", "type", "value", r6("value_num").alias("value_num"), "pos", "info")


@query
def speed_scores(spark, d):
    rows = controls._with_stats(controls.clause_speeds(_rows(spark, d)), _about(spark, d), _stats(spark, d), "speed")
    z = Z.population_z(F.col("speed"), F.col("mean"), F.col("std"))
    rows = rows.withColumn("z", r6(z))
    return rows.select(
        "utt_id", "clause_id", r6("speed").alias("speed"), "z", Z.annotated(F.col("z")).alias("annotated"), Z.level(F.col("z"), Z.SPEED_LEVELS).alias("level"),
        r6(Z.clamped(F.col("z"))).alias("clamped"),
    )


def _inputs(spark, d) -> Inputs:
    return Inputs(_rows(spark, d), _about(spark, d), _stats(spark, d), _frames(spark, d), table(spark, d, "emotion_scores"))


def _extracted(kinds: tuple[str, ...], as_number: bool) -> Query:
    def run(spark, d):
        return _plain(ControlBuilder(Options(as_number), kinds).controls(_inputs(spark, d)))

    return run


# each extractor alone, with labels and, where it has them, with numbers
SINGLE = {"style": "style", "break": "pause", "speed": "speed", "volume": "volume", "pitch": "pitch", "emphasis": "emphasis", "emotion": "emotion"}
for _kind, _name in SINGLE.items():
    QUERIES[f"{_name}_controls"] = _extracted((_kind,), False)
    if _kind not in ("style", "emotion"):
        QUERIES[f"{_name}_controls_number"] = _extracted((_kind,), True)


@query
def all_controls(spark, d):
    """All seven extractors."""
    return _plain(ControlBuilder().controls(_inputs(spark, d)))


@query
def all_controls_number(spark, d):
    return _plain(ControlBuilder(Options(number_control=True)).controls(_inputs(spark, d)))


@query
def limited_controls(spark, d):
    return _plain(ControlBuilder(Options(max_controls_per_clause=1)).controls(_inputs(spark, d)))


@query
def formatted_controls(spark, d):
    return compose.formatted(ControlBuilder().controls(_inputs(spark, d)))


def _control_text(spark, d, as_number: bool) -> DataFrame:
    x = _inputs(spark, d)
    return flagship.control_text(x.words, x.about, x.stats, x.scores, 2, x.frames, as_number)


@query
def control_text(spark, d):
    """Flagship: every utterance's text with the tags of all seven extractors, at most two per clause."""
    return _control_text(spark, d, False)


@query
def control_text_number(spark, d):
    """The same with numbers instead of labels."""
    return _control_text(spark, d, True)


@query
def control_text_by_steps(spark, d):
    """The same by extracting, uniting, limiting and rendering one after another."""
    return ControlBuilder(Options(max_controls_per_clause=2)).build(_inputs(spark, d))


def _given(spark, d) -> DataFrame:
    return compose.distinct_controls(table(spark, d, "controls"))


@query
def given_control_text(spark, d):
    """The text of each utterance with the controls of an earlier run."""
    return compose.control_text(_words(spark, d), _given(spark, d))


@query
def control_spans(spark, d):
    return compose.control_spans(_given(spark, d), table(spark, d, "segments"))


@query
def segment_table(spark, d):
    return compose.segment_table(table(spark, d, "segments"), compose.formatted(_given(spark, d)))


@query
def highlight_spans(spark, d):
    return compose.highlight_spans(_words(spark, d), compose.formatted(_given(spark, d)))


# --- calibration and quality


def _timed(spark, d) -> DataFrame:
    """Listed rows, with the times that no recording can hold left out: a few of them would swamp every mean."""
    lasts = table(spark, d, "utterances").groupBy("utt_id").agg(F.max("duration_s").alias("duration_s"))
    wrong = spikes.impossible(F.col("start"), F.col("end"), F.col("duration_s"))
    rows = table(spark, d, "segments").join(lasts, "utt_id", "left").withColumn("_w", wrong)
    return segments.listed_rows(rows.withColumns({c: F.when(~F.col("_w"), F.col(c)) for c in ("start", "end")}).drop("_w", "duration_s"))


def _loudness(spark, d, rows: DataFrame) -> DataFrame:
    """Stand-in loudness of each clause that lasts, from the utterance's embedding by a fixed rule."""
    spans = calibrate.clause_spans(rows).select("utt_id", "clause_id")
    at = F.get("e", F.col("clause_id") % F.greatest(F.size("e"), F.lit(1)))
    return spans.join(_vectors(spark, d), "utt_id").select("utt_id", "clause_id", (F.lit(-23.0) + at * 10).alias("lufs"))


def _rounded(stats: DataFrame) -> DataFrame:
    """Nine decimals: means of times in ms are often ties at six."""
    return stats.select("lang_style", "feature", "n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query
def calibration(spark, d):
    return _rounded(calibrate.calibrate(_timed(spark, d), table(spark, d, "utterances")))


@query
def calibration_with_frames(spark, d):
    """All six features: times, frames and loudness."""
    rows = _timed(spark, d)
    return _rounded(calibrate.calibrate(rows, table(spark, d, "utterances"), _frames(spark, d), _loudness(spark, d, rows)))


@query
def resumed_calibration(spark, d):
    """Stored statistics continued with this corpus."""
    return _rounded(calibrate.merge(_stats(spark, d), calibrate.calibrate(_timed(spark, d), table(spark, d, "utterances"))))


@query
def compared_calibration(spark, d):
    rows = calibrate.compare(calibrate.calibrate(_timed(spark, d), table(spark, d, "utterances")), _stats(spark, d))
    return rows.select("lang_style", "feature", "n_found", "n_shipped", F.round("mean_diff", 9).alias("mean_diff"))


@query
def control_density(spark, d):
    return quality.density(_given(spark, d), _words(spark, d), _about(spark, d))


@query
def label_counts(spark, d):
    return quality.label_counts(_given(spark, d))


@query
def clamp_rates(spark, d):
    return quality.clamp_rates(_given(spark, d))
