"""Folders of recordings and transcripts as tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoweave.functions.text import SPACE


def _files(spark: SparkSession, root: str, pattern: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return (reader.option("recursiveFileLookup", "true") if recursive else reader).load(root)


def recordings(spark: SparkSession, root: str, recursive: bool = True, any_case: bool = False) -> DataFrame:
    """``path, dir, stem`` of the ``.wav`` files below ``root`` (or in it).  Contents are not read."""
    return with_parts(_files(spark, root, "*.[wW][aA][vV]" if any_case else "*.wav", recursive).select("path"))


def files_by_ext(spark: SparkSession, root: str, ext: str = ".wav") -> DataFrame:
    return with_parts(_files(spark, root, f"*{ext}", True).select("path"))


def with_parts(paths: DataFrame) -> DataFrame:
    """Add ``dir`` (the folder's path), ``lang_dir`` (its name) and ``stem`` to ``path``."""
    return paths.select(
        "path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("lang_dir"),
        F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("stem"),
    )


def transcripts(spark: SparkSession, root: str, ext: str = ".txt", strip: bool = True) -> DataFrame:
    """``path, dir, lang_dir, stem, text``: whole files as UTF-8, white space at the ends off if ``strip``."""
    raw = spark.read.option("pathGlobFilter", f"*{ext}").option("recursiveFileLookup", "true").text(root, wholetext=True)
    read = raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    text = F.regexp_replace("text", rf"^{SPACE}+|{SPACE}+\z", "") if strip else F.col("text")
    return with_parts(read.select("path")).join(read.select("path", text.alias("text")), "path")


def transcript_path(wav: Column, ext: str = ".txt") -> Column:
    """A recording's transcript path: every ``.wav`` in it replaced."""
    return F.replace(wav, F.lit(".wav"), F.lit(ext))


def pair(wavs: DataFrame, texts: DataFrame, how: str = "inner") -> DataFrame:
    """Recordings with their transcripts by folder and stem: ``path, dir, stem, text``.

    ``inner`` skips recordings without a transcript, ``left`` gives them an empty text, ``left_anti`` lists them.
    """
    side = texts.select("dir", "stem", "text")
    joined = wavs.join(side if how != "left_anti" else side.drop("text"), ["dir", "stem"], how)
    return joined.withColumn("text", F.coalesce("text", F.lit(""))) if how == "left" else joined


def utterance_table(pairs: DataFrame) -> DataFrame:
    """``utt_id, path, lang, label, text`` of paired recordings: the label is ``[folder] stem``."""
    return pairs.select(
        F.concat_ws("/", "lang_dir", "stem").alias("utt_id"), "path", F.col("lang_dir").alias("lang"),
        F.format_string("[%s] %s", "lang_dir", "stem").alias("label"), "text",
    )


def energy_frames(spark: SparkSession, root: str, frame_ms: int = 30, hop_ms: int = 10) -> DataFrame:
    """``path, sr, hop, energy, error``: perceptual energy of each recording below ``root``.

    Samples stay inside the worker; a file that cannot be decoded has null frames and its error.
    """
    from sonoweave.functions import signal as S

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    y, sr = S.decode_wav(content)
                    n_fft, hop = S.frame_params(sr, frame_ms, hop_ms)
                    rows.append((path, sr, hop, S.perceptual_energy(y, sr, n_fft, hop), None))
                except Exception as e:  # one unreadable file must not end the job
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "sr", "hop", "energy", "error"]).astype({"sr": "Int32", "hop": "Int32"})

    return _files(spark, root, "*.[wW][aA][vV]", True).select("path", "content").mapInPandas(run, "path string, sr int, hop int, energy array<double>, error string")


def _known(utterances: DataFrame) -> DataFrame:
    """``utt_id, lang_dir, stem`` of utterances with a path, each once: what names their recording below any root."""
    return with_parts(utterances.where("path IS NOT NULL").select("path").distinct()).join(utterances.select("utt_id", "path").distinct(), "path").select("utt_id", "lang_dir", "stem").distinct()


def utterance_frames(spark: SparkSession, root: str, utterances: DataFrame, **options) -> DataFrame:
    """Frames as the extractors take them, ``utt_id, sr, hop, energy, f0_hop, f0``, from the recordings of ``utterances(utt_id, path)``.

    Recordings below ``root`` are found by folder and name.  The pitch is null: it needs a tracker, whose frames
    can be joined in its place.  A recording that cannot be decoded has no row; :func:`decoding_status` names it.
    """
    frames = energy_frames(spark, root, **options).where("error IS NULL")
    named = with_parts(frames.select("path")).select("path", "lang_dir", "stem")
    found = frames.join(named, "path").join(_known(utterances), ["lang_dir", "stem"])
    return found.select("utt_id", "sr", "hop", "energy", F.col("hop").alias("f0_hop"), F.lit(None).cast("array<double>").alias("f0"))


def decoding_status(spark: SparkSession, root: str) -> DataFrame:
    """``path, ok, error`` of each recording below ``root``."""
    return energy_frames(spark, root).select("path", F.col("error").isNull().alias("ok"), "error")


def clause_loudness(spark: SparkSession, root: str, rows: DataFrame, utterances: DataFrame) -> DataFrame:
    """``utt_id, clause_id, lufs`` of the clauses of listed rows, as calibration takes it, from the recordings below ``root``."""
    from sonoweave.operators.calibrate import clause_spans

    named = recordings(spark, root, any_case=True).select("path", "lang_dir", "stem").join(_known(utterances), ["lang_dir", "stem"]).select("path", "utt_id")
    spans = clause_spans(rows).select("utt_id", "clause_id", "start", "end").join(named, "utt_id")
    return segment_loudness(spark, root, spans.select("path", "utt_id", "clause_id", "start", "end")).select("utt_id", "clause_id", "lufs")


def segment_loudness(spark: SparkSession, root: str, spans: DataFrame) -> DataFrame:
    """Add ``lufs`` to ``spans(path, start, end, ...)``: gated loudness of each; null under 0.4 s, where it is not finite, and
    where the recording cannot be decoded.

    A recording meets all its spans once.
    """
    from sonoweave.functions import signal as S

    keep = [c for c in spans.columns if c != "path"]
    grouped = spans.groupBy("path").agg(F.collect_list(F.struct(*keep)).alias("s"))
    rows = _files(spark, root, "*.[wW][aA][vV]", True).select("path", "content").join(grouped, "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content, listed in zip(pdf["path"], pdf["content"], pdf["s"], strict=True):
                try:
                    y, sr = S.decode_wav(content)
                except Exception:  # one unreadable file must not end the job
                    y, sr = None, None
                for s in listed:
                    known = y is not None and s["start"] is not None and s["end"] is not None
                    out.append((path, *[s[k] for k in keep], S.segment_loudness(y, sr, s["start"], s["end"]) if known else None))
            yield pd.DataFrame(out, columns=["path", *keep, "lufs"])

    types = {f.name: f.dataType.simpleString() for f in spans.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in ["path", *keep]) + ", lufs double"
    return rows.mapInPandas(run, schema)
