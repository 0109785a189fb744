"""Writers: control text, analysis rows, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_new(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write JSON rows where nothing is yet; an existing path is an error."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).json(path)


def analysis_rows(control_text: DataFrame, table: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per utterance: its control text, its segment table and its controls' spans, in order."""
    rows = table.groupBy("utt_id").agg(F.sort_array(F.collect_list(F.struct("pos", "start", "end", "dur", "type", "text", "tags"))).alias("segments"))
    details = spans.groupBy("utt_id").agg(F.sort_array(F.collect_list(F.struct("pos", "type", "value", "info", "time", "time_end"))).alias("controls"))
    return control_text.withColumnRenamed("text", "control_text").join(rows, "utt_id", "left").join(details, "utt_id", "left")


def alignment_lines(segments: DataFrame) -> DataFrame:
    """``value``: a report line per segment row."""
    known = segments.where(F.col("start").isNotNull() & F.col("end").isNotNull())
    return known.select(F.format_string("%s\t%.3f\t%.3f\t%s\t%s", "utt_id", "start", "end", "type", F.coalesce("text", F.lit(""))).alias("value"))


def wer_lines(rates: DataFrame) -> DataFrame:
    """``value``: a report line per file, then the mean rate (0 without files)."""
    each = rates.select(F.lit(0).alias("o"), F.col("utt_id").alias("k"), F.format_string("%s WER=%.4f ref=%s hyp=%s", "utt_id", "wer", "ref", "hyp").alias("value"))
    mean = rates.agg(F.lit(1).alias("o"), F.lit("").alias("k"), F.format_string("mean WER=%.4f", F.coalesce(F.avg("wer"), F.lit(0.0))).alias("value"))
    return each.unionByName(mean)
