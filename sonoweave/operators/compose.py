"""Combining controls: limit, order, render, and put back into the text or onto the time axis."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoweave.functions import text as T
from sonoweave.operators.segments import _delivered, in_list_blocks, of_long_lists, only_words, usable

# Priority of a control type; others come last.
PRIORITY = {"style": 0, "emotion": 1, "speed": 2, "volume": 3, "pitch": 4, "break": 5, "emphasis": 6}
LAST = 99


class Registry:
    """Extractors by type, in order; adding a type again replaces it in its place."""

    def __init__(self) -> None:
        self.extractors: dict[str, Callable[[], DataFrame]] = {}

    def add(self, kind: str, extractor: Callable[[], DataFrame]) -> Registry:
        self.extractors[kind] = extractor
        return self

    def collect(self) -> DataFrame:
        return union([f() for f in self.extractors.values()])


def union(controls: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, controls)


def priority(kind: Column) -> Column:
    out = F.lit(LAST)
    for name, p in PRIORITY.items():
        out = F.when(kind == name, p).otherwise(out)
    return out


def distinct_controls(controls: DataFrame) -> DataFrame:
    """Controls of an earlier run: repeated rows once, NaN numbers as null."""
    return controls.withColumn("value_num", F.when(~F.isnan("value_num"), F.col("value_num"))).distinct()


def limit_per_clause(controls: DataFrame, words: DataFrame, most: int | None) -> DataFrame:
    """At most ``most`` controls per clause by priority, then in order of extraction; ``None`` keeps all.

    Controls whose ``pos`` is no word form a clause of their own per utterance.  Catalyst limits each group
    while it sorts, so a group's rows beyond the limit are not kept.
    """
    if most is None:
        return controls
    if most < 0:
        raise ValueError("the number of controls per clause cannot be negative")
    place = only_words(words).select("utt_id", F.col("pos").cast("int").alias("pos"), F.col("clause_id"))
    order = Window.partitionBy("utt_id", "_c").orderBy(priority(F.col("type")), "ext_order", "pos", "value")
    return (
        controls.join(place, ["utt_id", "pos"], "left")
        .withColumn("_c", F.coalesce("clause_id", F.lit(-1)))
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= most)
        .select(*controls.columns)
    )


def formatted(controls: DataFrame) -> DataFrame:
    """``utt_id, pos, tags``: the tags of a position by priority, then in order of extraction."""
    tag = T.render_tag(F.col("type"), F.coalesce("value", F.lit("None")))
    entry = F.struct(priority(F.col("type")).alias("p"), F.col("ext_order").alias("e"), tag.alias("t"))
    ordered = F.sort_array(F.collect_list(entry))
    return controls.groupBy("utt_id", "pos").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("tags"))


def control_text(words: DataFrame, controls: DataFrame) -> DataFrame:
    """``utt_id, text``: words joined by spaces, each after its tags; a null word is empty."""
    tags = formatted(controls)
    rows = only_words(words).select("utt_id", F.col("pos").cast("int").alias("pos"), "wi", "text").join(tags, ["utt_id", "pos"], "left")
    shown = F.concat(F.coalesce("tags", F.lit("")), F.coalesce("text", F.lit("")))
    listed = rows.groupBy("utt_id").agg(F.sort_array(F.collect_list(F.struct("wi", shown.alias("s")))).alias("w"))
    return listed.select("utt_id", F.array_join(F.transform("w", lambda x: x["s"]), " ").alias("text"))


def segment_context(segments: DataFrame) -> DataFrame:
    """Each row of a segment list with the end of the word before it and the spans of the clause and sentence it lies in.

    ``utt_id, pos, start, end, before, clause, sentence``: the clause (sentence) row at or after the position.
    Found inside blocks of positions, and across blocks from a row for each.
    """
    columns = ("seg_id", "utt_id", "pos", "start", "end", "type", "loaded_at")
    listed = lambda df: _delivered(in_list_blocks(df.select(*columns).withColumns({c: usable(F.col(c)) for c in ("start", "end")})))
    rows = listed(segments)
    forward = Window.partitionBy("utt_id", "_block").orderBy("pos", "seg_id").rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("utt_id", "_block").orderBy(F.desc("pos"), F.desc("seg_id")).rowsBetween(Window.unboundedPreceding, 0)
    span, kinds = F.struct("start", "end"), ("word", "clause", "sentence")
    own = {k: F.when(F.col("type") == k, span) for k in kinds}
    near = rows.select(
        "utt_id", "_block", "pos", "start", "end", F.last(own["word"], ignorenulls=True).over(forward).alias("word"),
        *[F.last(own[k], ignorenulls=True).over(backward).alias(k) for k in kinds[1:]],
    )
    place = F.struct("pos", "seg_id", span.alias("x"))
    edges = listed(of_long_lists(segments)).groupBy("utt_id", "_block").agg(
        F.max(F.when(F.col("type") == "word", place))["x"].alias("word"), *[F.min(F.when(F.col("type") == k, place))["x"].alias(k) for k in kinds[1:]]
    )
    earlier = Window.partitionBy("utt_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("utt_id").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    far = edges.select(
        F.col("utt_id").alias("_u"), F.col("_block").alias("_b"), F.last("word", ignorenulls=True).over(earlier).alias("_word"),
        *[F.last(k, ignorenulls=True).over(later).alias(f"_{k}") for k in kinds[1:]],
    )
    joined = near.join(far, F.col("utt_id").eqNullSafe(F.col("_u")) & (F.col("_block") == F.col("_b")), "left")
    return joined.select(
        "utt_id", "pos", "start", "end", F.coalesce("word", "_word")["end"].alias("before"),
        F.coalesce("clause", "_clause").alias("clause"), F.coalesce("sentence", "_sentence").alias("sentence"),
    )


def control_spans(controls: DataFrame, segments: DataFrame) -> DataFrame:
    """``utt_id, type, value, pos, info, time, time_end``: where on the time axis a control holds.

    A break: from the end of the word before to the row's start (0 at the first word).  Emotion: its sentence;
    speed, volume and pitch: their clause; without such a row: the row's start, twice.  Others: the row.
    A position out of range: 0 to 0.  Rounded to four decimals.
    """
    rows = controls.join(segment_context(segments), ["utt_id", "pos"], "left")
    start, end = F.col("start"), F.col("end")
    within = lambda group: (F.when(F.col(group).isNotNull(), F.col(f"{group}.start")).otherwise(start), F.when(F.col(group).isNotNull(), F.col(f"{group}.end")).otherwise(start))
    (ss, se), (cs, ce) = within("sentence"), within("clause")
    kind = F.col("type")
    by_clause = kind.isin("speed", "volume", "pitch")
    frm = F.when(kind == "break", F.coalesce("before", F.lit(0.0))).when(kind == "emotion", ss).when(by_clause, cs).otherwise(start)
    to = F.when(kind == "break", start).when(kind == "emotion", se).when(by_clause, ce).otherwise(end)
    return rows.select(
        "utt_id", "type", "value", "pos", "info", F.round(F.coalesce(frm, F.lit(0.0)), 4).alias("time"), F.round(F.coalesce(to, F.lit(0.0)), 4).alias("time_end")
    )


def segment_table(segments: DataFrame, tags: DataFrame) -> DataFrame:
    """``utt_id, pos, start, end, dur, type, text, tags``: times as text with three decimals, tags of the position."""
    rows = _delivered(segments.select("seg_id", "utt_id", "pos", "start", "end", "type", "text", "loaded_at"))
    shown = lambda x: F.format_string("%.3f", F.round(usable(x), 3))
    known = F.when(usable(F.col("start")).isNotNull() & usable(F.col("end")).isNotNull(), F.col("end") - F.col("start"))
    return rows.join(tags, ["utt_id", "pos"], "left").select(
        "utt_id", "pos",
        F.when(usable(F.col("start")).isNotNull(), shown(F.col("start"))).alias("start"),
        F.when(usable(F.col("end")).isNotNull(), shown(F.col("end"))).alias("end"),
        F.when(known.isNotNull(), shown(known)).alias("dur"), "type", "text", F.coalesce("tags", F.lit("")).alias("tags"),
    )


def highlight_spans(words: DataFrame, tags: DataFrame) -> DataFrame:
    """``utt_id, wi, n, span, label``: each word's tags one by one, then the word itself with its first tag as label."""
    rows = only_words(words).select("utt_id", F.col("pos").cast("int").alias("pos"), "wi", "text").join(tags, ["utt_id", "pos"], "left")
    found = T.tag_spans(F.col("tags"))
    kind = lambda t: F.regexp_extract(t, r"\[([^=\]]*)", 1)
    first = F.get(found, F.lit(0))
    spans = F.concat(
        F.transform(found, lambda t: F.struct(t.alias("span"), kind(t).alias("label"))),
        F.array(F.struct(F.coalesce("text", F.lit("")).alias("span"), F.when(first.isNotNull(), kind(first)).alias("label"))),
    )
    return rows.select("utt_id", "wi", F.posexplode(spans).alias("n", "s")).select("utt_id", "wi", "n", "s.span", "s.label")
