"""Texts that were cut off: strict prefixes of longer copies elsewhere in the table.

A sentence row has two more copies of its text in the table: the word rows that
belong to it and the clause rows they close.  Rows are co-grouped by the
sentence they belong to, copies are put together without white space, and a
sentence text that is a strict prefix of its copy was cut.  The texts of other
sentences are not looked at: one that starts alike does not tell whether this
one is whole.

Where the copies were cut as well there is nothing longer.  Such a text has the
length of its source's field: limits are learned from the cuts already found.
At a limit, words are joined by hashed prefixes: a text is cut if the word at its
end is a strict prefix of longer words elsewhere.

Which sentence a row belongs to is the next sentence row's position.  It is
found in two levels, inside blocks of positions and across blocks, so that no
task depends on the length of one utterance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoweave.session import reliable

#: Positions per block.
BLOCK = 4096
#: Length of the prefix that is compared first, and the longest that is hashed.
PREFIX = 16
REPLACEMENT = "�"
#: Cuts of one length that make a field limit, at least.
LEAST_VOTES = 3
#: A final mark or closing sign, at the end of a text.
CLOSED = r"[.!?。！？｡…‥։؟۔।॥።፧။។\"'”’»›」』)）\]】》]\s*$"
#: The word at the very end.
TAIL = r"[\p{L}\p{M}\p{N}]+$"
#: A letter of a script that sets no spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsKatakana}\p{IsHiragana}\p{IsThai}\p{IsKhmer}\p{IsLao}\p{IsMyanmar}]"
#: What surrounds the letters and digits of a word.
AROUND = r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$"


def sentence_members(segments: DataFrame) -> DataFrame:
    """``seg_id, source, text, kinds, texts``: each sentence row with the rows that belong to it.

    ``kinds`` has a letter (w, c) per member in order of position and ``texts`` their texts.  Each ``seg_id``
    counts once.  Members after an utterance's last sentence row belong to none.
    """
    rows = segments.where(F.col("utt_id").isNotNull() & F.col("pos").isNotNull() & F.col("seg_id").isNotNull()).select(
        "utt_id", "pos", "seg_id", "loaded_at", "source", F.substring("type", 1, 1).alias("kind"), "text",
        F.floor(F.col("pos") / F.lit(BLOCK)).alias("block"),
    )
    backward = Window.partitionBy("utt_id", "block").orderBy(F.desc("pos"), F.desc("seg_id"), F.desc("loaded_at"))
    own = F.when(F.col("kind") == "s", F.col("pos"))
    near = rows.select(
        "*",
        F.min(own).over(backward.rowsBetween(Window.unboundedPreceding, 0)).alias("near"),
        F.lead("seg_id").over(backward).alias("twin"),  # the earlier delivery of the same row, if there is one
    ).where(~F.coalesce(F.col("twin") == F.col("seg_id"), F.lit(False)))
    later = Window.partitionBy("utt_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("utt_id", "block").agg(F.min(own).alias("first"))
    far = blocks.select("utt_id", "block", F.min("first").over(later).alias("far"))
    joined = near.join(far, ["utt_id", "block"]).withColumn("sentence", F.coalesce("near", "far")).where("sentence IS NOT NULL")
    member = F.struct("pos", "seg_id", "kind", "text", "source")
    grouped = joined.groupBy("utt_id", "sentence").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") != "s", member))).alias("members"),
        F.max(F.when(F.col("kind") == "s", F.struct("seg_id", "source", "text"))).alias("s"),
    )
    return grouped.select(
        "s.seg_id", "s.source", "s.text",
        F.array_join(F.transform("members", lambda m: m["kind"]), "").alias("kinds"),
        F.transform("members", lambda m: m["text"]).alias("texts"),
    )


def solid(text: str) -> str:
    """The text without white space."""
    return "".join(text.split())


def longer_copy(kinds: str, texts: list[str | None]) -> list[str | None]:
    """The sentence put together from its words, as known pieces; ``None`` stands for an unknown word.

    A clause with an unknown word is taken from its clause row; where that is unknown too, or a clause is
    not closed, its words are used.
    """
    pieces: list[str | None] = []
    words: list[str | None] = []
    for kind, text in zip(kinds, texts, strict=True):
        if kind == "w":
            words.append(None if text is None else solid(text))
        elif kind == "c":
            pieces += [solid(text)] if text is not None and None in words else words
            words = []
    pieces += words
    out: list[str | None] = []
    for p in pieces:
        if p is not None and out and out[-1] is not None:
            out[-1] += p
        elif p != "":
            out.append(p)
    return out


def stops_before(text: str, copy: list[str | None]) -> bool:
    """Is ``text`` (white space apart) a strict prefix of ``copy``, whose unknown words match anything?

    A replacement character at the end is what is left of a character cut in half and is not compared.
    A text that says something else than the copy is not cut; an unknown last word proves nothing.
    """
    seen = solid(text).rstrip(REPLACEMENT)
    if copy and copy[0] is not None and len(seen) >= PREFIX and seen[:PREFIX] != copy[0][:PREFIX] and len(copy[0]) >= PREFIX:
        return False
    at, after_unknown = 0, False
    for i, piece in enumerate(copy):
        if piece is None:
            if at >= len(seen):
                return True
            after_unknown = True
            continue
        if after_unknown:
            where = seen.find(piece, at + 1)
            if where < 0:
                # the piece is not there as a whole: the text ends in it, or in the unknown word before it
                rest = seen[at + 1 :]
                known = next((n for n in range(min(len(rest), len(piece)), 0, -1) if rest.endswith(piece[:n])), 0)
                return i == len(copy) - 1 or known > 0 or all(p not in rest for p in copy[i + 1 :] if p)
            at, after_unknown = where + len(piece), False
            continue
        if seen.startswith(piece, at):
            at += len(piece)
        elif piece.startswith(seen[at:]):
            return True
        else:
            return False
    return False


def judged_rows(segments: DataFrame) -> DataFrame:
    """``seg_id, source, text, cut`` per sentence row with a text: is it a strict prefix of its own longer copy?

    An empty text with a copy is cut, and so is one that ends in half a character.  A row without members has
    no longer copy.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("kinds").to_pylist(), batch.column("texts").to_pylist(), strict=True)
            cut = [text.endswith(REPLACEMENT) or stops_before(text, longer_copy(kinds, texts)) for text, kinds, texts in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("seg_id", "source", "text")), pa.array(cut, pa.bool_())], names=["seg_id", "source", "text", "cut"])

    return sentence_members(segments).where("text IS NOT NULL").mapInArrow(run, "seg_id bigint, source string, text string, cut boolean")


def measured(judged: DataFrame) -> DataFrame:
    """``seg_id, source, cut, half, points, bytes, width, open, tail`` of judged rows: what tells a text cut at a limit.

    ``points`` counts code points and ``bytes`` the bytes of whole characters; ``width`` is the last one's, and
    ``half`` says that half a character follows it.  ``open``: no mark or closing sign ends the text.  ``tail``
    is the word at its very end, empty where a space or a clause mark ends it or its script writes no spaces.
    """
    whole = F.rtrim(F.col("text"), F.lit(REPLACEMENT))
    tail = F.regexp_extract("text", TAIL, 0)
    return judged.select(
        "seg_id", F.coalesce("source", F.lit("")).alias("source"), "cut", F.endswith("text", F.lit(REPLACEMENT)).alias("half"),
        F.char_length("text").cast("bigint").alias("points"), F.octet_length(whole).cast("bigint").alias("bytes"),
        F.greatest(F.octet_length(F.right(whole, F.lit(1))), F.lit(1)).cast("bigint").alias("width"),
        (~F.regexp_like("text", F.lit(CLOSED))).alias("open"), F.when(F.regexp_like(tail, F.lit(UNSPACED)), F.lit("")).otherwise(tail).alias("tail"),
    )


def field_limits(rows: DataFrame) -> DataFrame:
    """``source, unit, size``: the field limit of each source that has one, from the lengths of its cuts.

    A cut votes for its length in code points, and for the limits in bytes that its whole characters leave room
    for no further one like the last.  The length with the most votes is the limit if it has ``LEAST_VOTES`` of
    them and half of all cuts; ties go to bytes, then to the shorter one.
    """
    vote = lambda unit, size: F.struct(F.lit(unit).alias("unit"), size.alias("size"))
    first = F.col("bytes") + F.col("half").cast("bigint")
    last = F.col("bytes") + F.when(F.col("half"), F.lit(3)).otherwise(F.col("width") - 1)
    votes = F.concat(F.array(vote("points", F.col("points"))), F.transform(F.sequence(first, last), lambda n: vote("bytes", n)))
    cuts = rows.where("cut").select("source", F.explode(votes).alias("v")).groupBy("source", "v.unit", "v.size").agg(F.count("*").alias("n"))
    total = rows.where("cut").groupBy("source").agg(F.count("*").alias("c"))
    best = cuts.groupBy("source").agg(F.min(F.struct((-F.col("n")).alias("m"), "unit", "size")).alias("b"))
    enough = (-F.col("b.m") >= LEAST_VOTES) & (-F.col("b.m") * 2 >= F.col("c"))
    return best.join(total, "source").where(enough).select("source", "b.unit", "b.size")


def begun_words(tails: DataFrame, segments: DataFrame) -> DataFrame:
    """The ``tail`` of those of ``tails`` that are a strict prefix of a longer word elsewhere.

    A self-join by hashed prefixes of the words: each distinct word gives its strict prefixes of up to
    ``PREFIX`` code points, a longer tail looks for its first ``PREFIX`` and compares the rest.
    """
    core = F.regexp_replace("text", AROUND, "")
    words = segments.where((F.col("type") == "word") & F.col("text").isNotNull()).select(core.alias("word")).where("word <> ''").distinct()
    lengths = F.sequence(F.lit(1), F.least(F.char_length("word"), F.lit(PREFIX)))
    held = words.where(F.char_length("word") > 1).select("word", F.explode(lengths).alias("n")).where(F.col("n") < F.char_length("word"))
    long = F.when(F.col("n") == PREFIX, F.col("word"))  # only these are compared further
    keys = held.select(F.xxhash64(F.substring("word", F.lit(1), F.col("n"))).alias("h"), long.alias("long")).distinct()
    wanted = tails.select("tail").distinct().withColumn("h", F.xxhash64(F.left("tail", F.lit(PREFIX))))
    rest = F.col("long").isNull() | (F.startswith("long", F.col("tail")) & (F.col("long") != F.col("tail")))
    return wanted.join(keys, (wanted["h"] == keys["h"]) & rest, "left_semi").select("tail")


def cut_rows(segments: DataFrame) -> DataFrame:
    """``seg_id, source, cut`` per sentence row with a text.

    Cut is a text whose own words or clauses hold more of it.  Where those were cut as well, the text equals its
    copy; it is cut if no mark ends it, it has just the length at which its source's known cuts end, and the
    word at its end is only the beginning of words elsewhere (no whole word, where no word is at its end).
    A text that merely lacks a mark which its words lack as well is not cut.  The source of a row may be null,
    and is a source of its own.
    """
    rows = reliable(measured(judged_rows(segments)))
    fits = F.when(F.col("unit") == "points", F.col("points") == F.col("size")).otherwise(
        (F.col("bytes") <= F.col("size")) & (F.col("bytes") > F.col("size") - F.col("width"))
    )
    # one row per source at most; the planner broadcasts it if it measures small and splits a hot source if not
    full = rows.where(~F.col("cut") & F.col("open")).join(field_limits(rows), "source").where(fits).select("seg_id", "tail")
    begun = begun_words(full.where("tail <> ''"), segments).withColumnRenamed("tail", "begun")
    more = full.join(begun, F.col("tail") == F.col("begun"), "left").where("tail = '' OR begun IS NOT NULL").select(F.col("seg_id").alias("more"))
    return rows.join(more, F.col("seg_id") == F.col("more"), "left").select(
        "seg_id", F.when(F.col("source") != "", F.col("source")).alias("source"), (F.col("cut") | F.col("more").isNotNull()).alias("cut")
    )


def truncated(segments: DataFrame) -> DataFrame:
    """``seg_id`` of each sentence row whose text stops before the sentence text it was made from."""
    return cut_rows(segments).where("cut").select("seg_id")


def truncation_by_source(segments: DataFrame) -> DataFrame:
    """``source, sentences, cut, cut_share``: how often each source truncates (sentence rows with a text)."""
    counted = cut_rows(segments).groupBy("source").agg(F.count("*").alias("sentences"), F.sum(F.col("cut").cast("bigint")).alias("cut"))
    return counted.withColumn("cut_share", F.col("cut") / F.col("sentences"))
