"""Words, clauses and sentences: ordered relational operators.

Order is explicit: ``wi`` numbers the words of an utterance and ``pos`` the rows
of its interleaved list (each word, then the clause it closes, then the sentence
it closes).  ``pos = wi + clause_id + sent_id`` for words; a clause row follows
its last word and a sentence row follows that.

Stored lists are read in blocks of positions: counts run inside a block, and each
block is given what the blocks before it hold, a row per block.  So no task
depends on the length of one utterance.  What an operator needs of the word
before (``prev``) is found with the counts; windows are used only where a list
was made in this session and does not have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoweave.functions import text as T
from sonoweave.functions.frames import let


def with_groups(words: DataFrame, key: str = "utt_id") -> DataFrame:
    """Add ``clause_end, sent_end, clause_id, sent_id, pos`` to ordered ``words(key, wi, text)``."""
    before = Window.partitionBy(key).orderBy("wi").rowsBetween(Window.unboundedPreceding, -1)
    closed = lambda flag: F.coalesce(F.sum(F.col(flag).cast("int")).over(before), F.lit(0)).cast("int")
    return (
        words.withColumn("clause_end", T.ends_clause(F.col("text")))
        .withColumn("sent_end", T.ends_sentence(F.col("text")))
        .withColumn("clause_id", closed("clause_end"))
        .withColumn("sent_id", closed("sent_end"))
        .withColumn("pos", F.col("wi") + F.col("clause_id") + F.col("sent_id"))
    )


def text_tokens(df: DataFrame, key: str, index: str, text: str = "text") -> DataFrame:
    """``key, index, text``: the tokens of each text.  Null, empty and blank texts have none.

    Texts are moved by key before they become tokens, which are many times larger; the windows and groups of a
    text's tokens then need no exchange.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(key, text).repartition(width, key).select(F.col(key), F.posexplode(T.tokens(F.col(text))).alias(index, "text"))


def text_words(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, wi, text, clause_end, sent_end, clause_id, sent_id, pos``: the words of each text, see :func:`text_tokens`."""
    return with_groups(text_tokens(df, key, "wi", text), key)


def synthetic_times(words: DataFrame, key: str, seed: Column) -> DataFrame:
    """Add ``start_ms, end_ms`` by a fixed rule.  It stands in for an alignment and is none.

    A word lasts 50 ms and 20 ms per character; a gap of 30 ms precedes each, longer after a clause (300)
    or a sentence (800), and 500 more on a pattern of ``wi`` and ``seed``.
    """
    order = Window.partitionBy(key).orderBy("wi")
    lasts = F.lit(50) + F.lit(20) * F.char_length("text")
    last_clause, last_sent = (F.coalesce(F.lag(c).over(order), F.lit(False)) for c in ("clause_end", "sent_end"))
    gap = (
        F.lit(30) + F.when(last_clause, 300).otherwise(0) + F.when(last_sent, 800).otherwise(0)
        + F.when((F.col("wi") * 7 + seed * 13) % 11 == 0, 500).otherwise(0)
    )
    return (
        words.withColumn("_d", lasts.cast("bigint"))
        .withColumn("_g", gap.cast("bigint"))
        .withColumn("end_ms", F.sum(F.col("_g") + F.col("_d")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start_ms", F.col("end_ms") - F.col("_d"))
        .drop("_d", "_g")
    )


def interleave(words: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """``key, pos, type, text, start, end``: word rows with the clause and sentence rows they close.

    A group starts with its first word, ends with its last and has their text without the spaces that
    Chinese does not write.  A clause lies in one sentence, so both are nested groups of one lineage: the words
    are made and moved once, and a row holds one sentence at a time.
    """
    member = F.struct("wi", "text", "pos", F.col(start).alias("s"), F.col(end).alias("e"))
    clause = words.groupBy(key, "sent_id", "clause_id").agg(F.sort_array(F.collect_list(member)).alias("m"))
    sentence = clause.groupBy(key, "sent_id").agg(F.sort_array(F.collect_list(F.struct("clause_id", "m"))).alias("c"))

    def row(kind: str, pos: Column, text: Column, first: Column, last: Column) -> Column:
        return F.struct(pos.alias("pos"), F.lit(kind).alias("type"), text.alias("text"), first["s"].alias(start), last["e"].alias(end))

    def group(kind: str, m: Column, offset: int) -> Column:
        last = F.element_at(m, -1)
        return row(kind, last["pos"] + offset, T.join_tokens(F.transform(m, lambda w: w["text"])), F.get(m, F.lit(0)), last)

    def of_clause(c: Column) -> Column:
        return F.concat(F.transform(c["m"], lambda w: row("word", w["pos"], w["text"], w, w)), F.array(group("clause", c["m"], 1)))

    all_words = F.flatten(F.transform("c", lambda c: c["m"]))
    whole = let(all_words, lambda m: group("sentence", m, 2))
    rows = F.concat(F.flatten(F.transform("c", of_clause)), F.array(whole))
    return sentence.select(key, F.explode(rows).alias("r")).select(key, "r.pos", "r.type", "r.text", f"r.{start}", f"r.{end}")


def attach_times(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """Words with times from ``tokens(utt_id, ti, text)`` and ``items(utt_id, item_idx, start, end)``.

    A token with a Chinese character takes as many items as it has letters (what is left, if fewer), any
    other token one, a token of punctuation alone none: it is glued to the last word that got a time, or
    dropped if there is none.  A token for which no item is left is dropped.
    Result: ``utt_id, wi, text, start, end``.
    """
    clean = T.clean_word(F.col("text"))
    use = F.when(clean == "", 0).when(T.has_cjk(clean), F.char_length(clean)).otherwise(1)
    order = Window.partitionBy("utt_id").orderBy("ti")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    have = items.groupBy("utt_id").agg(F.count("*").cast("int").alias("have"))
    placed = (
        tokens.join(have, "utt_id")
        .withColumn("use", use)
        .withColumn("first", F.least(F.coalesce(F.sum("use").over(before), F.lit(0)), F.col("have")).cast("int"))
        .withColumn("timed", (F.col("use") > 0) & (F.col("first") < F.col("have")))
        .withColumn("wi", F.sum(F.col("timed").cast("int")).over(upto).cast("int") - 1)
        .where((F.col("wi") >= 0) & (F.col("timed") | (F.col("use") == 0)))
        .withColumn("last", F.least(F.col("first") + F.col("use"), F.col("have")).cast("int") - 1)
    )
    words = placed.groupBy("utt_id", "wi").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ti", "text"))), lambda x: x["text"]), "").alias("text"),
        F.min(F.when(F.col("timed"), F.col("first"))).alias("first"), F.min(F.when(F.col("timed"), F.col("last"))).alias("last"),
    )
    # one join for both ends of a word, which as a rule are of one item
    sought = words.withColumn("_i", F.explode(F.array_distinct(F.array("first", "last"))))
    times = items.select("utt_id", F.col("item_idx").cast("int").alias("_i"), "start", "end")
    return sought.join(times, ["utt_id", "_i"], "left").groupBy("utt_id", "wi").agg(
        F.max("text").alias("text"), F.max(F.when(F.col("_i") == F.col("first"), F.col("start"))).alias("start"),
        F.max(F.when(F.col("_i") == F.col("last"), F.col("end"))).alias("end"),
    )


#: Positions per block of a stored list.
BLOCK = 4096


def in_list_blocks(segments: DataFrame) -> DataFrame:
    """Add ``_block``; rows without a position come before all others."""
    return segments.withColumn("_block", F.coalesce(F.floor(F.col("pos") / F.lit(BLOCK)), F.lit(-1)))


def of_long_lists(segments: DataFrame) -> DataFrame:
    """The rows of those lists that are more than one block."""
    block = in_list_blocks(segments.select("utt_id", "pos"))
    long = block.groupBy("utt_id").agg(F.min("_block").alias("lo"), F.max("_block").alias("hi")).where("lo <> hi").select(F.col("utt_id").alias("_long"))
    return segments.join(long, F.col("utt_id").eqNullSafe(F.col("_long")), "left_semi")


def _delivered(segments: DataFrame) -> DataFrame:
    """Rows of a stored segment list, each once: copies of a row share their utterance and position and lie next to each other."""
    order = Window.partitionBy("utt_id", "_block").orderBy("pos", "seg_id", "loaded_at")
    rows = segments if "_block" in segments.columns else in_list_blocks(segments)
    return rows.withColumn("_copy", F.coalesce(F.lag("seg_id").over(order) == F.col("seg_id"), F.lit(False))).where(~F.col("_copy")).drop("_copy")


def usable(seconds: Column) -> Column:
    """The time, null if it is NaN or infinite."""
    return F.when(~F.isnan(seconds) & (F.abs(seconds) < F.lit(float("inf"))), seconds)


def listed_rows(segments: DataFrame) -> DataFrame:
    """The words and clause rows of stored segment lists, with the ids of what they belong to.

    ``utt_id, source, type, wi, pos, clause_id, sent_id, text, start, end, prev``; NaN and infinite times become
    null.  ``prev`` is ``(end, clause_id, sent_id)`` of the word before, null at the first.  A null ``utt_id`` is
    an utterance of its own.
    """
    columns = ("seg_id", "utt_id", "pos", "type", "end", "loaded_at")
    place = Window.partitionBy("utt_id", "_block").orderBy("pos", "seg_id", "loaded_at").rowsBetween(Window.unboundedPreceding, -1)
    is_word = F.col("type") == "word"
    last = F.struct(F.col("end"), F.col("clause_id"), F.col("sent_id"))

    def counted(segments: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        before = lambda kind: F.coalesce(F.sum((F.col("type") == kind).cast("int")).over(place), F.lit(0)).cast("int")
        times = {c: usable(F.col(c)) for c in ("start", "end") if c in columns}
        rows = _delivered(in_list_blocks(segments.select(*columns).withColumns(times)))
        return rows.select("*", before("word").alias("wi"), before("clause").alias("clause_id"), before("sentence").alias("sent_id"))

    of = lambda kind: F.sum((F.col("type") == kind).cast("int"))
    blocks = counted(of_long_lists(segments), columns).groupBy("utt_id", "_block").agg(
        of("word").alias("w"), of("clause").alias("c"), of("sentence").alias("s"),
        F.max(F.when(is_word, F.struct("pos", "seg_id", last.alias("l"))))["l"].alias("l"),
    )
    earlier = Window.partitionBy("utt_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("int").alias(f"_{c}")
    moved = lambda x: F.when(x.isNotNull(), F.struct(x["end"].alias("end"), (x["clause_id"] + F.col("_c")).alias("clause_id"), (x["sent_id"] + F.col("_s")).alias("sent_id")))
    blocks = blocks.select("utt_id", "_block", offset("w"), offset("c"), offset("s"), "l").withColumn("l", moved(F.col("l")))
    blocks = blocks.select(
        F.col("utt_id").alias("_u"), F.col("_block").alias("_b"), "_w", "_c", "_s", F.last("l", ignorenulls=True).over(earlier).alias("_before")
    )
    rows = counted(segments, (*columns, "source", "start", "text"))
    rows = rows.withColumn("_prev", F.last(F.when(is_word, last), ignorenulls=True).over(place)).where(F.col("type").isin("word", "clause"))
    # a list of one block has nothing before it, so as a rule this side is empty and known to be so before the join
    joined = rows.join(blocks, F.col("utt_id").eqNullSafe(F.col("_u")) & (F.col("_block") == F.col("_b")), "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_w", "_c", "_s")})
    return joined.select(
        "utt_id", "source", "type", (F.col("wi") + F.col("_w")).alias("wi"), "pos", (F.col("clause_id") + F.col("_c")).alias("clause_id"),
        (F.col("sent_id") + F.col("_s")).alias("sent_id"), "text", "start", "end", F.coalesce(moved(F.col("_prev")), F.col("_before")).alias("prev"),
    )


def only_words(rows: DataFrame) -> DataFrame:
    """The words of listed rows; a table of words is all of them."""
    return rows.where(F.col("type") == "word").drop("type") if "type" in rows.columns else rows


def listed_words(segments: DataFrame) -> DataFrame:
    """The words of stored segment lists, see :func:`listed_rows`."""
    return only_words(listed_rows(segments))


def with_previous(words: DataFrame) -> DataFrame:
    """Add ``prev`` to words that do not have it."""
    if "prev" in words.columns:
        return words
    order = Window.partitionBy("utt_id").orderBy("pos")
    return words.withColumn("prev", F.lag(F.struct("end", "clause_id", "sent_id")).over(order))


def clauses(rows: DataFrame) -> DataFrame:
    """``utt_id, clause_id, n_words, first_pos, text, start, end, first_start, last_end, paused, closed``.

    Start and end are those of the clause row; ``first_start`` and ``last_end`` those of the first and the last
    word; ``paused`` sums the gaps over 0.2 s inside the clause.  Words after the last clause row are of a clause
    that is not ``closed``.  Where there are only words, each clause is closed and has their first start and last end.
    """
    stored = "type" in rows.columns
    word = F.col("type") == "word" if stored else F.lit(True)
    gap = F.when(F.col("prev.clause_id") == F.col("clause_id"), F.col("start") - F.col("prev.end"))
    own = F.max(F.when(~word, F.struct("start", "end", "text"))).alias("_own") if stored else F.lit(None).alias("_own")
    grouped = (
        with_previous(rows)
        .withColumn("_g", F.when(word, gap))
        .groupBy("utt_id", "clause_id")
        .agg(
            F.sum(word.cast("bigint")).alias("n_words"), F.min(F.when(word, F.col("pos"))).alias("first_pos"),
            F.min_by(F.col("start"), F.when(word, F.col("pos"))).alias("first_start"), F.max_by(F.col("end"), F.when(word, F.col("pos"))).alias("last_end"),
            F.coalesce(F.sum(F.when(F.col("_g") > 0.2, F.col("_g"))), F.lit(0.0)).alias("paused"), own,
        )
        .where(F.col("n_words") > 0)
    )
    of = lambda c, other: F.col(f"_own.{c}") if stored else other
    return grouped.select(
        "utt_id", "clause_id", "n_words", "first_pos", of("text", F.lit(None).cast("string")).alias("text"), of("start", F.col("first_start")).alias("start"),
        of("end", F.col("last_end")).alias("end"), "first_start", "last_end", "paused", (F.col("_own").isNotNull() if stored else F.lit(True)).alias("closed"),
    )


def effective_duration(clamp: bool = False) -> Column:
    """Duration less pauses: of the clause, as extractors take it, or from its first word to its last and not below 0, as calibration does."""
    if clamp:
        return F.greatest(F.col("last_end") - F.col("first_start") - F.col("paused"), F.lit(0.0))
    return F.col("end") - F.col("start") - F.col("paused")


def pauses(words: DataFrame) -> DataFrame:
    """``utt_id, wi, pos, gap, inter_clause`` for each word but the first: time since the previous word's end."""
    return with_previous(words).where(F.col("prev").isNotNull()).select(
        "utt_id", "wi", "pos", (F.col("start") - F.col("prev.end")).alias("gap"), (F.col("prev.clause_id") != F.col("clause_id")).alias("inter_clause"),
    )


def trimmed_words(words: DataFrame, frames: DataFrame) -> DataFrame:
    """``words`` with silence trimmed off (see ``functions.frames.trim_silence``); without frames unchanged.

    The words of an utterance meet its frames once, as one array, so frames are not copied per word.
    """
    from sonoweave.functions import frames as A

    word = F.struct("wi", "start", "end")
    spans = words.groupBy("utt_id").agg(F.collect_list(word).alias("w"))
    moved = spans.join(frames.select("utt_id", "sr", "hop", "energy"), "utt_id").select(
        "utt_id",
        F.explode(
            F.transform(
                "w",
                lambda x: F.struct(x["wi"].alias("wi"), A.trim_silence(F.col("energy"), x["start"], x["end"], F.col("sr"), F.col("hop")).alias("t")),
            )
        ).alias("m"),
    )
    new = moved.select("utt_id", F.col("m.wi").alias("wi"), F.col("m.t.start").alias("_s"), F.col("m.t.end").alias("_e"))
    rest = [c for c in words.columns if c not in ("start", "end", "prev")]  # the word before has moved as well
    return words.join(new, ["utt_id", "wi"], "left").select(*rest, F.coalesce("_s", "start").alias("start"), F.coalesce("_e", "end").alias("end"))
