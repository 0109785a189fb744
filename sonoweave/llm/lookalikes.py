"""One form for texts that look the same but differ in their characters.

DuckDB runs inside each Arrow batch and applies one SQL expression: drop what is
invisible, compose accents (``nfc_normalize``), map single code points
(``translate``) and the few signs that stand for several (``replace``), and
compose once more.  The result is compared, never shown: letters of different
scripts that look alike come out as one of them.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters that have the shape of a Latin letter, Latin first, then Cyrillic and Greek.
SAME_AS_UPPER = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜϺ",
    "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", "G": "Ԍ", "Q": "Ԛ", "W": "Ԝ",
}
SAME_AS_LOWER = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "іι", "j": "јϳ", "l": "ӏ", "o": "оο", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү",
}
# The hiragana whose shape is the katakana's.
SAME_KANA = {"ヘ": "へ", "ベ": "べ", "ペ": "ぺ"}
#: Compatibility signs that a reader tells from their expansion (an ellipsis is one mark, three stops are three).
DISTINCT = frozenset("…‥․ſẛ")
#: Kinds of compatibility form that look like what they stand for.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<small>", "<vertical>", "<font>")


def _invisible(c: int) -> bool:
    """Format characters, variation selectors, fillers and joiners: nothing is drawn for them."""
    return (
        unicodedata.category(chr(c)) == "Cf" and not 0x600 <= c <= 0x605 and c not in (0x6DD, 0x70F, 0x8E2, 0x110BD, 0x110CD)
    ) or c in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or 0x180B <= c <= 0x180F


@cache
def tables() -> tuple[str, str, list[tuple[str, str]], str]:
    """``(from, to, expansions, invisible)``: single mappings, signs for several code points, what to drop."""
    single: dict[str, str] = {}
    several: list[tuple[str, str]] = []
    hidden = ""
    alike = {x: to for group in (SAME_AS_UPPER, SAME_AS_LOWER, SAME_KANA) for to, xs in group.items() for x in xs}
    # the planes between have no signs yet; the tags and variation selectors of plane 14 are invisible
    for c in itertools.chain(range(0x20, 0x34000), range(0xE0000, 0xE1000)):
        ch = chr(c)
        if 0xD800 <= c <= 0xDFFF:
            continue
        if _invisible(c):
            hidden += ch
            continue
        if unicodedata.category(ch) == "Zs":
            if ch != " ":
                single[ch] = " "
            continue
        kind = unicodedata.decomposition(ch).split(" ")[0]
        if 0xFF66 <= c <= 0xFF9F and c in (0xFF9E, 0xFF9F):
            single[ch] = "゙゚"[c - 0xFF9E]  # half-width sound marks combine with the kana before them
            continue
        to = ch
        if kind in SAME_LOOK and ch not in DISTINCT:
            to = unicodedata.normalize("NFKC", ch)
            if not to.strip() or to[0] == " ":
                to = ch
        # an accent on a look-alike letter is the accent on the letter it looks like
        to = unicodedata.normalize("NFC", "".join(alike.get(x, x) for x in unicodedata.normalize("NFD", to)))
        if len(to) == 1 and to != ch:
            if to != unicodedata.normalize("NFC", ch):  # composition already gives canonical equivalents
                single[ch] = to
        elif kind in SAME_LOOK and all(x.isalpha() or x in "!?" for x in to) and to.isascii():
            several.append((ch, to))  # ligatures, digraphs, numerals, doubled marks
    # what a mapped form is mapped to in turn
    for ch, to in list(single.items()):
        single[ch] = single.get(to, to)
    return "".join(single), "".join(single.values()), several, hidden


def _class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in chars) + "]"


def _common(ch: str) -> bool:
    """Spaces, width forms and look-alike letters; the other mappings are looked for first, since they are rare and many."""
    c = ord(ch)
    return c < 0x590 or 0x1F00 <= c < 0x2070 or c == 0x3000 or 0x3040 <= c < 0x3100 or 0xFF00 <= c < 0xFFF0


def one_form_sql(source: str, text: str = "t") -> str:
    """A DuckDB query: all columns of ``source`` and ``one_form``, the consistent form of its column ``text``.

    Null stays null.  A text of one-byte characters only is its own form.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    frm, to, several, hidden = tables()
    often = [(a, b) for a, b in zip(frm, to, strict=True) if _common(a)]
    seldom = [(a, b) for a, b in zip(frm, to, strict=True) if not _common(a)]
    mapped = lambda x, pairs: f"translate({x}, {quote(''.join(a for a, _ in pairs))}, {quote(''.join(b for _, b in pairs))})"
    rare = quote(_class("".join(a for a, _ in seldom) + "".join(a for a, _ in several)))
    expanded = mapped("f1", seldom)
    by_target: dict[str, str] = {}
    for ch, target in several:
        by_target[target] = by_target.get(target, "") + ch
    for target, chars in by_target.items():
        expanded = f"regexp_replace({expanded}, {quote(_class(chars))}, {quote(target)}, 'g')"
    plain = f"strlen({text}) = length({text})"
    steps = [
        f"CASE WHEN {plain} THEN NULL ELSE nfc_normalize(regexp_replace({text}, {quote(_class(hidden))}, '', 'g')) END AS f1",
        f"CASE WHEN regexp_matches(f1, {rare}) THEN {expanded} ELSE f1 END AS f2",
        f"{mapped('f2', often)} AS f3",
        "nfc_normalize(f3) AS f4",
        # what composition has made of mapped letters may be a mapped letter again
        f"CASE WHEN {plain} THEN {text} WHEN f4 = f3 THEN f4 ELSE {mapped('f4', often)} END AS one_form",
    ]
    query = source
    for step in steps:
        query = f"SELECT *, {step} FROM ({query})"
    return f"SELECT * EXCLUDE (f1, f2, f3, f4) FROM ({query})"


def with_one_form(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, one_form``: DuckDB over each Arrow batch, on one thread of the task.

    A null text has a null form; an empty one, or one of invisible characters only, the empty form.
    """
    sql = one_form_sql("SELECT k, t FROM batch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        try:
            for b in batches:
                if b.num_rows:
                    con.register("batch", pa.Table.from_batches([b]))
                    table = con.sql(sql).to_arrow_table()
                    con.unregister("batch")
                    yield from table.cast(out).to_batches()
        finally:
            con.close()

    out = pa.schema([("k", pa.int64()), ("t", pa.string()), ("one_form", pa.string())])
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "k bigint, t string, one_form string").select(F.col("k").alias(key), F.col("t").alias(text), "one_form")


def sentence_rows(segments: DataFrame) -> DataFrame:
    """``seg_id, source, text`` of the sentence rows with an id and a text, each ``seg_id`` once.

    Of several deliveries with different contents the earliest counts, ties by text.
    """
    rows = segments.where((F.col("type") == "sentence") & F.col("seg_id").isNotNull() & F.col("text").isNotNull())
    first = rows.groupBy("seg_id").agg(F.min(F.struct("loaded_at", "text", "source")).alias("r"))
    return first.select("seg_id", F.col("r.source").alias("source"), F.col("r.text").alias("text"))


def forms(segments: DataFrame) -> DataFrame:
    """``seg_id, form, variant``: 128-bit fingerprints of each sentence row's one form and of its text as stored."""
    rows = segments.where((F.col("type") == "sentence") & F.col("seg_id").isNotNull() & F.col("text").isNotNull())
    marked = with_one_form(rows, "seg_id", "text").select("seg_id", F.md5("one_form").alias("form"), F.md5("text").alias("variant"))
    # redelivered rows are equal: the fingerprints settle them without moving the texts
    return marked.groupBy("seg_id").agg(F.min("form").alias("form"), F.min("variant").alias("variant"))


def same_look_groups(segments: DataFrame) -> DataFrame:
    """One row per sentence row: ``seg_id, look_id, variants``.

    ``look_id`` is the least ``seg_id`` that looks the same, ``variants`` the number of different strings
    that do (1: it has no differing twin).  Linear in the rows: copies are counted, not paired.
    """
    marked = forms(segments)
    groups = marked.groupBy("form", "variant").agg(F.min("seg_id").alias("m")).groupBy("form").agg(F.min("m").alias("look_id"), F.count("*").alias("variants"))
    return marked.join(groups, "form").select("seg_id", "look_id", "variants")


def same_look_pairs(segments: DataFrame) -> DataFrame:
    """``seg_a, seg_b``, ``seg_a < seg_b``: sentence rows whose texts look the same but are different strings.

    Null texts are never in a pair, equal strings neither; a redelivered row counts once.  The pairs are the
    stated result; they are made only within forms that occur in more than one string, by an equi-join whose
    partitions adaptive execution splits where a form is hot.
    """
    marked = forms(segments)
    mixed = marked.groupBy("form").agg(F.min("variant").alias("lo"), F.max("variant").alias("hi")).where("lo <> hi").select("form")
    inside = marked.join(mixed, "form", "left_semi")
    a = inside.select("form", F.col("seg_id").alias("seg_a"), F.col("variant").alias("va"))
    b = inside.select("form", F.col("seg_id").alias("seg_b"), F.col("variant").alias("vb"))
    return a.join(b, "form").where((F.col("seg_a") < F.col("seg_b")) & (F.col("va") != F.col("vb"))).select("seg_a", "seg_b")
