"""Column expressions over transcript text: tokens, words, languages, tags.

All of them stay in the JVM, work on one row and need no shuffle.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks that end a sentence, and those that also end a clause.
SENTENCE_END = "。！？.!?"
CLAUSE_END = SENTENCE_END + "，,；;"
# Language names by code or name.
LANGUAGES = {
    "zh": "Chinese", "en": "English", "yue": "Cantonese", "ja": "Japanese", "ko": "Korean", "fr": "French", "de": "German",
    "es": "Spanish", "pt": "Portuguese", "ru": "Russian", "it": "Italian",
}

#: White space as Unicode has it, wider than Java's ``\s``.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_WORD = "[a-zA-Z0-9']"
#: A token proper: a run of ASCII letters, digits and apostrophes, or one other letter or digit.
_CORE = rf"(?:{_WORD}{{2,}}|[a-zA-Z0-9]|(?!{_WORD})[\p{{L}}\p{{N}}])"
#: Punctuation: any other sign but white space, and an apostrophe that stands alone.
_MARK = rf"(?:[^\p{{L}}\p{{N}}'\s\x1c-\x1f\x85\p{{Z}}]|(?<!{_WORD})'(?!{_WORD}))"
#: A token with the punctuation that is glued to it; punctuation that opens the text is a token of its own.
TOKEN = rf"{_CORE}(?:{SPACE}*{_MARK})*|\A{SPACE}*{_MARK}(?:{SPACE}*{_MARK})*"
CJK_TOKEN = r"^[一-鿿　-〿＀-￯]+$"


def tokens(text: Column) -> Column:
    """Tokens of a text in order; ``[]`` for null, empty and blank texts.

    Each non-ASCII letter is a token, punctuation is glued to the token before it, white space is dropped.
    One regular expression finds a token with what is glued to it, so there is no fold over characters.
    """
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.regexp_replace(t, SPACE, ""))


def normalize(text: Column) -> Column:
    """The tokens of a text joined by spaces."""
    return F.array_join(tokens(text), " ")


def denormalize(text: Column) -> Column:
    """Undo :func:`normalize`: no space next to a token that is wholly Chinese or full-width, one between others."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), rf"{SPACE}+"), lambda t: t != "")
    return join_tokens(parts)


# Code points that no text holds, around tokens that take no spaces.
_OPEN, _SHUT = "\ufdd0", "\ufdd1"


def join_tokens(parts: Column) -> Column:
    """Token array to text, with a space only between two tokens that are not wholly Chinese or full-width.

    Two replacements over the joined text: linear in it, unlike a lookup of each token's neighbour.
    """
    marked = F.regexp_replace(F.array_join(parts, " "), rf"(?<=^| )({CJK_TOKEN[1:-1]})(?= |$)", f"{_OPEN}$1{_SHUT}")
    return F.regexp_replace(marked, f" ?{_OPEN}|{_SHUT} ?", "")


def is_punctuation(char: Column) -> Column:
    """One character of a Unicode punctuation category."""
    return char.rlike(r"^\p{P}$")


def clean_word(word: Column) -> Column:
    """Letters, digits and underscore only, lower case."""
    return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}_]", ""))


def has_cjk(word: Column) -> Column:
    return word.rlike(r"[一-鿿]")


def ends_clause(word: Column) -> Column:
    """A clause mark anywhere in the word; null is no mark."""
    return F.coalesce(word.rlike(f"[{CLAUSE_END}]"), F.lit(False))


def ends_sentence(word: Column) -> Column:
    """A sentence mark anywhere in the word (so ``3.14`` ends a sentence); null is no mark."""
    return F.coalesce(word.rlike(f"[{SENTENCE_END}]"), F.lit(False))


def language_name(lang: Column, strict: bool = False) -> Column:
    """English name of a language code or name, any case.

    Unknown languages pass through unchanged; with ``strict`` they raise when evaluated.
    """
    pairs = {k: v for k, v in LANGUAGES.items()} | {v.lower(): v for v in LANGUAGES.values()}
    known = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs.items()))
    name = F.try_element_at(known, F.lower(lang))
    if strict:
        return F.when(name.isNull() & lang.isNotNull(), F.raise_error(F.concat(F.lit("Unsupported language: "), lang))).otherwise(name)
    return F.coalesce(name, lang)


def spelled_language(lang: Column) -> Column:
    """Language of a code, name, or directory in any case, padding and with a region (``zh-CN``): its English name.

    Null, blank, ``mixed`` and names of several languages (``zh_en``) are null: only the recording tells.  Others
    pass through unchanged.
    """
    parts = F.split(F.lower(F.trim(lang)), "[-_]")
    known = F.array_distinct(F.filter(F.transform(parts, lambda p: F.when(language_name(p) != p, language_name(p))), lambda n: n.isNotNull()))
    return F.when(F.trim(lang).isin("", "mixed") | (F.size(known) > 1), None).otherwise(F.coalesce(F.get(known, F.lit(0)), F.trim(lang)))


def written_language(text: Column) -> Column:
    """Language of a recognised text by its script: Japanese for kana, Chinese, Korean, Russian, else English; null for null."""
    return (
        F.when(text.rlike(r"[\p{IsHiragana}\p{IsKatakana}]"), "Japanese").when(text.rlike(r"\p{IsHangul}"), "Korean")
        .when(text.rlike(r"\p{IsHan}"), "Chinese").when(text.rlike(r"\p{IsCyrillic}"), "Russian").when(text.isNotNull(), "English")
    )


def lang_style(lang: Column, style: Column | None = None) -> Column:
    """Statistics group: ``zh`` for ``zh`` and ``chinese``, ``en`` for everything else and null; then the style (``read`` if null)."""
    prefix = F.when(F.coalesce(lang, F.lit("")).isin("zh", "chinese"), "zh").otherwise("en")
    return F.concat_ws("_", prefix, F.lit("read") if style is None else F.coalesce(style, F.lit("read")))


def language_of_directory(name: Column) -> Column:
    """English or Chinese if the directory name has just one of ``en`` and ``zh``, else null."""
    en, zh = name.contains("en"), name.contains("zh")
    return F.when(en & ~zh, "English").when(zh & ~en, "Chinese")


def error_rate_tokens(text: Column) -> Column:
    """Tokens that the word error rate compares: lower case, no punctuation, split at white space; ``[]`` for null."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]", "")
    return F.filter(F.split(bare, rf"{SPACE}+"), lambda t: t != "")


def render_tag(kind: Column, value: Column) -> Column:
    """``[type=value]``; the emphasis label is ``[emphasis]``."""
    return F.when((kind == "emphasis") & (value == "emphasis"), F.lit("[emphasis]")).otherwise(
        F.concat(F.lit("["), kind, F.lit("="), value, F.lit("]"))
    )


def utterance_label(lang: Column, stem: Column) -> Column:
    return F.format_string("[%s] %s", lang, stem)


def tag_spans(tags: Column) -> Column:
    """The tags of a rendered string, ``[...]`` each."""
    return F.regexp_extract_all(F.coalesce(tags, F.lit("")), F.lit(r"\[[^\]]*\]"), F.lit(0))
