"""Sentence boundaries by ordered break and no-break rules.

A rule is a pair of regular expressions, one that ends at a position and one
that starts there, with a verdict.  At each candidate position the rules of a
language are tried in order and the first whose two sides both match decides.
Each language has a table of rules; tables cascade tier by tier (tokens,
abbreviations, quotations, pauses, possible endings, final marks), in each tier
the languages' rules before the common ones.  A text gets the tables of the
languages it is written in, as its scripts and function words show; the stored
language is often missing or wrong, texts mix languages, and no join is needed.
A text that shows none gets all tables.

A rule sees the start of the sentence and what lies next to the position, a
bounded number of code points, so time is linear in the text.

Before the rules run, a text is read through a *view*: invisible characters are
skipped, width forms and look-alikes stand for the plain letter, all kinds of
space are one.  Positions are kept, so the result refers to the stored text.
Quotations and brackets are found first; no position inside one is a candidate.
A line break ends a sentence and everything that is open.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sonoweave.llm.lookalikes import SAME_AS_LOWER, SAME_AS_UPPER, sentence_rows, tables

#: Final marks of scripts that need no space after them: Chinese and Japanese, Devanagari, Arabic and Urdu, Ethiopic, Armenian, Khmer, Burmese.
FULL_STOPS = "。！？｡।॥؟۔።፧։។៕။"
MARKS = ".!?…" + FULL_STOPS
#: Opening and closing signs that shield what lies between them.
PAIRS = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】", "《": "》", "‹": "›", "‘": "’", "‚": "‘’"}
CLOSERS = "”»」』)）]】》›\"“’"

# Abbreviations, as patterns of the view, by what may follow them.
#: Titles before a name, with a capital; the same letters in lower case are words or other abbreviations.
TITLES = {
    "en": ["Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Sgt", "Lt", "Capt", "Col", "Gen", "Rev", "Hon", "Gov", "Sen", "Rep", "Maj"],
    "it": ["Sig", r"Sig\.?ra", "Dott", r"Dott\.?ssa", "Prof", "Ing", "Avv", "Geom"],
    "pt": ["Sra?", "Dra?", "Profa?", "Av", "Exm[oa]", "Eng"],
}
#: A name or more of the sentence follows.
NEVER_LAST = {
    "en": ["vol", "cf", r"i\.\s?e", r"e\.\s?g", "approx", "vs", "viz"],
    "it": ["pag", "pagg", "cfr", r"p\.\s?es", "ca"],
    "pt": ["pág", "págs", r"p\.\s?ex", "aprox"],
    "de": ["Dr", "Hr", "Fr", "Prof", "Nr", "ca", "bzw", r"z\.\s?B", r"d\.\s?h", r"u\.\s?a", r"o\.\s?ä", "vgl", "evtl", "ggf"],
    "fr": ["MM", "Mme", "Mlle", "Dr", "env", r"c\.-[aà]-d", "cf"],
    "es": ["Sr", "Sra", "Srta", "Dra?", "Dña", "Uds?", "aprox", r"p\.\s?ej", "pág", "núm"],
    "ru": [r"т\.\s?[еe]", r"т\.\s?к", "ул", "стр", "см", "гл", "проф"],
}
#: A number follows.
BEFORE_NUMBER = ["no", "nos", "vol", "vols", "pp?", "fig", "art", "chap", "ch", "sec", "Nr", "Bd", "S", "pág", "núm", "стр", "с", "гл", "рис"]
#: Single letters, in this case only, that go on with another part of an abbreviation.
FIRST_LETTERS = r"(?:[zduoivnapce]|[тиаик])\.", r"\s?(?:B|h|a|e|g|ej|ä|m|s|w|Chr|C|е|д|к|п|э|-?à)\b"
#: A title of one letter before a name.
LETTER_TITLES = r"[MDSP]"
# Months that follow an ordinal number.
MONTHS = ["Januar", "Jänner", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]
#: The sentence may end here: it does if what follows starts like one.
MAYBE_LAST = {
    "en": [r"a\.\s?m", r"p\.\s?m", "etc", "Co", "Inc", "Ltd", "Corp", "Jr", "Sr", r"U\.\s?S", "Bros"],
    "de": ["usw", r"u\.\s?s\.\s?w", r"v\.\s?Chr", r"n\.\s?Chr", "Jh"],
    "fr": ["etc", r"av\.\s?J\.-C"],
    "es": ["etc", r"a\.\s?C", r"d\.\s?C", r"EE\.\s?UU"],
    "it": ["ecc", r"a\.\s?C", r"d\.\s?C"],
    "pt": ["etc", r"a\.\s?C", r"d\.\s?C"],
    "ru": ["г", "гг", "руб", "коп", "тыс", "млн", r"т\.\s?д", r"т\.\s?п", r"др", "км", "м"],
}
#: Verbs of a reporting clause; it belongs to the quotation before it.
REPORTING = {
    "en": ["said", "asked", "shouted", "replied", "answered", "cried", "called", "whispered", "added", "wrote", "told", "exclaimed"],
    "de": ["sagte", "fragte", "rief", "antwortete", "schrieb", "meinte", "flüsterte"],
    "fr": ["dit", "demanda", "s'écria", "s’écria", "répondit", "cria", "murmura", "ajouta", "dit-on", "demanda-t-on", "demanda-t-elle", "demanda-t-il"],
    "es": ["dijo", "preguntó", "gritó", "respondió", "exclamó", "contestó", "añadió"],
    "ru": ["сказал", "сказала", "спросил", "спросила", "крикнул", "крикнула", "ответил", "ответила", "закричал", "закричала"],
}
CHINESE_REPORTING = "说问喊道答叫"
#: English verbs after which "no" is an answer, and nouns that a letter numbers.
ANSWERS, LETTERED = ["answered", "replied", "said", "says", "say"], ["plan", "vitamin", "grade", "type", "class", "group", "section", "option", "team", "room"]
# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the and of is was were to in that it with for on at by from he she they have had be not this".split(),
    "de": "der die das und ist nicht ein eine mit von den dem des zu im auf für war hat sich aus am".split(),
    "fr": "le la les et est des un une dans que qui du au pour pas sur avec il elle en a ce".split(),
    "es": "el la los las y es de que en un una del por con no se al su para lo".split(),
    "it": "il lo la gli e è di che un una del della per con non si nel sono ha".split(),
    "pt": "o a os as e é de que um uma do da em por com não se no na para".split(),
}
#: Words that carry a sentence on after a pause.
GOING_ON = {"zh": ["可是", "但是", "不过", "然而", "却", "而", "又", "就", "所以", "因为", "于是", "后来", "然后"], "ja": ["いや", "でも", "しかし", "だが", "そして", "それ", "と"]}


@cache
def _one_sign() -> dict[int, str | None]:
    """Width forms, compatibility signs and spaces for the view; ``None`` is skipped."""
    frm, to, several, hidden = tables()
    alike = {x for group in (SAME_AS_UPPER, SAME_AS_LOWER) for xs in group.values() for x in xs}
    out: dict[int, str | None] = {ord(a): b for a, b in zip(frm, to, strict=True) if a not in alike}
    # marks keep their own width: the rules tell them apart
    for ch in "！？，；：（）［］｡．＂":
        out.pop(ord(ch), None)
    out.update({ord(a): b for a, b in several})
    out.update({ord(c): None for c in hidden})
    return out


#: Letters of Russian that no Latin letter looks like.
_RUSSIAN = regex.compile(r"[бвгджзийклмнптфцчшщъыьэюяё]", regex.IGNORECASE)


@cache
def _alike() -> tuple[dict[str, str], dict[str, str]]:
    """Look-alike letters to Latin, and Latin letters to the Cyrillic ones they look like."""
    latin = {x: to for group in (SAME_AS_UPPER, SAME_AS_LOWER) for to, xs in group.items() for x in xs}
    cyrillic = {to: x for x, to in latin.items() if 0x400 <= ord(x) < 0x460 and x not in "іјѕІЈЅ"}
    return latin, cyrillic


def view(text: str) -> tuple[str, list[int]]:
    """The text as a reader sees it and, per character of it, the position in ``text``."""
    if text.isascii():
        return text, list(range(len(text)))
    signs = _one_sign()
    chars: list[str] = []
    at: list[int] = []
    for i, ch in enumerate(text):
        code = ord(ch)
        if code < 128:
            chars.append(ch)
            at.append(i)
            continue
        to = signs.get(code, ch)
        if to is None:
            continue
        if unicodedata.combining(ch) and chars:
            whole = unicodedata.normalize("NFC", chars[-1] + ch)
            if len(whole) == 1:
                chars[-1] = whole
                continue
        for c in to:
            chars.append(c)
            at.append(i)
    plain = "".join(chars)
    return (plain if plain.isascii() else _one_script(plain)), at


def _one_script(plain: str) -> str:
    """Look-alike letters to the script of their word, as its other letters show it; else to that of the text."""
    latin, cyrillic = _alike()
    russian = len(regex.findall(_RUSSIAN, plain)) > len(regex.findall(r"\p{Latin}", plain))

    def settle(word: regex.Match) -> str:
        w = word.group()
        if w.isascii() and not russian:
            return w
        if regex.search(_RUSSIAN, w):
            return "".join(cyrillic.get(c, c) for c in w)
        if russian and all(c in cyrillic or c in latin for c in w):
            return "".join(cyrillic.get(c, c) for c in w)
        return "".join(latin.get(c, c) for c in w)

    return regex.sub(r"\p{L}+", settle, plain)


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _flat(table: dict[str, list[str]], *langs: str) -> list[str]:
    return sorted({w for lang in langs for w in table.get(lang, [])}, key=lambda w: (-len(w), w))


#: What a sentence may start with after a gap: a capital, a digit, an opening sign, a letter without case.
_START = r"[\p{Lu}\p{Lt}\p{Lo}\p{N}“„«「『(（\[\"'‘¿¡—–-]"


#: How much of a sentence's start, and of what lies before a position, the rules see.
OPENING, NEAR = 32, 96
#: A break or no-break pair: the verdict, what ends at the position, what starts there.
Rule = tuple[bool, str, str]
#: Order of precedence; within each, the languages' rules come before the common ones.
TIERS = ("token", "abbreviation", "quotation", "pause", "ending", "mark")
LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "ru", "zh", "ja")

# French sets a space between the mark and the closing sign
_CLOSE = r"(?:\s?[»›]|[”」』\"“’)）\]】》])*"
_WORD_START = r"(?<![\p{L}\p{N}])(?<!\p{L}\.)"
_NAME = r"(?:\p{Lu}[\p{L}'’-]*\.?|[\p{Lu}]\.)"
_QUOTED = r"(?s:^\s*[\"“„«].*[\"”»“])"


def language_table(lang: str) -> dict[str, list[Rule]]:
    """The rules of one language by tier."""
    table: dict[str, list[Rule]] = {tier: [] for tier in TIERS}
    if lang == "en":  # a lone "no", and a letter after the noun that it numbers, end a sentence
        table["abbreviation"] += [(True, rf"(?i:\b{_any(ANSWERS)}) no\.", r"\s+\p{N}"), (True, rf"(?i:\b{_any(LETTERED)}) \p{{Lu}}\.", r"\s+\p{Lu}")]
    if lang in TITLES:
        titles = _flat(TITLES, lang)
        table["abbreviation"] += [
            (False, rf"{_WORD_START}{_any(titles)}\.", r"\s*[^\s\n]"),
            # a text all in capitals, or in none
            (False, rf"{_WORD_START}(?=\p{{Lu}}+\.)(?i:{_any(titles)})\.", r"\s*\p{Lu}"), (False, rf"{_WORD_START}(?i:{_any(titles)})\.", r"\s*\p{Ll}"),
        ]
    if lang in NEVER_LAST:
        table["abbreviation"].append((False, rf"(?i:{_WORD_START}{_any(_flat(NEVER_LAST, lang))})\.", r"\s*[^\s\n]"))
    if lang in MAYBE_LAST:
        maybe = _any(_flat(MAYBE_LAST, lang))
        starts = rf"\s+{_START}|[“„«「\"¿¡]|[\p{{Han}}\p{{Katakana}}\p{{Hiragana}}]|\p{{Lu}}[\p{{Ll}}.'’]"
        table["ending"] += [(True, rf"(?i:{_WORD_START}{maybe})\.{_CLOSE}", starts), (False, rf"(?i:{_WORD_START}{maybe})\.", r"\s*\S")]
    if lang in REPORTING:
        says = rf"(?i:{_any(REPORTING[lang])})(?![\p{{L}}])"
        table["quotation"] += [
            # the reporting clause after a quotation: the verb, or a name and the verb; after a bare mark the verb only
            (False, r"[\"”»“]", rf"\s*{says}"),
            (False, _QUOTED, rf"\s(?:{_NAME}\s){{1,4}}{says}"),
            (False, rf"[!?]{_CLOSE}", rf"\s?{says}(?!-)"),
        ]
    if lang in GOING_ON:
        table["pause"].append((False, r"(?:…+|\.\.+)", rf"\s?{_any(GOING_ON[lang])}"))
    if lang == "en":  # a clock time that opens the sentence leads on to its subject
        table["abbreviation"].append((False, r"(?i:(?:^|[\n])\s*[\"“«„]?at \p{N}{1,2} ?[ap]\.\s?m)\.", r"\s"))
    if lang == "de":  # ordinal numbers of dates
        table["token"].append((False, r"(?<!\p{N})\p{N}{1,2}\.", rf"\s?(?i:{_any(MONTHS)})(?!\p{{L}})"))
    if lang == "fr":  # only French sets a space before these marks
        table["quotation"].append((False, r"\s[!?]", r"\s\p{Ll}"))
    if lang == "zh":
        quoted = r"(?s:^\s*[“\"「『].*[”\"」』])"
        table["quotation"] += [
            (False, quoted, rf"\s?[^\n。！？!?，,“”\"]{{1,24}}[{CHINESE_REPORTING}](?=[，,。！？：:]|$)"),
            (False, quoted, r"\s?[^\n。！？!?，,“”\"]{1,16}\Z"),  # only the beginning of it, in a cut text
        ]
    if lang == "ja":
        table["quotation"].append((False, r"[」』]", r"\s?(?:と|って|は|が|を|に|の|も)"))
    return table


def common_table() -> dict[str, list[Rule]]:
    """The rules that hold in every language, by tier."""
    first, second = FIRST_LETTERS
    return {
        "token": [  # numbers, versions, file names: no gap, more of the token follows
            (False, r"[\p{N}]\.", r"\p{N}"),
            (False, r"[\p{L}\p{N}_]\.", r"[a-z]{2,4}(?![\p{L}])(?<![.!?。！？])(?=[\s,;:.!?)”\"。，]|$)"),
        ],
        "abbreviation": [
            (False, rf"{_WORD_START}{first}", second),
            (False, rf"(?i:{_WORD_START}{_any(BEFORE_NUMBER)})\.", r"\s?\p{N}"),
            # initials and titles of one letter
            (False, rf"{_WORD_START}\p{{Lu}}\.", r"\s?\p{Lu}"),
            (False, rf"{_WORD_START}{LETTER_TITLES}\.", r"\s?\p{L}"),
            (False, r"^\s*\p{L}\.", r"\s?\S"),
        ],
        "quotation": [(False, _QUOTED, rf"\s(?:{_NAME}\s?){{1,3}}\p{{Ll}}{{0,8}}\Z")],  # the beginning of a reporting clause, in a cut text
        "pause": [  # the sentence goes on unless a new one visibly starts
            (False, r"(?:…+|\.\.+)", r"\s?[\p{Ll},;:，；、]"),
            (False, r"\s\.\.+", r"\s?\S"),
            (False, r"…", r"[\p{Lo}\p{Lm}]"),
            (True, r"(?:…+|\.\.+)[”»」』\"“’)）]*", rf"(?:\s+|){_START}"),
            (False, r"(?:…+|\.\.+)", r"\s*\S"),
        ],
        "ending": [],
        "mark": [
            # a quotation or bracket that ends with a mark: the sentence goes on in lower case or after a comma
            (False, rf"[{MARKS}](?:\s?[»›]|[”」』\"“’)）\]】》])+", r"\s*[\p{Ll},;:，；：、—–]"),
            (False, r"[)）\]】》›]", r"\s?[^\s]"),
            (False, r"[!?]", r"\s\p{Ll}"),  # part of a name, or of what is exclaimed
            (True, rf"[.!?{FULL_STOPS}]{_CLOSE}", r"\s+\S"),
            (True, rf"[{FULL_STOPS}]{_CLOSE}", r"\S"),
            (True, rf"(?:[!?]|[\p{{L}}\p{{N}})]\.){_CLOSE}", rf"[\p{{Lu}}\p{{Lo}}“„«「『¿¡\"]|\p{{N}}"),
        ],
    }


@cache
def rules(langs: tuple[str, ...] = LANGUAGES) -> tuple[tuple[bool, regex.Pattern, regex.Pattern], ...]:
    """The cascade of some languages: tier by tier, each language's table, then the common one."""
    tables = [*map(language_table, langs), common_table()]
    cascade = [rule for tier in TIERS for table in tables for rule in table[tier]]
    return tuple((breaks, regex.compile(rf"(?:{before})\Z", regex.REVERSE), regex.compile(after)) for breaks, before, after in cascade)


_SCRIPTS = (
    (regex.compile(r"\p{Cyrillic}"), ("ru",)), (regex.compile(r"[\p{Hiragana}\p{Katakana}]"), ("ja", "zh")), (regex.compile(r"\p{Han}"), ("zh", "ja")),
)
_SPELLED = {w: tuple(lang for lang, words in FUNCTION_WORDS.items() if w in words) for words in FUNCTION_WORDS.values() for w in words}


def languages_of(plain: str) -> tuple[str, ...]:
    """The languages whose tables a text (of the view) needs, in the order of ``LANGUAGES``.

    A script names its languages.  Of those in Latin letters all count that have half as many function words
    as the one with the most; a text with Latin words of none may be in any of them.
    """
    found = {lang for script, langs in _SCRIPTS if script.search(plain) for lang in langs}
    counts = dict.fromkeys(FUNCTION_WORDS, 0)
    latin = False
    for word in regex.findall(r"\p{Latin}+", plain.lower()):
        latin = True
        for lang in _SPELLED.get(word, ()):
            counts[lang] += 1
    most = max(counts.values())
    if most:
        found |= {lang for lang, n in counts.items() if 2 * n >= most}
    elif latin or not found:
        found |= set(FUNCTION_WORDS) if latin else set(LANGUAGES)
    return tuple(lang for lang in LANGUAGES if lang in found)


#: Stands for what a rule does not see.
_ELISION = "\ufffc"
_OPEN_DOUBLE = '"'


def shielded(line: str) -> list[tuple[int, int]]:
    """Outermost ``[open, close]`` ranges of quotations and brackets in a line; an unclosed one runs to its end."""
    out: list[tuple[int, int]] = []
    stack: list[str] = []
    start = 0
    for i, ch in enumerate(line):
        if stack and ch in stack[-1]:
            stack.pop()
            if not stack:
                out.append((start, i))
        elif ch == _OPEN_DOUBLE:
            if not stack:
                start = i
            stack.append(_OPEN_DOUBLE)
        elif ch in PAIRS and not (ch in "‘‚" and i and line[i - 1].isalpha()):
            if not stack:
                start = i
            stack.append(PAIRS[ch])
    if stack:
        out.append((start, len(line)))
    return out


def line_breaks(line: str, langs: tuple[str, ...] = LANGUAGES) -> list[int]:
    """Positions in a line (of the view) where a sentence ends and another starts."""
    table = rules(langs)
    inside = bytearray(len(line) + 1)
    for lo, hi in shielded(line):
        inside[lo : min(hi, len(line))] = b"\x01" * (min(hi, len(line)) - lo)
    end = len(line.rstrip())
    ends: list[int] = []
    begin = 0
    for i in _candidates(line, inside):
        if i >= end:
            break
        head = line[begin:i] if i - begin <= OPENING + NEAR else line[begin : begin + OPENING] + _ELISION + line[i - NEAR : i]
        for breaks, before, after in table:
            if after.match(line, i) and before.search(head):
                if breaks:
                    ends.append(i)
                    begin = i
                    while line[begin].isspace():
                        begin += 1
                break
    return ends


def _candidates(line: str, inside: bytearray) -> Iterator[int]:
    """Ends of runs of final marks with the closing signs after them, outside of all shields."""
    n, i = len(line), 0
    while i < n:
        ch = line[i]
        if ch in MARKS and not inside[i]:
            while i < n and line[i] in MARKS and not inside[i]:
                i += 1
            yield i
            continue
        if ch in CLOSERS and not inside[i] and i and inside[i - 1]:
            # the closing sign of a shield, after a mark (French sets a space between)
            k = i - 1
            while k > i - NEAR and k > 0 and line[k] == " ":
                k -= 1
            closed = line[k] in MARKS
            i += 1
            more = i
            while more < n and line[more] in MARKS and not inside[more]:
                more += 1
            if closed or more > i:
                i = more
                yield i
            continue
        i += 1


def sentences(text: str, langs: tuple[str, ...] | None = None) -> list[tuple[int, int]]:
    """``(from, to)`` of each sentence of a text, code points, without white space at either end.

    ``langs`` are the languages whose tables apply; by default those it is written in.
    """
    if not text or text.isspace():
        return []
    plain, at = view(text)
    langs = langs or languages_of(plain)
    at.append(len(text))
    signs = _one_sign()
    out: list[tuple[int, int]] = []
    base = 0
    for line in plain.splitlines(keepends=True):
        body = line.rstrip("\r\n\x0b\x0c\x1c\x1d\x1e\x85  ")
        cuts = [0, *line_breaks(body, langs), len(body)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            a = at[base + lo]
            b = at[base + hi - 1] + 1 if hi > lo else a
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            while a < b < len(text) and ord(text[b]) > 127 and signs.get(ord(text[b]), "") is None:
                b += 1  # signs without a shape that follow directly belong to it
            if b > a:
                out.append((a, b))
        base += len(line)
    return out


def split_texts(df: DataFrame, key: str = "seg_id", text: str = "text") -> DataFrame:
    """``seg_id, sent_no, char_from, char_to`` for every row; one narrow pass.

    Null, empty and blank texts have no sentence.  Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(k, n, a, b) for n, (a, b) in enumerate(sentences(t))] if t else []
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), ty) for c, ty in zip(cols, types, strict=True)], names=[key, "sent_no", "char_from", "char_to"])

    return df.select(key, text).mapInArrow(run, f"{key} bigint, sent_no int, char_from int, char_to int")


def sentence_positions(segments: DataFrame) -> DataFrame:
    """The sentences of every sentence row with a text, each ``seg_id`` once."""
    return split_texts(sentence_rows(segments).select("seg_id", "text"))
