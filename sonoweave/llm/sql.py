"""DuckDB counterparts of the queries that SQL can express, on whole tables."""

from __future__ import annotations

import itertools
import unicodedata

from sonoweave.llm.lookalikes import DISTINCT, SAME_AS_LOWER, SAME_AS_UPPER, SAME_KANA, SAME_LOOK
from sonoweave.llm.truncation import AROUND, CLOSED, LEAST_VOTES, TAIL, UNSPACED



def _look(ch: str) -> str:
    """What one sign looks like, by the Unicode database: nothing, a space, plain letters or itself."""
    code = ord(ch)
    if unicodedata.category(ch) == "Cf" and not 0x600 <= code <= 0x605 or code in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0) or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
        return ""
    if unicodedata.category(ch) == "Zs":
        return " "
    plain = ch
    if unicodedata.decomposition(ch).split(" ")[0] in SAME_LOOK and ch not in DISTINCT:
        wide = unicodedata.normalize("NFKC", ch)
        if len(wide) == 1 and not wide.isspace() or wide.isascii() and all(x.isalpha() or x in "!?" for x in wide):
            plain = wide
    alike = {x: to for group in (SAME_AS_UPPER, SAME_AS_LOWER, SAME_KANA) for to, xs in group.items() for x in xs}
    return unicodedata.normalize("NFC", "".join(alike.get(x, x) for x in unicodedata.normalize("NFD", plain)))


def _looks() -> str:
    """Rows ``(sign, look)`` of the signs that look like something else."""
    signs = map(chr, itertools.chain(range(0x80, 0x3400), range(0xF900, 0x10000), range(0x1D400, 0x1D800), range(0x1F100, 0x1F200), range(0xE0000, 0xE1000)))
    pairs = ((ch, _look(ch)) for ch in signs if unicodedata.category(ch) != "Cs")
    quoted = ((ord(ch), to.replace("'", "''")) for ch, to in pairs if to != ch)
    return ", ".join(f"(chr({code}), '{to}')" for code, to in quoted)


#: Sign by sign, against a table of looks, and composed: not the expression that the operator runs.
_FORMS = f"""
WITH rows AS (
  SELECT DISTINCT ON (seg_id) seg_id, text AS t FROM segments
  WHERE type = 'sentence' AND text IS NOT NULL ORDER BY seg_id, loaded_at
), looks(sign, look) AS (VALUES {_looks()}), signs AS (
  SELECT seg_id, i, substr(n, i, 1) AS sign FROM (
    SELECT seg_id, n, unnest(range(1, length(n) + 1)) AS i FROM (SELECT seg_id, nfc_normalize(t) AS n FROM rows WHERE strlen(t) > length(t))
  )
), built AS (
  SELECT seg_id, nfc_normalize(string_agg(coalesce(look, sign), '' ORDER BY i)) AS form FROM signs LEFT JOIN looks USING (sign) GROUP BY seg_id
), forms AS (SELECT seg_id, t, coalesce(form, t) AS form FROM rows LEFT JOIN built USING (seg_id))
"""

#: Windows of 100 code points, those that another document has too, and their union per document.
_WINDOWS = """
WITH docs AS (SELECT doc_id, text FROM documents WHERE length(text) >= 100),
windows AS (
  SELECT doc_id, i - 1 AS pos0, substr(text, i, 100) AS w
  FROM (SELECT doc_id, text, unnest(range(1, length(text) - 98)) AS i FROM docs)
), shared AS (SELECT w FROM windows GROUP BY w HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, pos0 FROM windows WHERE w IN (SELECT w FROM shared)),
marked AS (
  SELECT doc_id, pos0, CASE WHEN pos0 - lag(pos0) OVER (PARTITION BY doc_id ORDER BY pos0) <= 100 THEN 0 ELSE 1 END AS fresh FROM hits
), runs AS (SELECT doc_id, pos0, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos0) AS run FROM marked),
stretches AS (
  SELECT doc_id, CAST(min(pos0) AS BIGINT) AS char_from, CAST(max(pos0) + 100 AS BIGINT) AS char_to FROM runs GROUP BY doc_id, run
)
"""

SQL: dict[str, str] = {
    "p1_found": _FORMS
    + "SELECT a.seg_id AS seg_a, b.seg_id AS seg_b FROM forms a JOIN forms b ON a.form = b.form AND a.seg_id < b.seg_id AND a.t <> b.t",
    "p1_groups": _FORMS
    + "SELECT seg_id, min(seg_id) OVER (PARTITION BY form) AS look_id, variants FROM forms JOIN"
    " (SELECT form AS f, count(DISTINCT t) AS variants FROM forms GROUP BY form) ON form = f",
    "p8_found": _WINDOWS + "SELECT doc_id, char_from, char_to FROM stretches",
    "p8_shared": _WINDOWS
    + """, amounts AS (SELECT doc_id, sum(char_to - char_from) AS c FROM stretches GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(length(d.text), 0) AS BIGINT) AS n_chars, CAST(coalesce(c, 0) AS BIGINT) AS shared_chars,
  CASE WHEN length(d.text) > 0 THEN coalesce(c, 0) / length(d.text) ELSE 0.0 END AS share
FROM documents d LEFT JOIN amounts USING (doc_id)""",
}

#: White space as the operators strip it.
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"

#: Sentence rows with their longer copy, chr(1) in it for an unknown word, and whether they stop before it does.
_CUTS = rf"""
WITH seg AS (SELECT DISTINCT ON (seg_id) seg_id, utt_id, source, pos, type, text FROM segments ORDER BY seg_id, loaded_at),
near AS (
  SELECT *, min(CASE WHEN type = 'sentence' THEN pos END) OVER o AS sp, min(CASE WHEN type = 'clause' THEN pos END) OVER o AS cp
  FROM seg WINDOW o AS (PARTITION BY utt_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), clauses AS (
  SELECT utt_id, sp, CASE WHEN cp < sp THEN cp ELSE sp END AS place,
    bool_or(type = 'word' AND text IS NULL) AS unknown, max(CASE WHEN type = 'clause' THEN regexp_replace(text, '{_SPACE}', '', 'g') END) AS whole,
    string_agg(coalesce(regexp_replace(text, '{_SPACE}', '', 'g'), chr(1)), '' ORDER BY pos) FILTER (WHERE type = 'word') AS parts
  FROM near WHERE sp IS NOT NULL AND type <> 'sentence' GROUP BY ALL
), copies AS (
  SELECT utt_id, sp, string_agg(CASE WHEN unknown AND whole IS NOT NULL THEN whole ELSE parts END, '' ORDER BY place) AS copy FROM clauses GROUP BY utt_id, sp
), pairs AS (
  SELECT seg_id, source, text, rtrim(regexp_replace(text, '{_SPACE}', '', 'g'), '�') AS t, copy, split_part(copy, chr(1), 1) AS head
  FROM seg s LEFT JOIN copies c ON c.utt_id = s.utt_id AND c.sp = s.pos WHERE type = 'sentence' AND text IS NOT NULL
), judged AS (
  SELECT seg_id, source, text, rtrim(text, '�') AS w, ends_with(text, '�') AS half, regexp_extract(text, '{TAIL}') AS tail, CASE
    WHEN ends_with(text, '�') THEN true
    WHEN copy IS NULL THEN false
    WHEN NOT contains(copy, chr(1)) THEN starts_with(copy, t) AND copy <> t
    WHEN length(t) < length(head) THEN starts_with(head, t)
    WHEN NOT starts_with(t, head) THEN false
    ELSE NOT regexp_matches(t, '(?s)^' || replace(regexp_escape(copy), regexp_escape(chr(1)), '.+')) END AS cut
  FROM pairs
), measured AS (
  SELECT seg_id, coalesce(source, '') AS source, cut, half, length(text) AS points, strlen(w) AS bytes, greatest(strlen(right(w, 1)), 1) AS width,
    NOT regexp_matches(text, '{CLOSED.replace("'", "''")}') AS open, CASE WHEN regexp_matches(tail, '{UNSPACED.replace("Is", "")}') THEN '' ELSE tail END AS tail
  FROM judged
), votes AS (
  SELECT source, 'points' AS unit, points AS size FROM measured WHERE cut
  UNION ALL SELECT source, 'bytes', unnest(CASE WHEN half THEN [bytes + 1, bytes + 2, bytes + 3] ELSE range(bytes, bytes + width) END) FROM measured WHERE cut
), best AS (
  SELECT DISTINCT ON (source) * FROM (SELECT source, unit, size, count(*) AS n FROM votes GROUP BY ALL) ORDER BY source, n DESC, unit, size
), limits AS (
  SELECT source, unit, size FROM best JOIN (SELECT source, count(*) AS c FROM measured WHERE cut GROUP BY source) USING (source) WHERE n >= {LEAST_VOTES} AND n * 2 >= c
), whole AS (SELECT DISTINCT regexp_replace(text, '{AROUND}', '', 'g') AS word FROM segments WHERE type = 'word' AND text IS NOT NULL),
filled AS (
  SELECT seg_id, tail FROM measured JOIN limits USING (source)
  WHERE NOT cut AND open AND CASE unit WHEN 'points' THEN points = size ELSE bytes <= size AND bytes > size - width END
), more AS (
  SELECT seg_id FROM filled WHERE tail = '' OR EXISTS (SELECT 1 FROM whole WHERE starts_with(word, tail) AND word <> tail)
), cuts AS (SELECT seg_id, nullif(source, '') AS source, cut OR seg_id IN (SELECT seg_id FROM more) AS cut FROM measured)
"""

SQL |= {
    "p4_found": _CUTS + "SELECT seg_id FROM cuts WHERE cut",
    "p4_by_source": _CUTS
    + "SELECT source, count(*) AS sentences, CAST(sum(CAST(cut AS INT)) AS BIGINT) AS cut, sum(CAST(cut AS INT)) / count(*) AS cut_share FROM cuts GROUP BY source",
}
