"""DuckDB counterparts of the queries, on whole tables."""

from __future__ import annotations

from sonoweave.functions import text as T
from sonoweave.functions import zscore as Z
from sonoweave.operators.calibrate import FEATURES
from sonoweave.operators.compose import PRIORITY

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def _values(mapping: dict) -> str:
    return ", ".join(f"('{k}', {v!r})" for k, v in mapping.items())


def _tokens(source: str, key: str) -> str:
    """CTEs ending in ``toks(key, wi, text)``: raw tokens, marks glued to the token before them."""
    return rf"""
raw AS (
  SELECT {key}, unnest(x) AS t, generate_subscripts(x, 1) AS i
  FROM (SELECT {key}, regexp_extract_all(text, '[a-zA-Z0-9'']+|[^\n]') AS x FROM {source} WHERE text IS NOT NULL)
), kept AS (
  SELECT *, length(t) > 1 OR regexp_full_match(t, '[\p{{L}}\p{{N}}]') AS core FROM raw
  WHERE length(t) > 1 OR NOT regexp_full_match(t, '{_SPACE}')
), glued AS (SELECT *, sum(CAST(core AS INT)) OVER (PARTITION BY {key} ORDER BY i) AS g FROM kept),
joined AS (SELECT {key}, g, string_agg(t, '' ORDER BY i) AS text FROM glued GROUP BY {key}, g),
toks AS (SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY g) - 1 AS INT) AS wi, text FROM joined)"""


def _grouped(source: str, key: str) -> str:
    """CTEs ending in ``grp``: words with clause and sentence ids and positions."""
    return f"""
ends AS (
  SELECT *, CAST(regexp_matches(text, '[{T.CLAUSE_END}]') AS INT) AS ce, CAST(regexp_matches(text, '[{T.SENTENCE_END}]') AS INT) AS se FROM {source}
), ids AS (
  SELECT *, CAST(coalesce(sum(ce) OVER o, 0) AS INT) AS clause_id, CAST(coalesce(sum(se) OVER o, 0) AS INT) AS sent_id
  FROM ends WINDOW o AS (PARTITION BY {key} ORDER BY wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), grp AS (SELECT *, wi + clause_id + sent_id AS pos FROM ids)"""


_DOC_WORDS = "WITH " + _tokens("documents", "doc_id") + "," + _grouped("toks", "doc_id")

_CJK = f"regexp_full_match(%s, '{T.CJK_TOKEN[1:-1]}')"


def _denormal(source: str, keys: str, order: str, text: str) -> str:
    """CTE body: the group's tokens with a space only between two that are not wholly Chinese."""
    return f"""
SELECT {keys}, string_agg(CASE WHEN n = 1 OR {_CJK % "text"} OR {_CJK % "before"} THEN text ELSE ' ' || text END, '' ORDER BY {order}) AS {text}
FROM (
  SELECT *, lag(text) OVER (PARTITION BY {keys} ORDER BY {order}) AS before, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {source}
) GROUP BY {keys}"""


_ONCE = """
seg AS (SELECT DISTINCT ON (seg_id) * FROM segments ORDER BY seg_id, loaded_at),
lw AS (
  SELECT *, CAST(count(*) FILTER (WHERE type = 'word') OVER o AS INT) AS wi, CAST(count(*) FILTER (WHERE type = 'clause') OVER o AS INT) AS clause_id,
    CAST(count(*) FILTER (WHERE type = 'sentence') OVER o AS INT) AS sent_id
  FROM seg WINDOW o AS (PARTITION BY utt_id ORDER BY pos, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), words AS (
  SELECT utt_id, source, wi, pos, clause_id, sent_id, text, CASE WHEN isfinite(start) THEN start END AS s, CASE WHEN isfinite("end") THEN "end" END AS e
  FROM lw WHERE type = 'word'
), gapped AS (
  SELECT *, s - lag(e) OVER o AS gap, lag(clause_id) OVER o AS pc FROM words WINDOW o AS (PARTITION BY utt_id ORDER BY wi)
), clr AS (
  SELECT utt_id, clause_id, any_value(text) AS ctext, any_value(CASE WHEN isfinite(start) THEN start END) AS s, any_value(CASE WHEN isfinite("end") THEN "end" END) AS e
  FROM lw WHERE type = 'clause' GROUP BY utt_id, clause_id
), grp0 AS (
  SELECT utt_id, clause_id, count(*) AS n_words, min(pos) AS first_pos, list(s ORDER BY pos)[1] AS fs, list(e ORDER BY pos)[-1] AS le,
    coalesce(sum(gap) FILTER (WHERE pc = clause_id AND gap > 0.2), 0.0) AS paused
  FROM gapped GROUP BY utt_id, clause_id
), call AS (
  SELECT g.*, ctext, c.s, c.e, c.clause_id IS NOT NULL AS closed FROM grp0 g LEFT JOIN clr c ON c.utt_id = g.utt_id AND c.clause_id = g.clause_id
), cl AS (SELECT * FROM call WHERE closed), about AS (
  SELECT utt_id, min(lower(trim(lang, ' '))) AS lang, coalesce(min(lower(trim(style, ' '))), 'read') AS style FROM utterances GROUP BY utt_id
), ps AS (SELECT lang_style, feature, max(mean) AS mean, max(std) AS std FROM population_stats GROUP BY lang_style, feature),
grouped AS (SELECT utt_id, CASE WHEN lang IN ('zh', 'chinese') THEN 'zh_' ELSE 'en_' END || style AS lang_style, lang, style FROM about)
"""


def _case_level(z: str, labels) -> str:
    a, b, c, d = Z.EDGES
    return (
        f"CASE WHEN {z} < {a} THEN '{labels[0]}' WHEN {z} < {b} THEN '{labels[1]}' WHEN {z} <= {c} THEN '{labels[2]}'"
        f" WHEN {z} <= {d} THEN '{labels[3]}' WHEN {z} IS NOT NULL THEN '{labels[4]}' END"
    )


def _pause_level(g: str) -> str:
    whens = " ".join(f"WHEN {g} < {bound} THEN '{name}'" for name, bound in Z.PAUSE_LEVELS if bound is not None)
    return f"CASE WHEN {g} IS NULL THEN NULL {whens} ELSE '{Z.PAUSE_LEVELS[-1][0]}' END"




def _round(x: str, digits: int) -> str:
    """Half away from zero on the shortest decimal form, as Spark rounds; multiplying first would make ties of near misses."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def _fixed(x: str, digits: int) -> str:
    """With so many decimals, rounded half away from zero on the shortest decimal form."""
    rounded = f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DECIMAL(38, {digits}))"
    return f"CASE WHEN {x} < 0 AND {rounded} = 0 THEN '-' ELSE '' END || CAST({rounded} AS VARCHAR)"


_CLAMPED = _round(f"greatest(-{Z.CLAMP}, least({Z.CLAMP}, z))", 2)

_SPEED = """
speeds AS (
  SELECT utt_id, clause_id, first_pos, n_words, n_words / (e - s - paused) AS speed FROM cl WHERE e - s - paused > 0
), zs AS (
  SELECT speeds.*, CASE WHEN std > 0 THEN (speed - mean) / std END AS z
  FROM speeds LEFT JOIN grouped USING (utt_id) LEFT JOIN ps ON ps.lang_style = grouped.lang_style AND feature = 'speed'
)"""

_TOP = f"""
emo AS (
  SELECT DISTINCT utt_id, sent_id, value FROM (
    SELECT utt_id, sent_id, array_to_string(list_transform(list_slice(list_sort(list_filter(
      list_transform(range(1, {len(Z.EMOTIONS) + 1}), lambda i: struct_pack(s := -scores[i], i := i, name := {list(Z.EMOTIONS)!r}[i])),
      lambda p: p.name NOT IN {Z.SILENT_EMOTIONS!r} AND p.s IS NOT NULL AND NOT isnan(p.s) AND p.s <= -0.3)), 1, 2), lambda p: p.name), '+') AS value
    FROM emotion_scores) WHERE value <> ''
)"""

_COLS = "utt_id, CAST({o} AS INT) AS ext_order, '{t}' AS type, {v} AS value, CAST({n} AS DOUBLE) AS value_num, CAST({p} AS INT) AS pos, {i} AS info"

_STYLE = (
    "SELECT " + _COLS.format(o=0, t="style", v="style", n="NULL", p="min(pos)", i="'style=' || style")
    + " FROM (SELECT utt_id, pos, coalesce(style, 'read') AS style FROM words LEFT JOIN about USING (utt_id)) GROUP BY utt_id, style"
)


def _breaks(value: str) -> str:
    return (
        "SELECT " + _COLS.format(o=1, t="break", v=value, n=_round("gap", 1), p="pos", i=f"'duration=' || ({_fixed('gap', 2)}) || CASE WHEN pc <> clause_id THEN 's, inter_clause' ELSE 's, intra_clause' END")
        + f" FROM gapped WHERE pc IS NOT NULL AND {_pause_level('gap')} <> '{Z.PAUSE_LEVELS[0][0]}'"
    )


_NUMBER = f"CAST({_CLAMPED} AS VARCHAR)"
_INFO = {
    "speed": f"'speed=' || ({_fixed('speed', 2)}) || 'word/s, z=' || ({_fixed('z', 2)})",
    "volume": f"'[' || coalesce(ctext, '') || '] energy=' || ({_fixed('v', 4)}) || ', z=' || ({_fixed('z', 2)})",
    "pitch": f"'f0=' || ({_fixed('f0', 1)}) || 'Hz, speaker=' || ({_fixed('bm', 1)}) || '±' || ({_fixed('bs', 1)}) || 'Hz, z=' || ({_fixed('z', 2)})",
    "emphasis": f"'[' || coalesce(text, '') || '] composite_z=' || ({_fixed('z', 2)}) || ' (' || concat_ws(', ', "
    + ", ".join(f"'{k}=' || {_fixed(f'z{n}', 2)}" for n, k in ((1, "e"), (2, "d"), (3, "p"))) + ") || ')'",
}


def _scored(kind: str, order: int, labels, source: str, as_number: bool = False) -> str:
    value = _NUMBER if as_number else _case_level("z", labels)
    return "SELECT " + _COLS.format(o=order, t=kind, v=value, n=_CLAMPED, p="first_pos", i=_INFO[kind]) + f" FROM {source} WHERE abs(z) > {Z.THRESHOLD}"


def _emphasised(source: str, as_number: bool = False) -> str:
    value = _NUMBER if as_number else "'emphasis'"
    return "SELECT " + _COLS.format(o=5, t="emphasis", v=value, n=_CLAMPED, p="first_pos", i=_INFO["emphasis"]) + f" FROM {source} WHERE z > 1.0"


_EMOTION = (
    "SELECT " + _COLS.format(o=6, t="emotion", v="value", n="NULL", p="fp", i="'emo=' || value")
    + " FROM (SELECT utt_id, sent_id, min(pos) AS fp FROM words GROUP BY utt_id, sent_id) JOIN emo USING (utt_id, sent_id)"
)

_PRIO = f"pr(type, prio) AS (VALUES {_values(PRIORITY)})"


def _limit(most: int, source: str = "allc") -> str:
    return f"""{_PRIO}, lim AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.utt_id, coalesce(w.clause_id, -1) ORDER BY coalesce(prio, 99), ext_order, c.pos, value) AS k
    FROM {source} c LEFT JOIN pr USING (type) LEFT JOIN words w ON w.utt_id = c.utt_id AND w.pos = c.pos
  ) WHERE k <= {most}
)"""


def _format(source: str) -> str:
    return f"""fmt AS (
  SELECT utt_id, pos, string_agg(CASE WHEN type = 'emphasis' AND value = 'emphasis' THEN '[emphasis]' ELSE '[' || type || '=' || coalesce(value, 'None') || ']' END, ''
    ORDER BY coalesce(prio, 99), ext_order, type, value) AS tags
  FROM {source} LEFT JOIN pr USING (type) GROUP BY utt_id, pos
)"""


_TEXT = "SELECT utt_id, string_agg(coalesce(tags, '') || coalesce(text, ''), ' ' ORDER BY wi) AS text FROM words LEFT JOIN fmt USING (utt_id, pos) GROUP BY utt_id"

_GIVEN = """given AS (
  SELECT DISTINCT utt_id, ext_order, type, value, CASE WHEN NOT isnan(value_num) THEN value_num END AS value_num, pos, info FROM controls
)"""

_FRAMES = """
fr AS (
  SELECT utt_id, e, list_transform(e, lambda x: abs(x) * 0.2) AS energy, list_transform(e, lambda x: CASE WHEN x > -0.05 THEN 200.0 + 100.0 * x ELSE 0.0 END) AS f0
  FROM (SELECT DISTINCT utt_id, CAST(regexp_extract(utt_id, '(\\d+)$', 1) AS BIGINT) % (SELECT greatest(count(*), 1) FROM embeddings) AS vec_id FROM utterances)
  JOIN (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings) USING (vec_id)
), base AS (
  SELECT utt_id, list_avg(v) AS bm, greatest(list_stddev_samp(v), 10.0) AS bs
  FROM (SELECT utt_id, list_filter(f0, lambda x: x > 0) AS v FROM fr) WHERE len(v) >= 5
)"""


def _slice(array: str, s: str, e: str) -> str:
    """Frames ``s..e`` at ten a second; a negative index counts from the end."""
    at = lambda t: f"(CASE WHEN trunc({t} * 10.0) < 0 THEN greatest(trunc({t} * 10.0) + len({array}), 0) ELSE least(trunc({t} * 10.0), len({array})) END)"
    return f"(CASE WHEN {s} IS NULL OR {e} IS NULL THEN [] ELSE list_slice({array}, CAST({at(s)} AS BIGINT) + 1, CAST({at(e)} AS BIGINT)) END)"


def _framed(spans: str) -> str:
    """CTE ``sl``: spans with their energy and voiced pitch frames."""
    return f"""sl AS (
  SELECT x.*, {_slice("energy", "x.s", "x.e")} AS en, list_filter({_slice("f0", "x.s", "x.e")}, lambda v: v > 0) AS vo, bm, bs
  FROM {spans} x JOIN fr USING (utt_id) LEFT JOIN base USING (utt_id)
)"""


def _z(value: str, feature: str, alias: str) -> str:
    return f"CASE WHEN {alias}.std > 0 THEN ({value} - {alias}.mean) / {alias}.std END"


_VOLUME = f"""{_framed("cl")}, zs AS (
  SELECT sl.utt_id, clause_id, first_pos, ctext, coalesce(list_avg(en), 0.0) AS v, {_z("coalesce(list_avg(en), 0.0)", "energy", "ps")} AS z
  FROM sl LEFT JOIN grouped USING (utt_id) LEFT JOIN ps ON ps.lang_style = grouped.lang_style AND feature = 'energy'
)"""
_PITCH = f"""{_framed("cl")}, zs AS (
  SELECT utt_id, clause_id, first_pos, bm, bs, list_avg(vo) AS f0, CASE WHEN len(vo) >= 5 THEN (list_avg(vo) - bm) / bs END AS z FROM sl
)"""
_EMPHASIS = f"""{_framed("words")}, parts AS (
  SELECT sl.utt_id, pos, text, {_z("coalesce(list_avg(en), 0.0)", "word_energy", "pe")} AS z1, {_z("(e - s)", "word_duration", "pd")} AS z2,
    CASE WHEN len(vo) >= 3 THEN (list_avg(vo) - bm) / bs END AS z3
  FROM sl LEFT JOIN grouped g USING (utt_id) LEFT JOIN ps pe ON pe.lang_style = g.lang_style AND pe.feature = 'word_energy'
  LEFT JOIN ps pd ON pd.lang_style = g.lang_style AND pd.feature = 'word_duration'
), zs AS (
  SELECT utt_id, pos AS first_pos, text, z1, z2, z3, (coalesce(0.4 * z1, 0) + coalesce(0.3 * z2, 0) + coalesce(0.3 * z3, 0)) /
    nullif(CASE WHEN z1 IS NULL THEN 0.0 ELSE 0.4 END + CASE WHEN z2 IS NULL THEN 0.0 ELSE 0.3 END + CASE WHEN z3 IS NULL THEN 0.0 ELSE 0.3 END, 0) AS z
  FROM parts
)"""

def _all(as_number: bool = False) -> str:
    """CTEs ending in ``allc``: the controls of all seven extractors."""
    parts = [_STYLE, _breaks(f"CAST({_round('gap', 1)} AS VARCHAR)" if as_number else _pause_level("gap")), _EMOTION]
    parts += [
        _scored("speed", 2, Z.SPEED_LEVELS, "zs", as_number), _scored("volume", 3, Z.VOLUME_LEVELS, "zsv", as_number),
        _scored("pitch", 4, Z.LEVELS, "zsp", as_number), _emphasised("zse", as_number),
    ]
    renamed = lambda x, k: x.replace("zs AS", f"zs{k} AS").replace("sl AS", f"sl{k} AS").replace("FROM sl", f"FROM sl{k} sl").replace("parts", f"parts{k}")
    return (
        f"WITH {_ONCE}, {_SPEED}, {_TOP}, {_FRAMES}, {renamed(_VOLUME, 'v')}, {renamed(_PITCH, 'p')}, {renamed(_EMPHASIS, 'e')}, allc AS ({' UNION ALL '.join(parts)})"
    )


_ALL = _all()

#: Clauses that last, as calibration takes them: times of the clause row, else of the first and the last word.
_LASTING = """(
  SELECT * FROM (SELECT * REPLACE (CASE WHEN closed THEN s ELSE fs END AS s, CASE WHEN closed THEN e ELSE le END AS e) FROM call) WHERE e - s > 0
)"""
_FEATURES = """feats AS (
  SELECT utt_id, 'duration' AS feature, e - s AS value FROM """ + _LASTING + """
  UNION ALL SELECT utt_id, 'speed', n_words / (le - fs - paused) FROM """ + _LASTING + """ WHERE le - fs - paused > 0
  UNION ALL SELECT utt_id, 'word_duration', e - s FROM words WHERE e - s > 0
  {more}
), st AS (
  SELECT coalesce(lang, 'unknown') || '_' || style AS lang_style, feature, count(value) AS n, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std
  FROM feats LEFT JOIN about USING (utt_id) GROUP BY ALL
), grid AS (
  SELECT lang_style, feature, coalesce(n, 0) AS n, coalesce(mean, 0.0) AS mean, coalesce(std, 0.0) AS std
  FROM (SELECT lang_style, unnest({names}) AS feature FROM (SELECT DISTINCT lang_style FROM st)) LEFT JOIN st USING (lang_style, feature)
)"""
#: The words with times in the recording only.
_TIMED = _ONCE.replace(
    "seg AS (SELECT DISTINCT ON (seg_id) * FROM segments ORDER BY seg_id, loaded_at)",
    """seg AS (
  SELECT * REPLACE (CASE WHEN ok THEN start END AS start, CASE WHEN ok THEN "end" END AS "end") FROM (
    SELECT g.*, isfinite(start) AND isfinite("end") AND start >= 0 AND "end" > start AND (d IS NULL OR "end" <= d) AS ok
    FROM (SELECT DISTINCT ON (seg_id) * FROM segments ORDER BY seg_id, loaded_at) g
    LEFT JOIN (SELECT utt_id, max(duration_s) AS d FROM utterances GROUP BY utt_id) USING (utt_id)
  )
)""",
)
assert _TIMED != _ONCE
_CALIBRATION = f"WITH {_TIMED}, " + _FEATURES.format(more="", names=repr(list(FEATURES)))
_FRAME_FEATURES = """
  UNION ALL SELECT utt_id, 'energy', list_avg(en) FROM sl WHERE len(en) > 0
  UNION ALL SELECT utt_id, 'word_energy', list_avg(en) FROM slw WHERE len(en) > 0
  UNION ALL SELECT utt_id, 'loudness_lufs', -23.0 + e[clause_id % len(e) + 1] * 10 FROM (SELECT utt_id, clause_id FROM """ + _LASTING + """) JOIN fr USING (utt_id)"""
_ROUNDED = "SELECT lang_style, feature, n, round(mean, 9) AS mean, round(std, 9) AS std FROM "

_INTERVALS = """
WITH i AS (
  SELECT DISTINCT utt_id, type AS seg_type, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e
  FROM segments WHERE type IN ('clause', 'sentence') AND isfinite(start) AND isfinite("end")
), m AS (
  SELECT *, max(e) OVER (PARTITION BY utt_id, seg_type ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM i WHERE e > s
)
"""


def _weighted(rows: str, keys: str, value: str, q: float) -> str:
    """The least value whose cumulated ``n`` reaches ``q`` of all, per key, and the total."""
    return f"""SELECT {keys}, min({value}) AS v, any_value(t) AS t FROM (
    SELECT {keys}, {value}, sum(n) OVER (PARTITION BY {keys} ORDER BY {value}) AS c, sum(n) OVER (PARTITION BY {keys}) AS t FROM {rows}
  ) WHERE c >= t * {q} GROUP BY {keys}"""


def _usual(hist: str, out: str) -> str:
    """CTE ``out(source, hour, usual_ms, season)``: what is usual by a histogram."""
    return f"""{out}m AS ({_weighted(f"(SELECT source, ms, sum(n) AS n FROM {hist} GROUP BY ALL)", "source", "ms", 0.5)}),
{out}s AS (
  SELECT source, sqrt(sum(n * r * r) / sum(n)) AS sd FROM (SELECT source, n, ln(ms / v) AS r FROM {hist} JOIN {out}m USING (source)) WHERE abs(r) < ln(5.0) GROUP BY source
), {out}h AS ({_weighted(hist, "source, hour", "ms", 0.5)}),
{out} AS (
  SELECT h.source, hour, m.v AS usual_ms, CASE WHEN abs(ln(h.v / m.v)) > 4.0 * 1.2533 * sd / sqrt(h.t) THEN ln(h.v / m.v) ELSE 0.0 END AS season
  FROM {out}h h JOIN {out}m m USING (source) LEFT JOIN {out}s USING (source)
)"""


def _cuts(hist: str, usual: str, out: str, least: float, most: float) -> str:
    """CTE ``out(source, hi, lo)``: cutoffs by a generalised Pareto fit of either tail's excesses over the 95 per cent point, at risk 1e-6."""
    return f"""{out}r AS (SELECT source, n, ln(ms / usual_ms) - season AS r FROM {hist} JOIN {usual} USING (source, hour)),
{out}t AS (SELECT source, side, n, side * r AS x FROM {out}r, (VALUES (1.0), (-1.0)) AS sides(side) WHERE abs(r) < ln(5.0)),
{out}u AS ({_weighted(f"{out}t", "source, side", "x", 0.95)}),
{out}e AS (
  SELECT source, side, v AS u, t, sum(n) AS k, sum(n * (x - v)) / sum(n) AS m, sum(n * (x - v) * (x - v)) / sum(n) AS m2
  FROM {out}u JOIN {out}t USING (source, side) WHERE x > v GROUP BY ALL
), {out}f AS (SELECT *, greatest(m2 - m * m, 0.0) AS var FROM {out}e), {out}g AS (
  SELECT *, CASE WHEN k >= 10 AND var > 1e-12 THEN (1 - m * m / var) / 2 END AS xi, 1e-6 * t / k AS rate FROM {out}f
), {out}c AS (
  SELECT source, side, greatest(ln({least}), least(ln({most}), coalesce(
    CASE WHEN abs(xi) < 1e-9 THEN u - m * (1 - xi) * ln(rate) ELSE u + m * (1 - xi) / xi * (pow(rate, -xi) - 1) END, ln({least})))) AS cut
  FROM {out}u JOIN (SELECT DISTINCT source FROM {out}t) USING (source) LEFT JOIN {out}g g USING (source, side, t)
), {out} AS (SELECT source, max(cut) FILTER (side > 0) AS hi, max(cut) FILTER (side < 0) AS lo FROM {out}c GROUP BY source)"""


def _flags(least: float, most: float) -> str:
    """CTEs ending in ``flags``: word rows with times, impossible, out of what the fits allow, or stuck."""
    return f"""
WITH w AS (
  SELECT DISTINCT ON (seg_id) seg_id, utt_id, coalesce(source, '') AS source, pos, start AS s, "end" AS e FROM segments
  WHERE type = 'word' AND seg_id IS NOT NULL ORDER BY seg_id, loaded_at
), u AS (SELECT utt_id, max(duration_s) AS d, min(hour(recorded_at)) AS hour FROM utterances GROUP BY utt_id),
r AS (
  SELECT w.*, d, coalesce(hour, -1) AS hour, CASE WHEN isfinite(s) THEN round(s * 1000) END AS sm, CASE WHEN isfinite(e) THEN round(e * 1000) END AS em
  FROM w LEFT JOIN u USING (utt_id)
), n AS (
  SELECT *,
    CASE WHEN sm = lag(sm) OVER o THEN 0 ELSE 1 END AS sc, CASE WHEN em = lag(em) OVER o THEN 0 ELSE 1 END AS ec
  FROM r WINDOW o AS (PARTITION BY utt_id ORDER BY pos, seg_id)
), g AS (
  SELECT *, sum(sc) OVER o AS sg, sum(ec) OVER o AS eg FROM n WINDOW o AS (PARTITION BY utt_id ORDER BY pos, seg_id)
), f AS (
  SELECT *, utt_id IS NOT NULL AND pos IS NOT NULL
    AND (count(*) OVER (PARTITION BY utt_id, sg) >= 4 OR count(*) OVER (PARTITION BY utt_id, eg) >= 4) AS stuck FROM g
), t AS (
  SELECT *, NOT (isfinite(s) AND isfinite(e) AND s >= 0 AND e > s AND (d IS NULL OR e <= d)) AS impossible
  FROM f WHERE s IS NOT NULL AND e IS NOT NULL
), hist AS (
  SELECT source, hour, greatest(CAST(round((e - s) * 1000) AS BIGINT), 1) AS ms, count(*) AS n FROM t WHERE NOT impossible GROUP BY ALL
), {_usual("hist", "ua")}, {_cuts("hist", "ua", "ca", 2.0, 5.0)}, body AS (
  SELECT source, hour, ms, n FROM hist JOIN ua USING (source, hour) LEFT JOIN ca USING (source)
  WHERE coalesce(ln(ms / usual_ms) - season < hi AND ln(ms / usual_ms) - season > -lo, true)
), {_usual("body", "ub")}, {_cuts("hist", "ub", "cb", least, most)}, flags AS (
  SELECT t.*, coalesce(x >= coalesce(hi, ln({least})) - 1e-9 OR x <= -coalesce(lo, ln({least})) + 1e-9, false) AS spike
  FROM (
    SELECT t.*, CASE WHEN NOT impossible THEN ln(CASE WHEN impossible THEN 1.0 ELSE (e - s) * 1000.0 END / usual_ms) - season END AS x
    FROM t LEFT JOIN ub USING (source, hour)
  ) t LEFT JOIN cb USING (source)
)
"""


_ATTACH = r"""
said AS (SELECT utt_id, max(text) AS text FROM utterances {where} GROUP BY utt_id),
""" + _tokens("said", "utt_id") + r""",
cleaned AS (SELECT *, lower(regexp_replace(text, '[^\p{{L}}\p{{N}}_]', '', 'g')) AS c FROM toks),
uses AS (SELECT *, CASE WHEN c = '' THEN 0 WHEN regexp_matches(c, '[一-鿿]') THEN length(c) ELSE 1 END AS use FROM cleaned),
have AS (SELECT utt_id, count(*) AS have FROM words GROUP BY utt_id),
pl AS (
  SELECT *, least(coalesce(sum(use) OVER (PARTITION BY utt_id ORDER BY wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), have) AS fi
  FROM uses JOIN have USING (utt_id)
), tm AS (SELECT *, use > 0 AND fi < have AS timed FROM pl),
nb AS (SELECT * EXCLUDE (wi), wi AS ti, CAST(sum(CAST(timed AS INT)) OVER (PARTITION BY utt_id ORDER BY wi) - 1 AS INT) AS wi FROM tm),
aw AS (
  SELECT utt_id, wi, string_agg(text, '' ORDER BY ti) AS text, min(fi) FILTER (WHERE timed) AS fi, min(least(fi + use, have) - 1) FILTER (WHERE timed) AS la
  FROM nb WHERE wi >= 0 AND (timed OR use = 0) GROUP BY utt_id, wi
), att AS (
  SELECT aw.utt_id, aw.wi, aw.text, round(a.s, 6) AS start, round(b.e, 6) AS "end"
  FROM aw LEFT JOIN words a ON a.utt_id = aw.utt_id AND a.wi = fi LEFT JOIN words b ON b.utt_id = aw.utt_id AND b.wi = la
)"""

_LANG = "CASE lower(lang) " + " ".join(f"WHEN '{k}' THEN '{v}' WHEN '{v.lower()}' THEN '{v}'" for k, v in T.LANGUAGES.items()) + " ELSE lang END"
_WF = r"regexp_extract(path, '([^/]*)/[^/]*$', 1)"
_STEM = r"regexp_extract(path, '([^/]*?)(?:\.[^./]*)?$', 1)"

SQL: dict[str, str] = {
    "p2_found": _flags(5.0, 5.0) + "SELECT seg_id FROM flags WHERE impossible OR stuck OR spike",
    "p2_by_source": _flags(3.0, 8.0)
    + "SELECT source, count(*) AS n, count_if(impossible)::BIGINT AS n_impossible, count_if(spike)::BIGINT AS n_spike, count_if(stuck)::BIGINT AS n_stuck FROM flags GROUP BY source",
    "p5_found": _INTERVALS + "SELECT utt_id, seg_type, before AS gap_from_ms, s AS gap_to_ms FROM m WHERE before < s",
    "p5_periods": _INTERVALS
    + """, p AS (
  SELECT *, sum(CASE WHEN before >= s THEN 0 ELSE 1 END) OVER (PARTITION BY utt_id, seg_type ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m
)
SELECT utt_id, seg_type, min(s) AS from_ms, max(e) AS to_ms FROM p GROUP BY utt_id, seg_type, k""",
    "tokens": "WITH " + _tokens("documents", "doc_id") + " SELECT doc_id, wi, text AS token FROM toks",
    "token_counts": "WITH " + _tokens("documents", "doc_id") + " SELECT d.doc_id, count(t.wi) AS n_tokens FROM documents d LEFT JOIN toks t USING (doc_id) GROUP BY d.doc_id",
    "normalized": "WITH said AS (SELECT DISTINCT utt_id, text FROM utterances)," + _tokens("said", "utt_id")
    + ", j AS (SELECT utt_id, string_agg(text, ' ' ORDER BY wi) AS x FROM toks GROUP BY utt_id) SELECT utt_id, coalesce(x, '') AS normalized FROM said LEFT JOIN j USING (utt_id)",
    "denormalized": "WITH said AS (SELECT DISTINCT utt_id, text FROM utterances)," + _tokens("said", "utt_id")
    + f", j AS ({_denormal('toks', 'utt_id', 'wi', 'x')}) SELECT utt_id, coalesce(x, '') AS denormalized FROM said LEFT JOIN j USING (utt_id)",
    "word_properties": rf"""
SELECT text, count(*) AS n, lower(regexp_replace(text, '[^\p{{L}}\p{{N}}_]', '', 'g')) AS clean, regexp_matches(text, '[一-鿿]') AS cjk,
  regexp_matches(text, '[{T.CLAUSE_END}]') AS clause_end, regexp_matches(text, '[{T.SENTENCE_END}]') AS sentence_end, regexp_full_match(text, '\p{{P}}') AS punctuation
FROM segments WHERE type = 'word' AND text IS NOT NULL GROUP BY text""",
    "languages": f"""
SELECT utt_id, {_LANG} AS language, CASE WHEN lower(lang) IN ('zh', 'chinese') THEN 'zh_' ELSE 'en_' END || coalesce(style, 'read') AS lang_style,
  CASE WHEN lang LIKE '%en%' AND lang NOT LIKE '%zh%' THEN 'English' WHEN lang LIKE '%zh%' AND lang NOT LIKE '%en%' THEN 'Chinese' END AS dir_language
FROM (SELECT DISTINCT utt_id, lang, style FROM utterances)""",
    "paired_datasets": f"""
SELECT utt_id, source, d.style AS set_style, {_WF} AS lang_dir, {_STEM} AS stem, regexp_extract(path, '^(.*)/[^/]*$', 1) || '/' || {_STEM} || coalesce(text_ext, '.txt') AS transcript,
  '[' || {_WF} || '] ' || {_STEM} AS label
FROM (SELECT DISTINCT utt_id, source, path FROM utterances WHERE path IS NOT NULL)
JOIN (SELECT name, style, text_ext FROM datasets) d ON d.name = source""",
    "unpaired_utterances": "SELECT DISTINCT utt_id, source FROM utterances WHERE utt_id NOT IN (SELECT utt_id FROM utterances WHERE text IS NOT NULL)",
    "document_words": _DOC_WORDS + " SELECT doc_id, wi, pos, clause_id, sent_id, text FROM grp",
    "document_segments": _DOC_WORDS
    + f""", tmd AS (
  SELECT *, 50 + 20 * length(text) AS d, 30 + CASE WHEN coalesce(lag(ce) OVER o, 0) = 1 THEN 300 ELSE 0 END + CASE WHEN coalesce(lag(se) OVER o, 0) = 1 THEN 800 ELSE 0 END
    + CASE WHEN (wi * 7 + doc_id * 13) % 11 = 0 THEN 500 ELSE 0 END AS gp
  FROM grp WINDOW o AS (PARTITION BY doc_id ORDER BY wi)
), ed AS (SELECT *, CAST(sum(gp + d) OVER (PARTITION BY doc_id ORDER BY wi) AS BIGINT) AS end_ms FROM tmd),
sd AS (SELECT *, end_ms - d AS start_ms FROM ed),
ct AS ({_denormal("sd", "doc_id, clause_id", "wi", "text")}), stx AS ({_denormal("sd", "doc_id, sent_id", "wi", "text")})
SELECT doc_id, pos, 'word' AS type, text, start_ms, end_ms FROM sd
UNION ALL SELECT doc_id, max(pos) + 1, 'clause', any_value(ct.text), min(start_ms), max(end_ms) FROM sd JOIN ct USING (doc_id, clause_id) GROUP BY doc_id, clause_id
UNION ALL SELECT doc_id, max(pos) + 2, 'sentence', any_value(stx.text), min(start_ms), max(end_ms) FROM sd JOIN stx USING (doc_id, sent_id) GROUP BY doc_id, sent_id""",
    "attached_times": f"WITH {_ONCE}," + _ATTACH.replace("{where}", "").replace("{{", "{").replace("}}", "}") + " SELECT * FROM att",
    "listed_words": f'WITH {_ONCE} SELECT utt_id, source, wi, pos, clause_id, sent_id, text, round(s, 6) AS start, round(e, 6) AS "end" FROM words',
    "clauses": f"""WITH {_ONCE} SELECT utt_id, clause_id, n_words, first_pos, round(s, 6) AS start, round(e, 6) AS "end", round(e - s - paused, 6) AS effective,
  round(greatest(le - fs - paused, 0.0), 6) AS effective_clamped FROM call""",
    "pauses": f"WITH {_ONCE} SELECT utt_id, wi, pos, round(gap, 6) AS gap, pc <> clause_id AS inter_clause, {_pause_level('round(gap, 6)')} AS level FROM gapped WHERE pc IS NOT NULL",
    "frame_means": f"WITH {_ONCE}, {_FRAMES}, {_framed('cl')} SELECT utt_id, clause_id, round(coalesce(list_avg(en), 0.0), 6) AS energy FROM sl",
    "speaker_baselines": f"WITH {_FRAMES} SELECT utt_id, round(bm, 6) AS f0_mean, round(bs, 6) AS f0_std FROM base",
    "clause_pitches": f"WITH {_ONCE}, {_FRAMES}, {_PITCH} SELECT utt_id, clause_id, round(f0, 6) AS f0, round(z, 6) AS z FROM zs",
    "speed_scores": f"""WITH {_ONCE}, {_SPEED}, r AS (SELECT * REPLACE (round(z, 6) AS z) FROM zs)
SELECT utt_id, clause_id, round(speed, 6) AS speed, z, coalesce(abs(z) > {Z.THRESHOLD}, false) AS annotated, {_case_level("z", Z.SPEED_LEVELS)} AS level,
  CASE WHEN z IS NOT NULL THEN greatest(-{Z.CLAMP}, least({Z.CLAMP}, z)) END AS clamped FROM r""",
    "style_controls": f"WITH {_ONCE} {_STYLE}",
    "pause_controls": f"WITH {_ONCE} {_breaks(_pause_level('gap'))}",
    "pause_controls_number": f"WITH {_ONCE} {_breaks(f"CAST({_round('gap', 1)} AS VARCHAR)")}",
    "speed_controls": f"WITH {_ONCE}, {_SPEED} {_scored('speed', 2, Z.SPEED_LEVELS, 'zs')}",
    "volume_controls": f"WITH {_ONCE}, {_FRAMES}, {_VOLUME} {_scored('volume', 3, Z.VOLUME_LEVELS, 'zs')}",
    "pitch_controls": f"WITH {_ONCE}, {_FRAMES}, {_PITCH} {_scored('pitch', 4, Z.LEVELS, 'zs')}",
    "emphasis_controls": f"WITH {_ONCE}, {_FRAMES}, {_EMPHASIS} {_emphasised('zs')}",
    "speed_controls_number": f"WITH {_ONCE}, {_SPEED} {_scored('speed', 2, Z.SPEED_LEVELS, 'zs', True)}",
    "volume_controls_number": f"WITH {_ONCE}, {_FRAMES}, {_VOLUME} {_scored('volume', 3, Z.VOLUME_LEVELS, 'zs', True)}",
    "pitch_controls_number": f"WITH {_ONCE}, {_FRAMES}, {_PITCH} {_scored('pitch', 4, Z.LEVELS, 'zs', True)}",
    "emphasis_controls_number": f"WITH {_ONCE}, {_FRAMES}, {_EMPHASIS} {_emphasised('zs', True)}",
    "emotion_controls": f"WITH {_ONCE}, {_TOP} {_EMOTION}",
    "all_controls": _ALL + " SELECT * FROM allc",
    "all_controls_number": _all(True) + " SELECT * FROM allc",
    "limited_controls": f"{_ALL}, {_limit(1)} SELECT * FROM lim",
    "formatted_controls": f"{_ALL}, {_PRIO}, {_format('allc')} SELECT * FROM fmt",
    "control_text": f"{_ALL}, {_limit(2)}, {_format('lim')} {_TEXT}",
    "control_text_number": f"{_all(True)}, {_limit(2)}, {_format('lim')} {_TEXT}",
    "given_control_text": f"WITH {_ONCE}, {_GIVEN}, {_PRIO}, {_format('given')} {_TEXT}",
    "control_spans": f"""WITH {_ONCE}, {_GIVEN}, cx AS (
  SELECT utt_id, pos, CASE WHEN isfinite(start) THEN start END AS s, CASE WHEN isfinite("end") THEN "end" END AS e, type FROM seg
), ctx AS (
  SELECT g.type, g.value, g.utt_id, g.pos, g.info, x.s, x.e,
    (SELECT arg_max(w.e, w.pos) FILTER (WHERE true) FROM cx w WHERE w.utt_id = g.utt_id AND w.pos < g.pos AND w.type = 'word' AND w.pos = (SELECT max(pos) FROM cx v WHERE v.utt_id = g.utt_id AND v.pos < g.pos AND v.type = 'word')) AS b,
    (SELECT min(pos) FROM cx v WHERE v.utt_id = g.utt_id AND v.pos >= g.pos AND v.type = 'clause') AS cp,
    (SELECT min(pos) FROM cx v WHERE v.utt_id = g.utt_id AND v.pos >= g.pos AND v.type = 'sentence') AS sp
  FROM given g LEFT JOIN cx x ON x.utt_id = g.utt_id AND x.pos = g.pos
)
SELECT q.utt_id, q.type, q.value, q.pos, q.info,
  round(coalesce(CASE WHEN q.type = 'break' THEN coalesce(b, 0.0) WHEN q.type = 'emotion' THEN CASE WHEN sp IS NULL THEN q.s ELSE sr.s END
    WHEN q.type IN ('speed', 'volume', 'pitch') THEN CASE WHEN cp IS NULL THEN q.s ELSE cr.s END ELSE q.s END, 0.0), 4) AS time,
  round(coalesce(CASE WHEN q.type = 'break' THEN q.s WHEN q.type = 'emotion' THEN CASE WHEN sp IS NULL THEN q.s ELSE sr.e END
    WHEN q.type IN ('speed', 'volume', 'pitch') THEN CASE WHEN cp IS NULL THEN q.s ELSE cr.e END ELSE q.e END, 0.0), 4) AS time_end
FROM ctx q LEFT JOIN cx cr ON cr.utt_id = q.utt_id AND cr.pos = q.cp LEFT JOIN cx sr ON sr.utt_id = q.utt_id AND sr.pos = q.sp""",
    "segment_table": f"WITH {_ONCE}, {_GIVEN}, {_PRIO}, {_format('given')} SELECT utt_id, pos, ({_fixed('s', 3)}) AS start, ({_fixed('e', 3)}) AS \"end\", "
    + _fixed("(e - s)", 3) + " AS dur, type, text, coalesce(tags, '') AS tags FROM ("
    + """SELECT *, CASE WHEN isfinite(start) THEN start END AS s, CASE WHEN isfinite("end") THEN "end" END AS e FROM seg) LEFT JOIN fmt USING (utt_id, pos)""",
    "highlight_spans": rf"""WITH {_ONCE}, {_GIVEN}, {_PRIO}, {_format('given')}, x AS (
  SELECT utt_id, wi, text, regexp_extract_all(coalesce(tags, ''), '\[[^\]]*\]') AS f FROM words LEFT JOIN fmt USING (utt_id, pos)
)
SELECT utt_id, wi, CAST(generate_subscripts(f, 1) - 1 AS INT) AS n, unnest(f) AS span, regexp_extract(unnest(f), '\[([^=\]]*)', 1) AS label FROM x
UNION ALL SELECT utt_id, wi, CAST(len(f) AS INT), coalesce(text, ''), CASE WHEN len(f) > 0 THEN regexp_extract(f[1], '\[([^=\]]*)', 1) END FROM x""",
    "calibration": f"{_CALIBRATION} {_ROUNDED} grid",
    "calibration_with_frames": f"WITH {_TIMED}, {_FRAMES}, {_framed(_LASTING)}, "
    + _framed("(SELECT * FROM words WHERE e - s > 0)").replace("sl AS", "slw AS", 1) + ", " + _FEATURES.format(more=_FRAME_FEATURES, names=repr(list(FEATURES))) + f" {_ROUNDED} grid",
    "resumed_calibration": f"""{_CALIBRATION}, u AS (
  SELECT * FROM grid WHERE n > 0 UNION ALL SELECT lang_style, feature, n, mean, std FROM population_stats WHERE n > 0
), t AS (SELECT lang_style, feature, sum(n) AS tn, sum(n * mean) / sum(n) AS tm FROM u GROUP BY ALL)
SELECT lang_style, feature, CAST(any_value(tn) AS BIGINT) AS n, round(any_value(tm), 9) AS mean,
  round(CASE WHEN any_value(tn) > 1 THEN sqrt(sum(std * std * (n - 1) + n * (mean - tm) * (mean - tm)) / (any_value(tn) - 1)) ELSE 0.0 END, 9) AS std
FROM u JOIN t USING (lang_style, feature) GROUP BY lang_style, feature""",
    "compared_calibration": f"{_CALIBRATION} SELECT lang_style, feature, g.n AS n_found, p.n AS n_shipped, round(g.mean - p.mean, 9) AS mean_diff FROM grid g JOIN population_stats p USING (lang_style, feature)",
    "control_density": f"""WITH {_ONCE}, {_GIVEN}, c AS (SELECT utt_id, count(*) AS c FROM given WHERE type <> 'style' GROUP BY utt_id),
w AS (SELECT utt_id, count(*) AS w, count(DISTINCT clause_id) AS cl FROM words GROUP BY utt_id)
SELECT lang, utt_id, CAST(sum(coalesce(c, 0)) AS BIGINT) AS n_controls, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(cl) AS BIGINT) AS n_clauses,
  round(sum(coalesce(c, 0)) / sum(w), 6) AS per_word, round(sum(coalesce(c, 0)) / sum(cl), 6) AS per_clause
FROM (SELECT coalesce(lang, 'unknown') AS lang, utt_id, w, cl, c FROM w LEFT JOIN c USING (utt_id) LEFT JOIN about USING (utt_id)) GROUP BY ROLLUP (lang, utt_id)""",
    "label_counts": f"WITH {_GIVEN} SELECT type, value, count(*) AS n FROM (SELECT type, coalesce(value, 'None') AS value FROM given) GROUP BY ROLLUP (type, value)",
    "clamp_rates": f"""WITH {_GIVEN} SELECT type, count(*) AS n, CAST(count(*) FILTER (WHERE abs(value_num) >= 3) AS BIGINT) AS n_clamped,
  round(avg(CASE WHEN abs(value_num) >= 3 THEN 1.0 ELSE 0.0 END), 6) AS rate, round(avg(value_num), 6) AS mean_z, round(coalesce(stddev_samp(value_num), 0.0), 6) AS sd_z
FROM given WHERE type IN ('speed', 'volume', 'pitch', 'emphasis') AND value_num IS NOT NULL GROUP BY type""",
}
SQL["control_text_by_steps"] = SQL["control_text"]

SQL["trimmed_words"] = f"""WITH {_ONCE}, {_FRAMES}, {_framed("words")}, th AS (
  SELECT *, greatest(list_aggregate(en, 'quantile_cont', 0.1), 0.002) AS lim FROM sl
), ld AS (SELECT *, list_filter(range(1, len(en) + 1), lambda i: en[i] > lim) AS loud FROM th),
mv AS (
  SELECT utt_id, wi, CASE WHEN len(loud) > 0 THEN (trunc(s * 10.0) + loud[1] - 1) / 10.0 ELSE s END AS ns,
    CASE WHEN len(loud) > 0 THEN (trunc(s * 10.0) + loud[-1] - 1) / 10.0 ELSE e END AS ne FROM ld
)
SELECT w.utt_id, w.wi, round(coalesce(ns, s), 6) AS start, round(coalesce(ne, e), 6) AS "end" FROM words w LEFT JOIN mv USING (utt_id, wi)"""

_HEARD = """(
  SELECT utt_id, coalesce(max(u.text), any_value(h.text)) AS text FROM utterances u LEFT JOIN (
    SELECT utt_id, string_agg(text, ' ' ORDER BY pos, text) AS text
    FROM (SELECT DISTINCT utt_id, pos, text FROM segments WHERE type = 'sentence' AND text IS NOT NULL) GROUP BY utt_id
  ) h USING (utt_id) GROUP BY utt_id
)"""


def _aligned(said: str) -> str:
    return (
        f"WITH {_ONCE}," + _ATTACH.replace("FROM utterances {where} GROUP BY utt_id", f"FROM {said} GROUP BY utt_id").replace("{{", "{").replace("}}", "}")
        + "," + _grouped("att", "utt_id") + ' SELECT utt_id, wi, pos, clause_id, sent_id, text, start, "end" FROM grp'
    )


SQL["aligned_words"] = _aligned("utterances")
SQL["aligned_utterances"] = _aligned(_HEARD)

SQL["alignment_report"] = f"""WITH {_ONCE}
SELECT utt_id || chr(9) || ({_fixed("start", 3)}) || chr(9) || ({_fixed('"end"', 3)}) || chr(9) || type || chr(9) || coalesce(text, '') AS value
FROM seg WHERE isfinite(start) AND isfinite("end")"""
