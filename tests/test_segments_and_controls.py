import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sonoweave.functions import text as T
from sonoweave.operators import align, calibrate, compose, controls, quality, segments
from sonoweave.plans import queries

T0 = datetime(2024, 5, 1)
WORDS = "utt_id string, wi int, pos int, clause_id int, sent_id int, text string, start double, end double"
STATS = "lang_style string, feature string, n bigint, mean double, std double"
FRAMES = "utt_id string, sr int, hop int, energy array<double>, f0_hop int, f0 array<double>"
SEG = "seg_id bigint, utt_id string, source string, pos int, start double, end double, text string, type string, loaded_at timestamp"


def test_words_clauses_sentences(spark):
    df = spark.createDataFrame([("a", "Hello, 你好！How are you？我很好，谢谢。"), ("b", ""), ("c", None), ("d", "no mark")], "k string, text string")
    rows = sorted(segments.text_words(df, "k").collect(), key=lambda r: (r.k, r.wi))
    got = [(r.wi, r.text, r.clause_id, r.sent_id, r.pos) for r in rows if r.k == "a"]
    assert got == [
        (0, "Hello,", 0, 0, 0), (1, "你", 1, 0, 2), (2, "好！", 1, 0, 3), (3, "How", 2, 1, 6), (4, "are", 2, 1, 7), (5, "you？", 2, 1, 8),
        (6, "我", 3, 2, 11), (7, "很", 3, 2, 12), (8, "好，", 3, 2, 13), (9, "谢", 4, 2, 15), (10, "谢。", 4, 2, 16),
    ]
    assert {r.k for r in rows} == {"a", "d"}
    timed = segments.synthetic_times(segments.text_words(df, "k"), "k", F.lit(1))
    listed = sorted((r for r in segments.interleave(timed, "k", "start_ms", "end_ms").collect() if r.k == "a"), key=lambda r: r.pos)
    assert [r.pos for r in listed] == list(range(len(listed)))  # positions are list indices
    assert [(r.type, r.text) for r in listed if r.type != "word"] == [
        ("clause", "Hello,"), ("clause", "你好！"), ("sentence", "Hello,你好！"), ("clause", "How are you？"), ("sentence", "How are you？"),
        ("clause", "我很好，"), ("clause", "谢谢。"), ("sentence", "我很好，谢谢。"),
    ]
    assert all(r.end_ms > r.start_ms for r in listed)


def sequential_attach(tokens, items):
    """The rule read one token at a time."""
    out, k = [], 0
    for t in tokens:
        clean = re.sub(r"[^\w]", "", t).lower()
        if not clean:
            if out:
                out[-1][0] += t
            continue
        need = min(len(clean), len(items) - k) if re.search("[一-鿿]", clean) else 1
        if need <= 0 or k >= len(items):
            continue
        out.append([t, items[k][0], items[k + need - 1][1]])
        k += need
    return [tuple(x) for x in out]


def test_attach_times(spark):
    rng = random.Random(2)
    toks, items, want = [], [], {}
    for u in range(60):
        ts = [rng.choice(["a", "b,", "你", "好！", "--", "你好吗", "c。", "…"]) for _ in range(rng.randrange(1, 12))]
        its = [(i * 1.0, i + 0.5) for i in range(rng.randrange(0, 12))]
        toks += [(f"u{u}", i, t) for i, t in enumerate(ts)]
        items += [(f"u{u}", i, s, e) for i, (s, e) in enumerate(its)]
        want[f"u{u}"] = sequential_attach(ts, its)
    got = segments.attach_times(spark.createDataFrame(toks, "utt_id string, ti int, text string"), spark.createDataFrame(items, "utt_id string, item_idx int, start double, end double"))
    found = {u: [] for u in want}
    for r in sorted(got.collect(), key=lambda r: (r.utt_id, r.wi)):
        assert r.wi == len(found[r.utt_id])
        found[r.utt_id].append((r.text, r.start, r.end))
    assert found == want


def example(spark):
    """One utterance of two clauses with known features."""
    words = spark.createDataFrame(
        [
            ("u", 0, 0, 0, 0, "Well,", 0.00, 0.40), ("u", 1, 2, 1, 0, "this", 0.70, 0.90), ("u", 2, 3, 1, 0, "is", 0.95, 1.05),
            ("u", 3, 4, 1, 0, "fast", 1.10, 1.30), ("u", 4, 5, 1, 0, "talk.", 1.35, 1.60),
        ],
        WORDS,
    )
    stats = spark.createDataFrame(
        [("en_read", f, 9, m, s) for f, m, s in [("speed", 2.88, 0.58), ("energy", 0.020, 0.003), ("word_duration", 0.318, 0.214), ("word_energy", 0.021, 0.012)]], STATS
    )
    about = spark.createDataFrame([("u", "en", "read")], "utt_id string, lang string, style string")
    return words, about, stats


@pytest.mark.parametrize("as_number, speeds, gap", [(False, {0: "slow", 2: "xfast"}, "short"), (True, {0: "-0.66", 2: "2.7"}, "0.3")])
def test_worked_example(spark, as_number, speeds, gap):
    words, about, stats = example(spark)
    speed = controls.speed_controls(words, about, stats, as_number)
    assert {r.pos: r.value for r in speed.collect()} == speeds
    pause = controls.pause_controls(words, as_number)
    assert [(r.pos, r.value, r.info.endswith("inter_clause")) for r in pause.collect()] == [(2, gap, True)]
    style = controls.style_controls(words, about)
    given = spark.createDataFrame(
        [("u", 3, "volume", "1.33" if as_number else "loud", 1.33, 0, ""), ("u", 4, "pitch", "1.25" if as_number else "high", 1.25, 0, ""), ("u", 5, "emphasis", "1.29" if as_number else "emphasis", 1.29, 0, "")],
        "utt_id string, ext_order int, type string, value string, value_num double, pos int, info string",
    )
    every = compose.union([style, pause, speed, given])
    text = compose.control_text(words, every).first().text
    assert text == (
        "[style=read][speed=-0.66][volume=1.33][pitch=1.25][emphasis=1.29]Well, [speed=2.7][break=0.3]this is fast talk."
        if as_number
        else "[style=read][speed=slow][volume=loud][pitch=high][emphasis]Well, [speed=xfast][break=short]this is fast talk."
    )
    limited = compose.limit_per_clause(every, words, 1)
    value = "2.7" if as_number else "xfast"
    assert compose.control_text(words, limited).first().text == f"[style=read]Well, [speed={value}]this is fast talk."
    again = compose.limit_per_clause(limited, words, 1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, limited.collect()))
    assert compose.limit_per_clause(every, words, None).count() == every.count()
    with pytest.raises(ValueError):
        compose.limit_per_clause(every, words, -1)


def test_frame_controls(spark):
    words, about, stats = example(spark)
    energy = [0.024] * 40 + [0.0] * 30 + [0.0195] * 130
    f0 = ([225.0] * 40 + [0.0] * 30 + [195.0] * 90 + [0.0] * 40)
    frames = spark.createDataFrame([("u", 16000, 160, energy, 160, f0)], FRAMES)
    volume = controls.volume_controls(words, frames, about, stats).collect()
    assert [(r.pos, r.value, round(r.value_num, 2)) for r in volume] == [(0, "loud", 1.33)]
    base = 204.23  # mean of 40 frames of 225 and 90 of 195
    pitch = controls.pitch_controls(words, frames, as_number=True).collect()
    sd = max((sum((x - base) ** 2 for x in f0 if x) / 129) ** 0.5, 10.0)
    assert {r.pos: round(r.value_num, 1) for r in pitch} == {0: round((225 - base) / sd, 1), 2: round((195 - base) / sd, 1)}
    loud = spark.createDataFrame([("u", 16000, 160, [0.045] * 40 + energy[40:], 160, f0)], FRAMES)
    emphasis = controls.emphasis_controls(words, loud, about, stats).collect()
    assert [(r.pos, r.value) for r in emphasis] == [(0, "emphasis")]
    score = {r.wi: r.z for r in controls.emphasis_scores(words, loud, about, stats).collect()}
    assert score[0] == pytest.approx(0.4 * 2.0 + 0.3 * (0.4 - 0.318) / 0.214 + 0.3 * (225 - base) / sd, abs=1e-3)
    silent = spark.createDataFrame([("u", 16000, 160, [], 160, [])], FRAMES)
    assert controls.pitch_controls(words, silent).count() == 0
    assert {r.value for r in controls.volume_controls(words, silent, about, stats).collect()} == {"whisper"}
    trimmed = segments.trimmed_words(words, loud)
    assert trimmed.count() == 5 and trimmed.columns == words.columns


def test_emotions_and_missing_statistics(spark):
    words, about, stats = example(spark)
    scores = spark.createDataFrame([("u", 0, [0.1, 0.0, 0.0, 0.6, 0.9, 0.0, 0.31, 0.0, 0.0]), ("u", 7, [0.9] + [0.0] * 8), ("u", 0, None)], "utt_id string, sent_id int, scores array<double>")
    assert [(r.pos, r.value) for r in controls.emotion_controls(words, scores).collect()] == [(0, "happy+sad")]
    none = stats.limit(0)
    assert controls.speed_controls(words, about, none).count() == 0
    assert controls.speed_controls(words, about.limit(0), stats).count() == 2  # no language counts as English
    assert controls.speed_controls(words.limit(0), about, stats).count() == 0


def stored(spark):
    rows = [
        (1, "u", "s", 0, 0.0, 0.4, "Hi,", "word", T0), (2, "u", "s", 1, 0.0, 0.4, "Hi,", "clause", T0), (3, "u", "s", 2, 0.9, 1.2, "you", "word", T0),
        (4, "u", "s", 3, 1.2, float("inf"), None, "word", T0), (5, "u", "s", 4, 0.9, 1.6, "you there", "clause", T0), (6, "u", "s", 5, 0.0, 1.6, "Hi, you there", "sentence", T0),
    ]
    return spark.createDataFrame(rows[::-1] + [(*rows[2][:8], datetime(2024, 6, 1))], SEG)


def test_stored_lists(spark):
    df = stored(spark)
    words = sorted(segments.listed_words(df).collect(), key=lambda r: r.wi)
    assert [(r.wi, r.pos, r.clause_id, r.sent_id, r.text, r.end) for r in words] == [(0, 0, 0, 0, "Hi,", 0.4), (1, 2, 1, 0, "you", 1.2), (2, 3, 1, 0, None, None)]
    given = spark.createDataFrame(
        [("u", 1, "break", "short", None, 2, None), ("u", 2, "speed", "fast", float("nan"), 2, None), ("u", 6, "emotion", "happy", None, 0, None), ("u", 5, "emphasis", "emphasis", 1.0, 0, None), ("u", 1, "break", "long", None, 0, None), ("u", 2, "speed", "fast", None, 99, None)] * 2,
        "utt_id string, ext_order int, type string, value string, value_num double, pos int, info string",
    )
    clean = compose.distinct_controls(given)
    assert clean.count() == 6
    spans = {(r.type, r.pos): (r.time, r.time_end) for r in compose.control_spans(clean, df).collect()}
    assert spans == {("break", 2): (0.4, 0.9), ("speed", 2): (0.9, 1.6), ("emotion", 0): (0.0, 1.6), ("emphasis", 0): (0.0, 0.4), ("break", 0): (0.0, 0.0), ("speed", 99): (0.0, 0.0)}
    tags = compose.formatted(clean)
    table = {r.pos: r for r in compose.segment_table(df, tags).collect()}
    assert table[2].tags == "[speed=fast][break=short]" and table[2].dur == "0.300" and table[3].end is None and table[1].tags == ""
    text = compose.control_text(segments.listed_words(df), clean).first().text
    assert text == "[emotion=happy][break=long][emphasis]Hi, [speed=fast][break=short]you "
    marks = {(r.wi, r.n): (r.span, r.label) for r in compose.highlight_spans(segments.listed_words(df), tags).collect()}
    assert marks[0, 2] == ("[emphasis]", "emphasis") and marks[0, 3] == ("Hi,", "emotion") and marks[2, 0] == ("", None)


@pytest.mark.parametrize("block", [1, 3, 7])
def test_blocks_of_lists_do_not_matter(spark, monkeypatch, block):
    """Lists read in small blocks equal lists read as one: ids, the word before, clauses and the spans of controls."""
    rng = random.Random(block)
    rows = []
    for u in ("hot", "b", None):
        pos, at = 0, 0.0
        for _ in range(60 if u == "hot" else 9):
            kind = rng.choice(["word"] * 5 + ["clause", "sentence"])
            rows.append((len(rows), u, "s", pos, at, at + rng.choice([0.1, 0.5]), "w,", kind, T0))
            pos += rng.choice([1, 1, 4])
            at += 0.4
    df = spark.createDataFrame(rows + rows[::5], SEG)
    given = spark.createDataFrame([("hot", 1, t, "x", None, p, None) for t in ("break", "speed", "emotion") for p in range(0, 60, 3)], "utt_id string, ext_order int, type string, value string, value_num double, pos int, info string")

    def everything():
        listed = segments.listed_rows(df)
        parts = listed, segments.clauses(listed), segments.pauses(segments.only_words(listed)), compose.control_spans(given, df)
        return [sorted(map(str, x.collect())) for x in parts]

    whole = everything()
    monkeypatch.setattr(segments, "BLOCK", block)
    assert everything() == whole
    words = sorted((r for r in segments.listed_words(df).collect() if r.utt_id == "hot"), key=lambda r: r.pos)
    assert [r.wi for r in words] == list(range(len(words))) and words[0].prev is None
    assert all(b.prev.end == a.end and b.prev.clause_id == a.clause_id and b.prev.sent_id == a.sent_id for a, b in zip(words, words[1:]))


def test_registry_keeps_places(spark):
    words, about, stats = example(spark)
    r = compose.Registry().add("style", lambda: controls.style_controls(words, about)).add("break", lambda: controls.pause_controls(words))
    r.add("style", lambda: controls.style_controls(words, about.withColumn("style", F.lit("chat"))))
    assert list(r.extractors) == ["style", "break"]
    assert {x.value for x in r.collect().collect()} == {"chat", "short"}


def test_calibration(spark):
    words, about, stats = example(spark)
    utts = spark.createDataFrame([("u", "EN ", "read"), ("u", "en", "read")], "utt_id string, lang string, style string")
    got = {(r.lang_style, r.feature): r for r in calibrate.calibrate(words, utts).collect()}
    assert len(got) == len(calibrate.FEATURES)
    assert got["en_read", "speed"].n == 2 and got["en_read", "speed"].mean == pytest.approx((2.5 + 4 / 0.9) / 2)
    assert (got["en_read", "energy"].n, got["en_read", "energy"].mean, got["en_read", "energy"].std) == (0, 0.0, 0.0)
    values = spark.createDataFrame([("a", "speed", v) for v in (4.1, 4.9, 5.2, 4.4)] + [("b", "speed", 1.0)], "utt_id string, feature string, value double")
    both = spark.createDataFrame([("a", "zh", None), ("b", "fr", "chat")], "utt_id string, lang string, style string")
    s = {r.lang_style: r for r in calibrate.statistics(values, both).collect()}
    assert s["zh_read"].mean == pytest.approx(4.65) and s["zh_read"].std == pytest.approx(0.493288, abs=1e-6) and s["fr_chat"].std == 0.0


@pytest.mark.parametrize("cut", [1, 3, 17, 39])
def test_merge_equals_statistics_of_the_union(spark, cut):
    rng = random.Random(cut)
    rows = [("u", "speed", rng.gauss(5, 2)) for _ in range(40)]
    about = spark.createDataFrame([("u", "en", "read")], "utt_id string, lang string, style string")
    stat = lambda xs: calibrate.statistics(spark.createDataFrame(xs, "utt_id string, feature string, value double"), about)
    whole, merged = stat(rows).first(), calibrate.merge(stat(rows[:cut]), stat(rows[cut:]), stat(rows).limit(0)).first()
    assert merged.n == 40 and merged.mean == pytest.approx(whole.mean) and merged.std == pytest.approx(whole.std)
    assert calibrate.compare(stat(rows), stat(rows)).first().mean_diff == 0.0


def test_quality(spark):
    words, about, _ = example(spark)
    given = spark.createDataFrame([("u", "style", "read", None), ("u", "speed", "fast", 3.0), ("u", "speed", "slow", -1.0), ("u", "break", "short", 0.3)], "utt_id string, type string, value string, value_num double")
    d = {(r.lang, r.utt_id): r for r in quality.density(given, words, about).collect()}
    assert d["en", "u"].n_controls == 3 and d[None, None].per_clause == 1.5 and ("en", None) in d
    counts = {(r.type, r.value): r.n for r in quality.label_counts(given).collect()}
    assert counts["speed", None] == 2 and counts[None, None] == 4
    assert [(r.type, r.n_clamped, r.rate) for r in quality.clamp_rates(given).collect()] == [("speed", 1, 0.5)]


def test_alignment_by_providers(spark):
    utts = spark.createDataFrame([("a", "Hi there.", "EN"), ("b", None, "zh"), ("c", "x", None)], "utt_id string, text string, lang string")
    heard = spark.createDataFrame([("b", "你好。", "Chinese"), ("c", "y", "French"), ("a", "no", "German")], "utt_id string, text string, language string")
    filled = {r.utt_id: (r.text, r.lang) for r in align.with_text_and_language(utts, align.TableProvider(heard)).collect()}
    assert filled == {"a": ("Hi there.", "en"), "b": ("你好。", "zh"), "c": ("x", "french")}
    words = align.align(utts, align.SyntheticAligner(), align.TableProvider(heard))
    got = {}
    for r in sorted(words.collect(), key=lambda r: (r.utt_id, r.wi)):
        got.setdefault(r.utt_id, []).append(r.text)
    assert got["a"] == ["Hi", "there."] and got["c"] == ["x"]
    assert {r.lang for r in align.detected_languages(utts, align.TableProvider(heard)).collect()} == {"chinese", "french", "german"}
    with pytest.raises(Exception, match="Unsupported"):
        align.align(utts.withColumn("lang", F.lit("klingon")), align.SyntheticAligner()).collect()


def test_all_utterances_are_aligned(spark, tmp_path):
    langs = ["en", "EN ", "English", "zh-CN", "zh_en", "mixed", None, "Japanese", ""]
    utts = [(f"u{i}", "a b.", lang) for i, lang in enumerate(langs)] + [("v", None, "French"), ("w", None, None)]
    spark.createDataFrame(utts, "utt_id string, text string, lang string").write.parquet(str(tmp_path / "utterances.parquet"))
    rows = []
    for u, _, _ in utts:
        for kind, pos, text, at in (("word", 0, "a", 0.0), ("word", 1, "b.", 1.0), ("clause", 2, "a b.", 0.0), ("sentence", 3, "a b.", 0.0)):
            rows.append((len(rows), u, "s", pos, at, at + 0.5, text, kind))
    segs = spark.createDataFrame(rows, "seg_id bigint, utt_id string, source string, pos int, start double, end double, text string, type string")
    segs.withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(str(tmp_path / "segments.parquet"))
    got = [(r.utt_id, r.wi, r.text, r.start) for r in queries.QUERIES["aligned_utterances"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((u, i, w, float(i)) for u, _, _ in utts for i, w in enumerate(["a", "b."]))
    assert queries.QUERIES["unsupported_languages"](spark, str(tmp_path)).collect() == []
    names = {r.lang: r.l for r in spark.createDataFrame(utts + [("x", "", "klingon")], "utt_id string, text string, lang string").select("lang", T.spelled_language(F.col("lang")).alias("l")).collect()}
    assert names == {"en": "English", "EN ": "English", "English": "English", "zh-CN": "Chinese", "zh_en": None, "mixed": None, None: None, "": None, "Japanese": "Japanese", "French": "French", "klingon": "klingon"}
