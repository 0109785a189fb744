import wave

import numpy as np
import pytest

from sonoweave.__main__ import main
from sonoweave.plans import flagship, queries
from sonoweave.plans.builder import ControlBuilder, Inputs, Options
from sonoweave.sources import config, tree

from .conftest import DATA, needs_data
from .test_segments_and_controls import FRAMES, example


def test_default_statistics(spark):
    rows = {(r.lang_style, r.feature): r for r in config.default_stats(spark).collect()}
    assert len(rows) == 24 and rows["en_read", "speed"].mean == 2.88 and rows["zh_emotion", "loudness_lufs"].std == 5.2


def test_builder(spark):
    words, about, stats = example(spark)
    frames = spark.createDataFrame([("u", 16000, 160, [0.045] * 40 + [0.0] * 30 + [0.0195] * 130, 160, [225.0] * 40 + [0.0] * 30 + [195.0] * 130)], FRAMES)
    scores = spark.createDataFrame([("u", 0, [0.0, 0.0, 0.0, 0.6] + [0.0] * 5)], "utt_id string, sent_id int, scores array<double>")
    plain, three = Inputs(words, about, stats), ("style", "break", "speed")
    with pytest.raises(ValueError, match="volume, pitch, emphasis, emotion"):
        ControlBuilder().build(plain)
    assert ControlBuilder(kinds=three).build(plain).first().text == "[style=read][speed=slow]Well, [speed=xfast][break=short]this is fast talk."
    assert ControlBuilder(Options(number_control=True, max_controls_per_clause=1), kinds=three).build(plain).first().text == "[style=read]Well, [speed=2.7]this is fast talk."
    full = ControlBuilder().build(Inputs(words, about, stats, frames, scores)).first().text
    assert full.startswith("[style=read][emotion=happy][speed=slow][volume=shout]") and "[emphasis]Well," in full
    for number in (False, True):
        for most in (None, 0, 1, 3):
            steps = ControlBuilder(Options(number, most)).build(Inputs(words, about, stats, frames, scores)).first().text
            assert flagship.control_text(words, about, stats, scores, most, frames, number).first().text == steps
    loose = ControlBuilder(Options(pause_levels=(("none", 0.5), ("long", None))), kinds=("break",))
    assert loose.build(plain).first().text == "Well, this is fast talk."
    own = ControlBuilder(kinds=("style",)).add_extractor("volume", lambda x, o: ControlBuilder(kinds=("break",)).controls(x))
    assert {r.type for r in own.controls(plain).collect()} == {"style", "break"}
    assert ControlBuilder(Options(emphasis_threshold=99.0), kinds=("emphasis",)).controls(Inputs(words, about, stats, frames)).count() == 0


@needs_data
def test_command_line(spark, tmp_path):
    run = lambda *more: main(["control-text", "--data", str(DATA), "--number", "--max-per-clause", "1", *more])
    run("--out", str(tmp_path / "t"), "--extractors", "style,break,speed,emotion")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
    with pytest.raises(ValueError, match="volume"):
        run("--out", str(tmp_path / "none"))
    queries._frames(spark, str(DATA)).write.parquet(str(tmp_path / "frames"))
    run("--out", str(tmp_path / "all"), "--frames", str(tmp_path / "frames"))
    assert spark.read.parquet(str(tmp_path / "all")).where("text LIKE '%[volume=%'").count() > 0
    main(["calibrate", "--data", str(DATA), "--out", str(tmp_path / "c")])
    assert config.read_stats(spark, str(tmp_path / "c")).where("feature = 'speed' AND n > 0").count() > 0


def tone(path, sr, seconds, level):
    y = level * np.sin(2 * np.pi * 997 * np.arange(int(sr * seconds)) / sr)
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes((y * 32767).astype("<i2").tobytes())


def test_from_recordings_to_statistics_and_tags(spark, tmp_path):
    """Two recordings, one of them broken: energy and loudness reach calibration, energy the tags."""
    tone(tmp_path / "wav/en/a.wav", 16000, 3.0, 0.5)
    (tmp_path / "wav/en/b.WAV").write_bytes(b"no sound")
    data = tmp_path / "data"
    utts = [("u", "s", "x/en/a.wav", "en", "read", 3.0), ("v", "s", "x/en/b.wav", "en", "read", 3.0), ("w", "s", None, "en", "read", 3.0)]
    spark.createDataFrame(utts, "utt_id string, source string, path string, lang string, style string, duration_s double").write.parquet(str(data / "utterances.parquet"))
    rows = []
    for u in "uvw":
        for kind, text, s, e in [("word", "one", 0.2, 0.9), ("word", "two.", 1.0, 1.8), ("clause", "one two.", 0.2, 1.8), ("sentence", "one two.", 0.2, 1.8)]:
            rows.append((len(rows), u, "s", len(rows), s, e, text, kind))
    segs = spark.createDataFrame(rows, "seg_id bigint, utt_id string, source string, pos int, start double, end double, text string, type string")
    segs.selectExpr("*", "timestamp'2024-01-01' AS loaded_at").write.parquet(str(data / "segments.parquet"))
    main(["calibrate", "--data", str(data), "--out", str(tmp_path / "c"), "--audio", str(tmp_path / "wav")])
    got = {r.feature: r for r in config.read_stats(spark, str(tmp_path / "c")).collect()}
    assert (got["duration"].n, got["energy"].n, got["word_energy"].n, got["loudness_lufs"].n) == (3, 1, 2, 1)
    assert abs(got["loudness_lufs"].mean - (20 * np.log10(0.5) - 3.01)) < 0.1  # a sine of full scale at 997 Hz is -3.01 LUFS
    status = {r.path.rsplit("/", 1)[1]: r.ok for r in tree.decoding_status(spark, str(tmp_path / "wav")).collect()}
    assert status == {"a.wav": True, "b.WAV": False}
    main(["control-text", "--data", str(data), "--out", str(tmp_path / "t"), "--audio", str(tmp_path / "wav"), "--extractors", "style,volume"])
    text = {r.utt_id: r.text for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert text["u"].startswith("[style=read][volume=") and text["v"] == "[style=read]one two."
