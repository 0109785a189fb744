import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoweave.sources import config, sinks, tree
from sonoweave.streaming.calibration import IncrementalCalibration


def write_wav(path, y, sr=16000):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(b"".join(struct.pack("<h", int(v * 32767)) for v in y))


@pytest.fixture
def corpus(tmp_path):
    t = np.arange(16000) / 16000
    write_wav(tmp_path / "zh" / "a.wav", 0.5 * np.sin(2 * np.pi * 997 * t))
    write_wav(tmp_path / "en" / "b.wav", 0.1 * np.sin(2 * np.pi * 997 * t))
    write_wav(tmp_path / "en" / "c.WAV", 0.1 * np.sin(2 * np.pi * 997 * t))
    (tmp_path / "en" / "broken.wav").write_bytes(b"RIFFnot a wave file")
    (tmp_path / "zh" / "a.txt").write_text("  你好。\n", encoding="utf-8")
    (tmp_path / "en" / "alone.txt").write_text("Hi.", encoding="utf-8")
    return tmp_path


def test_tree(spark, corpus):
    wavs = tree.recordings(spark, str(corpus))
    assert {r.stem for r in wavs.collect()} == {"a", "b", "broken"}
    assert {r.stem for r in tree.recordings(spark, str(corpus / "en"), recursive=False, any_case=True).collect()} == {"b", "broken", "c"}
    assert tree.files_by_ext(spark, str(corpus), ".txt").count() == 2
    texts = tree.transcripts(spark, str(corpus))
    pairs = tree.pair(wavs, texts)
    assert [(r.stem, r.text) for r in pairs.collect()] == [("a", "你好。")]
    assert {(r.stem, r.text) for r in tree.pair(wavs, texts, "left").collect()} == {("a", "你好。"), ("b", ""), ("broken", "")}
    assert {r.stem for r in tree.pair(wavs, texts, "left_anti").collect()} == {"b", "broken"}
    row = tree.utterance_table(tree.pair(wavs.where("stem = 'a'"), texts)).first()
    assert (row.utt_id, row.lang, row.label) == ("zh/a", "zh", "[zh] a")
    assert spark.range(1).select(tree.transcript_path(F.lit("/x.wav/y.wav"))).first()[0] == "/x.txt/y.txt"


def test_audio(spark, corpus):
    rows = {r.path.rsplit("/", 1)[1]: r for r in tree.energy_frames(spark, str(corpus)).collect()}
    assert rows["a.wav"].hop == 160 and len(rows["a.wav"].energy) == 101
    assert np.median(rows["a.wav"].energy) / np.median(rows["b.wav"].energy) == pytest.approx(5.0, rel=0.01)
    assert rows["broken.wav"].energy is None and rows["broken.wav"].error
    path = next(r.path for r in tree.recordings(spark, str(corpus)).collect() if r.stem == "a")
    spans = spark.createDataFrame([(path, 1, 0.0, 1.0), (path, 2, 0.0, 0.3)], "path string, id int, start double, end double")
    lufs = {r.id: r.lufs for r in tree.segment_loudness(spark, str(corpus / "zh"), spans).collect()}
    assert lufs[1] == pytest.approx(-9.05, abs=0.2) and (lufs[2] is None or lufs[2] != lufs[2])


def test_configuration(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("# x\ndatasets:\n  - name: a\n    path: /p # here\n    lang: zh\n    style: 'read'\n  - name: b\n    path: q\n    lang: en\n    style: chat\n    text_ext: .lab\nother: 1\n")
    rows = [tuple(r) for r in config.read_datasets(spark, str(tmp_path / "d.yaml")).collect()]
    assert rows == [("a", "/p", "zh", "read", ".txt"), ("b", "q", "en", "chat", ".lab")]
    assert config.parse_datasets("x: 1\n") == []


def test_statistics_round_trip(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"_comment": "n", "zh_read": {"speed": {"n": 3, "mean": 1.23456789, "std": 0.5}}, "bad": 3}')
    stats = config.read_stats(spark, str(tmp_path / "s.json"))
    assert [tuple(r) for r in stats.collect()] == [("zh_read", "speed", 3, 1.23456789, 0.5)]
    config.write_stats(stats, str(tmp_path / "out"))
    assert [tuple(r) for r in config.read_stats(spark, str(tmp_path / "out")).collect()] == [("zh_read", "speed", 3, 1.234568, 0.5)]
    assert config.empty_stats(spark).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("u", "t", "en")], "utt_id string, text string, lang string")
    sinks.write_new(df, str(tmp_path / "o"), by="lang")
    assert spark.read.json(str(tmp_path / "o")).first().lang == "en"
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_new(df, str(tmp_path / "o"))
    rates = spark.createDataFrame([("u", 0.5, "a", "b"), ("v", 0.0, "a", "a")], "utt_id string, wer double, ref string, hyp string")
    assert {r.value for r in sinks.wer_lines(rates).collect()} >= {"mean WER=0.2500"}
    seg = spark.createDataFrame([("u", 0, 0.0, 1.0, "x", "word", "")], "utt_id string, pos int, start double, end double, text string, type string, tags string")
    assert sinks.alignment_lines(seg).first().value == "u\t0.000\t1.000\tword\tx"
    spans = spark.createDataFrame([("u", 0, "speed", "fast", "i", 0.0, 1.0)], "utt_id string, pos int, type string, value string, info string, time double, time_end double")
    row = sinks.analysis_rows(df.select("utt_id", "text"), seg.withColumn("dur", F.lit("1.000")), spans).first()
    assert row.control_text == "t" and row.controls[0].value == "fast" and row.segments[0].text == "x"


def test_incremental_calibration(spark, tmp_path):
    schema = "lang_style string, feature string, value double"
    batches = [[("en_read", "speed", float(v)) for v in xs] for xs in ([1, 2, 3], [4, 5], [9])]
    inc = IncrementalCalibration(spark, str(tmp_path / "state"))
    for i, b in enumerate(batches):
        inc.process(spark.createDataFrame(b, schema), i)
    inc.process(spark.createDataFrame(batches[1], schema), 1)  # a replay counts once
    row = inc.statistics().first()
    assert (row.n, row.mean) == (6, 4.0) and row.std == pytest.approx(np.std([1, 2, 3, 4, 5, 9], ddof=1))
    source = tmp_path / "in"
    for b in batches:
        spark.createDataFrame(b, schema).write.mode("append").parquet(str(source))
    live = IncrementalCalibration(spark, str(tmp_path / "live"))
    q = live.start(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert live.statistics().first().n == 6
