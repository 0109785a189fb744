import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoweave.functions import frames as A
from sonoweave.functions import signal as S
from sonoweave.functions import zscore as Z

c = F.col
NAN = float("nan")


@pytest.mark.parametrize("z, label", [(-1.5, "low"), (-0.5, "normal"), (0.5, "normal"), (1.5, "high"), (-1.5000001, "xlow"), (9.0, "xhigh"), (NAN, None)])
def test_levels(one, z, label):
    assert one(Z.level(c("z")), z=z) == label


@pytest.mark.parametrize("z, yes", [(0.5, False), (-0.5, False), (0.5000001, True), (-3.0, True), (NAN, False)])
def test_annotated(one, z, yes):
    assert one(Z.annotated(c("z")), z=z) is yes


def test_clamp_and_population(one):
    for z, out in [(5.5, 3.0), (-4.0, -3.0), (1.5, 1.5)]:
        assert one(Z.clamped(c("z")), z=z) == out
    z = Z.population_z(c("v"), c("m"), c("s"))
    assert one(z, v=3.0, m=1.0, s=2.0) == 1.0
    assert one(z, v=3.0, m=1.0, s=0.0) is None
    assert one(z, v=NAN, m=1.0, s=2.0) is None
    assert one(Z.population_z(c("v"), F.lit(None).cast("double"), F.lit(None).cast("double")), v=3.0) is None
    assert one(Z.shown(c("z"), Z.SPEED_LEVELS), z=2.6973) == "xfast"
    assert one(Z.shown(c("z"), as_number=True), z=2.6973) == "2.7"
    assert one(Z.shown(c("z"), as_number=True), z=-7.0) == "-3.0"
    assert one(Z.number(c("z")), z=1700000001.1) == "1700000001.1"


@pytest.mark.parametrize("gap, level", [(-0.1, "none"), (0.2, "short"), (0.5, "medium"), (0.9, "long"), (1.5, "xlong"), (NAN, None)])
def test_pause_levels(one, gap, level):
    assert one(Z.pause_level(c("g")), g=gap) == level


def test_emotions(one):
    scores = [0.2, 0.0, 0.0, 0.6, 0.9, 0.0, 0.31, 0.0, 0.0]
    assert one(Z.top_emotions(c("s")), s=scores) == "happy+sad"
    assert one(Z.top_emotions(c("s")), s=[0.2] * 9) is None
    assert one(Z.top_emotions(c("s")), s=[0.4] * 9) == "angry+disgusted"
    assert one(Z.top_emotions(c("s")), s=[NAN, 0.3]) == "disgusted"
    assert one(Z.top_emotions(c("s")), s=[]) is None


def test_slices(one):
    frames = [float(i) for i in range(100)]
    cut = lambda s, e: one(A.time_slice(c("f"), F.lit(s), F.lit(e), F.lit(16000), F.lit(160)), f=frames)
    assert cut(0.0, 0.03) == [0.0, 1.0, 2.0]
    assert cut(0.29, 0.30) == [28.0, 29.0]  # 0.29 * 100 is truncated
    assert cut(0.5, 0.4) == [] and cut(2.0, 3.0) == []
    assert cut(0.98, 9e12) == [98.0, 99.0]
    assert cut(-0.02, 1.0) == [98.0, 99.0]
    assert one(A.mean(c("f")), A.mean_or_zero(c("f")), f=[]) == (None, 0.0)
    assert one(A.mean(c("f")), f=[1.0, 2.0]) == 1.5


def test_baseline_and_trim(one):
    base = A.speaker_baseline(c("f"))
    assert one(base, f=[200.0, 0.0, 200.0, 200.0, 200.0]) is None
    assert tuple(one(base, f=[200.0] * 5)) == (200.0, 10.0)
    mean, std = one(base, f=[0.0, 100.0, 200.0, 150.0, 120.0, 180.0])
    assert mean == pytest.approx(150.0) and std == pytest.approx(np.std([100, 200, 150, 120, 180], ddof=1))
    frames = [0.0, 0.0, 0.5, 0.6, 0.0, 0.0]
    trim = lambda s, e, f=frames: tuple(one(A.trim_silence(c("f"), F.lit(s), F.lit(e), F.lit(16000), F.lit(160)), f=f))
    assert trim(0.0, 0.06) == pytest.approx((0.02, 0.03))
    assert trim(0.0, 0.02) == pytest.approx((0.0, 0.02))  # nothing loud
    assert trim(5.0, 6.0) == pytest.approx((5.0, 6.0))  # no frames
    assert one(A.percentile_10(c("f")), f=[1.0, 2.0, 4.0]) == pytest.approx(1.2)
    assert one(A.percentile_10(c("f")), f=[]) is None


@pytest.mark.parametrize("sr, hop, n30, n20", [(8000, 80, 256, 128), (16000, 160, 512, 256), (22050, 220, 512, 512), (44100, 441, 1024, 1024), (48000, 480, 1024, 1024)])
def test_frame_parameters(one, sr, hop, n30, n20):
    assert S.frame_params(sr) == (n30, hop) and S.frame_params(sr, 20) == (n20, hop)
    assert one(A.hop_length(c("sr")), A.fft_length(c("sr"), 30), A.fft_length(c("sr"), 20), sr=sr) == (hop, n30, n20)


def tone(hz, amplitude=0.5, seconds=2.0, sr=16000):
    return amplitude * np.sin(2 * np.pi * hz * np.arange(int(seconds * sr)) / sr)


def test_energy_follows_amplitude_and_ear():
    n, hop = S.frame_params(16000)
    mid = lambda y: np.median(S.perceptual_energy(y, 16000, n, hop))
    assert mid(tone(1000, 0.5)) / mid(tone(1000, 0.25)) == pytest.approx(2.0, rel=1e-6)
    assert mid(tone(100)) < 0.05 * mid(tone(1000))
    assert S.a_weighting_db(np.array([1000.0]))[0] == pytest.approx(0.0, abs=0.01)
    assert S.a_weighting_db(np.array([100.0]))[0] == pytest.approx(-19.1, abs=0.2)
    assert len(S.perceptual_energy(np.zeros(0), 16000, n, hop)) <= 1


def test_loudness():
    full = S.loudness(tone(997, 1.0, 5.0, 48000), 48000)
    assert full == pytest.approx(-3.01, abs=0.05)  # a full-scale sine near 1 kHz
    assert S.loudness(tone(997, 0.1, 5.0, 48000), 48000) == pytest.approx(full - 20, abs=0.05)
    assert S.loudness(tone(997, 1.0, 0.399, 48000), 48000) is None
    assert S.loudness(np.zeros(48000), 48000) is None
    assert S.segment_loudness(tone(997, 1.0, 5.0, 48000), 48000, 1.0, 1.2) is None


def test_resampling_keeps_a_tone():
    y = S.resample(tone(440, sr=8000), 8000, 16000)
    assert len(y) == 32000 and np.allclose(y[4000:-4000], tone(440)[4000:-4000], atol=1e-3)
