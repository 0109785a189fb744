"""Signal kernels in numpy, from published definitions: STFT energy with A-weighting, gated loudness, resampling."""

from __future__ import annotations

import io
import wave

import numpy as np


def frame_params(sr: int, frame_ms: int = 30, hop_ms: int = 10) -> tuple[int, int]:
    """``(n_fft, hop)`` in samples."""
    return 2 ** int(np.log2(int(frame_ms * sr / 1000)) + 0.5), max(1, int(hop_ms * sr / 1000))


def a_weighting_db(freqs: np.ndarray, floor_db: float = -80.0) -> np.ndarray:
    """A-curve of IEC 61672 in dB, 0 at 1 kHz, not below ``floor_db``."""
    f2 = np.asarray(freqs, dtype=float) ** 2
    # The curve's pole frequencies in Hz.
    p1, p2, p3, p4 = (x * x for x in (20.598997, 107.65265, 737.86223, 12194.217))
    with np.errstate(divide="ignore"):
        gain = 2.0 + 20 * (np.log10(p4) + 2 * np.log10(f2) - np.log10(f2 + p1) - np.log10(f2 + p4) - 0.5 * np.log10(f2 + p2) - 0.5 * np.log10(f2 + p3))
    return np.maximum(gain, floor_db)


def perceptual_energy(y: np.ndarray, sr: int, n_fft: int, hop: int) -> np.ndarray:
    """Energy per frame: magnitudes times the A-curve as a power factor, root of the sum of squares over ``n_fft``.

    Frames are centred, padded with zeros, under a periodic Hann window.  Blocks of frames bound the memory.
    """
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    weight = 10.0 ** (a_weighting_db(np.fft.rfftfreq(n_fft, 1 / sr) + 1e-8) / 10.0)
    padded = np.concatenate([np.zeros(n_fft // 2), np.asarray(y, dtype=float), np.zeros(n_fft // 2)])
    if len(padded) < n_fft:
        return np.zeros(0)
    frames = np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop]
    out = np.empty(len(frames))
    for at in range(0, len(frames), 1024):
        spectrum = np.abs(np.fft.rfft(frames[at : at + 1024] * window, axis=1)) * weight
        out[at : at + 1024] = np.sqrt((spectrum**2).sum(axis=1)) / n_fft
    return out


def _biquad(x: np.ndarray, b: tuple, a: tuple) -> np.ndarray:
    """Second-order filter through its impulse response (overlap of FFT blocks), long enough to have died out."""
    n = 8192
    h = np.zeros(n)
    x1 = x2 = y1 = y2 = 0.0
    for i in range(n):
        xi = 1.0 if i == 0 else 0.0
        h[i] = b[0] * xi + b[1] * x1 + b[2] * x2 - a[1] * y1 - a[2] * y2
        x2, x1, y2, y1 = x1, xi, y1, h[i]
    size = 1 << int(np.ceil(np.log2(len(x) + n)))
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[: len(x)]


def _k_weighting(sr: int) -> list[tuple[tuple, tuple]]:
    """Shelf and high-pass of ITU-R BS.1770, designed for the sample rate."""
    out = []
    # Fixed values of the recommendation: gain in dB, quality, corner in Hz.
    gain, q, f = 3.999843853973347, 0.7071752369554196, 1681.974450955533
    k, vh = np.tan(np.pi * f / sr), 10 ** (gain / 20)
    vb = vh**0.4996667741545416
    a0 = 1 + k / q + k * k
    out.append((((vh + vb * k / q + k * k) / a0, 2 * (k * k - vh) / a0, (vh - vb * k / q + k * k) / a0), (1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)))
    q, f = 0.5003270373238773, 38.13547087602444
    k = np.tan(np.pi * f / sr)
    a0 = 1 + k / q + k * k
    out.append(((1.0, -2.0, 1.0), (1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)))
    return out


def loudness(y: np.ndarray, sr: int, block_s: float = 0.4) -> float | None:
    """Gated loudness (LUFS) of a mono signal by ITU-R BS.1770; null under one block or where it is not finite."""
    if len(y) / sr < block_s:
        return None
    for b, a in _k_weighting(sr):
        y = _biquad(np.asarray(y, dtype=float), b, a)
    size, step = int(block_s * sr), int(block_s * sr / 4)
    power = np.array([np.mean(y[i : i + size] ** 2) for i in range(0, len(y) - size + 1, step)])
    with np.errstate(divide="ignore"):
        level = -0.691 + 10 * np.log10(power)
    power = power[level > -70.0]
    if not len(power):
        return None
    gate = -0.691 + 10 * np.log10(power.mean()) - 10.0
    kept = power[-0.691 + 10 * np.log10(power) > gate]
    value = -0.691 + 10 * np.log10(kept.mean()) if len(kept) else float("nan")
    return float(value) if np.isfinite(value) else None


def segment_loudness(y: np.ndarray, sr: int, start: float, end: float) -> float | None:
    return loudness(y[int(start * sr) : int(end * sr)], sr)


def resample(y: np.ndarray, sr: int, to: int) -> np.ndarray:
    """Band-limited resampling in the frequency domain."""
    if sr == to or not len(y):
        return np.asarray(y, dtype=float)
    n = int(round(len(y) * to / sr))
    spectrum = np.fft.rfft(np.asarray(y, dtype=float))
    keep = min(len(spectrum), n // 2 + 1)
    out = np.zeros(n // 2 + 1, dtype=complex)
    out[:keep] = spectrum[:keep]
    return np.fft.irfft(out, n) * (n / len(y))


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in -1..1 at their own rate, from PCM of 8, 16, 24 or 32 bits; channels are averaged."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, sr, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16)) << 8 >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(float) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(axis=1), sr
