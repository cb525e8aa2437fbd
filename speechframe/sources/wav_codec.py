"""PCM WAV bytes and samples."""

import io
import wave

import numpy as np


def decode(content: bytes):
    """(samples, rate) of PCM WAV bytes of 8, 16, 24 or 32 bits; channels are averaged per frame."""
    with wave.open(io.BytesIO(content)) as sound:
        width, rate, channels = sound.getsampwidth(), sound.getframerate(), sound.getnchannels()
        raw = sound.readframes(sound.getnframes())
    if width == 1:
        samples = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128.0) / 128.0
    elif width == 3:
        # three bytes become the upper ones of four
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        samples = wide.view("<i4").ravel().astype(np.float64) / float(1 << 31)
    else:
        samples = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float64) / float(1 << (8 * width - 1))
    if channels > 1:
        samples = samples.reshape(-1, channels).mean(axis=1)
    return samples.astype(np.float32), rate


def encode(samples, rate: int) -> bytes:
    """16-bit PCM WAV bytes."""
    if samples is None:
        raise ValueError("no audio")
    pcm = np.clip(np.rint(np.asarray(samples, np.float64) * 32768.0), -32768, 32767).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as sound:
        sound.setnchannels(1)
        sound.setsampwidth(2)
        sound.setframerate(int(rate))
        sound.writeframes(pcm.tobytes())
    return out.getvalue()
