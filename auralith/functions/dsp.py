"""Signal processing on NumPy arrays: filters, resampling, loudness, pitch, synthesis, rooms and devices; for map_rows.

Recursive filters are applied through their impulse responses, which end where they have decayed below double precision, so that a signal is
one convolution by FFT rather than a loop over samples.
"""

from __future__ import annotations

from functools import lru_cache
from math import gcd

import numpy as np

RATE = 16_000
Section = tuple[float, float, float, float, float]  # b0, b1, b2, a1, a2 with a0 = 1


# filters


def _convolved(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The first len(x) samples of the convolution."""
    n = 1 << (len(x) + len(h) - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(x, n) * np.fft.rfft(h, n), n)[: len(x)]


@lru_cache(64)
def response(sections: tuple[Section, ...]) -> np.ndarray:
    """Impulse response of a cascade of second-order sections, up to where its poles have decayed by 300 dB."""
    radius = max(max(abs(np.roots([1.0, a1, a2]))) for *_, a1, a2 in sections)
    n = int(min(1 << 18, max(64, np.ceil(-35 / np.log(min(max(radius, 1e-6), 1 - 1e-9)))))) * (1 + len(sections) // 2)
    h = np.zeros(n)
    h[0] = 1.0
    for b0, b1, b2, a1, a2 in sections:
        out, x1, x2, y1, y2 = np.empty(n), 0.0, 0.0, 0.0, 0.0
        for i, x in enumerate(h.tolist()):
            y = b0 * x + b1 * x1 + b2 * x2 - a1 * y1 - a2 * y2
            x2, x1, y2, y1 = x1, x, y1, y
            out[i] = y
        h = out
    return h


def filtered(x: np.ndarray, sections: tuple[Section, ...]) -> np.ndarray:
    return _convolved(np.asarray(x, float), response(sections)) if len(x) else np.zeros(0)


def _normal(b: tuple[float, float, float], a: tuple[float, float, float]) -> Section:
    return b[0] / a[0], b[1] / a[0], b[2] / a[0], a[1] / a[0], a[2] / a[0]


@lru_cache(64)
def butterworth(kind: str, order: int, cutoff: float, rate: int) -> tuple[Section, ...]:
    """Sections of a low-pass ("low") or high-pass ("high") by the bilinear transform."""
    w, out = np.tan(np.pi * cutoff / rate), []
    for k in range(order // 2):
        q = 2 * np.sin(np.pi * (2 * k + 1) / (2 * order))
        b = (w * w, 2 * w * w, w * w) if kind == "low" else (1.0, -2.0, 1.0)
        out.append(_normal(b, (1 + q * w + w * w, 2 * (w * w - 1), 1 - q * w + w * w)))
    if order % 2:
        out.append(_normal((w, w, 0.0) if kind == "low" else (1.0, -1.0, 0.0), (1 + w, w - 1, 0.0)))
    return tuple(out)


@lru_cache(64)
def high_shelf(gain_db: float, f0: float, rate: int) -> tuple[Section, ...]:
    """A shelf of slope 1."""
    amp, w = 10 ** (gain_db / 40), 2 * np.pi * f0 / rate
    cos, root = np.cos(w), np.sqrt(2 * 10 ** (gain_db / 40)) * np.sin(w)
    up, down = amp + 1, amp - 1
    return (_normal((amp * (up + down * cos + root), -2 * amp * (down + up * cos), amp * (up + down * cos - root)), (up - down * cos + root, 2 * (down - up * cos), up - down * cos - root)),)


@lru_cache(64)
def peaking(centre: float, gain_db: float, q: float, rate: int) -> tuple[Section, ...]:
    amp, w = 10 ** (gain_db / 40), 2 * np.pi * centre / rate
    alpha = np.sin(w) / (2 * q)
    return (_normal((1 + alpha * amp, -2 * np.cos(w), 1 - alpha * amp), (1 + alpha / amp, -2 * np.cos(w), 1 - alpha / amp)),)


def zero_phase(x: np.ndarray, sections: tuple[Section, ...]) -> np.ndarray:
    """Forwards and backwards, with the ends mirrored through their points."""
    pad = min(len(x) - 1, len(response(sections)))
    if pad < 1:
        return filtered(x, sections)
    y = np.r_[2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]]
    return filtered(filtered(y, sections)[::-1], sections)[::-1][pad : pad + len(x)]


def resampled(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """Polyphase resampling with a Kaiser window (beta 5) of ten periods to each side."""
    g = gcd(source, target)
    up, down = target // g, source // g
    if up == down or not len(x):
        return np.asarray(x, float)
    half = 10 * max(up, down)
    taps = np.sinc(np.arange(-half, half + 1) / max(up, down)) * np.kaiser(2 * half + 1, 5.0)
    taps *= up / taps.sum()
    spread = np.zeros(len(x) * up + 2 * half)
    spread[: len(x) * up : up] = x
    return _convolved(spread, taps)[half : half + len(x) * up : down]


def wiener(x: np.ndarray, size: int = 29) -> np.ndarray:
    """Towards the local mean where the local variance is noise; noise is the mean of the local variances."""
    box = np.ones(size)
    mean = np.convolve(x, box, "same") / size
    variance = np.convolve(np.square(x), box, "same") / size - mean**2
    noise = variance.mean()
    return np.where(variance < noise, mean, mean + (x - mean) * (1 - noise / np.where(variance == 0, 1, variance)))


# Intensity -> gain in dB of a raised voice.
RAISED = {4: 2.0, 5: 3.5}


def lombard(x: np.ndarray, intensity: int) -> np.ndarray:
    """A raised voice's spectrum at the two highest intensities."""
    gain = RAISED.get(intensity)
    return filtered(x, high_shelf(gain, 2500.0, RATE)) if gain else x


# levels


def rms(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(np.asarray(x, float))))) if len(x) else 0.0


def speech_rms(x: np.ndarray, rate: int = RATE) -> float:
    """Over the frames of 20 ms from the median level on."""
    n = rate // 50
    if len(x) < n:
        return rms(x)
    levels = np.sqrt(np.mean(np.square(x[: len(x) // n * n].reshape(-1, n)), 1))
    return float(np.sqrt(np.mean(np.square(levels[levels >= np.median(levels)]))))


def snr_db(speech: np.ndarray, noise: np.ndarray) -> float:
    """D15."""
    s, n = speech_rms(speech), rms(noise)
    return float("-inf") if s == 0 else float("inf") if n == 0 else float(20 * np.log10(s / n))


def rms_gain(x: np.ndarray, target_dbfs: float) -> np.ndarray:
    """Near silence stays."""
    level = rms(x)
    return x if level < 1e-4 else x * (10 ** (target_dbfs / 20) / level)


def to_peak(x: np.ndarray, target_dbfs: float) -> np.ndarray:
    peak = float(np.max(np.abs(x))) if len(x) else 0.0
    return x if peak < 1e-4 else x * (10 ** (target_dbfs / 20) / peak)


def peak_limited(x: np.ndarray, ceiling_dbfs: float = -1.0) -> np.ndarray:
    peak = float(np.max(np.abs(x))) if len(x) else 0.0
    return x * min(1.0, 10 ** (ceiling_dbfs / 20) / peak) if peak else x


def matched(degraded: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, bool]:
    """At the level of the clean signal, with a peak of 0.99 at most; whether that had to be enforced."""
    out = degraded * (rms(clean) / (rms(degraded) + 1e-12))
    peak = float(np.max(np.abs(out)))
    return (out * (0.99 / peak), True) if peak > 0.99 else (out, False)


def loudness(x: np.ndarray, rate: int) -> float | None:
    """Integrated loudness with both gates, over blocks of 400 ms that overlap by three quarters; None below a block or for silence."""
    block, hop = int(0.4 * rate), int(0.1 * rate)
    if len(x) < block:
        return None
    gain, wide, high = 10 ** (4.0 / 40), 2 * np.pi * 1500.0 / rate, 2 * np.pi * 38.0 / rate
    alpha, root = np.sin(wide) / np.sqrt(2.0), 2 * np.sqrt(gain)
    shelf = _normal((gain * (gain + 1 + (gain - 1) * np.cos(wide) + root * alpha), -2 * gain * (gain - 1 + (gain + 1) * np.cos(wide)), gain * (gain + 1 + (gain - 1) * np.cos(wide) - root * alpha)),
                    (gain + 1 - (gain - 1) * np.cos(wide) + root * alpha, 2 * (gain - 1 - (gain + 1) * np.cos(wide)), gain + 1 - (gain - 1) * np.cos(wide) - root * alpha))
    slope = np.sin(high)
    cut = _normal(((1 + np.cos(high)) / 2, -(1 + np.cos(high)), (1 + np.cos(high)) / 2), (1 + slope, -2 * np.cos(high), 1 - slope))
    y = np.cumsum(np.r_[0.0, np.square(filtered(x, (shelf, cut)))])
    starts = np.arange(0, len(x) - block + 1, hop)
    power = (y[starts + block] - y[starts]) / block
    with np.errstate(divide="ignore"):
        level = -0.691 + 10 * np.log10(power)
    loud = power[level >= -70]
    if not len(loud):
        return None
    limit = -0.691 + 10 * np.log10(loud.mean()) - 10
    loud = power[(level >= -70) & (level > limit)]
    return float(-0.691 + 10 * np.log10(loud.mean())) if len(loud) else None


# measures of turns


def pitches(x: np.ndarray, rate: int) -> np.ndarray:
    """Pitch in Hz (50 to 500) of the voiced frames of 30 ms, by autocorrelation."""
    size, hop, short, long = int(0.030 * rate), int(0.010 * rate), rate // 500, rate // 50
    if len(x) < size or long >= size:
        return np.zeros(0)
    frames = np.lib.stride_tricks.sliding_window_view(np.asarray(x, float), size)[::hop]
    frames = frames[np.sqrt(np.mean(np.square(frames), 1)) >= 0.01]
    n = 1 << (2 * size - 1).bit_length()
    spectrum = np.fft.rfft(frames, n)
    corr = np.fft.irfft(spectrum * spectrum.conj(), n)[:, :size]
    at = corr[:, short : long + 1].argmax(1) + short
    voiced = corr[np.arange(len(at)), at] > 0.3 * corr[:, 0]
    return rate / at[voiced]


def measured(x: np.ndarray, rate: int, onset: float, offset: float) -> tuple[float | None, float | None, float, float | None]:
    """Median pitch, its deviation, level in dBFS and loudness of a segment; (None, None, -96, None) below 50 ms."""
    part = np.asarray(x, float)[max(0, int(onset * rate)) : max(0, min(len(x), int(offset * rate)))]
    if len(part) < int(rate * 0.05):
        return None, None, -96.0, None
    f0 = pitches(part, rate)
    voiced = (float(np.median(f0)), float(np.std(f0))) if len(f0) else (None, None)
    return *voiced, float(20 * np.log10(max(rms(part), 1e-9))), loudness(part, rate)


def longest_voiced(x: np.ndarray, rate: int) -> float:
    """Seconds of the longest run of frames (20 ms every 10 ms) above -40 dBFS."""
    size, hop = int(0.020 * rate), int(0.010 * rate)
    if len(x) < size:
        return 0.0
    power = np.cumsum(np.r_[0.0, np.square(np.asarray(x, float))])
    starts = np.arange(0, len(x) - size + 1, hop)
    edges = np.flatnonzero(np.diff(np.r_[0, ((power[starts + size] - power[starts]) / size > 1e-4).astype(int), 0]))
    most = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
    return (size + (most - 1) * hop) / rate if most else 0.0


def steps(x: np.ndarray, rate: int, window_ms: int = 40) -> np.ndarray:
    """At each sample the difference of the means of the windows after and before it, silence beyond the ends."""
    w = max(1, window_ms * rate // 1000)
    sums = np.cumsum(np.r_[np.zeros(w + 1), np.asarray(x, float), np.zeros(w)])
    i = np.arange(len(x))
    return np.abs((sums[i + 1 + 2 * w] - sums[i + 1 + w]) - (sums[i + w] - sums[i])) / w


def suppressed(step: np.ndarray, height: float, distance: int) -> np.ndarray:
    """The peaks of at least that height, the highest first, none nearer than the distance to one that is taken; of a plateau its middle."""
    padded = np.r_[0.0, step, 0.0]
    change = np.flatnonzero(np.diff(padded)) + 1
    starts, ends = change, np.r_[change[1:], len(padded)]
    rises = padded[starts] > padded[starts - 1]
    falls = np.r_[padded[starts[1:]] < padded[starts[:-1]], False] if len(starts) else rises
    top = rises & falls & (padded[starts] >= height)
    at = (starts[top] + ends[top] - 1) // 2 - 1
    kept = np.ones(len(at), bool)
    for i in np.argsort(step[at], kind="stable")[::-1]:
        if kept[i]:
            near = np.abs(at - at[i]) < distance
            near[i] = False
            kept &= ~near
    return at[kept]


def gate(x: np.ndarray, rate: int, gender: str) -> tuple[bool, str | None]:
    """Whether a turn passes, and the first gate that it fails."""
    if longest_voiced(x, rate) > 2.8:
        return False, "sustained_vowel"
    f0 = pitches(x, rate)
    low, high = (80.0, 180.0) if gender == "male" else (150.0, 290.0)
    if len(f0) >= 5 and not low <= float(np.median(f0)) <= high:
        return False, "f0_guardrails"
    w = max(1, 40 * rate // 1000)
    return (False, "click_detection") if len(x) and len(suppressed(steps(x, rate), 0.08, w)) >= 3 else (True, None)


def speech_end(x: np.ndarray) -> int:
    """The end of the last frame of 160 samples, counted from the end, within 40 dB of the loudest; 0 for silence."""
    n = len(x) // 160
    if n == 0:
        return len(x) if rms(x) > 0 else 0
    levels = np.sqrt(np.mean(np.square(np.asarray(x[len(x) - n * 160 :], float).reshape(n, 160)), 1))
    return 0 if levels.max() <= 0 else len(x) - n * 160 + (int(np.flatnonzero(levels >= levels.max() / 100)[-1]) + 1) * 160


# synthesis


def pink(n: int, rng: np.random.Generator) -> np.ndarray:
    """D17."""
    spectrum, f = np.fft.rfft(rng.standard_normal(n)), np.fft.rfftfreq(n)
    f[0] = 1.0
    return np.fft.irfft(spectrum / np.sqrt(f), n)


def ambient(kind: str, seconds: float, rate: int, rng: np.random.Generator) -> np.ndarray:
    """Hum, a ringing telephone, or band-limited pink noise."""
    n = int(seconds * rate)
    t = np.arange(n) / rate
    if not n:
        return t
    if kind == "hvac_hum":
        return sum(a * np.sin(2 * np.pi * f * t) for f, a in ((100, 0.5), (120, 0.3), (200, 0.2))) + 0.05 * rng.standard_normal(n)
    if kind == "distant_phone_ring":
        return 0.3 * np.where(t % 6 < 2, np.sin(2 * np.pi * 480 * t) + np.sin(2 * np.pi * 620 * t), 0.0)
    return filtered(filtered(pink(n, rng), butterworth("high", 4, 300.0, rate)), butterworth("low", 4, 4000.0, rate))


# Shortest and longest burst in seconds.
BURSTS = {"ACOU_BREAK": (0.4, 0.8), "ACOU_SLAM": (0.15, 0.35), "ACOU_THROW": (0.2, 0.5), "ACOU_FALL": (0.5, 1.2)}


def burst(kind: str, rate: int, rng: np.random.Generator) -> np.ndarray:
    """Steps, or decaying noise."""
    if kind == "ACOU_FOOT":
        step, gap = int(0.03 * rate), int(rng.uniform(0.08, 0.15) * rate)
        one = lambda: np.r_[rng.standard_normal(step) * np.exp(-np.linspace(0, 8, step)), np.zeros(gap)]
        return np.concatenate([one() for _ in range(int(rng.integers(3, 6)))])
    n = int(rng.uniform(*BURSTS.get(kind, (0.3, 0.6))) * rate)
    out = rng.standard_normal(n) * np.exp(-rng.uniform(5.0, 12.0) * np.linspace(0, 1, n))
    rise = min(int(0.005 * rate), n)
    out[:rise] *= np.linspace(0, 1, rise)
    return out


def fitted(x: np.ndarray, n: int) -> np.ndarray:
    """Repeated or cut to n samples."""
    return np.resize(x, n) if len(x) else np.zeros(n)


def onset(event: dict, seconds: float, phases: dict[str, float] | None, shares: dict[str, float]) -> float:
    """The given onset, else that of the phase (of the clip's phases or by the phase's share), else 0; with its offset, inside the clip."""
    base, phase = event.get("onset_seconds"), event.get("onset_at_phase")
    if base is None:
        base = 0.0 if phase is None else phases[phase] if phases and phase in phases else shares.get(phase, 0.5) * seconds
    return max(0.0, min(base + (event.get("onset_offset_seconds") or 0.0), seconds - 0.1))


def mixed_noise(x: np.ndarray, rate: int, events: list[dict], snr_target: float, seed: int, phases: dict[str, float] | None, shares: dict[str, float]) -> tuple[np.ndarray, list[dict], float]:
    """The signal with looped sounds at the wanted signal-to-noise ratio and single ones at their onsets; what was placed; the ratio measured."""
    rng, seconds, out, log = np.random.default_rng(seed), len(x) / rate, np.array(x, float), []
    dbfs = lambda y: float(20 * np.log10(np.abs(y).max())) if len(y) and np.abs(y).max() > 0 else float("-inf")
    loops = [e for e in events if e.get("loop")]
    if loops:
        bed = sum(fitted(ambient(e["type"], seconds, rate, rng), len(x)) for e in loops)
        if speech_rms(x, rate) > 0 and rms(bed) > 0:
            bed = bed * (speech_rms(x, rate) / 10 ** (snr_target / 20) / rms(bed))
        out += bed
        log += [{"type": e["type"], "onset": 0.0, "offset": seconds, "level_db": dbfs(bed)} for e in loops]
    for e in events:
        if e.get("loop"):
            continue
        at, sound = onset(e, seconds, phases, shares), burst(e["type"], rate, rng)
        first = int(at * rate)
        sound = sound[: max(0, len(x) - first)]
        if not len(sound):
            continue
        if e.get("level_db") is not None:
            sound = sound * (10 ** (e["level_db"] / 20) / (np.abs(sound).max() + 1e-9))
        out[first : first + len(sound)] += sound
        log.append({"type": e["type"], "onset": at, "offset": at + len(sound) / rate, "level_db": e["level_db"] if e.get("level_db") is not None else dbfs(sound)})
    return out, log, snr_db(np.asarray(x, float), out - x)


# Room -> smallest and largest width, length, height; reverberation times.
ROOMS = {
    "small_bedroom": ((2.5, 2.5, 2.3), (3.5, 3.5, 2.7), (0.20, 0.40)), "apartment_kitchen": ((2.5, 2.0, 2.3), (4.0, 3.5, 2.7), (0.15, 0.35)),
    "living_room": ((4.0, 3.5, 2.4), (6.5, 5.5, 3.0), (0.30, 0.60)), "clinic_office": ((3.0, 2.5, 2.4), (5.0, 4.0, 3.0), (0.20, 0.40)),
    "welfare_office": ((3.5, 3.0, 2.4), (6.0, 5.0, 3.0), (0.25, 0.50)), "open_office_corridor": ((6.0, 2.5, 2.4), (12.0, 4.0, 3.5), (0.30, 0.70)),
}


def in_room(x: np.ndarray, rate: int, room: str, distance: float, seed: int) -> np.ndarray:
    """The signal in a box-shaped room by image sources up to order 12, walls by Sabine's formula; size, time and direction are drawn. As long as the input."""
    rng = np.random.default_rng(seed)
    low, high, times = ROOMS[room]
    dims = np.array([rng.uniform(a, b) for a, b in zip(low, high, strict=True)])
    t60 = rng.uniform(*times)
    surface = 2 * (dims[0] * dims[1] + dims[0] * dims[2] + dims[1] * dims[2])
    reflection = np.sqrt(1 - min(0.99, 24 * np.log(10) / 343.0 * dims.prod() / (surface * t60)))
    mic = np.array([dims[0] / 2, dims[1] / 2, np.clip(1.2, 0.1, dims[2] - 0.1)])
    angle, reach = rng.uniform(0, 2 * np.pi), min(distance, 0.85 * min(dims[:2]))
    source = np.clip([mic[0] + reach * np.cos(angle), mic[1] + reach * np.sin(angle), 1.6], 0.1, dims - 0.1)
    order = int(min(12, np.ceil(343.0 * t60 / dims.min() - 1)))
    k = np.arange(-order, order + 1)
    grid = np.stack(np.meshgrid(k, k, k, indexing="ij"), -1).reshape(-1, 3)
    grid = grid[np.abs(grid).sum(1) <= order]
    images = np.where(grid % 2 == 0, grid * dims + source, (grid + 1) * dims - source)
    far = np.linalg.norm(images - mic, axis=1)
    at = np.rint(far / 343.0 * rate).astype(int)
    h = np.bincount(at, reflection ** np.abs(grid).sum(1) / (4 * np.pi * np.maximum(far, 0.1)))
    return _convolved(np.asarray(x, float), h)


# Device -> high-pass, low-pass, peak (Hz, dB, Q), further low-pass, hum (Hz, dBFS), level in dB.
DEVICE_COLOURS = {
    "phone_in_hand": (200, 8000, (3000, 3.0, 1.5), 6500, None, 0.0), "phone_in_pocket": (300, 2500, None, None, None, -6.0),
    "phone_on_table": (100, 7000, (2800, 2.0, 1.5), 6500, None, -3.0), "pi_budget_mic": (80, 7000, None, None, (50.0, -50.0), 0.0),
}


def through_device(x: np.ndarray, rate: int, device: str) -> np.ndarray:
    """Filters, hum and level of a device."""
    high, low, peak, further, hum, level = DEVICE_COLOURS[device]
    sections = butterworth("high", 4, high, rate) + (butterworth("low", 4, low, rate) if low < rate / 2 else ()) + (peaking(*peak, rate) if peak else ()) + (butterworth("low", 2, further, rate) if further and further < rate / 2 else ())
    out = filtered(x, sections)
    if hum:
        out = out + 10 ** (hum[1] / 20) * np.sin(2 * np.pi * hum[0] * np.arange(len(out)) / rate)
    return out * 10 ** (level / 20)


def augmented(x: np.ndarray, rate: int, scene: dict, seed: int, shares: dict[str, float], phases: dict[str, float] | None = None) -> tuple[np.ndarray, list[dict], float]:
    """Room, device and noise, each with a seed of its own from the seed."""
    room, _, noise = (int(s) for s in np.random.default_rng(seed).integers(0, 2**31, 3))
    y = through_device(in_room(x, rate, scene["room_type"], scene["speaker_distance_meters"], room), rate, scene["device"])
    return mixed_noise(y, rate, scene.get("background_events") or [], scene.get("snr_target_db", 20.0), noise, phases, shares)


def restored(x: np.ndarray, n: int, pad: int) -> np.ndarray:
    """Cut or padded to n samples, with silent ends."""
    out = np.zeros(n)
    out[: min(n, len(x))] = x[:n]
    if pad:
        out[:pad], out[-pad:] = 0.0, 0.0
    return out


def breathy(x: np.ndarray, rate: int, level: float, seed: int = 0) -> np.ndarray:
    """Noise of 3 to 7.5 kHz up to a quarter of the signal's level."""
    if not 0 <= level <= 1 or rate <= 15_000:
        raise ValueError("level must be 0 to 1 and the rate above 15 kHz")
    if not level or rms(x) < 1e-10:
        return np.array(x, float)
    noise = filtered(np.random.default_rng(seed).standard_normal(len(x)), butterworth("high", 4, 3000.0, rate) + butterworth("low", 4, 7500.0, rate))
    return x + noise * (0.25 * level * rms(x) / rms(noise))


def degraded(x: np.ndarray, rate: int, kind: str, amount: float, seed: int = 0) -> np.ndarray:
    """White noise at a signal-to-noise ratio, a low-pass, or slower speech cut to length."""
    if kind == "white_noise":
        return x + np.random.default_rng(seed).standard_normal(len(x)) * np.sqrt((np.mean(np.square(x)) + 1e-12) / 10 ** (amount / 10))
    if kind == "lowpass":
        return zero_phase(np.asarray(x, float), butterworth("low", 8, amount, rate))
    if kind == "slow_rate":
        n = int(round(len(x) / amount))
        spectrum = np.fft.rfft(x)
        longer = np.zeros(n // 2 + 1, complex)
        longer[: min(len(spectrum), len(longer))] = spectrum[: len(longer)]
        return np.fft.irfft(longer, n)[: len(x)] * (n / len(x))
    raise ValueError(f"unknown degradation {kind}")


def preprocessed(channels: np.ndarray, source: int, target_dbfs: float = -2.0, denoise: bool = False) -> tuple[np.ndarray, list[str]]:
    """Samples at 16 kHz and the steps taken: resample, downmix, high-pass, denoise, peak to target, limit, half a second of silence at both ends."""
    taken = []
    if source != RATE:
        channels = np.stack([resampled(c, source, RATE) for c in channels])
        taken.append(f"resample_{source}_to_{RATE}")
    x = channels.mean(0)
    taken += ["downmix_to_mono"] if len(channels) > 1 else []
    x = filtered(x, butterworth("high", 2, 80.0, RATE))
    taken.append("highpass_80Hz_order2")
    if denoise:
        x, taken = wiener(x), [*taken, "wiener_denoise"]
    x = peak_limited(to_peak(x, target_dbfs))
    pad = np.zeros(RATE // 2)
    return np.r_[pad, x, pad], [*taken, "peak_normalize", "peak_limit", "silence_pad"]
