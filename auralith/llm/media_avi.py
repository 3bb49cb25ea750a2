"""Media columns: AVI motion JPEG.

The writer stores bytes as the 8-bit samples of lossless JPEG frames (left prediction, Huffman codes) in an AVI file with an index. The
reader parses the RIFF chunks and the index, decodes each intra frame on its own (lossless, or the luminance of baseline JPEG),
and cuts shots where the difference of neighbouring histograms stands out from the differences of the shot so far. Shots are
timed clip rows.

Code tables in which code and magnitude bits always add up to one width, as the writer's do, are decoded by array operations; others bit by bit.

Frames are found by the OpenDML index of the video stream (of one or several RIFF parts), else by the old index, else by the chunks in order.
Frames without Huffman tables, as usual in AVI, are read with the standard ones.

Cases: null and empty payloads are stored as one block of zero bytes; equal payloads give equal files; data that are no AVI file or hold a frame that can't be
read have no clips and an error text (null media: neither); a file without frames has no clips; repeated rows are read alike; an empty table gives an empty
result; other columns pass through, but for those with the names of the results.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import map_texts, map_values

UNIT, WIDTH, HEIGHT, RATE = 64, 32, 32, 25
#: Histogram bins, the differences that the threshold looks back on, its deviations, and its least value.
BINS, BACK, DEVIATIONS, LEAST = 16, 12, 3.0, 0.25
#: Code lengths of the categories 0 to 8: with its extra bits, each difference takes 9 bits.
LENGTHS = [9 - k for k in range(9)]
#: Order of a block's coefficients in the stream.
ZIGZAG = sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8)))


# The standard Huffman tables: how many codes of 1, 2 ... 16 bits, and the first symbols in the order of their codes; the others follow by size.
STANDARD = {
    0x00: ("0 1 5 1 1 1 1 1 1", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x01: ("0 3 1 1 1 1 1 1 1 1 1", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x10: ("0 2 1 3 3 2 4 3 5 5 4 4 0 0 1 125", "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"),
    0x11: ("0 2 1 2 4 4 3 4 7 5 4 4 0 1 2 119", "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
}


@lru_cache(1)
def _standard() -> dict[int, dict[int, int]]:
    """Table -> symbol -> code length."""
    out = {}
    for name, (counts, first) in STANDARD.items():
        head = [int(x, 16) for x in first.split()]
        rest = sorted({run << 4 | size for run in range(16) for size in range(1, 11)} - set(head)) if name & 16 else []
        out[name] = dict(zip(head + rest, [k for k, c in enumerate(map(int, counts.split()), 1) for _ in range(c)], strict=True))
    return out


def codes(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length), canonical in the order of length, then of the given symbols."""
    out, code, last = {}, 0, 0
    for symbol, length in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= length - last
        out[symbol] = (code, length)
        code, last = code + 1, length
    return out


@lru_cache(1)
def _differences() -> np.ndarray:
    """9-bit word of each difference from -255 to 255."""
    table, out = codes(dict(enumerate(LENGTHS))), np.zeros(511, np.uint16)
    for d in range(-255, 256):
        k = abs(d).bit_length()
        out[d + 255] = (table[k][0] << k) | ((d if d > 0 else d + (1 << k) - 1) if k else 0)
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(64)
def _head(width: int, height: int) -> bytes:
    symbols = sorted(range(9), key=lambda k: LENGTHS[k])
    counts = bytes(sum(n == length for n in LENGTHS) for length in range(1, 17))
    return b"\xff\xd8" + _segment(0xC4, b"\0" + counts + bytes(symbols)) + _segment(0xC3, struct.pack(">BHHB3B", 8, height, width, 1, 1, 0x11, 0)) + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """Lossless JPEG files of frames x height x width samples."""
    n, h, w = samples.shape
    x = samples.astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    words = _differences()[d.reshape(n, h * w // 8, 8) + 255]
    packed = np.zeros((n, h * w // 8, 9), np.uint8)
    for i in range(9):  # 8 words of 9 bits are 9 bytes
        if i:
            packed[:, :, i] |= (words[:, :, i - 1] << (8 - i)).astype(np.uint8)
        if i < 8:
            packed[:, :, i] |= (words[:, :, i] >> (i + 1)).astype(np.uint8)
    head = _head(w, h)
    return [head + p.tobytes().replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for p in packed]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(payload: bytes) -> bytes:
    """An AVI file whose frames hold the payload (a positive multiple of 64 bytes); the last frame may be lower than the others."""
    data, full = np.frombuffer(payload, np.uint8), WIDTH * HEIGHT
    whole = len(data) // full * full
    frames = encode_frames(data[:whole].reshape(-1, HEIGHT, WIDTH)) if whole else []
    if whole < len(data):
        frames += encode_frames(data[whole:].reshape(1, -1, WIDTH))
    most = max(map(len, frames))
    main = struct.pack("<14I", 1_000_000 // RATE, most * RATE, 0, 0x10, len(frames), 0, 1, most, WIDTH, HEIGHT, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4H", 0, 0, 0, 0, 1, RATE, 0, len(frames), most, -1, 0, 0, 0, WIDTH, HEIGHT)
    shape = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 24, b"MJPG", WIDTH * HEIGHT * 3, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", shape)))
    index, at = [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += 8 + len(f) + len(f) % 2
    return _chunk(b"RIFF", b"AVI " + header + _chunk(b"LIST", b"movi" + b"".join(_chunk(b"00dc", f) for f in frames)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Name, start and length of each chunk's body."""
    while at + 8 <= end:
        name, n = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        yield name, at + 8, min(n, end - at - 8)
        at += 8 + n + n % 2


def _open_index(data: bytes, at: int) -> list[bytes]:
    """The frames of an OpenDML index: of an index of indexes, those of each."""
    words, kind, n = int.from_bytes(data[at : at + 2], "little"), data[at + 3], int.from_bytes(data[at + 4 : at + 8], "little")
    if kind == 0 and words == 4:
        entries = [int.from_bytes(data[e : e + 8], "little") for e in range(at + 24, at + 24 + 16 * n, 16)]
        return [f for e in entries for f in _open_index(data, e + 8)]
    base = int.from_bytes(data[at + 12 : at + 20], "little")
    entries = np.frombuffer(data, "<u4", 2 * n, at + 24).reshape(-1, 2).tolist()
    return [data[base + o : base + o + (k & 0x7FFFFFFF)] for o, k in entries if k & 0x7FFFFFFF]


def _movie(data: bytes, at: int, end: int) -> Iterator[bytes]:
    """The frames of a movi list in order, those inside its records too."""
    for name, s, k in _chunks(data, at, end):
        if name == b"LIST":
            yield from _movie(data, s + 4, s + k)
        elif name[2:] in (b"dc", b"db") and k:
            yield data[s : s + k]


def read_avi(data: bytes) -> tuple[float, list[bytes]]:
    """Frames a second, and the JPEG data of the frames by the file's index (by the chunks in order without one)."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    rate, movies, index, wide = 0.0, [], None, None
    for _, start, size in _chunks(data, 0, len(data)):  # RIFF parts
        for name, at, n in _chunks(data, start + 4, start + size):
            kind = data[at : at + 4]
            if name == b"LIST" and kind == b"hdrl":
                for sub, s, k in _chunks(data, at + 4, at + n):
                    if sub == b"avih":
                        period = int.from_bytes(data[s : s + 4], "little")
                        rate = 1e6 / period if period else 0.0
                    elif sub == b"LIST" and data[s : s + 4] == b"strl" and wide is None:
                        parts = {p: o for p, o, _ in _chunks(data, s + 4, s + k)}
                        if b"strh" in parts and data[parts[b"strh"] : parts[b"strh"] + 4] == b"vids":
                            wide = parts.get(b"indx")
            elif name == b"LIST" and kind == b"movi":
                movies.append((at, n))
            elif name == b"idx1" and index is None:
                index = np.frombuffer(data, "<u4", n // 16 * 4, at).reshape(-1, 4)
    if not movies:
        raise ValueError("an AVI file without a movi list")
    if wide is not None and (found := _open_index(data, wide)):
        return rate, found
    if index is None:
        return rate, [f for at, n in movies for f in _movie(data, at + 4, at + n)]
    video = index[(index[:, 0] >> 16 == 0x6364) | (index[:, 0] >> 16 == 0x6264)]
    # offsets count from the list's kind or, in some files, from the start of the file
    at = movies[0][0]
    base = at if not len(video) or data[at + int(video[0, 2]) : at + int(video[0, 2]) + 4] == struct.pack("<I", int(video[0, 0])) else 0
    return rate, [data[base + o + 8 : base + o + 8 + k] for o, k in video[:, 2:].tolist() if k]


def _parse(jpeg: bytes) -> dict:
    """Frame header, tables and the scan's data without stuffed bytes."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    out, at = {"huffman": dict(_standard()), "quant": {}, "restart": 0}, 2
    while True:
        while jpeg[at + 1] == 0xFF:
            at += 1
        marker, n = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body, at = jpeg[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xC4:
            while body:
                lengths = [k for k, c in enumerate(body[1:17], 1) for _ in range(c)]
                out["huffman"][body[0]] = dict(zip(body[17 : 17 + len(lengths)], lengths, strict=True))
                body = body[17 + len(lengths) :]
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                out["quant"][body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int32)
                body = body[65 + 64 * wide :]
        elif marker in (0xC0, 0xC1, 0xC3):
            out |= {"kind": marker, "height": int.from_bytes(body[1:3], "big"), "width": int.from_bytes(body[3:5], "big"), "parts": [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(body[5])]}
        elif marker == 0xDD:
            out["restart"] = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            out["tables"] = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            out["predictor"] = body[-3]
            end = jpeg.rfind(b"\xff\xd9")
            out["scan"] = jpeg[at : end if end >= at else len(jpeg)]
            return out
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only baseline and lossless JPEG frames are read")


class _Bits:
    """Huffman symbols and magnitudes from a scan, bit by bit."""

    def __init__(self, data: bytes) -> None:
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)).tolist()
        self.at = 0

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = length = 0
        while True:
            code, length = code << 1 | self.bits[self.at], length + 1
            self.at += 1
            if (found := table.get((code, length))) is not None:
                return found
            if length > 16:
                raise ValueError("a code that no table has")

    def magnitude(self, k: int) -> int:
        value = 0
        for b in self.bits[self.at : self.at + k]:
            value = value << 1 | b
        self.at += k
        return value if not k or value >> (k - 1) else value - (1 << k) + 1


@lru_cache(8)
def _fixed(lengths: tuple[tuple[int, int], ...]) -> tuple[int, np.ndarray] | None:
    """The width that code and magnitude bits of every symbol add up to, and the difference of each word of that width."""
    if len({n + k for k, n in lengths}) != 1 or lengths[0][0] + lengths[0][1] > 16:
        return None
    width = lengths[0][0] + lengths[0][1]
    out = np.zeros(1 << width, np.int16)
    for k, (code, _) in codes(dict(lengths)).items():
        for extra in range(1 << k):
            out[code << k | extra] = extra if not k or extra >> (k - 1) else extra - (1 << k) + 1
    return width, out


def _undo(d: np.ndarray) -> np.ndarray:
    """Samples from frames of differences under left prediction."""
    d = d.astype(np.int32)
    d[:, :, 0] = 128 + np.cumsum(d[:, :, 0], 1)
    return (np.cumsum(d, 2) & 255).astype(np.uint8)


def decode_frames(jpegs: list[bytes]) -> list[np.ndarray]:
    """The 8-bit samples of each frame (height x width): of lossless frames as stored, of baseline frames the luminance."""
    out: list[np.ndarray | None] = [None] * len(jpegs)
    alike: dict[tuple, tuple[np.ndarray, int, list[int], list[bytes]]] = {}
    heads: dict[bytes, dict] = {}
    for i, jpeg in enumerate(jpegs):
        # frames of one writer share everything before their scan
        cut = jpeg.find(b"\xff\xda")
        cut += 2 + int.from_bytes(jpeg[cut + 2 : cut + 4], "big") if cut > 0 else 0
        p = heads.get(jpeg[:cut])
        if p is None:
            p = heads[jpeg[:cut]] = _parse(jpeg)
            p["cut"] = cut
        if p["kind"] == 0xC3 and p["predictor"] == 1 and len(p["parts"]) == 1 and not p["restart"]:
            lengths = tuple(p["huffman"][next(iter(p["tables"].values())) >> 4].items())
            if fixed := _fixed(lengths):
                end = -2 if jpeg[-2:] == b"\xff\xd9" else len(jpeg)
                group = alike.setdefault((p["height"], p["width"], lengths), (fixed[1], fixed[0], [], []))
                group[2].append(i)
                group[3].append(jpeg[cut:end].replace(b"\xff\x00", b"\xff"))
                continue
        p = _parse(jpeg)
        out[i] = _lossless(p) if p["kind"] == 0xC3 else _baseline(p)
    for (h, w, _), (table, width, which, scans) in alike.items():
        n = h * w
        if width == 9 and n % 8 == 0:
            b = np.frombuffer(b"".join(s[: n // 8 * 9] for s in scans), np.uint8).reshape(len(scans), n // 8, 9).astype(np.uint16)
            words = np.empty((len(scans), n // 8, 8), np.uint16)
            for k in range(8):
                words[:, :, k] = ((b[:, :, k] << (k + 1)) | (b[:, :, k + 1] >> (7 - k))) & 511
        else:
            bits = np.stack([np.unpackbits(np.frombuffer(s, np.uint8), count=n * width) for s in scans]).reshape(len(scans), n, width)
            words = bits @ (1 << np.arange(width - 1, -1, -1))
        for i, frame in zip(which, _undo(table[words].reshape(len(scans), h, w)), strict=True):
            out[i] = frame
    return out


def _table(lengths: dict[int, int]) -> dict[tuple[int, int], int]:
    return {code: symbol for symbol, code in codes(lengths).items()}


def _lossless(p: dict) -> np.ndarray:
    if p["predictor"] != 1 or len(p["parts"]) != 1 or p["restart"]:
        raise ValueError("lossless frames are read with one component, left prediction and no restarts")
    bits, table = _Bits(p["scan"]), _table(p["huffman"][next(iter(p["tables"].values())) >> 4])
    return _undo(np.array([bits.magnitude(bits.symbol(table)) for _ in range(p["height"] * p["width"])]).reshape(1, p["height"], p["width"]))[0]


_cosines = np.array([[(np.sqrt(0.125) if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for u in range(8)] for x in range(8)])


def _baseline(p: dict) -> np.ndarray:
    """Luminance of a sequential DCT frame; the other components are read over."""
    parts, h, w = p["parts"], p["height"], p["width"]
    most = max(s >> 4 for _, s, _ in parts), max(s & 15 for _, s, _ in parts)
    across, down = -(-w // (8 * most[0])), -(-h // (8 * most[1]))
    if len(parts) == 1:
        parts, across, down = [(parts[0][0], 0x11, parts[0][2])], -(-w // 8), -(-h // 8)
    first = parts[0]
    wide, high = first[1] >> 4, first[1] & 15
    blocks = np.zeros((down * high, across * wide, 64))
    pieces = iter([p["scan"]])
    if p["restart"]:
        import re

        pieces = iter(re.split(rb"\xff[\xd0-\xd7]", p["scan"]))
    tables = {k: _table(v) for k, v in p["huffman"].items()}
    bits, last = None, {}
    for unit in range(across * down):
        if bits is None or (p["restart"] and unit % p["restart"] == 0):
            bits, last = _Bits(next(pieces)), dict.fromkeys((c for c, *_ in parts), 0)
        for c, sampling, quant in parts:
            dc, ac = tables[p["tables"][c] >> 4], tables[16 | (p["tables"][c] & 15)]
            for k in range((sampling >> 4) * (sampling & 15)):
                last[c] += bits.magnitude(bits.symbol(dc))
                block = np.zeros(64)
                block[0], i = last[c], 1
                while i < 64:
                    s = bits.symbol(ac)
                    if not s & 15:
                        if s != 0xF0:
                            break
                        i += 16
                        continue
                    i += s >> 4
                    block[ZIGZAG[i]] = bits.magnitude(s & 15) * p["quant"][quant][i]
                    i += 1
                if c == first[0]:
                    block[0] *= p["quant"][quant][0]
                    blocks[unit // across * high + k // wide, unit % across * wide + k % wide] = block
    pixels = np.einsum("xu,abuv,yv->abxy", _cosines, blocks.reshape(*blocks.shape[:2], 8, 8), _cosines) + 128
    return np.clip(np.rint(pixels), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(blocks.shape[0] * 8, -1)[:h, :w]


def shots(frames: list[np.ndarray]) -> list[tuple[int, int]]:
    """First frame and end of each shot: a cut where the histogram difference exceeds the mean of the shot's last ones by DEVIATIONS, and LEAST."""
    if not frames:
        return []
    sizes = np.array([f.size for f in frames])
    bins = np.repeat(np.arange(len(frames)) * BINS, sizes) + (np.concatenate([f.ravel() for f in frames]) >> 4)
    h = np.bincount(bins, minlength=BINS * len(frames)).reshape(-1, BINS) / np.maximum(sizes, 1)[:, None]
    d = (np.abs(np.diff(h, axis=0)).sum(1) / 2).tolist()
    out, start, seen = [], 0, []
    for i, x in enumerate(d, 1):
        limit = LEAST
        if seen:
            mean = sum(seen) / len(seen)
            limit = max(LEAST, mean + DEVIATIONS * (sum((s - mean) ** 2 for s in seen) / len(seen)) ** 0.5)
        if x > limit:
            out.append((start, i))
            start, seen = i, []
        else:
            seen = [*seen[1 - BACK :], x]
    return [*out, (start, len(frames))]


def clip_rows(media: bytes) -> list[dict]:
    rate, frames = read_avi(media)
    if not rate:
        raise ValueError("an AVI file without a frame rate")
    return [{"clip": i, "start_s": a / rate, "end_s": b / rate, "frames": b - a} for i, (a, b) in enumerate(shots(decode_frames(frames)))]


CLIPS = "array<struct<clip:int,start_s:double,end_s:double,frames:int>>"


def store(docs: DataFrame, text: str = "text") -> DataFrame:
    """Appends n_bytes, media (the AVI file), payload (read back from it) and clips (of its shots) for each whole text."""

    def work(texts: list[str]) -> list[pa.Array]:
        sizes, media, payloads, clips = [], [], [], []
        for t in texts:
            data = t.encode()
            sizes.append(len(data))
            made = write_avi(data + b"\0" * (-len(data) % UNIT or UNIT * (not data)))
            rate, jpegs = read_avi(made)
            frames = decode_frames(jpegs)
            media.append(made)
            payloads.append(b"".join(f.tobytes() for f in frames))
            clips.append([{"clip": i, "start_s": a / rate, "end_s": b / rate, "frames": b - a} for i, (a, b) in enumerate(shots(frames))])
        kind = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())]))
        return [pa.array(sizes, pa.int64()), pa.array(media, pa.binary()), pa.array(payloads, pa.binary()), pa.array(clips, kind)]

    return map_texts(docs, text, f"n_bytes bigint, media binary, payload binary, clips {CLIPS}", work)


def inspect(files: DataFrame, media: str = "media") -> DataFrame:
    """Appends clips and error (null where the file could be read) for each file."""

    def read(data: bytes | None) -> tuple[list[dict], str | None]:
        try:
            return ([] if data is None else clip_rows(bytes(data))), None
        except (ValueError, KeyError, IndexError, TypeError, StopIteration, struct.error) as e:  # what broken data lead to
            return [], f"{type(e).__name__}: {e}"

    def work(column: list) -> list[pa.Array]:
        made = [read(x) for x in column]
        kind = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())]))
        return [pa.array([c for c, _ in made], kind), pa.array([e for _, e in made], pa.string())]

    return map_values(files, media, f"clips {CLIPS}, error string", work)


def clips(files: DataFrame, key: str, media: str = "media") -> DataFrame:
    """The key, clip, start_s, end_s, frames: a row for each shot of each file that can be read."""
    return inspect(files.select(key, media), media).select(F.col(key), F.explode("clips").alias("c")).select(key, "c.*")


def digests(stored: DataFrame) -> DataFrame:
    """doc_id and the digest columns of store's rows."""
    tail = F.expr(f"substring(payload, octet_length(payload) - {UNIT - 1}, {UNIT})")
    shot = F.transform("clips", lambda c: F.concat(c["frames"].cast("string"), F.lit("@"), F.round(c["start_s"] * 1000).cast("long").cast("string")))
    return stored.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.concat(F.lit("shots "), F.array_join(shot, " ")).alias("feature"))
