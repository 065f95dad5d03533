"""Media columns: AVI motion-JPEG of bytes, its index, its intra frames, and shots by adaptive histogram differences.

A payload is stored without loss in grey baseline JPEG frames: one byte is the level of one flat block of 8 by 8 pixels,
whose only coefficient, the DC at a quantiser of 8, is the byte less 128. Any motion-JPEG player shows these frames.
Frames of a slice of rows are coded and decoded side by side, one array operation for the same block of all frames.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, utf8

#: Blocks in a frame: 24 by 24.
SIDE = 24
FRAME = SIDE * SIDE
RATE = 25
#: Frames that are coded or decoded at a time.
FRAMES = 4096
#: Lengths of the DC codes by category (bits of the difference): letters next to each other differ by 2 to 7 bits.
DC_LENGTHS = {1: 3, 2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 0: 4, 8: 5}
#: Fixed value: the order in which baseline JPEG stores coefficients, by rows of diagonals.
ZIGZAG = sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else -(i // 8)))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _codes(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Canonical codes (code, length) of symbols, shorter first and in the given order."""
    code, last, out = 0, 0, {}
    for symbol, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[symbol] = (code, n)
        code, last = code + 1, n
    return out


def _huffman(kind: int, lengths: dict[int, int]) -> bytes:
    ordered = sorted(lengths.items(), key=lambda x: x[1])
    counts = bytes(sum(n == k for _, n in ordered) for k in range(1, 17))
    return _segment(0xC4, bytes([kind]) + counts + bytes(s for s, _ in ordered))


@functools.cache
def frame_header() -> bytes:
    """Everything of a frame before its coded blocks; the AC table has only the end of a block, as the one bit 0."""
    table = bytes([0]) + bytes([8] + [1] * 63)
    size = struct.pack(">BHHB", 8, 8 * SIDE, 8 * SIDE, 1) + bytes([1, 0x11, 0])
    return b"\xff\xd8" + _segment(0xDB, table) + _segment(0xC0, size) + _huffman(0x00, DC_LENGTHS) + _huffman(0x10, {0: 1}) + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))


@functools.cache
def _words() -> tuple[np.ndarray, np.ndarray]:
    """For each difference from -255, its code with the end of the block, and the length of that."""
    codes, out = _codes(DC_LENGTHS), []
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = codes[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        out.append(((code << size | extra) << 1, n + size + 1))
    words, lengths = zip(*out)
    return np.array(words, np.int64), np.array(lengths, np.int64)


def encode(frames: np.ndarray) -> list[bytes]:
    """JPEG frames of levels [n, FRAME]."""
    out: list[bytes] = []
    for at in range(0, len(frames), FRAMES):
        out += _encode(frames[at : at + FRAMES])
    return out


def _encode(frames: np.ndarray) -> list[bytes]:
    words, lengths = _words()
    levels = frames.astype(np.int64) - 128
    levels[:, 1:] -= frames[:, :-1].astype(np.int64) - 128
    which = levels + 255
    word, length = words[which], lengths[which]
    ends = np.cumsum(length, axis=1)
    bits = ends[:, -1]
    sizes = (bits + 7) >> 3
    base = np.concatenate([[0], np.cumsum(sizes)])
    place = (ends - length + (base[:-1] * 8)[:, None]).ravel()
    value = (word.ravel() << (24 - length.ravel() - (place & 7)))
    first, total = place >> 3, int(base[-1])
    data = np.zeros(total + 2)
    for k, shift in enumerate((16, 8, 0)):
        data += np.bincount(first + k, weights=(value >> shift) & 255, minlength=total + 2)
    data = data[:total].astype(np.uint8)
    data[base[1:] - 1] |= ((1 << (sizes * 8 - bits)) - 1).astype(np.uint8)
    full = data == 255
    seen = np.cumsum(full)
    stuffed = np.zeros(total + int(seen[-1]), np.uint8)
    stuffed[np.arange(total) + seen - full] = data
    stops = base[1:] + seen[base[1:] - 1]
    raw, head, start, out = stuffed.tobytes(), frame_header(), 0, []
    for stop in stops.tolist():
        out.append(head + raw[start:stop] + b"\xff\xd9")
        start = stop
    return out


def _list(kind: bytes, body: bytes, name: bytes = b"LIST") -> bytes:
    return name + struct.pack("<I", len(body) + 4) + kind + body


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi(frames: list[bytes], rate: int = RATE, side: int = 8 * SIDE) -> bytes:
    """An AVI file of JPEG frames with an idx1 index."""
    largest = max(map(len, frames), default=0)
    main = struct.pack("<14I", 1_000_000 // rate, largest * rate, 0, 0x10, len(frames), 0, 1, largest, side, side, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, rate, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, side, side)
    picture = struct.pack("<IiiHH4sIiiII", 40, side, side, 1, 24, b"MJPG", side * side * 3, 0, 0, 0, 0)
    head = _list(b"hdrl", _chunk(b"avih", main) + _list(b"strl", _chunk(b"strh", stream) + _chunk(b"strf", picture)))
    parts, index, at = [], [], 4
    for f in frames:
        parts.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(parts[-1])
    return _list(b"AVI ", head + _list(b"movi", b"".join(parts)) + _chunk(b"idx1", b"".join(index)), b"RIFF")


def parse(data: bytes) -> tuple[int, list[bytes]]:
    """Microseconds a frame and the video frames of an AVI file, by its index; by walking the chunks where there is none.

    Raises ValueError if it is no AVI file or an entry of the index lies outside of it.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    micros, movi, index, at = 0, None, None, 12
    while at + 8 <= len(data):
        name, n = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"LIST" and data[at + 8 : at + 12] == b"hdrl":
            found = data.find(b"avih", at, at + 8 + n)
            micros = struct.unpack_from("<I", data, found + 8)[0] if found >= 0 else 0
        elif name == b"LIST" and data[at + 8 : at + 12] == b"movi":
            movi = (at + 8, at + 8 + n)
        elif name == b"idx1":
            index = np.frombuffer(data, np.dtype([("name", "S4"), ("flags", "<u4"), ("at", "<u4"), ("n", "<u4")]), n // 16, at + 8)
        at += 8 + n + (n & 1)
    if movi is None:
        raise ValueError("no frames")
    if index is None:
        out, at = [], movi[0] + 4
        while at + 8 <= movi[1]:
            name, n = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            if name[2:] in (b"dc", b"db"):
                out.append(data[at + 8 : at + 8 + n])
            at += 8 + n + (n & 1)
        return micros, out
    # places count from the list's name, or in some files from the start of the file
    origin = movi[0] if len(index) and int(index["at"][0]) < movi[0] else 0
    out = []
    for name, a, n in zip(index["name"].tolist(), index["at"].tolist(), index["n"].tolist()):
        if name[2:] in (b"dc", b"db"):
            if origin + a + 8 + n > len(data):
                raise ValueError("an index entry lies outside the file")
            out.append(data[origin + a + 8 : origin + a + 8 + n])
    return micros, out


class Header:
    """What a frame says before its coded blocks."""

    def __init__(self, frame: bytes):
        self.quant: dict[int, list[int]] = {}
        self.tables: dict[int, dict[int, int]] = {}
        self.restart, self.components, self.scan = 0, [], []
        at = 2
        if frame[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG frame")
        while True:
            marker, n = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
            body = frame[at + 4 : at + 2 + n]
            at += 2 + n
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    size = 128 if wide else 64
                    self.quant[body[0] & 15] = list(struct.unpack(">64H" if wide else "64B", body[1 : 1 + size]))
                    body = body[1 + size :]
            elif marker == 0xC4:
                while body:
                    kind, counts, total = body[0], body[1:17], sum(body[1:17])
                    symbols = iter(body[17 : 17 + total])
                    self.tables[kind] = {next(symbols): k + 1 for k, c in enumerate(counts) for _ in range(c)}
                    body = body[17 + total :]
            elif marker == 0xC0:
                self.height, self.width = struct.unpack_from(">HH", body, 1)
                self.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                self.scan = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
                break
            elif 0xC1 <= marker <= 0xCF:
                raise ValueError("not a baseline frame")
        self.length = at

    @property
    def flat(self) -> bool:
        """One component, whole blocks, no restarts, and blocks that can have no AC coefficient."""
        if len(self.components) != 1 or self.restart or self.width % 8 or self.height % 8:
            return False
        dc, ac = self.tables[self.scan[0][1]], self.tables[0x10 | self.scan[0][2]]
        return list(ac) == [0] and all(n + s <= 16 for s, n in dc.items())

    @functools.cached_property
    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """By the next 16 bits: the DC difference and the bits that it and the end of its block take."""
        differ, taken = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        end = next(iter(self.tables[0x10 | self.scan[0][2]].values()))
        for size, (code, n) in _codes(self.tables[self.scan[0][1]]).items():
            for extra in range(1 << size):
                value = extra if size == 0 or extra >> (size - 1) else extra - (1 << size) + 1
                low = (code << size | extra) << (16 - n - size)
                differ[low : low + (1 << (16 - n - size))] = value
                taken[low : low + (1 << (16 - n - size))] = n + size + end
        return differ, taken


def decode_flat(frames: list[bytes], head: Header) -> np.ndarray:
    """Levels [n, blocks] of frames of flat blocks that share one header."""
    bodies = [f[head.length : f.rindex(b"\xff\xd9")] for f in frames]
    raw = np.frombuffer(b"".join(bodies) + b"\0" * 8, np.uint8)
    keep = np.ones(len(raw), bool)
    keep[1:] = ~((raw[:-1] == 255) & (raw[1:] == 0))
    kept = np.cumsum(keep)
    ends = np.cumsum([len(b) for b in bodies])
    data = raw[keep].astype(np.uint32)
    window = np.zeros(len(data), np.uint32)
    window[:-3] = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    at = np.concatenate([[0], kept[ends[:-1] - 1]]).astype(np.int64) * 8
    differ, taken = head.steps
    blocks = head.width * head.height // 64
    level, scale = np.zeros(len(frames), np.int32), head.quant[head.components[0][3]][0]
    out = np.empty((blocks, len(frames)), np.int32)
    for k in range(blocks):
        bits = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(16)
        level = level + differ[bits]
        out[k] = level
        at += taken[bits]
    return np.clip((out.T * scale + 4) // 8 + 128, 0, 255).astype(np.uint8)


def decode_frame(frame: bytes) -> np.ndarray:
    """Pixels [height, width, components] of one baseline frame, components at the frame's size, for any tables."""
    head = Header(frame)
    across, down = max(c[1] for c in head.components), max(c[2] for c in head.components)
    columns, rows = -(-head.width // (8 * across)), -(-head.height // (8 * down))
    codes = {kind: {(n, c): s for s, (c, n) in _codes(t).items()} for kind, t in head.tables.items()}
    scans = {c: (dc, 0x10 | ac) for c, dc, ac in head.scan}
    body = frame[head.length :]
    cosine = np.array([[(0.5**0.5 if u == 0 else 1) * np.cos((2 * x + 1) * u * np.pi / 16) / 2 for u in range(8)] for x in range(8)])
    planes = {c: np.zeros((rows * v * 8, columns * h * 8)) for c, h, v, _ in head.components}
    level = dict.fromkeys(planes, 0)
    at, held, left = 0, 0, 0

    def take(n: int) -> int:
        nonlocal at, held, left
        while left < n:
            byte = body[at]
            at += 2 if byte == 255 else 1
            held, left = held << 8 | byte, left + 8
        left -= n
        got = held >> left
        held &= (1 << left) - 1
        return got

    def symbol(table: dict) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | take(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("no such code")

    def extended(size: int) -> int:
        value = take(size)
        return value if size == 0 or value >> (size - 1) else value - (1 << size) + 1

    for unit in range(rows * columns):
        if head.restart and unit and unit % head.restart == 0:
            held, left, level = 0, 0, dict.fromkeys(planes, 0)
            at = next(i for i in range(at, len(body)) if body[i] == 255 and 0xD0 <= body[i + 1] <= 0xD7) + 2
        y, x = divmod(unit, columns)
        for c, h, v, q in head.components:
            dc, ac = scans[c]
            for b in range(h * v):
                block = np.zeros(64)
                level[c] += extended(symbol(codes[dc]))
                block[0] = level[c] * head.quant[q][0]
                k = 1
                while k < 64:
                    run, size = divmod(symbol(codes[ac]), 16)
                    if size == 0 and run < 15:
                        break
                    k += run
                    if size and k < 64:
                        block[ZIGZAG[k]] = extended(size) * head.quant[q][k]
                    k += 1
                top, side = (y * v + b // h) * 8, (x * h + b % h) * 8
                planes[c][top : top + 8, side : side + 8] = cosine @ block.reshape(8, 8) @ cosine.T + 128
    full = [np.kron(planes[c], np.ones((down // v, across // h)))[: head.height, : head.width] for c, h, v, _ in head.components]
    return np.clip(np.rint(np.stack(full, axis=-1)), 0, 255).astype(np.uint8)


def levels(frames: list[bytes]) -> list[np.ndarray]:
    """The mean level of each block of 8 by 8 pixels of each frame's first component."""
    out: list[np.ndarray | None] = [None] * len(frames)
    alike: dict[bytes, list[int]] = {}
    for i, f in enumerate(frames):
        end = f.index(b"\xff\xda")
        alike.setdefault(f[: end + 2 + struct.unpack_from(">H", f, end + 2)[0]], []).append(i)
    for which in alike.values():
        head = Header(frames[which[0]])
        for at in range(0, len(which), FRAMES):
            part = which[at : at + FRAMES]
            if head.flat:
                for i, row in zip(part, decode_flat([frames[i] for i in part], head)):
                    out[i] = row
            else:
                for i in part:
                    pixels = decode_frame(frames[i])[: head.height // 8 * 8, : head.width // 8 * 8, 0]
                    out[i] = pixels.reshape(head.height // 8, 8, head.width // 8, 8).mean(axis=(1, 3)).astype(np.uint8).ravel()
    return out


def histograms(frames: list[np.ndarray], bins: int = 16) -> np.ndarray:
    """For each frame, the shares of its levels in `bins` equal ranges."""
    if not frames:
        return np.zeros((0, bins))
    size = len(frames[0])
    if any(len(f) != size for f in frames):
        return np.stack([np.bincount(f.astype(np.int64) * bins >> 8, minlength=bins) / len(f) for f in frames])
    which = (np.stack(frames).astype(np.int64) * bins >> 8) + (np.arange(len(frames)) * bins)[:, None]
    return np.bincount(which.ravel(), minlength=len(frames) * bins).reshape(-1, bins) / size


def shots(shares: np.ndarray, window: int = 12, factor: float = 3.0, least: float = 0.2) -> list[tuple[int, int]]:
    """Clips (first frame, frame after the last) between cuts.

    Before a frame is a cut if its histogram differs from that of the frame before (half the sum of absolute differences)
    by over `least` and over the mean and `factor` standard deviations of the `window` differences before.
    """
    n = len(shares)
    if n == 0:
        return []
    d = np.abs(np.diff(shares, axis=0)).sum(axis=1) / 2
    sums, squares = np.concatenate([[0], np.cumsum(d)]), np.concatenate([[0], np.cumsum(d * d)])
    i = np.arange(len(d))
    low = np.maximum(i - window, 0)
    count = np.maximum(i - low, 1)
    mean = (sums[i] - sums[low]) / count
    spread = np.sqrt(np.maximum((squares[i] - squares[low]) / count - mean * mean, 0))
    found = np.flatnonzero((d > least) & (d > mean + factor * spread)) + 1
    edges = [0, *found.tolist(), n]
    return list(zip(edges[:-1], edges[1:]))


def payload(data: bytes) -> bytes:
    """The bytes with 255 after them, up to a positive multiple of a frame."""
    n = max(1, -(-len(data) // FRAME)) * FRAME
    return data + b"\xff" * (n - len(data))


def store(payloads: list[bytes]) -> list[bytes]:
    """An AVI file for each payload, a multiple of FRAME long."""
    counts = [len(p) // FRAME for p in payloads]
    frames = encode(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME)) if payloads else []
    out, at = [], 0
    for n in counts:
        out.append(avi(frames[at : at + n]))
        at += n
    return out


def described(files: list[bytes]) -> list[dict]:
    """For each AVI file the levels of its frames as bytes, and its clips (number, start and end in seconds, frames, mean level)."""
    parsed = [parse(f) for f in files]
    rows, out, at = levels([f for _, fs in parsed for f in fs]), [], 0
    for micros, fs in parsed:
        own = rows[at : at + len(fs)]
        at += len(fs)
        clips = [
            {"clip": k, "start_s": a * micros / 1e6, "end_s": b * micros / 1e6, "frames": b - a, "mean_level": float(np.mean([r.mean() for r in own[a:b]]))}
            for k, (a, b) in enumerate(shots(histograms(own)))
        ]
        out.append({"payload": b"".join(r.tobytes() for r in own), "clips": clips})
    return out


CLIP = "struct<clip:int,start_s:double,end_s:double,frames:int,mean_level:double>"


def clip_rows(df: DataFrame, key: str, media: str) -> DataFrame:
    """The key and one timed row for each clip of the AVI file in a binary column, or one row with `error` for a file that can't be read.

    Null and empty files have no clips, a file of no frames none. What is no AVI file, cut short or broken inside says so in `error` and
    stops nothing else. Repeated rows give repeated clips; only the two columns are read.
    """
    kind = df.schema[key].dataType.simpleString()

    def one(file):
        try:
            return described([file])[0]["clips"], None
        except Exception as error:  # noqa: BLE001  whatever a broken file brings about
            return None, f"{type(error).__name__}: {error}"

    def make():
        def apply(keys, files):
            some = [f for f in files if f]
            try:
                found = iter([(x["clips"], None) for x in described(some)])
            except Exception:  # noqa: BLE001  one of them is broken
                found = iter([one(f) for f in some])
            every = [next(found) if f else ([], None) for f in files]
            return {"k": keys, "clips": [c for c, _ in every], "error": [e for _, e in every]}

        return apply

    rows = on_arrow(df, [F.col(key), F.col(media)], make, f"k {kind}, clips array<{CLIP}>, error string")
    held = rows.filter(F.col("error").isNotNull() | (F.size("clips") > 0))
    return held.select(F.col("k").alias(key), F.explode_outer("clips").alias("c"), "error").select(key, "c.*", "error")


def stored_media(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and media, the AVI file that holds the bytes of the whole text; null texts are empty."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        return lambda keys, texts: {"doc_id": keys, "media": store([payload(utf8(t)) for t in texts])}

    return on_arrow(df, [F.col(id_col), F.col(text)], make, f"doc_id {kind}, media binary")


def digests(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """What the stored and the read back bytes of each whole text are, and a feature of its clips.

    Null texts are empty, which is one frame of 255. Equal texts give equal values, repeated rows repeated ones, an
    empty table none. The feature is the number of frames, the ends of the clips in frames, and their mean levels.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")

    def make():
        def apply(keys, texts):
            raw = [utf8(t) for t in texts]
            files = store([payload(x) for x in raw])
            rows = []
            for key, data, file, got in zip(keys, raw, files, described(files)):
                back, ends, total = got["payload"], [], 0
                for c in got["clips"]:
                    total += c["frames"]
                    ends.append(f"{total}:{c['mean_level']:.3f}")
                sha = hashlib.sha256
                rows.append((key, len(data), len(back), sha(back).hexdigest(), zlib.crc32(back[-32:]), len(file), sha(file).hexdigest(), f"{total}|" + ",".join(ends)))
            return dict(zip(names, map(list, zip(*rows))))

        return apply

    schema = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return on_arrow(df, [F.col(id_col), F.col(text)], make, schema)
