"""Motion-JPEG in AVI: RIFF parsing, intra-frame decoding, shots from adaptive histogram differences, clip rows.

Bytes are stored losslessly in the unit of the format, the quantised coefficients of 8x8 blocks: with quantisation 1 and
Huffman tables of the one symbol "size 8", byte b is the coefficient whose eight additional bits are b. A restart marker
after each block makes the first coefficient stand for itself, so such frames are ordinary baseline JPEG and all of their
codes are nine bits long, which decodes without a loop. Other baseline frames take the general decoder.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib

from pyspark.sql import DataFrame

from .common import batches

BLOCKS_WIDE, BLOCKS_HIGH, FPS = 8, 8, 25
#: Shots: bins of a frame's histogram, least difference of a cut, standard deviations over the local mean, frames looked back.
BINS, LEAST, SIGMAS, BACK = 16, 0.2, 3.0, 12


@functools.lru_cache(maxsize=1)
def zigzag() -> list[int]:
    """Natural index of each zigzag place: along anti-diagonals, turning at each."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return [8 * r + c for r, c in cells]


@functools.lru_cache(maxsize=1)
def _idct():
    """(64, 64): zigzag coefficients times this are pixels, less 128."""
    import numpy as np

    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    basis = np.cos((2 * x + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.einsum("ry,cx->rcyx", basis, basis).reshape(64, 64)[zigzag()].astype(np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def coefficient_frames(payload: bytes, per_frame: int, wide: int, high: int) -> list[bytes]:
    """JPEG frames whose coefficients are the payload's bytes, 64 a block; the last frame is filled with zero bytes."""
    import numpy as np

    data = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    n = -(-len(data) // per_frame)
    data = np.concatenate([data, np.zeros((n * per_frame - len(data), 64), np.uint8)])
    bits = np.zeros((len(data), 64, 9), np.uint8)
    bits[:, :, 1:] = np.unpackbits(data, axis=1).reshape(len(data), 64, 8)
    coded = np.zeros((len(data), 74), np.uint8)
    coded[:, :72] = np.packbits(bits.reshape(len(data), 576), axis=1)
    coded[:, 72], coded[:, 73] = 0xFF, 0xD0 + np.arange(len(data)) % per_frame % 8
    head = b"\xff\xd8" + _segment(0xDB, bytes([0]) + bytes([1]) * 64) + _segment(0xC0, struct.pack(">BHHB3B", 8, 8 * high, 8 * wide, 1, 1, 0x11, 0))
    one = bytes([1] + [0] * 15 + [8])
    head += _segment(0xC4, b"\x00" + one) + _segment(0xC4, b"\x10" + one) + _segment(0xDD, struct.pack(">H", 1)) + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    out = []
    for f in range(n):
        flat = coded[f * per_frame : (f + 1) * per_frame].ravel()[:-2]
        full = np.flatnonzero((flat == 0xFF) & (np.arange(len(flat)) % 74 < 72))
        scan = np.insert(flat, full + 1, 0) if len(full) else flat
        out.append(head + scan.tobytes() + b"\xff\xd9")
    return out


def _huffman(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    table, code, at = {}, 0, 0
    for bits in range(1, 17):
        for _ in range(counts[bits - 1]):
            table[bits, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return table


def parse_jpeg(data: bytes, tables: bytes = b"") -> dict:
    """Segments of a baseline frame: size, components, quantisation, Huffman tables, restart interval and the scan's bytes.

    tables: DHT bodies for streams that leave them out.
    """
    out: dict = {"q": {}, "huff": {}, "restart": 0}

    def huffman(body: bytes) -> None:
        at = 0
        while at < len(body):
            n = sum(body[at + 1 : at + 17])
            out["huff"][body[at]] = (bytes(body[at + 1 : at + 17]), bytes(body[at + 17 : at + 17 + n]))
            at += 17 + n

    if tables:
        huffman(tables)
    at = 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG frame")
    while True:
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                out["q"][body[0] & 15] = list(struct.unpack(">64H", body[1 : 1 + n])) if wide else list(body[1:65])
                body = body[1 + n :]
        elif marker in (0xC0, 0xC1):
            out["height"], out["width"], n = struct.unpack_from(">HHB", body, 1)
            out["parts"] = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif marker == 0xC4:
            huffman(body)
        elif marker == 0xDD:
            out["restart"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            out["scan"] = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
            out["data"] = data[at : data.rindex(b"\xff\xd9")]
            return out
        elif 0xC2 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("only baseline frames can be decoded")


_ONE = (bytes([1] + [0] * 15), bytes([8]))


def frame_bytes(jpeg: dict):
    """(blocks, 64) bytes of a frame of nine-bit codes, or None if it is another kind."""
    import numpy as np

    if jpeg["restart"] != 1 or len(jpeg["parts"]) != 1 or jpeg["huff"].get(0) != _ONE or jpeg["huff"].get(16) != _ONE:
        return None
    n = -(-jpeg["height"] // 8) * -(-jpeg["width"] // 8)
    flat = np.frombuffer(jpeg["data"], np.uint8)
    if len(flat) != 74 * n - 2:  # stuffed zeros
        after = np.flatnonzero((flat[:-1] == 0xFF) & (flat[1:] == 0)) + 1
        flat = np.delete(flat, after)
    rows = np.concatenate([flat, np.array([0xFF, 0xD0 + (n - 1) % 8], np.uint8)]).reshape(n, 74)
    if (rows[:, 72] != 0xFF).any() or (rows[:, 73] != 0xD0 + np.arange(n) % 8).any():
        raise ValueError("restart markers out of place")
    bits = np.unpackbits(rows[:, :72], axis=1).reshape(n, 64, 9)
    if bits[:, :, 0].any():
        raise ValueError("unknown code")
    return np.packbits(bits[:, :, 1:].reshape(n, 512), axis=1)


def _coefficients(jpeg: dict):
    """General baseline decoding: {component: (rows of blocks, columns of blocks, 64)} quantised, in zigzag order."""
    import numpy as np

    most_h, most_v = max(p[1] for p in jpeg["parts"]), max(p[2] for p in jpeg["parts"])
    alone = len(jpeg["parts"]) == 1
    across, down = (-(-jpeg["width"] // 8), -(-jpeg["height"] // 8)) if alone else (-(-jpeg["width"] // (8 * most_h)), -(-jpeg["height"] // (8 * most_v)))
    tables = {k: _huffman(*v) for k, v in jpeg["huff"].items()}
    out = {c: np.zeros((down * (1 if alone else v), across * (1 if alone else h), 64), np.int32) for c, h, v, _ in jpeg["parts"]}
    pieces, data, at = [], jpeg["data"], 0
    while True:  # restart segments
        stop = next((i for i in range(at, len(data) - 1) if data[i] == 0xFF and 0xD0 <= data[i + 1] <= 0xD7), len(data))
        pieces.append(data[at:stop].replace(b"\xff\x00", b"\xff"))
        if stop == len(data):
            break
        at = stop + 2
    units, each = across * down, jpeg["restart"] or across * down
    for number, piece in enumerate(pieces):
        value, left = int.from_bytes(piece, "big"), 8 * len(piece)
        last = dict.fromkeys(out, 0)

        def take(n: int) -> int:
            nonlocal left
            left -= n
            return value >> left & (1 << n) - 1 if left >= 0 else (value << -left) & (1 << n) - 1

        def symbol(table) -> int:
            code = 0
            for bits in range(1, 17):
                code = code << 1 | take(1)
                if (bits, code) in table:
                    return table[bits, code]
            raise ValueError("unknown code")

        def extend(n: int) -> int:
            v = take(n) if n else 0
            return v if not n or v >> n - 1 else v - (1 << n) + 1

        for unit in range(number * each, min(units, (number + 1) * each)):
            row, col = divmod(unit, across)
            for c, h, v, _ in jpeg["parts"]:
                dc, ac = jpeg["scan"][c]
                for y in range(1 if alone else v):
                    for x in range(1 if alone else h):
                        block = out[c][row * (1 if alone else v) + y, col * (1 if alone else h) + x]
                        last[c] += extend(symbol(tables[dc]))
                        block[0], k = last[c], 1
                        while k < 64:
                            s = symbol(tables[16 + ac])
                            if not s & 15 and s >> 4 < 15:
                                break
                            k += s >> 4
                            if s & 15:
                                block[k] = extend(s & 15)
                            k += 1
    return out


def luma(jpeg: dict, stored=None):
    """8-bit samples (blocks, 64) of the first component, block after block."""
    import numpy as np

    first = jpeg["parts"][0]
    if stored is not None:
        b = stored.astype(np.int16)
        coefficients = np.where(b < 128, b - 255, b)
    else:
        coefficients = _coefficients(jpeg)[first[0]].reshape(-1, 64)
    scaled = coefficients.astype(np.float32) * np.array(jpeg["q"][first[3]], np.float32)
    return np.clip(np.rint(scaled @ _idct()) + 128, 0, 255).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(frames: list[bytes], width: int, height: int, comment: str = "", fps: int = FPS) -> bytes:
    """An AVI file with one MJPG stream, an old-style index and an optional comment."""
    most = max(map(len, frames), default=0)
    main = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, len(frames), 0, 1, most, width, height, 0, 0, 0, 0)
    stream = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, width, height)
    form = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", form)))
    info = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", comment.encode() + b"\0")) if comment else b""
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + head + info + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def read_avi(data: bytes) -> dict:
    """{fps, width, height, comment, frames}: RIFF chunks, frames by the index or, without one, in file order."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    out: dict = {"fps": float(FPS), "width": 0, "height": 0, "comment": "", "frames": []}
    movi, index, found = 0, b"", []

    def walk(at: int, stop: int) -> None:
        nonlocal movi, index
        while at + 8 <= stop:
            name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            body, end = at + 8, min(stop, at + 8 + size)
            if name == b"LIST":
                if data[body : body + 4] == b"movi":
                    movi = body
                walk(body + 4, end)
            elif name == b"avih":
                step, out["width"], out["height"] = struct.unpack_from("<I28xII", data, body)
                out["fps"] = 1e6 / step if step else out["fps"]
            elif name == b"ICMT":
                out["comment"] = data[body:end].rstrip(b"\0").decode("utf-8", "replace")
            elif name == b"idx1":
                index = data[body:end]
            elif name[2:] in (b"dc", b"db"):
                found.append((body, end))
            at = body + size + size % 2

    walk(12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0]))
    if index:
        rows = [struct.unpack_from("<4sIII", index, i) for i in range(0, len(index) - 15, 16)]
        base = movi if rows and data[movi + rows[0][2] : movi + rows[0][2] + 4] == rows[0][0] else 0
        found = [(base + at + 8, base + at + 8 + size) for name, _, at, size in rows if name[2:] in (b"dc", b"db")]
    out["frames"] = [data[a:b] for a, b in found]
    return out


def histograms(frames: list, bins: int = BINS):
    """Share of samples a bin, (frames, bins)."""
    import numpy as np

    shift = 8 - (bins - 1).bit_length()
    return np.array([np.bincount(f.ravel() >> shift, minlength=bins) / max(1, f.size) for f in frames]).reshape(-1, bins)


def shots(hist, least: float = LEAST, sigmas: float = SIGMAS, back: int = BACK) -> list[tuple[int, int]]:
    """[first, stop) frames of each shot: a cut is a histogram difference over `least` and over mean + sigmas * deviation
    of the differences in the shot so far (at most `back` of them)."""
    import numpy as np

    if not len(hist):
        return []
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2
    out, start = [], 0
    for i, d in enumerate(diff.tolist(), 1):
        seen = diff[max(start, i - 1 - back) : i - 1]
        bar = max(least, float(seen.mean() + sigmas * seen.std())) if len(seen) else least
        if d > bar:
            out.append((start, i))
            start = i
    return [*out, (start, len(hist))]


def store_text(text: str | None) -> tuple[bytes, int, int]:
    """(AVI bytes, bytes of the text, bytes of the payload: the text's and zeros up to a positive multiple of 64)."""
    raw = (text or "").encode()
    payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
    blocks = len(payload) // 64
    high = min(BLOCKS_HIGH, -(-blocks // BLOCKS_WIDE))
    frames = coefficient_frames(payload, BLOCKS_WIDE * high, BLOCKS_WIDE, high)
    return write_avi(frames, 8 * BLOCKS_WIDE, 8 * high, f"payload-bytes {len(payload)}"), len(raw), len(payload)


def load(media: bytes):
    """(payload or None, per-frame samples, fps) of an AVI file; the payload is there if its comment tells the length."""
    avi = read_avi(media)
    stored, samples = [], []
    for f in avi["frames"]:
        jpeg = parse_jpeg(f)
        own = frame_bytes(jpeg)
        stored.append(own)
        samples.append(luma(jpeg, own))
    size = avi["comment"].removeprefix("payload-bytes ")
    known = size.isdigit() and all(s is not None for s in stored)
    return (b"".join(s.tobytes() for s in stored)[: int(size)] if known else None), samples, avi["fps"]


def feature(samples: list, fps: float) -> str:
    hist = histograms(samples)
    found = shots(hist)
    levels = hist.mean(axis=0) if len(hist) else []
    return f"frames={len(samples)};shots={len(found)};cuts={','.join(str(a) for a, _ in found[1:])};seconds={len(samples) / fps:.2f};histogram={','.join(f'{x:.4f}' for x in levels)}"


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """Store every whole text as an AVI file, read the file back, and return what was read; one row a document.

    Columns: n_bytes, payload_bytes, payload_sha256, tail_crc32 (last 64 payload bytes), media_bytes, media_sha256, feature
    and, if with_media, media. A null text is empty (64 zero bytes). Repeated rows stay; other columns are left out.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    kinds = {"n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()} | ({"media": pa.binary()} if with_media else {})

    def run(parts):
        for batch in parts:
            for start, stop in batches(batch.column("text"), 1 << 21):
                rows = []
                for text in batch.column("text").slice(start, stop - start):
                    media, n, size = store_text(text.as_py())
                    payload, samples, fps = load(media)
                    if len(payload) != size:
                        raise ValueError("the payload read has another length")
                    rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples, fps), media)[: len(kinds)])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, stop - start), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds.values()))], names=["id", *kinds])

    names = {"n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "media": "binary"}
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} {names[n]}" for n in kinds)).withColumnRenamed("id", id_col)


def clips(videos: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """Timed clip rows of AVI files: id, clip, first_frame, stop_frame, start_s, stop_s, mean_luma; none for null or no frames."""
    import pyarrow as pa

    kind = videos.schema[id_col].dataType.simpleString()

    def run(parts):
        for batch in parts:
            names, cols = batch.column("id").to_pylist(), [[] for _ in range(7)]
            for name, media in zip(names, batch.column("media")):
                if media.as_py() is None:
                    continue
                _, samples, fps = load(media.as_py())
                for i, (a, b) in enumerate(shots(histograms(samples))):
                    mean = sum(float(f.mean()) for f in samples[a:b]) / (b - a)
                    for c, x in zip(cols, (name, i, a, b, a / fps, b / fps, mean)):
                        c.append(x)
            kinds = [batch.schema.field("id").type, pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "clip", "first_frame", "stop_frame", "start_s", "stop_s", "mean_luma"])

    return videos.select(videos[id_col].alias("id"), videos[media_col].alias("media")).mapInArrow(run, f"id {kind}, clip int, first_frame int, stop_frame int, start_s double, stop_s double, mean_luma double").withColumnRenamed("id", id_col)
