"""Media columns: payloads as baseline JPEG, and a reader that parses markers, Huffman-decodes scans and rebuilds DC-only luminance thumbnails.

Storing is lossless because a payload byte becomes one flat 8x8 block: its DC term is ``8 * (byte - 128)``, the DC quantiser is 8, and no
AC term follows. An image is 192 blocks wide, so a payload of ``192 * n`` bytes gives ``n`` block rows, and the DC-only thumbnail of the
stored image *is* the payload. Every block row is a restart interval; rows are decoded in lockstep, over all images of a batch at once.
A payload of over 192 * 8191 bytes takes several images, one behind the other.

The reader takes any baseline (SOF0) Huffman JPEG of one interleaved scan, grey or with chroma, with or without restart intervals.
Null text counts as empty; the empty text is one row of spaces. Equal texts give equal bytes, and repeated rows equal results. An empty table
gives an empty result. Bytes that are no such JPEG raise ValueError. Images are written and read in groups of about ``_GROUP`` bytes, so a very
long text needs a few copies of itself beside what one group takes. Own columns named like the features stay, ahead of them, as ``own`` and the name.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import bounded, clear_of, ddl, plainly, quoted, slices

WIDTH = 192
_MOST_ROWS = 65535 // 8
#: Payload or scan bytes that are handled at once; an image may be larger and is then handled alone.
_GROUP = 1 << 20
_PAD = b" "

# Fixed values of the format: (code lengths 1..16, symbols). DC: sizes 1-7 in three bits, 0 in four, 8 in five. AC: end of block only.
_DC = (bytes([0, 0, 7, 1, 1] + [0] * 11), bytes([1, 2, 3, 4, 5, 6, 7, 0, 8]))
_AC = (bytes([1] + [0] * 15), bytes([0]))


def padded(data: bytes) -> bytes:
    """Data with spaces up to a positive multiple of the width."""
    return data + _PAD * ((-len(data)) % WIDTH or (0 if data else WIDTH))


def _codes(lengths: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, bits) of a canonical Huffman table."""
    out, code, at = [], 0, 0
    for bits, n in enumerate(lengths, 1):
        for _ in range(n):
            out.append((symbols[at], code, bits))
            code, at = code + 1, at + 1
        code <<= 1
    return out


# ---- writing --------------------------------------------------------------------------------------------------------


@lru_cache(1)
def _encoder() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each DC difference from -255 to 255, end of block included."""
    dc = {s: (c, n) for s, c, n in _codes(*_DC)}
    value, bits = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = dc[size]
        amplitude = d if d > 0 else d + (1 << size) - 1
        value[d + 255] = ((code << size) | (amplitude if size else 0)) << 1
        bits[d + 255] = n + size + 1
    return value, bits


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(4096)
def _head(rows: int) -> bytes:
    quantisers = bytes([8] + [1] * 63)
    return b"\xff\xd8" + _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + _segment(0xDB, b"\0" + quantisers) + _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, WIDTH * 8, 1) + b"\1\x11\0") + _segment(0xC4, b"\x00" + _DC[0] + _DC[1]) + _segment(0xC4, b"\x10" + _AC[0] + _AC[1]) + _segment(0xDD, struct.pack(">H", WIDTH)) + _segment(0xDA, b"\1\1\0\0\x3f\0")


def _scans(payload: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of all block rows with restart markers between them, and where each row begins.

    first: the number of each row in its image; a row of another image has no marker before it.
    """
    value, bits = _encoder()
    d = payload.reshape(-1, WIDTH).astype(np.int16) - np.int16(128)
    step = d.copy()
    step[:, 1:] -= d[:, :-1]
    step += 255
    n = bits[step]
    cum = np.cumsum(n, 1)
    size = (cum[:, -1] + 7) >> 3
    start = np.cumsum(size) - size
    off = (cum - n + (start * 8)[:, None]).ravel()
    shifted = value[step].ravel() << (24 - n.ravel() - (off & 7))
    at, total = off >> 3, int(size.sum())
    out = sum(np.bincount(at + k, (shifted >> (16 - 8 * k)) & 255, total + 3) for k in range(3))[:total].astype(np.uint8)
    last = start + size - 1
    out[last] |= ((1 << (-cum[:, -1] & 7)) - 1).astype(np.uint8)
    stuffed = np.cumsum(1 + (out == 255).astype(np.int64))
    marked = np.cumsum(np.where(first > 0, 2, 0))
    row = np.repeat(np.arange(len(size)), size)
    place = stuffed - 1 - (out == 255) + marked[row]
    final = np.zeros(int(stuffed[-1] + marked[-1]), np.uint8)
    final[place] = out
    begin = place[start]
    later = first > 0
    final[begin[later] - 2] = 255
    final[begin[later] - 1] = 0xD0 + (first[later] - 1) % 8
    begin[later] -= 2
    return final, begin


def _grouped(sizes: list[int]) -> list[tuple[int, int]]:
    """Runs of values of about ``_GROUP`` bytes together, one value at least: where they begin and end."""
    out, a, total = [], 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > _GROUP:
            out.append((a, k))
            a, total = k, 0
        total += n
    return [*out, (a, len(sizes))] if sizes else out


def store(payloads: list[bytes]) -> list[bytes]:
    """JPEG bytes for each payload of a positive multiple of 192 bytes."""
    images = [(k, a, min(len(p), a + WIDTH * _MOST_ROWS)) for k, p in enumerate(payloads) for a in range(0, len(p), WIDTH * _MOST_ROWS)]
    out = [[] for _ in payloads]
    for first, last in _grouped([b - a for _, a, b in images]):
        part = images[first:last]
        rows = np.array([(b - a) // WIDTH for _, a, b in part])
        place = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
        scan, begin = _scans(np.frombuffer(b"".join(payloads[k][a:b] for k, a, b in part), np.uint8), place)
        edges = [*begin[np.cumsum(rows) - rows].tolist(), len(scan)]
        data = scan.tobytes()
        for (k, _, _), n, a, b in zip(part, rows.tolist(), edges, edges[1:], strict=False):
            out[k] += [_head(n), data[a:b], b"\xff\xd9"]
    return [b"".join(x) for x in out]


# ---- reading --------------------------------------------------------------------------------------------------------


@lru_cache(64)
def _reader(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For 16 bits ahead: the symbol and the length of its code (0: none)."""
    symbol, bits = np.zeros(65536, np.int32), np.zeros(65536, np.int32)
    for s, code, n in _codes(table[:16], table[16:]):
        symbol[code << (16 - n) : (code + 1) << (16 - n)] = s
        bits[code << (16 - n) : (code + 1) << (16 - n)] = n
    return symbol, bits


def parse(data: bytes, at: int = 0) -> tuple[dict, int, int, int]:
    """Markers of one image: its frame and tables, where its scan begins and ends, and where the image ends."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG starts here")
    at += 2
    frame: dict = {"restart": 0, "quantisers": {}, "tables": {}}
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a marker was expected")
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                frame["quantisers"][body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                frame["tables"][body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif marker == 0xC0:
            _, frame["height"], frame["width"], n = struct.unpack(">BHHB", body[:6])
            frame["parts"] = [tuple(body[6 + 3 * k : 9 + 3 * k]) for k in range(n)]
        elif 0xC1 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("only baseline frames are read")
        elif marker == 0xDD:
            frame["restart"] = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            if "parts" not in frame or body[0] != len(frame["parts"]):
                raise ValueError("only one interleaved scan is read")
            frame["chosen"] = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            break
    end = at
    while True:
        end = data.find(b"\xff", end)
        if end < 0 or end + 1 >= len(data):
            raise ValueError("the scan has no end")
        if data[end + 1] == 0xD9:
            return frame, at, end, end + 2
        end += 2


def _pattern(frame: dict) -> tuple:
    """Blocks of one coded unit: (is luminance, DC table, AC table) each; units across and down; luminance blocks across and down a unit."""
    parts = frame["parts"]
    if len(parts) == 1:
        across, down, h, v = -(-frame["width"] // 8), -(-frame["height"] // 8), 1, 1
        blocks = [(True, parts[0][0])]
    else:
        hs, vs = max(p[1] >> 4 for p in parts), max(p[1] & 15 for p in parts)
        across, down = -(-frame["width"] // (8 * hs)), -(-frame["height"] // (8 * vs))
        h, v = parts[0][1] >> 4, parts[0][1] & 15
        blocks = [(k == 0, p[0]) for k, p in enumerate(parts) for _ in range((p[1] >> 4) * (p[1] & 15))]
    tables = frame["tables"]
    return tuple((y, c, tables[frame["chosen"][c] >> 4], tables[0x10 | frame["chosen"][c] & 15]) for y, c in blocks), across, down, h, v


def _lockstep(words: np.ndarray, start: np.ndarray, count: np.ndarray, blocks: tuple) -> np.ndarray:
    """DC terms of the luminance blocks of each segment, all segments one unit at a time."""
    y_blocks = sum(b[0] for b in blocks)
    most = int(count.max(initial=0))
    out = np.zeros((len(start), most * y_blocks), np.int32)
    order = np.argsort(-count, kind="stable")
    pos, left = (start * 8)[order].astype(np.int64), count[order]
    before = {c: np.zeros(len(start), np.int32) for _, c, _, _ in blocks}
    got = np.zeros((most * y_blocks, len(start)), np.int32)
    top, k = np.uint32(16), 0
    for unit in range(most):
        n = int(np.searchsorted(-left, -unit, "left"))
        p = pos[:n]
        for is_y, c, dc, ac in blocks:
            symbol, bits = _reader(dc)
            ahead = words[p >> 3] << (p & 7).astype(np.uint32)
            peek = ahead >> top
            size, used = symbol[peek], bits[peek]
            if not used.all():
                raise ValueError("a code that the table doesn't have")
            raw = ((words[(p + used) >> 3] << ((p + used) & 7).astype(np.uint32)) >> top).astype(np.int32) >> (16 - size)
            half = (1 << size) >> 1
            before[c][:n] += np.where(raw < half, raw - (1 << size) + 1, raw)
            p = p + used + size
            if is_y:
                got[k, :n] = before[c][:n]
                k += 1
            symbol, bits = _reader(ac)
            lanes, done = np.arange(n), np.zeros(n, np.int32)
            while len(lanes):
                q = p[lanes]
                peek = (words[q >> 3] << (q & 7).astype(np.uint32)) >> top
                rs, used = symbol[peek], bits[peek]
                if not used.all():
                    raise ValueError("a code that the table doesn't have")
                if not rs.any():  # all end here
                    p[lanes] = q + used
                    break
                p[lanes] = q + used + (rs & 15)
                done[lanes] += (rs >> 4) + 1
                lanes = lanes[(rs != 0) & (done[lanes] < 63)]
        pos[:n] = p
    out[order] = got.T
    return out


def thumbnails(medias: list[bytes]) -> list[list[tuple[int, int, np.ndarray]]]:
    """(width, height, DC-only luminance thumbnail) of each image of each media value."""
    images = []
    for k, data in enumerate(medias):
        at, number = 0, 0
        while at < len(data):
            frame, a, b, at = parse(data, at)
            images.append((k, number, a, b, frame))
            number += 1
    places: list[list] = [[] for _ in medias]
    for k, *_ in images:
        places[k].append(None)
    for first, last in _grouped([b - a for _, _, a, b, _ in images]):
        _decode([(k, n, medias[k][a:b], frame, *_pattern(frame)) for k, n, a, b, frame in images[first:last]], places)
    return places


def _decode(found: list[tuple], places: list[list]) -> None:
    """Puts the thumbnails of these images, alike ones together, where they belong."""
    groups: dict = {}
    for k, place, scan, frame, blocks, across, down, h, v in found:
        groups.setdefault((blocks, frame["restart"]), []).append((k, place, scan, frame, across, down, h, v))
    for (blocks, restart), images in groups.items():
        scan = np.frombuffer(b"".join(x[2] for x in images), np.uint8)
        full = np.flatnonzero(scan[:-1] == 255) if len(scan) else np.zeros(0, np.int64)
        after = scan[full + 1]
        marks = full[(after >= 0xD0) & (after <= 0xD7)]
        keep = np.ones(len(scan), bool)
        keep[full[after == 0] + 1] = False
        keep[marks] = keep[marks + 1] = False
        moved = np.cumsum(keep)
        lengths = np.array([len(x[2]) for x in images])
        begins = np.cumsum(lengths) - lengths
        start = np.sort(np.concatenate([begins, marks + 2]))
        start = np.where(start > 0, moved[np.maximum(start - 1, 0)], 0)
        clean = np.concatenate([scan[keep], np.full(8, 255, np.uint8)]).astype(np.uint32)
        words = (clean[:-3] << 24) | (clean[1:-2] << 16) | (clean[2:-1] << 8) | clean[3:]
        count = []
        for x in images:
            units, step = x[4] * x[5], restart or x[4] * x[5]
            count += [min(step, units - u) for u in range(0, units, step)]
        if len(count) != len(start):
            raise ValueError("restart markers don't fit the frame")
        terms = _lockstep(words, start, np.array(count), blocks)
        y = sum(b[0] for b in blocks)
        at = 0
        for k, place, _, frame, across, down, h, v in images:
            units, step = across * down, restart or across * down
            n = -(-units // step)
            flat = terms[at : at + n].reshape(-1) if units == n * step else np.concatenate([terms[at + s, : min(step, units - s * step) * y] for s in range(n)])
            at += n
            q = frame["quantisers"][frame["parts"][0][2]]
            grid = flat.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            grid = grid[: -(-frame["height"] // 8), : -(-frame["width"] // 8)]
            places[k][place] = (frame["width"], frame["height"], np.clip((grid * q + 1028) >> 3, 0, 255).astype(np.uint8))


def average_hash(grid: np.ndarray) -> str:
    """64 bits: which cells of an 8x8 reduction are brighter than their mean; 16 hex digits."""
    ends = lambda n: (np.arange(8) * n // 8, np.maximum(np.arange(1, 9) * n // 8, np.arange(8) * n // 8 + 1))
    (r0, r1), (c0, c1) = ends(grid.shape[0]), ends(grid.shape[1])
    # rows are first summed to a band each where there are many, so that sums don't take eight bytes a cell
    bands = np.array([grid[a:b].sum(0, dtype=np.int64) for a, b in zip(r0, r1, strict=True)]) if grid.size > _GROUP else None
    down = np.zeros(((8 if bands is not None else grid.shape[0]) + 1, grid.shape[1] + 1), np.int64)
    np.cumsum(np.cumsum(grid if bands is None else bands, 0, dtype=np.int64), 1, out=down[1:, 1:])
    a, b = (r0, r1) if bands is None else (np.arange(8), np.arange(1, 9))
    cells = down[np.ix_(b, c1)] - down[np.ix_(a, c1)] - down[np.ix_(b, c0)] + down[np.ix_(a, c0)]
    means = cells / np.outer(r1 - r0, c1 - c0)
    return np.packbits(means > means.mean()).tobytes().hex()


# ---- DataFrames -----------------------------------------------------------------------------------------------------


def store_text(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, media): every whole text as stored JPEG bytes. No shuffle."""
    schema = f"{id_column} {df.schema[id_column].dataType.simpleString()}, n_bytes long, media binary"

    def run(batches):
        for part in slices(batches, text, 1 << 20):
            raw = [(t or "").encode() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array(store([padded(r) for r in raw]), pa.binary())], [id_column, "n_bytes", "media"])

    return bounded(df).select(id_column, text).mapInArrow(run, schema)


_FEATURES = ["width", "height", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def media_features(df: DataFrame, media: str = "media") -> DataFrame:
    """The columns of ``df`` but ``media``, and what reading the stored bytes back gives: dimensions, payload digests, thumbnail hash."""
    df, _ = clear_of(df, _FEATURES)
    keep = [c for c in df.columns if c != media]
    schema = ddl(df.select(*map(quoted, keep))) + ", width int, height int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches):
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(len(keep))])
            group = np.cumsum(sizes) >> 21
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                medias = [x.as_buffer().to_pybytes() for x in part.column(len(keep))]
                out = []
                for data, images in zip(medias, thumbnails(medias), strict=True):
                    payload = b"".join([g.tobytes() for _, _, g in images])
                    grid = np.frombuffer(payload, np.uint8).reshape(-1, images[0][2].shape[1]) if len({g.shape[1] for _, _, g in images}) == 1 else images[0][2]
                    width, height = images[0][0], sum(h for _, h, _ in images)
                    out.append((width, height, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), f"{width}x{height}:{average_hash(grid)}"))
                types = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keep))), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], [*keep, *_FEATURES])

    return plainly(bounded(df), [*keep, media]).mapInArrow(run, schema)
