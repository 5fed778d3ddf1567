"""GIF media columns: LZW decoding, palettes, disposal, transparency, timed frames, colour histograms.

``encode_gif`` stores bytes as 8-bit palette indices with the usual growing dictionary.  Code widths
depend only on the number of codes since the last clear code, so codes pack and unpack in numpy, a
clear-to-clear stretch at once; only the dictionary grows code by code.  ``decode_gif`` reads any
GIF, frame by frame: one canvas and one frame are in memory.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows

WIDTH, MAX_ROWS = 64, 65_535
GREY = bytes(v for i in range(256) for v in (i, i, i))


@dataclass
class Frame:
    """One frame: its rectangle's palette indices and the canvas after it was drawn."""

    left: int
    top: int
    indices: np.ndarray  # (rows, columns) uint8
    delay_cs: int
    start_cs: int
    canvas: np.ndarray  # (rows, columns, 4) uint8 RGBA

    def histogram(self, bins: int = 8) -> list[int]:
        """Counts per channel (red, green, blue) in equal bins, over opaque pixels of the canvas."""
        seen = self.canvas[self.canvas[..., 3] > 0]
        return [int(n) for c in range(3) for n in np.bincount(seen[:, c] // (256 // bins), minlength=bins)]


def pad(data: bytes, unit: int = 64) -> bytes:
    """Zero bytes up to a positive multiple of the unit."""
    return data + bytes(-len(data) % unit if data else unit)


def _sub_blocks(data: bytes) -> bytes:
    full = len(data) // 255
    body = np.empty((full, 256), np.uint8)
    body[:, 0] = 255
    body[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return body.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def _widths(bits: int) -> np.ndarray:
    """Widths of the codes after a clear code, until the dictionary of 4096 is full."""
    # Before the n-th code (from 0) the dictionary holds max(n - 1, 0) strings more than the first ones.
    held = (1 << bits) + 2 + np.maximum(np.arange(4096) - 1, 0)
    return np.minimum(np.maximum(np.ceil(np.log2(held + 1)).astype(np.int64), bits + 1), 12)


_FITS = {bits: _widths(bits) for bits in range(1, 12)}


def _bits_of(codes: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The bits of all codes, least significant first."""
    every = np.unpackbits(codes.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return every[np.arange(16) < widths[:, None]]


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """One LZW code stream, with a clear code first and whenever the dictionary is full."""
    clear, end = 1 << bits, (1 << bits) + 1
    codes: list[int] = [clear]
    sizes: list[int] = []  # codes of each stretch, its closing clear or end code included
    table: dict[int, int] = {}
    known, put = table.get, codes.append
    following, begun, prefix = end + 1, 1, data[0] if data else -1
    for value in data[1:]:
        key = prefix << 8 | value
        code = known(key)
        if code is not None:
            prefix = code
            continue
        put(prefix)
        prefix = value
        if following < 4096:
            table[key] = following
            following += 1
        else:
            put(clear)
            sizes.append(len(codes) - begun)
            table, following, begun = {}, end + 1, len(codes)
            known = table.get
    if prefix >= 0:
        codes.append(prefix)
    codes.append(end)
    sizes.append(len(codes) - begun)
    fits = _FITS[bits]
    widths = np.concatenate([[bits + 1], *(np.r_[fits[:n], np.full(max(n - len(fits), 0), 12)] for n in sizes)])
    return np.packbits(_bits_of(np.array(codes, np.int64), widths), bitorder="little").tobytes()


def lzw_decode(data: bytes, bits: int, n_pixels: int) -> np.ndarray:
    """Palette indices of one LZW code stream, n_pixels at most."""
    clear, end = 1 << bits, (1 << bits) + 1
    first = [bytes([i]) for i in range(clear)] + [b"", b""]
    windows = np.ndarray(len(data) + 1, "<u4", data + bytes(4), strides=(1,))
    fits = _FITS[bits]
    out: list[bytes] = []
    size = at = seen = 0  # bytes out, bit to read, codes since the clear code
    table, last = list(first), b""
    while size < n_pixels:
        widths = fits[seen:] if seen < len(fits) else np.full(4096, 12)
        stops = at + np.cumsum(widths)
        n = int(np.searchsorted(stops, 8 * len(data), side="right"))
        if not n:
            break
        starts = stops[:n] - widths[:n]
        codes = windows[starts >> 3] >> (starts & 7).astype(np.uint32) & ((1 << widths[:n]) - 1).astype(np.uint32)
        stop = np.flatnonzero((codes == clear) | (codes == end))
        used = int(stop[0]) if len(stop) else n
        part, begun = codes[:used].tolist(), len(out)
        if part and not last:
            if part[0] > end:
                raise ValueError("broken LZW stream")
            last = table[part[0]]
            out.append(last)
            part = part[1:]
        room = 4096 - len(table)
        grow, put = table.append, out.append
        for code in part[:room]:
            try:
                entry = table[code]
            except IndexError:
                if code > len(table):
                    raise ValueError("broken LZW stream") from None
                entry = last + last[:1]
            grow(last + entry[:1])
            put(entry)
            last = entry
        for code in part[room:]:
            last = table[code]
            put(last)
        size += sum(map(len, out[begun:]))
        at, seen = int(stops[used - 1]) if used else at, seen + used
        if len(stop):
            if codes[used] == end:
                break
            at, seen = int(stops[used]), 0
            table, last = list(first), b""
    return np.frombuffer(b"".join(out)[:n_pixels], np.uint8)


def encode_gif(payload: bytes, delay_cs: int = 10) -> bytes:
    """A GIF whose frames hold the payload (a positive multiple of 64 bytes) as indices of a grey palette."""
    samples = np.frombuffer(payload, np.uint8)
    rows = len(samples) // WIDTH
    tall = min(rows, MAX_ROWS)
    out = [b"GIF89a", WIDTH.to_bytes(2, "little"), tall.to_bytes(2, "little"), b"\xf7\0\0", GREY]
    for low in range(0, rows, MAX_ROWS):
        part = samples[low * WIDTH : (low + MAX_ROWS) * WIDTH]
        out.append(b"\x21\xf9\x04\x04" + delay_cs.to_bytes(2, "little") + b"\0\0")
        out.append(b"\x2c\0\0\0\0" + WIDTH.to_bytes(2, "little") + (len(part) // WIDTH).to_bytes(2, "little") + b"\0\x08")
        out.append(_sub_blocks(lzw_encode(part.tobytes())))
    return b"".join(out) + b";"


def decode_gif(data: bytes) -> Iterator[Frame]:
    """The frames one after the other, each with the canvas as shown: palette, transparency and the disposal of earlier frames applied."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    at, flags = 13, data[10]
    shared = None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        shared, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, clear_index, clock = 0, 0, -1, 0
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                bits = data[at + 3]
                disposal, delay = bits >> 2 & 7, int.from_bytes(data[at + 4 : at + 6], "little")
                clear_index = data[at + 6] if bits & 1 else -1
            at = _read_blocks(data, at + 2)[1]
            continue
        if data[at] != 0x2C:
            raise ValueError("broken GIF block")
        left, top, w, h = (int.from_bytes(data[at + i : at + i + 2], "little") for i in (1, 3, 5, 7))
        flags, at = data[at + 9], at + 10
        palette = shared
        if flags & 0x80:
            n = 3 << ((flags & 7) + 1)
            palette, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
        if palette is None:
            raise ValueError("no palette")
        code_bits = data[at]
        stream, at = _read_blocks(data, at + 1)
        got = lzw_decode(stream, code_bits, w * h)
        if len(got) < w * h:
            got = np.append(got, np.zeros(w * h - len(got), np.uint8))
        indices = got[: w * h].reshape(h, w)
        if flags & 0x40:
            order = [y for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(start, h, step)]
            plain = np.empty_like(indices)
            plain[order] = indices
            indices = plain
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        seen = indices[: area.shape[0], : area.shape[1]]
        rgb = palette[np.minimum(seen, len(palette) - 1)] if len(palette) < 256 else palette[seen]
        if clear_index >= 0:
            drawn = seen != clear_index
            area[..., :3][drawn] = rgb[drawn]
            area[..., 3][drawn] = 255
        else:
            area[..., :3] = rgb
            area[..., 3] = 255
        yield Frame(left, top, indices, delay, clock, canvas.copy())
        clock += delay
        if disposal == 2:
            canvas[top : top + h, left : left + w] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, clear_index = 0, 0, -1


def _read_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def text_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty) as a GIF.

    Texts of over 4 MB take several frames; repeated rows give repeated media; extra columns are
    ignored; an empty table gives an empty one.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, len(text or b""), encode_gif(pad(text or b""))

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, media binary")


def gif_frames(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per frame: key, frame, start and delay in hundredths of a second, size, RGBA canvas, histogram.

    A null, empty or broken medium gives, after the frames read before the break, one row with
    frame -1 and null columns, so that it stays visible.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, data in rows:
            try:
                for i, f in enumerate(decode_gif(data or b"")):
                    yield k, i, f.start_cs, f.delay_cs, f.canvas.shape[1], f.canvas.shape[0], f.canvas.tobytes(), f.histogram()
            except (ValueError, IndexError):
                yield (k, -1) + (None,) * 6

    return map_rows(media.select(key, "media"), run, f"{key} long, frame int, start_cs int, delay_cs int, width int, height int, rgba binary, histogram array<long>")


def media_digests(media: DataFrame) -> DataFrame:
    """Digest columns of each stored medium, read back through the decoder."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, n, data in rows:
            whole, size, tail, hist, count, clock, shape = hashlib.sha256(), 0, b"", np.zeros(24, np.int64), 0, 0, (0, 0)
            for f in decode_gif(data):
                part = f.indices.tobytes()
                whole.update(part)
                tail = (tail + part)[-64:]
                size, hist, clock, shape = size + len(part), hist + f.histogram(), clock + f.delay_cs, shape if count else f.canvas.shape
                count += 1
            feature = f"gif:{count}x{shape[1]}x{shape[0]}:{clock}cs:" + ",".join(map(str, hist))
            yield doc_id, n, size, whole.hexdigest(), zlib.crc32(tail), len(data), hashlib.sha256(data).hexdigest(), feature

    return map_rows(media.select("doc_id", "n_bytes", "media"), run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
