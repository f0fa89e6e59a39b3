"""Baseline JPEG in numpy: markers, Huffman scans, DC-only luminance thumbnails, thumbnail hashes.

A DC-only thumbnail has one sample per 8x8 block, the block's mean. All restart intervals of a batch of images are
decoded together, a symbol of each at a time, so the steps of Python are those of the longest interval. AC symbols
are decoded and skipped. Any baseline image is read: several components, sampling factors, scans and restart
intervals; images without restart markers are one interval each.

A payload of bytes is stored as grey images of 192 blocks a row: one byte is the mean of one block, with a DC quantum
of 8, so the thumbnail gives it back exactly. A payload over 192 * 8191 bytes is a sequence of images.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import spans, text_or_empty, utf8

ACROSS = 192
DOWN = 8191
BYTES_AT_ONCE = 2 << 20
# The numbers of codes by length, and their symbols, of the DC luminance table that the standard gives as typical.
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
DC_SYMBOLS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
# Only "end of block" occurs: one code of one bit.
AC_COUNTS = [1] + [0] * 15
AC_SYMBOLS = [0]


def _codes(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length), canonical."""
    out, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[symbols[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _window_table(counts: bytes, symbols: bytes) -> np.ndarray:
    """For each 16-bit window: length << 8 | symbol; 0 where no code fits."""
    out = np.zeros(1 << 16, np.int32)
    for s, (code, length) in _codes(list(counts), list(symbols)).items():
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | s
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


_CODE = _codes(DC_COUNTS, DC_SYMBOLS)
_DC_CODE = np.array([_CODE[s][0] for s in range(12)])
_DC_LENGTH = np.array([_CODE[s][1] for s in range(12)])
_SIZE = np.array([int(abs(d)).bit_length() for d in range(-256, 257)])
_TABLES = (
    _segment(0xDB, bytes([0] + [8] + [1] * 63))
    + _segment(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS]))
    + _segment(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS]))
    + _segment(0xDD, ACROSS.to_bytes(2, "big"))
)
_SCAN = _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))


def _entropy_rows(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes, stuffed, of rows of ACROSS samples; and where each row's bytes end."""
    value = samples.astype(np.int16) - 128
    diff = np.diff(value, axis=1, prepend=np.int16(0)).ravel().astype(np.int64)
    size = _SIZE[diff + 256]
    extra = np.where(diff < 0, diff + (1 << size) - 1, diff)
    word = (_DC_CODE[size] << size | extra) << 1  # the code, the extra bits, and a 0 that ends the block
    length = _DC_LENGTH[size] + size + 1
    per_row = length.reshape(-1, ACROSS).sum(axis=1)
    row_bytes = (per_row + 7) // 8
    row_end = np.cumsum(row_bytes)
    start = np.cumsum(length) - length
    first = start.reshape(-1, ACROSS)[:, :1]
    start = (start.reshape(-1, ACROSS) - first + (row_end - row_bytes)[:, None] * 8).ravel()
    raw = np.zeros(int(row_end[-1]) + 2, np.uint8)
    at, shifted = (start >> 3).reshape(-1, ACROSS).T, (word << (24 - (start & 7) - length)).reshape(-1, ACROSS).T
    for byte, value in zip(np.ascontiguousarray(at), np.ascontiguousarray(shifted), strict=True):  # a sample of every row; rows share no byte
        raw[byte] |= (value >> 16).astype(np.uint8)
        raw[byte + 1] |= (value >> 8).astype(np.uint8)
        raw[byte + 2] |= value.astype(np.uint8)
    raw = raw[: row_end[-1]]
    raw[row_end - 1] |= ((1 << (row_bytes * 8 - per_row)) - 1).astype(np.uint8)
    ff = np.flatnonzero(raw == 0xFF)
    return np.insert(raw, ff + 1, 0), row_end + np.searchsorted(ff, row_end)


def encode(payloads: list[bytes]) -> list[bytes]:
    """The stored form of payloads whose lengths are positive multiples of ACROSS."""
    data, ends = _entropy_rows(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ACROSS))
    raw, out, row = data.tobytes(), [], 0
    bounds = np.concatenate([[0], ends]).tolist()
    for p in payloads:
        parts = []
        left = len(p) // ACROSS
        while left:
            down = min(left, DOWN)
            frame = _segment(0xC0, bytes([8]) + (down * 8).to_bytes(2, "big") + (ACROSS * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))
            parts += [b"\xff\xd8", _TABLES, frame, _SCAN]
            for k in range(down):
                if k:
                    parts.append(bytes([0xFF, 0xD0 + (k - 1) % 8]))
                parts.append(raw[bounds[row + k] : bounds[row + k + 1]])
            parts.append(b"\xff\xd9")
            row, left = row + down, left - down
        out.append(b"".join(parts))
    return out


@dataclass
class Scan:
    """One scan of an image that holds luminance blocks. units: for each block of a unit, its component's place, DC and AC table."""

    image: int
    width: int
    height: int
    quantum: int
    across: int  # luminance blocks in a row of units
    h: int
    v: int
    units_across: int
    units_down: int
    restart: int
    units: list[tuple[int, bytes, bytes]]
    data: tuple[int, int]


def parse(raw: bytes, at: int, image: int) -> tuple[Scan | None, int]:
    """The luminance scan of the image that begins at `at`, and where the image ends."""
    if raw[at : at + 2] != b"\xff\xd8":
        raise ValueError("no image begins here")
    i, quanta, tables, restart, frame, found = at + 2, {}, {}, 0, None, None
    while True:
        while raw[i] != 0xFF or raw[i + 1] in (0x00, 0xFF):
            i += 1
        marker = raw[i + 1]
        if marker == 0xD9:
            return found, i + 2
        if 0xD0 <= marker <= 0xD7 or marker == 0x01:
            i += 2
            continue
        n = int.from_bytes(raw[i + 2 : i + 4], "big")
        body = raw[i + 4 : i + 2 + n]
        i += 2 + n
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quanta[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                count = sum(body[1:17])
                tables[body[0]] = body[1 : 17 + count]
                body = body[17 + count :]
        elif marker == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif marker in (0xC0, 0xC1):
            frame = (int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), {body[6 + 3 * k]: (k, body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])})
        elif 0xC2 <= marker <= 0xCF and marker != 0xCC and marker != 0xC8:
            raise ValueError("not a baseline image")
        elif marker == 0xDA:
            start = i
            while True:  # to the next marker that isn't a restart
                i = raw.index(b"\xff", i)
                if raw[i + 1] != 0 and not 0xD0 <= raw[i + 1] <= 0xD7:
                    break
                i += 2
            height, width, parts = frame
            chosen = [(body[1 + 2 * k], body[2 + 2 * k]) for k in range(body[0])]
            if found is None and any(parts[c][0] == 0 for c, _ in chosen):
                hmax, vmax = max(x[1] for x in parts.values()), max(x[2] for x in parts.values())
                _, h, v, q = next(x for x in parts.values() if x[0] == 0)
                if len(chosen) == 1:  # a scan of one component has its own blocks as units
                    ux, uy, uh, uv = -(-(-(-width * h // hmax)) // 8), -(-(-(-height * v // vmax)) // 8), 1, 1
                    units = [(0, tables[chosen[0][1] >> 4], tables[0x10 | chosen[0][1] & 15])]
                else:
                    ux, uy, uh, uv = -(-width // (8 * hmax)), -(-height // (8 * vmax)), h, v
                    units = [(parts[c][0], tables[t >> 4], tables[0x10 | t & 15]) for c, t in chosen for _ in range(parts[c][1] * parts[c][2])]
                found = Scan(image, width, height, quanta[q], ux * uh, uh, uv, ux, uy, restart, units, (start, i))


def decode(raw: bytes, scans: list[Scan]) -> list[np.ndarray]:
    """The DC-only luminance of each scan: a row of 8-bit samples for each row of blocks."""
    data = np.frombuffer(raw, np.uint8)
    starts, stops, owner, count = [], [], [], []
    keep = np.ones(len(data) + 1, bool)
    keep[-1] = False
    for k, s in enumerate(scans):
        a, b = s.data
        ff = a + np.flatnonzero(data[a : b - 1] == 0xFF)
        after = data[ff + 1]
        keep[ff[after == 0] + 1] = False
        cuts = ff[(after >= 0xD0) & (after <= 0xD7)]
        begins, ends = np.concatenate([[a], cuts + 2]), np.concatenate([cuts, [b]])
        whole = s.units_across * s.units_down
        each = s.restart or whole
        starts.append(begins)
        stops.append(ends)
        owner.append(np.full(len(begins), k))
        count.append(np.minimum(each, whole - each * np.arange(len(begins))))
    starts, stops, owner, count = (np.concatenate(x) for x in (starts, stops, owner, count))
    clean = np.concatenate([data[keep[: len(data)]], np.full(4, 0xFF, np.uint8)]).astype(np.int64)
    words = clean[:-3] << 24 | clean[1:-2] << 16 | clean[2:-1] << 8 | clean[3:]
    moved = np.concatenate([[0], np.cumsum(keep[: len(data)])])
    bit = moved[starts] * 8
    names = {t: n for n, t in enumerate(dict.fromkeys(t for s in scans for u in s.units for t in u[1:]))}
    windows = np.concatenate([_window_table(t[:16], t[16:]) for t in names])
    width = max(len(s.units) for s in scans)
    layout = np.zeros((len(scans), width, 3), np.int64)
    for k, s in enumerate(scans):
        layout[k, : len(s.units)] = [(c, names[d], names[a]) for c, d, a in s.units]
    size = np.array([len(s.units) for s in scans])
    luma = np.array([sum(u[0] == 0 for u in s.units) for s in scans])
    most = count * luma[owner]
    out_at = np.cumsum(most) - most
    out = np.zeros(int(most.sum()), np.int32)
    written = np.zeros(len(starts), np.int64)
    unit, block, coef = (np.zeros(len(starts), np.int64) for _ in range(3))
    last = np.zeros((len(starts), 4), np.int64)
    live = np.flatnonzero(count > 0)
    alike = (layout == layout[0]).all() and (size == size[0]).all()
    end = len(words) - 1
    while len(live):
        # one symbol of each interval
        bl, c = block[live], coef[live]
        comp, dc_table, ac_table = (layout[0, bl] if alike else layout[owner[live], bl]).T if width > 1 or not alike else layout[0, 0]
        at = bit[live]
        dc = c == 0
        all_dc, no_dc = dc.all(), not dc.any()
        table = dc_table if all_dc else ac_table if no_dc else np.where(dc, dc_table, ac_table)
        hit = windows[(table << 16) + ((words[np.minimum(at >> 3, end)] >> (16 - (at & 7))) & 0xFFFF)]
        at += hit >> 8
        symbol = hit & 0xFF
        if not hit.all():
            raise ValueError("a code that no table has")
        nbits = symbol & 15
        if not no_dc:
            extra = (words[np.minimum(at >> 3, end)] >> (32 - (at & 7) - nbits)) & ((1 << nbits) - 1)
            diff = np.where((nbits > 0) & (extra >> np.maximum(nbits - 1, 0) == 0), extra - (1 << nbits) + 1, extra)
            rows, of = (live, comp) if all_dc else (live[dc], comp[dc] if np.ndim(comp) else comp)
            last[rows, of] += diff if all_dc else diff[dc]
            y = rows if np.ndim(of) == 0 else rows[of == 0]
            out[out_at[y] + written[y]] = last[y, 0]
            written[y] += 1
        bit[live] = at + nbits
        if all_dc:
            coef[live] = 1
            continue
        c = np.where(dc, 1, np.where(symbol & 0xF0 == 0xF0, c + 16, np.where(nbits == 0, 64, c + (symbol >> 4) + 1)))
        done = c >= 64
        coef[live] = np.where(done, 0, c)
        bl = bl + done
        over = bl == (size[0] if alike else size[owner[live]])
        block[live] = np.where(over, 0, bl)
        unit[live] += over
        if over.any():
            live = live[unit[live] < count[live]]
    images, at = [], 0
    for s, n in zip(scans, np.bincount(owner, most, len(scans)).astype(int).tolist(), strict=True):
        dc = out[at : at + n].reshape(s.units_down, s.units_across, s.v, s.h).transpose(0, 2, 1, 3).reshape(s.units_down * s.v, s.units_across * s.h)
        images.append(np.clip((dc * s.quantum + 4 * (s.quantum % 8 != 0)) // 8 + 128, 0, 255).astype(np.uint8))
        at += n
    return images


def thumbnail_hashes(y: np.ndarray) -> tuple[int, int]:
    """(average hash, difference hash) of 64 bits: of 8 by 8 and 8 by 9 cell means of the thumbnail."""
    total = np.zeros((y.shape[0] + 1, y.shape[1] + 1))
    total[1:, 1:] = y.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)

    def cells(down: int, across: int) -> np.ndarray:
        r, c = np.arange(down + 1) * y.shape[0] // down, np.arange(across + 1) * y.shape[1] // across
        r1, c1 = np.maximum(r[1:], r[:-1] + 1), np.maximum(c[1:], c[:-1] + 1)
        sums = total[np.ix_(r1, c1)] - total[np.ix_(r[:-1], c1)] - total[np.ix_(r1, c[:-1])] + total[np.ix_(r[:-1], c[:-1])]
        return sums / np.outer(r1 - r[:-1], c1 - c[:-1])

    a, d = cells(8, 8), cells(8, 9)
    bits = lambda m: int.from_bytes(np.packbits(m.ravel()).tobytes(), "big")
    return bits(a > a.mean()), bits(d[:, 1:] > d[:, :-1])


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes, with blanks up to a positive multiple of ACROSS, as a JPEG. Null is an empty text."""

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            for i, j in spans(off, BYTES_AT_ONCE):
                bodies = [data[off[k] : off[k + 1]].tobytes() for k in range(i, j)]
                padded = [x.ljust(max(1, -(-len(x) // ACROSS)) * ACROSS) for x in bodies]
                yield pa.record_batch([b.column(0).slice(i, j - i), pa.array([len(x) for x in bodies], pa.int64()), pa.array(encode(padded), pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width long, height long, average_hash string, difference_hash string"


def features(media: DataFrame) -> DataFrame:
    """FEATURES of (doc_id, n_bytes, media): what the images' markers and thumbnails say. A sequence of images counts as one image, its thumbnails one below another. Media that isn't baseline JPEG or whose scan is damaged has null features; null media too. Repeated rows have equal features, an empty table has none."""

    def one(raw, scans, images):
        y = np.concatenate(images)
        body = y.tobytes()
        a, d = thumbnail_hashes(y)
        return [len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), scans[0].width, sum(s.height for s in scans), f"{a:016x}", f"{d:016x}"]

    def scans_of(raw: bytes, image: int) -> list[Scan]:
        at, got = 0, []
        try:
            while at < len(raw):
                s, at = parse(raw, at, image)
                if s is not None:
                    got.append(s)
        except (ValueError, IndexError, KeyError, TypeError):
            return []
        return got

    def rows_of(raws: list[bytes], of: list[list[Scan]]) -> list[list]:
        base = np.concatenate([[0], np.cumsum([len(x) for x in raws])]).tolist()
        scans = [replace(s, data=(s.data[0] + k, s.data[1] + k)) for k, got in zip(base, of, strict=False) for s in got]
        try:
            images = iter(decode(b"".join(raws), scans)) if scans else iter(())
        except (ValueError, IndexError, KeyError, TypeError):  # a damaged scan: halves, so that the others keep their features
            half = len(raws) // 2
            return rows_of(raws[:half], of[:half]) + rows_of(raws[half:], of[half:]) if half else [[None] * 9]
        return [one(x, got, [next(images) for _ in got]) if got else [None] * 9 for x, got in zip(raws, of, strict=True)]

    def run(batches):
        fields = FEATURES.replace(",", "").split()[::2]
        for b in batches:
            media = b.column(2).to_pylist()
            off = np.concatenate([[0], np.cumsum([len(x or b"") for x in media])])
            for i, j in spans(off, BYTES_AT_ONCE):
                raws = [x or b"" for x in media[i:j]]
                rows = rows_of(raws, [scans_of(x, k) for k, x in enumerate(raws)])
                cols = [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), *(pa.array(c) for c in zip(*rows, strict=True))]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.record_batch([c.cast(t) for c, t in zip(cols, kinds, strict=True)], fields)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
