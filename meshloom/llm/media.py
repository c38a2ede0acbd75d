"""Media columns: PNG images in binary columns, decoded from their chunks, with low-frequency cosine-transform hashes."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches, text_bytes

#: Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}

WIDTH = 192
_IDAT = 1 << 20
_FLUSH = 16 << 20


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _predict(kind: int, left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """The prediction of a filter from three neighbours, given as int16."""
    if kind == 3:
        return (left + up) // 2
    p = left + up - corner
    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))


def _filtered(rows: np.ndarray, kind: int, bpp: int) -> np.ndarray:
    wide = rows.astype(np.int16)
    up = np.vstack([np.zeros_like(wide[:1]), wide[:-1]])
    shift = lambda x: np.hstack([np.zeros((len(x), bpp), np.int16), x[:, :-bpp]])
    if kind == 0:
        return rows
    if kind == 1:
        return (wide - shift(wide)).astype(np.uint8)
    if kind == 2:
        return (wide - up).astype(np.uint8)
    return (wide - _predict(kind, shift(wide), up, shift(up))).astype(np.uint8)


#: Filters that the adaptive choice tries (fixed numbers of the format: none, left, up).
_TRIED = (0, 1, 2)


def _adaptive(rows: np.ndarray, bpp: int) -> np.ndarray:
    """Each row with the filter whose differences are least in sum, its number before it."""
    tried = [_filtered(rows, kind, bpp) for kind in _TRIED]
    cost = np.stack([np.abs(x.view(np.int8).astype(np.int16)).sum(axis=1, dtype=np.int64) for x in tried])
    best = cost.argmin(axis=0)
    out = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    for kind, x in zip(_TRIED, tried, strict=True):
        own = best == kind
        out[own, 0], out[own, 1:] = kind, x[own]
    return out


def encode_png(samples: bytes, width: int = WIDTH, color: int = 0, filters: int | None = None, level: int = 1) -> bytes:
    """A PNG of 8-bit samples, width pixels wide, with one filter or the best for each row; len(samples) is a positive multiple of width * channels."""
    bpp = CHANNELS[color]
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width * bpp)
    if filters is None:
        raw = _adaptive(rows, bpp)
    else:
        raw = np.empty((rows.shape[0], rows.shape[1] + 1), np.uint8)
        raw[:, 0], raw[:, 1:] = filters, _filtered(rows, filters, bpp)
    packed = zlib.compress(raw.data, level)
    head = struct.pack(">IIBBBBB", width, len(rows), 8, color, 0, 0, 0)
    body = b"".join(_chunk(b"IDAT", packed[at : at + _IDAT]) for at in range(0, len(packed), _IDAT))
    return SIGNATURE + _chunk(b"IHDR", head) + body + _chunk(b"IEND", b"")


def _by_diagonals(kinds: np.ndarray, rows: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Undo filters 0 to 4 of rows (height, width, channels), a diagonal at a time: its pixels depend on the two before only."""
    h, w, c = rows.shape
    done = np.zeros((h + 1, w + 1, c), np.int16)
    done[0, 1:] = above.reshape(w, c)
    kind = kinds.astype(np.int16)[:, None]
    for t in range(h + w - 1):
        y = np.arange(max(0, t - w + 1), min(h, t + 1))
        x = t - y
        left, up, k = done[y + 1, x], done[y, x + 1], kind[y]
        paeth = _predict(4, left, up, done[y, x]) if (k == 4).any() else 0
        guess = np.select([k == 1, k == 2, k == 3, k == 4], [left, up, (left + up) // 2, paeth], 0)
        done[y + 1, x + 1] = (rows[y, x] + guess) & 255
    return done[1:, 1:].astype(np.uint8)


def _unfiltered(raw: np.ndarray, bpp: int) -> np.ndarray:
    kinds, out = raw[:, 0], raw[:, 1:].copy()
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    hard = kinds > 2
    sort = np.where(hard, 3, kinds)
    cuts = np.flatnonzero(np.diff(sort)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(kinds)], strict=True):
        kind, rows = sort[start], out[start:end]
        above = out[start - 1] if start else np.zeros(out.shape[1], np.uint8)
        if kind == 1:
            rows[:] = np.cumsum(rows.reshape(len(rows), -1, bpp), axis=1, dtype=np.uint8).reshape(rows.shape)
        elif kind == 2:
            rows[0] += above
            rows[:] = np.cumsum(rows, axis=0, dtype=np.uint8)
        elif kind == 3:
            rows[:] = _by_diagonals(kinds[start:end], rows.reshape(len(rows), -1, bpp), above).reshape(rows.shape)
    return out


def decode_png(media: bytes) -> np.ndarray:
    """The samples of an 8-bit PNG as an array (height, width * channels); raises ValueError if a chunk, its checksum or its size is wrong."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, packed, ended = 8, None, [], False
    while at + 12 <= len(media) and not ended:
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if len(body) != size or media[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(body, zlib.crc32(kind))):
            raise ValueError(f"bad checksum in {kind!r}")
        if kind == b"IHDR" and size != 13:
            raise ValueError("bad header")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if not head or not ended:
        raise ValueError("incomplete PNG")
    width, height, depth, color, _, _, interlace = head
    if depth != 8 or color not in CHANNELS or interlace:
        raise ValueError("only plain 8-bit samples are read")
    line = width * CHANNELS[color] + 1
    try:
        raw = np.frombuffer(zlib.decompressobj().decompress(b"".join(packed), height * line + 1), np.uint8)
    except zlib.error as broken:
        raise ValueError("bad compressed data") from broken
    if not width or not height or len(raw) != height * line:
        raise ValueError("wrong number of samples")
    return _unfiltered(raw.reshape(height, width * CHANNELS[color] + 1), CHANNELS[color])


def _means(x: np.ndarray, n: int) -> np.ndarray:
    """Reduce the first axis to n bins by their means; fewer rows than bins are repeated."""
    if len(x) < n:
        return x[np.arange(n) * len(x) // n]
    at = np.arange(n) * len(x) // n
    return np.add.reduceat(x, at, axis=0) / np.diff(np.append(at, len(x)))[:, None]


_COSINES = np.cos(np.pi * np.outer(np.arange(8), 2 * np.arange(32) + 1) / 64)


def cosine_hash(gray: np.ndarray) -> str:
    """64 bits: which of the 8 x 8 lowest coefficients of the 32 x 32 means exceed their median (the constant term left out of it)."""
    small = _means(_means(gray.astype(np.float64), 32).T, 32).T
    low = np.round(_COSINES @ small @ _COSINES.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_bytes, media) per document: its text, null as empty, padded with spaces and stored as a grey PNG.

    Every row is kept, repeated ones and null doc_id too; equal texts give equal images. Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            ids, sizes, media, held = [], [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                sizes.append(len(text))
                media.append(encode_png(text + b" " * (WIDTH if not text else -len(text) % WIDTH)))
                held += len(media[-1])
                if held > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])
                    ids, sizes, media, held = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def media_features(media: DataFrame) -> DataFrame:
    """Read each image of (doc_id, n_bytes, media) back from its stored bytes and describe it.

    A null image gives null features. A damaged one (a wrong signature, checksum, size or filter) gives
    its media_bytes and media_sha256, null for what can't be read, and the reason in error.
    """

    def features(stored: bytes | None) -> tuple:
        if stored is None:
            return (None,) * 7
        kept = (len(stored), hashlib.sha256(stored).hexdigest())
        try:
            gray = decode_png(stored)
        except ValueError as broken:
            return None, None, None, *kept, None, str(broken)
        payload = gray.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), *kept, cosine_hash(gray), None

    def run(batches):
        for batch in batches:
            columns = list(zip(*map(features, batch.column(2).to_pylist()), strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [x.split()[0] for x in _FEATURES.split(", ")])

    small_batches(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, _FEATURES)


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(encode_media(read_table(spark, sf_dir, "documents")))
