"""Exact removal of repeated byte strings over a whole corpus, by run-length indexes of the places where windows may meet.

Every window of `WINDOW` bytes has a key, the least hash of its grams of GRAM bytes; equal windows
have equal keys. A document's consecutive windows with one key form a segment (at most SPAN windows).
A window can only recur in a segment with the same key, so the segments that may hold one travel, each
content once, and a run-length index per group of keys tells which of their windows recur; a content
that occurs more than once is an entry of the index with a multiplicity.

A key with more than CROWDED bytes of different contents (a short passage in very many surroundings)
would make one index too large. Its segments are cut again where the distance from a window to its least
gram leaves a range of a fixed grid; all windows of a piece share a string of WINDOW bytes less the
range, whose hash is the piece's key. Equal windows have equal distances, so they still meet. Ranges
shrink by LEVELS until no key is crowded; pieces of one window have one content a key.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_filter, materialise, may_hold, read_table, release, small_batches, text_bytes
from .runindex import repeated_starts

WINDOW, GRAM = 400, 64
SPAN = WINDOW - GRAM + 1
#: Windows of a text handled at once, and bytes of segments in an index.
_STEP, _INDEX = 1 << 20, 1 << 18
#: A key with more bytes of different contents than this is divided; an index holds at most so many more than _INDEX.
CROWDED = 1 << 20
#: Distances in a piece, level by level.
LEVELS = (48, 7, 1)
_ODD = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def _rolling(b: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hashes mod 2^64 of all strings of `width` bytes, by doubling."""
    level, size, out, done = _BYTES[b], 1, None, 0
    while size <= width:
        if width & size:
            if out is None:
                out, done = level[: len(b) - size + 1], size
            else:
                out = out[: len(b) - done - size + 1] * np.uint64(pow(base, size, 1 << 64)) + level[done : done + len(b) - done - size + 1]
                done += size
        if size * 2 <= width:
            level = level[: len(level) - size] * np.uint64(pow(base, size, 1 << 64)) + level[size:]
        size *= 2
    return out


def _window_keys(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams' hashes, and their minimum over each window."""
    grams = _mixed(_rolling(b, GRAM, _ODD))
    low, size = grams, 1
    while size * 2 <= SPAN:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    n = len(b) - WINDOW + 1
    return grams, np.minimum(low[:n], low[SPAN - size : SPAN - size + n])


def segments(text: bytes) -> list[tuple[int, int, int, bytes, bool]]:
    """(first byte, end of bytes, key, 128-bit hash of the bytes, key occurs twice in it) of each segment; none if the text is shorter than a window."""
    out = []
    whole = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - WINDOW + 1, _STEP):
        b = whole[at : at + _STEP + WINDOW - 1]
        grams, keys = _window_keys(b)
        n = len(keys)
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(heads, n))
        pieces = -(-sizes // SPAN)
        which = np.repeat(np.arange(len(heads)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = heads[which] + nth * SPAN
        end = np.minimum(first + SPAN, heads[which] + sizes[which])
        key = keys[first]
        # where the keys occur among the grams
        names = np.unique(key)
        spot = np.flatnonzero(grams <= names[-1])
        idx = np.minimum(np.searchsorted(names, grams[spot]), len(names) - 1)
        good = names[idx] == grams[spot]
        places = np.sort(idx[good] * (len(grams) + 1) + spot[good])
        own = np.searchsorted(names, key) * (len(grams) + 1)
        twice = np.searchsorted(places, own + end + SPAN - 1) - np.searchsorted(places, own + first) > 1
        for f, e, k, t in zip((first + at).tolist(), (end + at + WINDOW - 1).tolist(), key.view(np.int64).tolist(), twice.tolist(), strict=True):
            out.append((f, e, k, xxhash.xxh3_128_digest(text[f:e]), t))
    return out


def _spans(flags: np.ndarray) -> np.ndarray:
    """The byte ranges (first, end) that the flagged windows cover, as rows."""
    at = np.flatnonzero(flags)
    if not len(at):
        return np.zeros((0, 2), np.int64)
    new = np.append(True, np.diff(at) > WINDOW)  # windows that touch or overlap cover one range
    return np.stack([at[new], at[np.append(new[1:], True)] + WINDOW], axis=1)


def pieces(segment: bytes, key: int, width: int) -> list[tuple[int, int, int, bytes]]:
    """(first byte, end of bytes, key, 128-bit hash of the bytes) of a segment's pieces of at most `width` distances to the least gram."""
    grams = _mixed(_rolling(np.frombuffer(segment, np.uint8), GRAM, _ODD))
    spots = np.flatnonzero(grams == np.uint64(key & _M))
    n = len(segment) - WINDOW + 1
    anchor = spots[np.searchsorted(spots, np.arange(n))]
    away = (anchor - np.arange(n)) // width
    heads = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (away[1:] != away[:-1])))
    out = []
    for f, e in zip(heads.tolist(), [*heads[1:].tolist(), n], strict=True):
        at, low = int(anchor[f]), int(away[f]) * width
        shared = segment[at - low : at + WINDOW - min(low + width, SPAN) + 1]
        k = xxhash.xxh64_intdigest(shared, (key ^ low * _ODD) & _M)
        out.append((f, e + WINDOW - 1, k - (k >> 63 << 64), xxhash.xxh3_128_digest(segment[f : e + WINDOW - 1])))
    return out


_SEGMENT = "doc_id long, t long, first long, end long, k long, g binary, twice boolean, n long"
_KINDS = (*[pa.int64()] * 5, pa.binary(), pa.bool_(), pa.int64())


def _batch(rows: list, kinds: tuple, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _segment_table(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [(i, t, *s, 1) for i, t, b in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True) for s in segments(b)]
            yield _batch(rows, _KINDS, _names(_SEGMENT))

    return docs.mapInArrow(run, _SEGMENT)


def _with_lists(docs: DataFrame, asked: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, t, b, s) of the documents that rows of asked (doc_id, t, ...) are about, s the array of their columns. Only these documents are shuffled."""
    wanted = bit_filter(asked, "t")

    def may(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(wanted, batch.column(1).to_numpy(zero_copy_only=False))))

    lists = asked.groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).agg(F.collect_list(F.struct(*columns)).alias("s"))  # at most as many as the text has windows
    held = docs.mapInArrow(may, "doc_id long, t long, b binary").join(lists, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")))
    return held.select("doc_id", "t", "b", "s")


def _piece_table(docs: DataFrame, crowded: DataFrame, width: int) -> DataFrame:
    """The pieces of contents (k, n, doc_id, t, first, end) of crowded keys, in the form of a segment table; a piece's windows differ from each other."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, t, b, lists in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                for s in lists:
                    found = pieces(b[s["first"] : s["end"]], s["top"], width)
                    rows += [(i, t, s["first"] + f, s["first"] + e, k, g, False, s["n"], s["top"]) for f, e, k, g in found]
            yield _batch(rows, (*_KINDS, pa.int64()), _names(_SEGMENT + ", top long"))

    return _with_lists(docs, crowded, "top", "n", "first", "end").mapInArrow(run, _SEGMENT + ", top long")


def _index_groups(parts: DataFrame) -> DataFrame:
    """parts: (k, g, n, doc_id, t, first, b) clustered and sorted by k -> the covered ranges of each content: of the document's bytes if n is 1, else (with g) of the content's."""
    schema = "doc_id long, t long, first long, end long, g binary"

    def flush(rows: list) -> pa.RecordBatch:
        out = []
        flags = repeated_starts([r[6] for r in rows], WINDOW, [r[2] for r in rows])
        for (_, g, n, i, t, first, _), f in zip(rows, flags, strict=True):
            spans = _spans(f).tolist()
            out += [(i, t, first + a, first + e, None) for a, e in spans] if n == 1 else [(None, None, a, e, g) for a, e in spans]
        return _batch(out, (*[pa.int64()] * 4, pa.binary()), _names(schema))

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if row[0] != last:
                    if size > _INDEX:
                        yield flush(held)
                        held, size = [], 0
                    last = row[0]
                held.append(row)
                size += len(row[6])
        if held:
            yield flush(held)

    return parts.mapInArrow(run, schema)


_CONTENT = ("k", "g", "n", "doc_id", "t", "first", "end")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, t, b), t a hash of the bytes -> one row (doc_id, t, ranges) per document with repeated windows, ranges an array of (first, end)."""
    tables, scratch, asked = [materialise(_segment_table(docs).withColumn("top", F.col("k")), "segments")], [], None
    for width in (*LEVELS, None):
        kinds = tables[-1].groupBy("k", "g").agg(F.sum("n").alias("n"), F.max("twice").alias("twice"), F.min(F.struct("doc_id", "t", "first", "end", "top")).alias("r"))
        kinds = materialise(kinds.select("k", "g", "n", "twice", "r.*"), "contents")
        keys = kinds.groupBy("k").agg(F.count("*").alias("kinds"), F.max("n").alias("most"), F.max("twice").alias("twice"), F.sum(F.expr("end - first")).alias("bytes"))
        keys = materialise(keys.where("kinds > 1 OR most > 1 OR twice").select("k", (F.col("bytes") > CROWDED).alias("crowded")), "keys")
        scratch += [kinds, keys]
        plain = kinds.join(keys.where("NOT crowded") if width else keys, "k", "left_semi").select(*_CONTENT)
        asked = plain if asked is None else asked.unionAll(plain)
        if not width or not keys.where("crowded").take(1):
            break
        crowded = kinds.join(keys.where("crowded"), "k", "left_semi")
        asked = asked.unionAll(crowded.where("n > 1").withColumn("k", F.xxhash64("g")).select(*_CONTENT))  # copies of a whole content meet by themselves
        tables.append(materialise(_piece_table(docs, crowded, width), "pieces"))
    asked = materialise(asked, "asked")

    def cut(batches):
        for batch in batches:
            rows = [(s["k"], s["g"], s["n"], i, t, s["first"], b[s["first"] : s["end"]]) for i, t, b, lists in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True) for s in lists]
            yield _batch(rows, (pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.binary()), ["k", "g", "n", "doc_id", "t", "first", "b"])

    parts = _with_lists(docs, asked, "k", "g", "n", "first", "end").mapInArrow(cut, "k long, g binary, n long, doc_id long, t long, first long, b binary")
    found = materialise(_index_groups(parts.repartition("k").sortWithinPartitions("k")), "found")
    copied = found.where("g IS NOT NULL").select("g", F.col("first").alias("a"), F.col("end").alias("e"))
    ranges = found.where("g IS NULL").select("doc_id", "t", "first", "end")
    for table in tables:  # what the index says of a content holds for each of its copies
        ranges = ranges.unionAll(table.select("doc_id", "t", F.col("first").alias("at"), "g").join(copied, "g").select("doc_id", "t", F.expr("at + a").alias("first"), F.expr("at + e").alias("end")))
    ranges = ranges.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("ranges"))
    out = materialise(ranges, "ranges")
    release(*tables, *scratch, asked, found)
    return out


def _kept(text: bytes, ranges: list[dict]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed, and what remains."""
    removed, runs, at, out = 0, 0, 0, []
    for r in ranges:
        first, end = max(r["first"], at), r["end"]
        if end <= at:
            continue
        if first > at or at == 0:
            runs += 1
            out.append(text[at:first])
        removed += end - first
        at = end
    return removed, runs, b"".join((*out, text[at:]))


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with keep_text the remaining bytes as `text`.

    The text is decoded as UTF-8; the parts of a character that a removal cut become U+FFFD.

    A byte goes if it lies in a string of WINDOW bytes that also starts anywhere else in the corpus, in
    the same document too. Null texts count as empty; texts shorter than a window are kept whole.
    Repeated rows count as separate documents (so their long texts go) and each give a row; a null
    doc_id is kept. Other columns are ignored, and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("t"), text_bytes(text_col).alias("b"))
    found = repeated_ranges(source)
    marked = bit_filter(found, "t")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * keep_text

    def results(ids, texts, ranges) -> pa.RecordBatch:
        rows = []
        for i, b, r in zip(ids, texts, ranges, strict=True):
            removed, runs, kept = _kept(b, r or [])
            rows.append((i, len(b), removed, runs, hashlib.sha256(kept).hexdigest(), *[kept.decode("utf-8", "replace")] * keep_text))
        return _batch(rows, (*[pa.int64()] * 4, *[pa.string()] * (1 + keep_text)), _names(schema))

    def clean(batches):
        for batch in batches:
            part = batch.filter(pa.array(~may_hold(marked, batch.column(1).to_numpy(zero_copy_only=False))))
            yield results(part.column(0).to_pylist(), part.column(2).to_pylist(), [None] * part.num_rows)

    def may(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marked, batch.column(1).to_numpy(zero_copy_only=False))))

    def dirty(batches):
        for batch in batches:
            yield results(*(batch.column(c).to_pylist() for c in range(3)))

    right = found.withColumnsRenamed({"doc_id": "_d", "t": "_t"})
    joined = source.mapInArrow(may, "doc_id long, t long, b binary").join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left")
    return source.mapInArrow(clean, schema).unionAll(joined.select("doc_id", "b", "ranges").mapInArrow(dirty, schema))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated(read_table(spark, sf_dir, "documents"), keep_text=True)
