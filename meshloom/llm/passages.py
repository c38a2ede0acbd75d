"""Removal of word passages that documents with smaller ids hold already, by suffix automata of reference shards.

A document's references are all documents with smaller ids, so the reference is the corpus itself and has no
bounded size to broadcast. Windows of `WINDOW` words are therefore routed: a window's key is the least hash of its
grams of GRAM words, consecutive windows with one key form a segment, and only segments whose key other
documents have too travel, each content once, with the least id that has it. A task takes shards of at most
_SHARD words (more only for a single key, up to CROWDED) and streams their contents in the order of ids through
the suffix automaton of those before: where the matching statistic reaches WINDOW, a window ends that a
smaller id holds. A content's further copies go whole.

A key with more than CROWDED words of different contents is divided by the distance from a window to its least
gram, in ranges of LEVELS words; all windows of a piece share a string whose hash is the piece's key. At the
last level a piece is one window and a key has one content.

A separate reference of at most BROADCAST_WORDS words is broadcast as automata instead (`drop_known`), and
documents are streamed through them where they lie.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import materialise, may_hold, read_table, release, sized_filter, small_batches, text_bytes
from .substrings import _batch, _mixed, _names, _with_lists

WINDOW, GRAM = 50, 16
SPAN = WINDOW - GRAM + 1
#: Words of a shard, and of a key's different contents before it is divided.
_SHARD, CROWDED = 1 << 16, 1 << 17
#: Distances in a piece, level by level.
LEVELS = (8, 1)
#: Words of a reference that is broadcast.
BROADCAST_WORDS = 1 << 18
#: Bytes of a text that are split at once.
_STEP = 1 << 22
_ODD, _M = 0x9E3779B97F4A7C15, (1 << 64) - 1
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_lists(text: bytes):
    """The words of a text, some megabytes at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + _STEP)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()  # bytes are split at exactly these six characters
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in word_lists(text))])


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    b = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], (b != 32) & (b - np.uint8(9) > 4), [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _grams(hashes: np.ndarray) -> np.ndarray:
    n = len(hashes) - GRAM + 1
    mixed, out = _mixed(hashes), np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out * np.uint64(_ODD) + mixed[k : k + n]
    return _mixed(out)


def segments(hashes: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    """(first word, windows, key, 128-bit hash of the words) of each segment; none if there are fewer words than a window has."""
    n = len(hashes) - WINDOW + 1
    if n < 1:
        return []
    low, size = _grams(hashes), 1
    while size * 2 <= SPAN:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    keys = np.minimum(low[:n], low[SPAN - size : SPAN - size + n])
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    out = []
    for head, end, k in zip(heads.tolist(), [*heads[1:].tolist(), n], keys[heads].view(np.int64).tolist(), strict=True):
        for first in range(head, end, SPAN):  # a gram that recurs can keep its key for very long
            last = min(first + SPAN, end)
            out.append((first, last - first, k, xxhash.xxh3_128_digest(hashes[first : last + WINDOW - 1].tobytes())))
    return out


def pieces(hashes: np.ndarray, key: int, width: int) -> list[tuple[int, int, int, bytes]]:
    """The same of a segment's pieces of at most `width` distances from a window to its least gram."""
    n, spots = len(hashes) - WINDOW + 1, np.flatnonzero(_grams(hashes) == np.uint64(key & _M))
    anchor = spots[np.searchsorted(spots, np.arange(n))]
    away = (anchor - np.arange(n)) // width
    heads = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (away[1:] != away[:-1])))
    out = []
    for first, end in zip(heads.tolist(), [*heads[1:].tolist(), n], strict=True):
        at, low = int(anchor[first]), int(away[first]) * width
        shared = hashes[at - low : at + WINDOW - min(low + width, SPAN) + 1]
        k = xxhash.xxh64_intdigest(shared.tobytes(), (key ^ low * _ODD) & _M)
        out.append((first, end - first, k - (k >> 63 << 64), xxhash.xxh3_128_digest(hashes[first : end + WINDOW - 1].tobytes())))
    return out


#: A unit is a content to be judged: where it lies, and which part (from window `at`) of which segment content (pk, pg) it is. top: the key by whose gram a piece was cut.
_SEGMENT = "doc_id long, t long, first int, n int, k long, g binary"
_UNIT = _SEGMENT + ", pk long, pg binary, at int, top long"
_KIND = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _kinds(schema: str) -> tuple:
    return tuple(_KIND[x.split()[1]] for x in schema.split(", "))


def _segment_table(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [(i, t, *s) for i, t, b in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True) for s in segments(word_hashes(b))]
            yield _batch(rows, _kinds(_SEGMENT), _names(_SEGMENT))

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, _SEGMENT)


def _piece_table(docs: DataFrame, units: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = []
            for i, t, b, lists in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                words = word_hashes(b)
                for s in lists:
                    found = pieces(words[s["first"] : s["first"] + s["n"] + WINDOW - 1], s["top"], width)
                    rows += [(i, t, s["first"] + f, n, k, g, s["pk"], s["pg"], s["at"] + f, s["top"]) for f, n, k, g in found]
            yield _batch(rows, _kinds(_UNIT), _names(_UNIT))

    return _with_lists(docs, units, "first", "n", "pk", "pg", "at", "top").mapInArrow(run, _UNIT)


def known_windows(contents: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """contents: (id, words joined by spaces) -> for each the windows that a content with a smaller id holds."""
    ids, automaton, waiting, out = {}, SuffixAutomaton(), [], [None] * len(contents)
    for k in sorted(range(len(contents)), key=lambda k: contents[k][0]):
        words = [ids.setdefault(w, len(ids)) for w in contents[k][1].split(b" ")]
        if waiting and waiting[0][0] < contents[k][0]:  # one document's contents are no references to each other
            for _, before in waiting:
                automaton.add(before)
            waiting = []
        out[k] = np.flatnonzero(np.array(automaton.statistics(words, WINDOW)) == WINDOW) - (WINDOW - 1)
        waiting.append((contents[k][0], words))
    return out


def _runs(windows: np.ndarray) -> list[list[int]]:
    """Ranges (first, end) of consecutive windows."""
    if not len(windows):
        return []
    new = np.append(True, np.diff(windows) > 1)
    return np.stack([windows[new], windows[np.append(new[1:], True)] + 1], axis=1).tolist()


def _automaton_groups(parts: DataFrame) -> DataFrame:
    """parts: (k, g, doc_id, b) clustered and sorted by k -> ranges (a, e) of the known windows of each content."""
    schema = "k long, g binary, a int, e int"

    def flush(rows: list) -> pa.RecordBatch:
        found = known_windows([r[2:] for r in rows])
        return _batch([(k, g, *r) for (k, g, *_), w in zip(rows, found, strict=True) for r in _runs(w)], _kinds(schema), _names(schema))

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if row[0] != last:
                    if size > _SHARD:
                        yield flush(held)
                        held, size = [], 0
                    last = row[0]
                held.append(row)
                size += row[3].count(b" ") + 1
        if held:
            yield flush(held)

    return parts.mapInArrow(run, schema)


def _cut_words(docs: DataFrame, units: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = []
            for i, b, lists in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                first, end = word_places(b)
                rows += [(s["k"], s["g"], i, b" ".join(b[first[s["first"]] : end[s["first"] + s["n"] + WINDOW - 2]].split())) for s in lists]
            yield _batch(rows, (pa.int64(), pa.binary(), pa.int64(), pa.binary()), ["k", "g", "doc_id", "b"])

    return _with_lists(docs, units, "k", "g", "first", "n").mapInArrow(run, "k long, g binary, doc_id long, b binary")


def _only(table: DataFrame, keys: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(keys, batch.column("k").to_numpy(zero_copy_only=False))))

    return table.mapInArrow(run, table.schema)


def known_ranges(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, t, b), t a hash of the bytes -> one row (doc_id, t, ranges) per document with known windows, ranges an array of (first, end) of words."""
    table = materialise(_segment_table(docs), "segments")
    shared = materialise(table.groupBy("k").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("e")).where("a < e").select("k"), "shared")
    segments_ = table
    table = _only(table, sized_filter(shared, "k", shared.count()))
    contents = table.groupBy("k", "g").agg(F.min(F.struct("doc_id", "t", "first", "n")).alias("r"), F.max("doc_id").alias("last"))
    contents = materialise(contents.select("r.*", "k", "g", "last"), "contents")
    units = contents.select("doc_id", "t", "first", "n", "k", "g", F.col("k").alias("pk"), F.col("g").alias("pg"), F.lit(0).alias("at"), F.col("k").alias("top"))
    ranges, asked, scratch, judged = [], None, [shared, contents], []
    for width in (*LEVELS, None):
        kinds = units.groupBy("k", "g").agg(F.min(F.struct("doc_id", "t", "first", "n")).alias("r"))
        keys = kinds.groupBy("k").agg(F.count("*").alias("kinds"), F.sum(F.col("r.n") + WINDOW - 1).alias("words")).where("kinds > 1")
        keys = materialise(keys.select("k", (F.col("words") > CROWDED).alias("crowded")), "keys")
        scratch.append(keys)
        plain = kinds.join(keys.where("NOT crowded") if width else keys, "k", "left_semi").select("k", "g", "r.*")
        asked = plain if asked is None else asked.unionAll(plain)
        judged.append(units.select("k", "g", "pk", "pg", "at"))
        if not width or not keys.where("crowded").take(1):
            break
        pieces_ = materialise(_piece_table(docs, units.join(keys.where("crowded"), "k", "left_semi"), width), "pieces")
        least = pieces_.groupBy("k", "g").agg(F.min("doc_id").alias("least"))
        units = materialise(pieces_.join(least, ["k", "g"]), "units")
        scratch += [pieces_, units]
        ranges.append(units.where("doc_id > least").select("pk", "pg", F.col("at").alias("a"), F.expr("at + n").alias("e")))
        units = units.where("doc_id = least").drop("least")
    asked = materialise(asked, "asked")
    found = materialise(_automaton_groups(_cut_words(docs, asked).repartition("k").sortWithinPartitions("k")), "found")
    ranges += [u.join(found, ["k", "g"]).select("pk", "pg", F.expr("at + a").alias("a"), F.expr("at + e").alias("e")) for u in judged]
    whole = ranges[0]
    for more in ranges[1:]:
        whole = whole.unionAll(more)
    whole = whole.groupBy("pk", "pg").agg(F.collect_set(F.struct("a", "e")).alias("r")).withColumnsRenamed({"pk": "k", "pg": "g"})  # at most the windows of a segment, SPAN
    hits = contents.join(whole, ["k", "g"], "left").where("r IS NOT NULL OR last > doc_id").select("k", "g", F.col("doc_id").alias("least"), "r")
    spans = F.when(F.col("doc_id") > F.col("least"), F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("e")))).otherwise(F.col("r"))
    spans = F.transform(spans, lambda x: F.struct((F.col("first") + x["a"]).alias("first"), (F.col("first") + x["e"] + WINDOW - 1).alias("end")))
    out = table.join(hits, ["k", "g"]).select("doc_id", "t", F.explode(spans).alias("s")).groupBy("doc_id", "t").agg(F.sort_array(F.collect_set("s")).alias("ranges"))
    out = materialise(out, "ranges")
    release(segments_, *scratch, asked, found)
    return out


def _kept(text: bytes, ranges: list[dict]) -> tuple[int, int, str, bytes]:
    """Words, words removed, hash of the rest, and the rest; ranges are sorted by their first word."""
    spans = []
    for r in ranges:
        if spans and r["first"] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], r["end"])
        else:
            spans.append([r["first"], r["end"]])
    at = removed = nth = 0
    out = []
    for words in word_lists(text):
        end, kept, done = at + len(words), [], at
        while nth < len(spans) and spans[nth][0] < end:
            first, last = max(spans[nth][0], at), min(spans[nth][1], end)
            kept += words[done - at : first - at]
            removed += last - first
            done = last
            if spans[nth][1] > end:
                break
            nth += 1
        kept += words[done - at :]
        out += [b" ".join(kept)] * bool(kept)
        at = end
    rest = b" ".join(out)
    return at, removed, hashlib.sha256(rest).hexdigest(), rest


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _results(ids: list, texts: list, ranges: list, keep_text: bool) -> pa.RecordBatch:
    rows = []
    for i, b, r in zip(ids, texts, ranges, strict=True):
        n, removed, digest, rest = _kept(b, r or [])
        rows.append((i, n, removed, digest, *[rest.decode()] * keep_text))
    return _batch(rows, (*[pa.int64()] * 3, *[pa.string()] * (1 + keep_text)), [*_names(_RESULT), *["text"] * keep_text])


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("t"), text_bytes(text_col).alias("b"))


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with keep_text the remaining words, joined by spaces, as `text`.

    A word goes if a window of WINDOW words covers it that also starts in a document with a smaller doc_id.
    A null text has no words; texts of fewer words than a window stay whole. Rows with the same doc_id don't
    remove each other's words, whatever their texts; a row without doc_id stays whole and is no reference.
    Other columns are ignored, and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    source = _source(docs, id_col, text_col)
    found = known_ranges(source)
    marked = sized_filter(found, "t", found.count())
    schema = _RESULT + ", text string" * keep_text

    def clean(batches):
        for batch in batches:
            part = batch.filter(pa.array(~may_hold(marked, batch.column(1).to_numpy(zero_copy_only=False))))
            yield _results(part.column(0).to_pylist(), part.column(2).to_pylist(), [None] * part.num_rows, keep_text)

    def may(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marked, batch.column(1).to_numpy(zero_copy_only=False))))

    def dirty(batches):
        for batch in batches:
            yield _results(*(batch.column(c).to_pylist() for c in range(3)), keep_text)

    right = found.withColumnsRenamed({"doc_id": "_d", "t": "_t"})
    joined = source.mapInArrow(may, "doc_id long, t long, b binary").join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left")
    return source.mapInArrow(clean, schema).unionAll(joined.select("doc_id", "b", "ranges").mapInArrow(dirty, schema))


def drop_known(docs: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text", reference_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The same result where what goes are windows that any text of `reference` holds, whatever its ids.

    A reference of at most BROADCAST_WORDS words is built into suffix automata of shards in tasks and broadcast;
    each document is streamed through every shard, and its maximal spans go. A longer one is routed by keys with the
    documents, as texts before all of them. Null texts of either side have no words; documents of one doc_id
    and without one are treated like all others.
    """
    small_batches(docs.sparkSession)
    texts = reference.select(text_bytes(reference_col).alias("b"))

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, word_lists(b))) for b in batch.column(0).to_pylist()], pa.int64())], ["n"])

    words = texts.mapInArrow(count, "n long").agg(F.sum("n").alias("n")).first().n or 0
    schema = _RESULT + ", text string" * keep_text
    source = _source(docs, id_col, text_col)
    if words > BROADCAST_WORDS:
        rows = source.withColumn("own", F.lit(1)).unionAll(texts.select(F.lit(0).cast("long").alias("doc_id"), F.xxhash64("b").alias("t"), "b", F.lit(0).alias("own")))
        found = known_ranges(rows.dropDuplicates(["own", "t"]).select(F.col("own").cast("long").alias("doc_id"), "t", "b")).where("doc_id = 1").select(F.col("t").alias("_t"), "ranges")
        joined = source.join(found, F.col("t") == F.col("_t"), "left").select("doc_id", "b", "ranges")

        def known(batches):
            for batch in batches:
                yield _results(*(batch.column(c).to_pylist() for c in range(3)), keep_text)

        return joined.mapInArrow(known, schema)

    def build(batches):
        ids, automaton, size = {}, SuffixAutomaton(), 0
        for batch in batches:
            for b in batch.column(0).to_pylist():
                part = [ids.setdefault(w, len(ids)) for words in word_lists(b) for w in words]
                automaton.add(part)
                size += len(part)
                if size > _SHARD:
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((ids, automaton.next, automaton.link, automaton.size))], pa.binary())], ["a"])
                    ids, automaton, size = {}, SuffixAutomaton(), 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((ids, automaton.next, automaton.link, automaton.size))], pa.binary())], ["a"])

    shards = docs.sparkSession.sparkContext.broadcast([r.a for r in texts.mapInArrow(build, "a binary").collect()])

    def stream(batches):
        automata = []
        for ids, *parts in map(pickle.loads, shards.value):
            automaton = SuffixAutomaton()
            automaton.next, automaton.link, automaton.size = parts
            automata.append((ids, automaton))
        for batch in batches:
            ranges = []
            for b in batch.column(2).to_pylist():
                words, known = [w for part in word_lists(b) for w in part], set()
                for ids, automaton in automata:
                    known.update(np.flatnonzero(np.array(automaton.statistics([ids.get(w, -1) for w in words], WINDOW)) == WINDOW).tolist())
                ranges.append([{"first": a - WINDOW + 1, "end": e} for a, e in _runs(np.array(sorted(known), np.int64))])
            yield _results(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ranges, keep_text)

    return source.mapInArrow(stream, schema)


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_passages(read_table(spark, sf_dir, "documents"), keep_text=True)


def oracle() -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
known AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN known USING (h) WHERE least < doc_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256, coalesce(kept.text, '') AS text FROM d LEFT JOIN kept USING (r)"""
