"""Benchmark decontamination by template windows, with a check that slots are filled consistently.

Texts become streams of lower-cased words (A-Z and Latin-1; runs of letters or of digits) in which numbers, units after numbers and names (capitalised
words inside a sentence, and at its start also, beside the word itself) are typed placeholders. Windows of WINDOW words are hashed as they stand and
as templates and joined with those of the benchmark items. A document holds an item if along the
diagonals of the match at least CONTAINED of the item's windows are found. Windows found word for word
count in any case, those found as templates only if the slots of the diagonal are filled consistently
(each value of the item always with the same other value). So a copy with other numbers or names is
found, and one whose numbers or names don't fit together is only if enough of it is there word for word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_filter, may_hold, read_table, small_batches

WINDOW, CONTAINED = 5, 0.8
#: An item needs so many words to be searched for, and a window so many words that aren't placeholders.
LEAST_WORDS, LEAST_LITERAL = 4, 2
#: A table of flagged documents of at most so many rows is broadcast to drop them; a larger one is joined by shuffling.
BROADCAST_ROWS = 500_000

#: Units that make a slot after a number.
UNITS = frozenset("km m cm mm mi mile miles ft feet foot in inch inches yd yards kg g mg lb lbs pound pounds oz ounces t tons l ml litre litres liter liters gal gallon gallons s sec seconds min minutes h hr hour hours day days week weeks month months year years mph kph kmh w kw kwh v hz khz mhz ghz kb mb gb tb usd eur gbp dollars dollar euros euro cents cent percent".split())

_WORD, _CAPITAL, _NUMBER, _UNIT = range(4)
_P = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(64)]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GAP, _LETTER, _DIGIT = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _LETTER
_CLASS[0x80:] = _LETTER  # all letters beyond ASCII
_CLASS[[*b"0123456789"]] = _DIGIT
_MARKS = np.zeros(256, bool)
_MARKS[[*b".!?\n"]] = True
_INNER = np.zeros(256, bool)
_INNER[[*b".,:/"]] = True
#: Bytes of text in one pass, and of a word beyond which it is hashed by itself.
_CHUNK, _LONG_WORD = 1 << 20, 64


def _lowered(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with A-Z and the capitals of Latin-1 in lower case, and which they were."""
    upper = (b >= 65) & (b <= 90)
    latin = np.zeros(len(b), bool)
    latin[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
    upper |= latin
    return np.where(upper, b + 32, b).astype(np.uint8), upper


@dataclass
class _Tokens:
    """Words and numbers of a text: their bytes, hashes of the lower-cased form, kinds, and whether a sentence mark stands before."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    kind: np.ndarray
    after_mark: np.ndarray


def _tokens(data: bytes) -> _Tokens:
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        none = np.zeros(0, np.int64)
        return _Tokens(none, none, none.astype(np.uint64), none.astype(np.int8), none.astype(bool))
    low, upper = _lowered(b)
    kind = _CLASS[b]
    digit = kind == _DIGIT
    inner = np.zeros(len(b), bool)
    inner[1:-1] = _INNER[b[1:-1]] & digit[:-2] & digit[2:]
    kind[inner] = _DIGIT
    edge = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    stop = np.append(edge[1:], len(b))
    real = kind[edge] != _GAP
    start, end = edge[real], stop[real]
    size = end - start
    h = size.astype(np.uint64) * _BASE
    live = np.flatnonzero(size <= _LONG_WORD)
    for k in range(_LONG_WORD):
        live = live[size[live] > k]
        if not len(live):
            break
        h[live] = h[live] * _BASE + (low[start[live] + k] + np.uint64(1))
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    for k in np.flatnonzero(size > _LONG_WORD):
        h[k] = xxhash.xxh64_intdigest(low[start[k] : end[k]].tobytes())
    marks = np.concatenate([[0], np.cumsum(_MARKS[b] & ~inner)])
    before = np.append(0, end[:-1])
    capitals = np.concatenate([[0], np.cumsum(upper)])
    first = upper[start] | (b[start] == 0xC3) & upper[np.minimum(start + 1, len(b) - 1)]
    number = kind[start] == _DIGIT
    name = first & (capitals[end] - capitals[start] == 1) & (size > 1 + (b[start] == 0xC3)) & ~number
    what = np.where(number, _NUMBER, np.where(name, _CAPITAL, _WORD)).astype(np.int8)
    follows = np.flatnonzero(number[:-1]) + 1
    units = follows[np.isin(h[follows], _unit_hashes())]
    what[units] = _UNIT
    return _Tokens(start, end, h, what, (marks[start] > marks[before]) | (before == 0))


@lru_cache(maxsize=1)
def _unit_hashes() -> np.ndarray:
    out = []
    for unit in sorted(UNITS):
        h = np.array([len(unit)], np.uint64) * _BASE
        for c in unit.encode():
            h = h * _BASE + np.uint64(c + 1)
        out.append((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9))
    return np.concatenate(out)


def _long_tokens(data: bytes) -> _Tokens:
    """_tokens of a text of any length, in pieces cut before a space that follows a letter."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        while end < len(data) and not (data[end] == 32 and _CLASS[data[end - 1]] == _LETTER):
            end += 1
        t = _tokens(data[at:end])
        if at and len(t.after_mark):
            t.after_mark[0] = bool(_MARKS[np.frombuffer(data[at : at + int(t.start[0])], np.uint8)].any())
        parts.append(_Tokens(t.start + at, t.end + at, t.hash, t.kind, t.after_mark))
        at = end
    return parts[0] if len(parts) == 1 else _Tokens(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "end", "hash", "kind", "after_mark")))


def _sums(stream: np.ndarray, at: np.ndarray | None, width: int) -> np.ndarray:
    """Sums of the windows of a stream, of all or of those at some places; _mixed makes hashes of them."""
    out = np.zeros(len(stream) - width + 1 if at is None else len(at), np.uint64)
    for k in range(width):
        out += (stream[k : k + len(out)] if at is None else stream[at + k]) * _P[k]
    return out


def _mixed(out: np.ndarray) -> np.ndarray:
    out = out ^ out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


_SLOTS = np.array([0x0123456789ABCDEF, 0x1123456789ABCDEF, 0x2123456789ABCDEF, 0x3123456789ABCDEF], np.uint64)


#: Windows with more words at sentence starts than this are listed with none and with all of them as names.
_STARTS = 5


def _choices(bits: np.ndarray) -> list[int]:
    """The sets of offsets, as bits, that can be names where a sentence starts."""
    out = set()
    for b in np.unique(bits).tolist():
        part = b
        while part:
            out.add(part)
            part = part - 1 & b if b.bit_count() <= _STARTS else 0
    return sorted(out)


def template_windows(texts: list[bytes], width: int = WINDOW):
    """For a few texts: the text of each word, where texts start, their numbers of windows, and the plain and the template windows.

    The windows are lists of (position, hash, first word, words, names): names is None for plain ones,
    else which words at sentence starts are slots besides the others, as bits. A template window has
    slots. One of fewer than LEAST_LITERAL words besides is widened to the left, and to the right, until
    it has so many; it is left out only where the text, or len(_P) words, end before. A text of fewer
    words than a window is one window, one of fewer than LEAST_WORDS none. Slots are spelled by a
    function of first word, words and names, so only those asked for are.
    """
    whole = b"\n\x00\n".join(texts)
    t = _long_tokens(whole)
    sizes = np.array([len(x) + 3 for x in texts], np.int64)
    owner = np.searchsorted(np.cumsum(sizes), t.start, side="right")
    count = np.bincount(owner, minlength=len(texts))
    base = np.cumsum(count) - count
    starts = (t.kind == _CAPITAL) & t.after_mark
    slot = (t.kind != _WORD) & ~starts
    out = []

    def spell(at: int, n: int, names: int) -> str:
        return "\x1f".join(_lowered(np.frombuffer(whole[t.start[k] : t.end[k]], np.uint8))[0].tobytes().decode("utf-8", "replace") for k in range(at, at + n) if slot[k] or starts[k] and names >> k - at & 1)

    streams = [(0, slot, np.where(slot, _SLOTS[t.kind], t.hash)), (-1, slot | starts, np.where(slot | starts, _SLOTS[t.kind], t.hash))]
    if len(t.start) >= width:
        inside = owner[: len(t.start) - width + 1] == owner[width - 1 :]
        at = np.flatnonzero(inside)
        out.append((at, _mixed(_sums(t.hash, None, width))[at], at, width, None))
        filled = np.concatenate([[0], np.cumsum(slot)])
        n = filled[width:] - filled[:-width]
        sums = _sums(streams[0][2], None, width)
        at = np.flatnonzero(inside & (n > 0) & (width - n >= LEAST_LITERAL))
        out.append((at, _mixed(sums[at]), at, width, 0))
        bits = sum((starts[k : k + len(inside)].astype(np.uint64) << np.uint64(k) for k in range(width)), np.zeros(len(inside), np.uint64))
        some = np.flatnonzero(inside & (bits > 0))
        for names in _choices(bits[some]):
            at = some[(bits[some] & np.uint64(names) == np.uint64(names)) & (width - n[some] - names.bit_count() >= LEAST_LITERAL)]
            own = sums[at]
            for k in range(width):
                if names >> k & 1:
                    own += (_SLOTS[_CAPITAL] - t.hash[at + k]) * _P[k]
            out.append((at, _mixed(own), at, width, names))
        for names, slots, typed in streams:
            words = np.concatenate([[0], np.cumsum(~slots)])
            begun = np.concatenate([[0], np.cumsum(starts)])
            have = words[width:] - words[:-width]
            at = np.flatnonzero(inside & (have < width) & (have < LEAST_LITERAL))
            left = np.searchsorted(words, words[at + width] - LEAST_LITERAL, side="right") - 1
            right = np.searchsorted(words, words[at] + LEAST_LITERAL)
            low, high = base[owner[at]], base[owner[at]] + count[owner[at]]
            for k, first, last in ((1, left, at + width), (2, at, right)):
                good = (first >= low) & (last <= high) & (last - first <= len(_P))
                if names:  # without such words the window is in the first stream
                    good[good] = begun[last[good]] > begun[first[good]]
                where, first, wide = at[good], first[good], (last - first)[good]
                for w in np.unique(wide).tolist():
                    of = wide == w
                    out.append((where[of], _mixed(_sums(typed, first[of], w) + np.uint64(k)), first[of], w, names))
    for d in np.flatnonzero((count >= LEAST_WORDS) & (count < width)):
        at, w = np.array([base[d]]), int(count[d])
        out.append((at, _mixed(_sums(t.hash, at, w)), at, w, None))
        for names, slots, typed in streams:
            n = int(slots[at[0] : at[0] + w].sum())
            if n and w - n >= LEAST_LITERAL and (not names or starts[at[0] : at[0] + w].any()):
                out.append((at, _mixed(_sums(typed, at, w)), at, w, names))
    return owner, base, np.where(count >= LEAST_WORDS, np.maximum(count - width + 1, 1), 0), out, spell


_HIT = "h long, pos int, slots string"


def _window_rows(table: DataFrame, allowed: np.ndarray | None, width: int) -> DataFrame:
    """table: (id long, text string) -> (id, t, n, h, pos, slots) of each window that the filter lets pass; slots is null for plain windows."""

    def groups(ids: list, texts: list):
        held, size = [], 0
        for i, text in zip(ids, texts, strict=True):
            if text:
                held.append((i, text))
                size += len(text)
            if size > _CHUNK:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches):
        for batch in batches:
            rows = []
            for held in groups(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                owner, base, windows, found, spell = template_windows([x for _, x in held], width)
                known: dict[int, int] = {}
                for at, hashes, first, w, names in found:
                    if allowed is not None:
                        live = may_hold(allowed, hashes)
                        at, hashes, first = at[live], hashes[live], first[live]
                    for k, h, f, d in zip(at.tolist(), hashes.view(np.int64).tolist(), first.tolist(), owner[at].tolist(), strict=True):
                        if d not in known:
                            t = xxhash.xxh64_intdigest(held[d][1], 42)
                            known[d] = t - (t >> 63 << 64)
                        rows.append((held[d][0], known[d], int(windows[d]), h, k - int(base[d]), None if names is None else spell(f, w, names)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "t", "n", "h", "pos", "slots"])

    return table.toDF("id", "text").select("id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "id long, t long, n long, " + _HIT)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW, contained: float = CONTAINED) -> DataFrame:
    """One row (doc_id, item_id, kind, coverage, n_matched, n_windows, t) per document and item it holds.

    kind is 'verbatim' if all slots of the windows counted have the item's values, else 'reparameterised'; t is
    the hash of the document's text. Null and empty texts and items, and items of fewer than
    LEAST_WORDS words, match nothing. Repeated rows (same doc_id and text) give one row; a null doc_id
    or item_id is kept as such. Either table may be empty. Documents' windows are reduced by a filter
    of fixed size before the join, so only those that an item may hold are shuffled.
    """
    small_batches(docs.sparkSession)
    # an item's numbers of windows and slots stay together by its text's hash, should item_id repeat
    items = _window_rows(benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")), None, width)
    items = items.select(F.col("id").alias("item_id"), F.col("t").alias("item_t"), F.col("n").alias("n_windows"), "h", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    hits = _window_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), bit_filter(items, "h"), width)
    met = hits.withColumnRenamed("id", "doc_id").drop("n").join(items, "h").where(F.col("slots").isNull() == F.col("item_slots").isNull())
    pair = ["doc_id", "t", "item_id", "item_t", "n_windows"]
    lines = met.groupBy(*pair, (F.col("pos") - F.col("item_pos")).alias("line")).agg(
        F.collect_set(F.when(F.col("slots").isNull(), F.col("item_pos"))).alias("plain"),
        F.collect_set(F.when(F.col("slots").isNotNull(), F.struct("item_pos", "item_slots", "slots"))).alias("s"),
    )  # at most in proportion to the item's windows
    lines = lines.withColumn("m", F.array_distinct(F.flatten(F.transform("s", lambda x: F.zip_with(F.split(x["item_slots"], "\x1f"), F.split(x["slots"], "\x1f"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))))))
    fits = F.expr("size(array_distinct(m.a)) = size(m)")
    lines = lines.select(*pair, F.when(fits, F.array_union("plain", F.expr("s.item_pos"))).otherwise(F.col("plain")).alias("at"), (~fits | F.forall("m", lambda x: x["a"] == x["b"])).alias("same"))
    lines = lines.where(F.size("at") > 0)
    found = lines.groupBy(*pair).agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("n_matched"), F.every("same").alias("same"))
    found = found.where(F.col("n_matched") >= contained * F.col("n_windows")).withColumn("coverage", F.round(F.col("n_matched") / F.col("n_windows"), 6))
    best = found.groupBy("doc_id", "t", "item_id").agg(F.max(F.struct("coverage", "same", "n_matched", "n_windows")).alias("x"))
    return best.select("doc_id", "item_id", F.when(F.col("x.same"), "verbatim").otherwise("reparameterised").alias("kind"), "x.coverage", "x.n_matched", "x.n_windows", "t")


def drop_leaked(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, whose text holds no item. The flagged keys are broadcast only if they are few."""
    keys = leaks.select(F.coalesce("doc_id", F.lit(-1)).alias("_meshloom_d"), F.col("t").alias("_meshloom_t")).distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return docs.join(keys, (F.coalesce(F.col(id_col).cast("long"), F.lit(-1)) == F.col("_meshloom_d")) & (F.xxhash64(F.col(text_col)) == F.col("_meshloom_t")), "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("t")
