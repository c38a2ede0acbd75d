"""Audit of how the sources of a language differ in their words.

Terms are counted by (language, source), dealt out by ranges of (language, term) and sorted there, so that a
chunk of a language's kept terms is a sorted array: a term's id is its place in it, ids are in the order of the
terms' UTF-8, and counts become dense vectors of one chunk, one a source. All that a task holds is a chunk
of at most CHUNK terms and the names of a language's sources; the vocabulary as a whole is never in one place.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, release, small_batches, text_bytes

#: Documents of a language that must hold a term, the pseudo-count, the unit of shares, and ranks of terms that are listed.
LEAST_DOCS, PSEUDO, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: Terms of a chunk, entries (term and source) after which one ends early, sources that are compared at once.
CHUNK, _ENTRIES, _BLOCK = 1024, 1 << 18, 128
#: Bytes of a text that are split at once.
_STEP = 4 << 20
#: A to Z in lower case, a to z and the bytes from 0x80 stay, all else separates terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term binary, n long, df long"
_CHUNKS = "lang string, terms array<binary>, names array<string>, totals array<long>, s array<int>, id array<int>, n array<long>"
_FOUND = "part string, lang string, a string, b string, term binary, value long"


def _term_lists(text: bytes):
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + _STEP)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """docs: (lang, source, b) -> occurrences and documents of each (lang, source, term)."""

    def run(batches):
        for batch in batches:
            found = {}
            for lang, source, b in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n, df = found.setdefault((lang, source), (Counter(), Counter()))
                once = set()
                for terms in _term_lists(b):
                    n.update(terms)
                    once.update(terms)
                df.update(once)
            for (lang, source), (n, df) in found.items():
                columns = [lang] * len(n), [source] * len(n), list(n), list(n.values()), [df[t] for t in n]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["lang", "source", "term", "n", "df"])

    return docs.mapInArrow(run, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _encode(lang: str, rows: list[tuple]) -> list:
    """A chunk's rows (source, term, n), sorted by term: the sorted terms and sources, and the entries as places in both."""
    sources, entries, n = (np.array(c, dtype=k) for c, k in zip(zip(*rows, strict=True), (object, object, np.int64), strict=True))
    terms, names = (np.array(sorted(set(x.tolist())), object) for x in (entries, sources))
    s, ids = np.searchsorted(names, sources), np.searchsorted(terms, entries)
    totals = np.zeros(len(names), np.int64)
    np.add.at(totals, s, n)
    return [lang, terms.tolist(), names.tolist(), totals.tolist(), s.tolist(), ids.tolist(), n.tolist()]


def term_chunks(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Chunks of the kept terms. The counts of a term lie side by side, so no join tells which terms are kept."""
    kinds = (pa.string(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
    fields = [x.split()[0] for x in _CHUNKS.split(", ")]

    def as_batch(lang, rows):
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(_encode(lang, rows), kinds, strict=True)], fields)

    def run(batches):
        at, term, df, chunk, width = None, [], 0, [], 0  # language, rows and documents of the last term, rows and terms of the chunk
        for batch in batches:
            for lang, source, t, n, d in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if term and (lang != at or t != term[0][1]):
                    if df >= least:
                        chunk, width = chunk + term, width + 1
                    if chunk and (lang != at or width == CHUNK or len(chunk) > _ENTRIES):
                        yield as_batch(at, chunk)
                        chunk, width = [], 0
                    term, df = [], 0
                at = lang
                term.append((source, t, n))
                df += d
        if df >= least:
            chunk = chunk + term
        if chunk:
            yield as_batch(at, chunk)

    return counts.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term", "source").mapInArrow(run, _CHUNKS)


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + PSEUDO) / whole), exactly; whole is at least count + PSEUDO."""
    a, b = np.broadcast_arrays(count + PSEUDO, whole)
    if len(a) and b.max() > 1 << 53:
        return np.array([1 + UNIT * int(x) // int(y) for x, y in zip(a, b, strict=True)], np.int64)
    out, rest = np.divmod(a, b)
    for _ in range(3):  # three decimal digits at a time fit in 64 bits
        digits, rest = np.divmod(rest * 1000, b)
        out = out * 1000 + digits
    return out + 1


def compare_chunk(names: list, n: list, kept: int, chunk: dict):
    """Yields ("pair", i, j, None, sum of differences), i < j, and ("term", i, None, id, difference) of one chunk; names and n are the language's sources, sorted, and their totals."""
    totals, width = np.array(n, np.int64), len(chunk["terms"])
    whole = totals + PSEUDO * kept
    base = shares(np.zeros(len(names), np.int64), whole)  # of a term that a source doesn't hold
    s = np.searchsorted(np.array(names, object), np.array(chunk["names"], object))[np.array(chunk["s"], np.int64)]
    ids, count = np.array(chunk["id"], np.int64), np.array(chunk["n"], np.int64)
    p = shares(count, whole[s])
    every = np.zeros(width, np.int64)
    np.add.at(every, ids, count)
    more = p - shares(every, np.full(width, totals.sum() + PSEUDO * kept))[ids]
    order = np.lexsort((ids, -more, s))
    order = order[more[order] > 0]
    heads = np.flatnonzero(np.append(True, s[order][1:] != s[order][:-1])) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    for k in order[nth < TOP].tolist():
        yield "term", int(s[k]), None, int(ids[k]), int(more[k])

    def dense(first):
        rows = np.repeat(base[first : first + _BLOCK, None], width, axis=1)
        inside = (s >= first) & (s < first + _BLOCK)
        rows[s[inside] - first, ids[inside]] = p[inside]
        return rows

    for one in range(0, len(names), _BLOCK):
        left = dense(one)
        for two in range(one, len(names), _BLOCK):
            right = left if two == one else dense(two)
            for i in range(len(left)):
                later = i + 1 if two == one else 0
                for j, value in enumerate(np.abs(right[later:] - left[i]).sum(axis=1).tolist(), two + later):
                    yield "pair", one + i, j, None, value


def _compare(chunks: DataFrame, langs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names = [x["source"] for x in row["groups"]]
                found = list(compare_chunk(names, [x["n"] for x in row["groups"]], row["kept"], row))
                if not found:
                    continue
                part, i, j, ids, value = zip(*found, strict=True)
                columns = part, [row["lang"]] * len(part), [names[x] for x in i], [None if x is None else names[x] for x in j], [None if x is None else row["terms"][x] for x in ids], value
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (*[pa.string()] * 4, pa.binary(), pa.int64()), strict=True)], [x.split()[0] for x in _FOUND.split(", ")])

    return chunks.join(langs, "lang").mapInArrow(run, _FOUND)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: how far a source's shares of the kept terms lie from other sources' and which terms it has too often.

    Part `pair` gives each other source of the language with the sum of all differences, part `term` the
    TOP terms whose share exceeds the language's. A language keeps the terms that `least` of its rows hold
    (a repeated row counts each time). Nulls count as empty strings, which are a language or source like
    any other; one whose texts hold no kept term has rows in part `pair` only, and a language's only source
    has none there. A language without kept terms gives pairs of value 0. Other columns are ignored, an empty
    table gives no rows. A language's names of sources are one array: its result has the square of their number.
    """
    small_batches(docs.sparkSession)
    plain = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    source = docs.select(plain(lang_col, "lang"), plain(source_col, "source"), text_bytes(text_col).alias("b"))
    chunks = materialise(term_chunks(count_terms(source), least), "chunks")
    held = chunks.select("lang", F.explode(F.arrays_zip("names", "totals")).alias("x")).groupBy("lang", F.col("x.names").alias("source")).agg(F.sum("x.totals").alias("n"))
    groups = source.select("lang", "source").distinct().join(held, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    kept = chunks.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups")).join(kept, "lang", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    langs = materialise(langs, "langs")
    found = materialise(_compare(chunks, langs), "found")
    pairs = found.where("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value").select("lang", "x.source", "x.item", "value")
    same = langs.where("kept = 0").select("lang", F.explode("groups.source").alias("source"), F.col("groups.source").alias("items"))
    same = same.select("lang", "source", F.explode("items").alias("item"), F.lit(0).cast("long").alias("value")).where("source <> item")
    terms = found.where("part = 'term'").select("lang", F.col("a").alias("source"), F.col("term").cast("string").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.unionAll(same).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank.alias("rank")).where(F.col("rank") <= TOP)
    release(chunks)
    return pairs.unionAll(terms)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


def oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = f"CAST(1 + CAST({UNIT} AS HUGEINT) * ({{n}} + {PSEUDO}) // ({{whole}} + {PSEUDO} * kept) AS BIGINT)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT l.lang, count(k.term) AS kept FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k ON k.lang = l.lang GROUP BY l.lang),
c AS (SELECT t.lang, t.source, t.term, CAST(count(*) AS HUGEINT) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
g AS (SELECT d.lang, d.source, kept, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) d JOIN v ON v.lang = d.lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share.format(n="coalesce(c.n, 0)", whole="total")} AS p
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, {share.format(n="n", whole="total")} AS q FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY lang, term)
  JOIN (SELECT lang, sum(total) AS total, any_value(kept) AS kept FROM g GROUP BY lang) USING (lang)),
s AS (SELECT p.lang, p.source, o.source AS item, sum(abs(p.p - o.p)) AS value FROM p JOIN p o ON o.lang = p.lang AND o.term = p.term AND o.source <> p.source GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
