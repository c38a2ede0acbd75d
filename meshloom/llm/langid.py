"""Language identification by nearest centroids of TF-IDF n-gram vectors, with distance-based rejection."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, small_batches

#: At most so many labelled documents of each language train the centroids (those least in a hash of doc_id), and so many
#: in all, shared evenly; so every language is learned unless there are more of them than that.
TRAIN_DOCS, TRAIN_TOTAL = 400, 16_000
DIM = 4096
CENTROIDS = 4
#: A document is rejected if its best cosine is below this share of the median of its language's held-out texts of its length.
REJECT_SHARE = 0.45
#: Lengths in bytes of letters at which that median is taken; between them it is interpolated by the logarithm of the length.
LENGTHS = (4, 8, 16, 32, 64, 128, 256, 512, 1024)
#: Of each language one in so many training documents is held out for it, and a length needs so many texts.
HELD_OUT, LEAST_HELD = 4, 4
UNDETERMINED = "und"
_STEP = 1 << 20
#: What isn't a letter. Numerals such as one half or a superscript two are word characters to re, too; the second, slower pattern takes them out where there are any.
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_NUMERALS = re.compile(rf"[ {''.join(c for c in map(chr, range(0x110000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())}]+")


def _letters(text: str) -> str:
    """The lower-cased letters of a text, words set apart by spaces."""
    found = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return found if not found or found.replace(" ", "").isalpha() else _NUMERALS.sub(" ", found).strip()


def letters_of(text: str | None, most: int) -> str:
    """The lower-cased letters that a text begins with, words set apart by spaces, at most so many bytes of them."""
    letters = _letters(text[: 8 * most]) if text else ""
    return letters.encode()[:most].decode("utf-8", "ignore").strip()


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed byte 1- to 3-grams of the lower-cased letters of the whole text, words set apart by spaces; None without letters."""
    letters = _letters(text) if text else ""
    if not letters:
        return None
    raw = np.frombuffer(f"  {letters}  ".encode(), np.uint8)
    out = np.zeros(DIM, np.int64)
    for at in range(0, len(raw) - 2, _STEP):
        b = raw[at : at + _STEP + 2].astype(np.uint32)
        one, two, three = b[:-2], b[:-2] << 8 | b[1:-1], b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        for k, gram in enumerate((one, two, three)):
            mixed = (gram + np.uint32(k * 0x5BD1E995 & 0xFFFFFFFF)) * np.uint32(2654435761)
            out += np.bincount(mixed >> 20, minlength=DIM)
    return out


@dataclass(frozen=True)
class CentroidModel:
    languages: tuple[str, ...]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # by language and length

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def bound(self, lang: int, counts: np.ndarray) -> float:
        """The least cosine of a text of this language, given its counts (each byte of letters and two of the margins start three grams)."""
        size = max(int(counts.sum()) // 3 - 2, 1)
        return float(np.interp(np.log(size), np.log(LENGTHS), self.least[lang]))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0..1 (best cosine), rejected."""
        counts = ngram_counts(text)
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0, True
        cosines = self.centroids @ self.vector(counts)
        best = int(np.argmax(cosines))
        lang = int(self.owner[best])
        return self.languages[lang], float(min(1.0, max(0.0, cosines[best]))), bool(cosines[best] < self.bound(lang, counts))


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    heads = [x.mean(axis=0)]
    while len(heads) < min(k, len(x)):
        heads.append(x[int(np.argmin(np.max(x @ np.array(heads).T, axis=1)))])
    c = np.array(heads)
    for _ in range(10):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = np.argmax(x @ c.T, axis=1)
        c = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _medians(heads: list[str], idf: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The median cosine with the centroids c of the beginnings of texts, by length; lengths of too few texts take that of the next one."""
    out = np.full(len(LENGTHS), np.nan)
    for at, size in enumerate(LENGTHS):
        cut = [t for h in heads if len(h.encode()) >= size and (t := letters_of(h, size))]
        if len(cut) >= min(LEAST_HELD, len(heads)):
            v = np.array([np.log1p(ngram_counts(t)) * idf for t in cut])
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            out[at] = np.median(np.max(v @ c.T, axis=1))
    known = np.flatnonzero(~np.isnan(out))
    return np.interp(np.arange(len(out)), known, out[known]) if len(known) else np.zeros(len(out))


def train_centroids(labelled: list[tuple[str, np.ndarray, str]], k: int = CENTROIDS, reject_share: float = REJECT_SHARE) -> CentroidModel:
    """Spherical k-means in each language, started from the vectors farthest apart; no labelled vectors give a model that leaves all undetermined.

    labelled: (language, counts, the letters the text begins with). The bounds of rejection come from
    texts that the centroids they are compared with weren't trained on, if a language has enough.
    """
    languages = tuple(sorted({lang for lang, *_ in labelled}))
    if not languages:
        return CentroidModel((), np.zeros(0, int), np.zeros((0, DIM)), np.ones(DIM), np.zeros((0, len(LENGTHS))))
    seen = sum((c > 0).astype(np.int64) for _, c, _ in labelled)
    idf = np.log((1 + len(labelled)) / (1 + seen)) + 1
    owner, centroids, least = [], [], []
    for at, lang in enumerate(languages):
        own = [(c, head) for name, c, head in labelled if name == lang]
        x = np.array([np.log1p(c) * idf for c, _ in own])
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        c = _k_means(x, k)
        held = np.arange(len(x)) % HELD_OUT == 0
        if held.sum() >= LEAST_HELD:
            least.append(reject_share * _medians([h for (_, h), out in zip(own, held, strict=True) if out], idf, _k_means(x[~held], k)))
        else:
            least.append(reject_share * _medians([h for _, h in own], idf, c))
        owner += [at] * len(c)
        centroids.append(c)
    return CentroidModel(languages, np.array(owner), np.vstack(centroids), idf, np.array(least))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_DOCS, total: int = TRAIN_TOTAL) -> CentroidModel:
    """Train on a bounded sample of labelled rows: of each language the `most` (or its share of `total`) documents least in a hash of the identifier.

    Rows without identifier, language or letters don't take part; of repeated identifiers one does. The
    sample is drawn on narrow columns with a limit before the shuffle; only counts of fixed length, as
    pairs of place and count, and the beginnings of texts reach the driver, `total` rows at most.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(total).collect()}
    most = min(most, max(1, total // max(1, len(sizes))))
    # hashes are even, so the least `most` of n lie below a threshold that lets about 4 x most + 30 pass: large languages aren't sorted whole
    least = docs.sparkSession.createDataFrame([(lang, min((1 << 63) - 1, -(1 << 63) + int((1 << 64) * min(1.0, (4 * most + 30) / n)))) for lang, n in sorted(sizes.items())], "lang string, below long")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    low = rows.join(F.broadcast(least), "lang").where(F.xxhash64("id") <= F.col("below")).select("id", "lang").distinct()  # a row a language, `total` at most
    chosen = low.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("id", "lang").collect()
    wanted = docs.sparkSession.createDataFrame(chosen, rows.schema) if chosen else rows.limit(0)

    def count(batches):
        for batch in batches:
            found = []
            for i, lang, text in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
                if (c := ngram_counts(text)) is not None:
                    places = np.flatnonzero(c)
                    pairs = np.stack([places, np.minimum(c[places], 2**31 - 1)]).astype(np.int32)
                    found.append((i, lang, pairs.tobytes(), letters_of(text, LENGTHS[-1])))
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], ["id", "lang", "counts", "head"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(F.broadcast(wanted), ["id", "lang"], "left_semi")  # at most `total` pairs
    counted = picked.select(F.col("id").cast("string"), "lang", "text").mapInArrow(count, "id string, lang string, counts binary, head string")
    got = counted.groupBy("lang", "id").agg(F.min(F.struct("counts", "head")).alias("x")).select("lang", "id", "x.*").collect()

    def dense(pairs: bytes) -> np.ndarray:
        places, counts = np.frombuffer(pairs, np.int32).reshape(2, -1)
        out = np.zeros(DIM, np.int32)
        out[places] = counts
        return out

    return train_centroids([(r.lang, dense(r.counts), r.head) for r in sorted(got, key=lambda r: (r.lang, r.id))])


def identify(docs: DataFrame, model: CentroidModel, text_col: str = "text") -> DataFrame:
    """The same rows with lang_pred, score and rejected (columns of those names in docs are replaced); the text alone decides.

    Null, empty and letterless texts are 'und', score 0, rejected. Equal texts get equal results; ties
    between centroids go to the language first in order. Row by row, no shuffle.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop("lang_pred", "score", "rejected")
    at = kept.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(at).to_pylist()]
            new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "lang_pred", "score", "rejected"])

    schema = kept.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(True)}).schema
    return kept.mapInArrow(run, schema)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id counts as not held out, and isn't learned from."""
    docs = read_table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit(docs.where(part != 2))
    asked = docs.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "text")
    return identify(asked, model).drop("text")
