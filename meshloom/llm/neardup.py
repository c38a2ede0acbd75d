"""Near-duplicate removal: generalised pigeonhole search over SimHash fingerprints and MinHash bands find candidates, verified on five-word shingles.

The measure is the Jaccard similarity of sets of five-word shingles, which no small Hamming distance of
fingerprints bounds. So texts whose fingerprints lie within TAU bits, by op5_simhash's search, are candidates, and those that share
one of further keys are too: BANDS hashes of ROWS independent MinHashes each: two texts of similarity s share
one with probability 1 - (1 - s ** ROWS) ** BANDS (0.9998 at 0.8), wherever the edits are. Pairs
that a one-permutation MinHash of BINS bins doesn't rule out are decided by their exact similarity.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release, small_batches, text_bytes
from .components import connected_components
from .gph import near_pairs
from .simhash import fingerprints

WIDTH = 5
#: The similarity that links two texts, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 16, 4
BINS = 512
#: Bits by which the fingerprints of candidates may differ.
TAU = 2
#: Sketches rule a pair out if their estimate is below the bound by more than so many of its standard deviations.
LOOSE = 4
#: Texts of a bucket, and bytes of their shingle sets, that meet those of another block of it at once (a larger set is a block by itself).
BLOCK, BLOCK_BYTES = 256, 4 << 20
#: A table of dropped documents of at most so many rows is broadcast; a larger one is joined by shuffling.
BROADCAST_ROWS = 500_000

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(WIDTH)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _C1
    x = (x ^ x >> np.uint64(27)) * _C2
    return x ^ x >> np.uint64(31)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the WIDTH-word shingles from those of the words; of a shorter text, of the whole sequence."""
    width = min(WIDTH, len(hashes))
    if not width:
        return hashes
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for k in range(width):
        out += hashes[k : k + len(out)] * _P[k]
    return _mix(out)


#: Odd factors; the least product of the (already mixed) shingle hashes with each is a MinHash.
_TURNS = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _P[0]) | np.uint64(1)
_BAND = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)


def describe(text: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """The keys of the bands, the sorted set of shingle hashes, and its sketch (a byte per bin, 0 for an empty one)."""
    words = text.lower().split()
    sketch = np.zeros(BINS, np.uint8)
    if not words:
        return _mix(_BAND), np.zeros(0, np.uint64), sketch.tobytes()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))
    s = np.unique(shingle_hashes(hashes))
    least = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for at in range(0, len(s), 1 << 10):
        np.minimum(least, (_TURNS[:, None] * s[at : at + (1 << 10)]).min(axis=1), out=least)
    keys = _BAND.copy()
    for row in least.reshape(BANDS, ROWS).T:
        keys = _mix(keys * _P[1] + row)
    bins = (s >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    sketch[bins[first]] = 1 + (_mix(s[first]) % np.uint64(255)).astype(np.uint8)
    return keys, s, sketch.tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of sketches; two empty ones are alike."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(either, 1)
    return np.where(either == 0, 1.0, (same - 1 / 255) / (1 - 1 / 255))


def _features(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [describe(b) for b in batch.column(1).to_pylist()]
            flat = np.concatenate([r[0] for r in rows] or [np.zeros(0, np.uint64)]).view(np.int64)
            keys = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * BANDS, pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, pa.array([r[2] for r in rows], pa.binary()), pa.array([len(r[1]) for r in rows], pa.int64())], ["t", "keys", "sketch", "m"])

    return docs.mapInArrow(run, "t long, keys array<long>, sketch binary, m long")


def buckets(texts: DataFrame) -> DataFrame:
    """texts: (t, keys, sketch, m), one row per text of m shingles -> (k, t, sketch, m, n, hub) of the keys that n > 1 texts have.

    The hub of a bucket is the text whose buckets hold most texts in all: among copies of one original,
    each edited by itself, that is the original.
    """
    index = texts.select("t", F.explode("keys").alias("k"))
    sizes = index.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(index.join(sizes, "k"), "shared")
    score = shared.groupBy("t").agg(F.sum("n").alias("score"))
    hubs = shared.join(score, "t").groupBy("k").agg(F.max_by("t", F.struct("score", F.xxhash64("t"))).alias("hub"))
    out = materialise(shared.join(hubs, "k").join(texts.select("t", "sketch", "m"), "t").select("k", "t", "sketch", "m", "n", "hub"), "members")
    release(shared)
    return out


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each text of a bucket with its hub: distinct (a, b, sketch_a, sketch_b)."""
    ties = members.where("t <> hub").select(F.col("t").alias("a"), F.col("hub").alias("b"), F.col("sketch").alias("sketch_a")).dropDuplicates(["a", "b"])
    hubs = members.where("t = hub").select(F.col("t").alias("b"), F.col("sketch").alias("sketch_b")).dropDuplicates(["b"])
    return ties.join(hubs, "b").select("a", "b", "sketch_a", "sketch_b")


def other_links(members: DataFrame, joined: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between the texts of a bucket that aren't in one component yet, as many as join what can be joined; joined: (t, c), docs: (t, b).

    At least one text of such a pair is outside the component of the bucket's hub, so only those texts
    meet all others. Both sides are dealt into blocks; a cell of two blocks compares its sets of shingle
    hashes exactly and returns links, fewer than it has texts, instead of pairs.
    """
    own = members.where("n > 2").join(joined, "t", "left").withColumn("c", F.coalesce("c", "t"))
    main = own.where("t = hub").select("k", F.col("c").alias("main"))
    own = own.join(main, "k").withColumn("out", F.col("c") != F.col("main"))
    blocks = lambda n, m: F.greatest(F.ceil(n / BLOCK), F.ceil(m * 8 / BLOCK_BYTES)).cast("long")
    counts = own.groupBy("k").agg(F.count_if("out").alias("n_out"), blocks(F.count("*"), F.sum("m")).alias("nb"), blocks(F.count_if("out"), F.sum(F.when(F.col("out"), F.col("m")))).alias("no")).where("n_out > 0")
    own = materialise(own.join(counts, "k").select("k", "t", "c", "out", "nb", "no"), "apart")
    sets = materialise(shingle_sets(docs.join(own.select("t").distinct(), "t", "left_semi").select("t", "b")), "sets")
    own = own.join(sets, "t")
    place = lambda n: F.pmod(F.xxhash64("t", "k"), F.col(n)).alias("i" if n == "no" else "j")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("i" if n == "no" else "j")
    cell = ("k", "i", "j", "asks", "t", "c", "s")
    left = own.where("out").select("k", F.lit(True).alias("asks"), "t", "c", "s", place("no"), every("nb")).select(*cell)
    right = own.select("k", F.lit(False).alias("asks"), "t", "c", "s", place("nb"), every("no")).select(*cell)

    def run(batches):
        last, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(len(cell))), strict=True):
                if row[:3] != last:
                    if held:
                        yield _links(held)
                    last, held = row[:3], []
                held.append(row[3:])
        if held:
            yield _links(held)

    out = materialise(left.unionAll(right).repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInArrow(run, "a long, b long"), "more")
    release(sets)
    return out


def _links(rows: list[tuple[bool, int, int, bytes]]) -> pa.RecordBatch:
    """A spanning set of the links between texts (asks, t, c, s) that ask and those that don't, given the components c."""
    asked = [(t, c, np.frombuffer(s, np.uint64)) for asks, t, c, s in rows if asks]
    others = [(t, c, np.frombuffer(s, np.uint64)) for asks, t, c, s in rows if not asks]
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = parent.get(up, up)
            c = up
        return c

    sizes = np.array([len(s) for *_, s in others], np.int64)
    names, inverse = np.unique(np.concatenate([*(s for *_, s in others), np.zeros(0, np.uint64)]), return_inverse=True)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    marked, common, out = np.zeros(len(names), np.int64), np.zeros(len(others), np.int64), []
    for t, c, s in asked if others else ():
        at = np.searchsorted(names, s)
        at = at[at < len(names)]
        at = at[names[at] == s[: len(at)]]
        marked[at] = 1
        common[full] = np.add.reduceat(marked[inverse], starts) if len(full) else 0
        marked[at] = 0
        for k in np.flatnonzero(SIMILAR[1] * common >= SIMILAR[0] * (sizes + len(s) - common)).tolist():
            a, b = root(c), root(others[k][1])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((t, others[k][0]))
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(2)], ["a", "b"])


def may_be_alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of sketches can belong to texts of the bound's similarity; the fewer bins are filled, the looser."""
    bound = SIMILAR[0] / SIMILAR[1]
    filled = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    return similarity(a, b) >= bound - LOOSE * np.sqrt(bound * (1 - bound) / filled)


def are_alike(a: bytes, b: bytes) -> bool:
    """Whether two sorted sets of shingle hashes have the bound's similarity; two empty ones are alike."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return SIMILAR[1] * common >= SIMILAR[0] * (len(both) - common)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """docs: (t, b) -> (t, s), the sorted set of shingle hashes."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([describe(b)[1].tobytes() for b in batch.column(1).to_pylist()], pa.binary())], ["t", "s"])

    return docs.mapInArrow(run, "t long, s binary")


def alike(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of similarity 0.8 or more; docs: (t, b), the texts. Only texts of pairs that the sketches leave are read again."""

    def rule_out(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array(may_be_alike(a, b)))

    def decide(batches):
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array([are_alike(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], pa.bool_()))

    left = materialise(pairs.mapInArrow(rule_out, "a long, b long").distinct(), "left")
    asked = materialise(left.select(F.explode(F.array("a", "b")).alias("t")).distinct(), "asked")
    few = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    sets = materialise(shingle_sets(docs.join(few, "t", "left_semi").select("t", "b")), "sets")
    both = left.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    out = materialise(both.mapInArrow(decide, "a long, b long"), "links")
    release(left, asked, sets)
    return out


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """docs: (t, b) -> distinct candidates (a, b) by the generalised pigeonhole search of op5_simhash: texts whose SimHash fingerprints lie within TAU bits.

    The text of least t stands for a fingerprint: it is paired with the others that have it, and with those that stand
    for fingerprints nearby.
    """
    fps = materialise(fingerprints(docs.select(F.col("t").alias("doc_id"), F.col("b").alias("text"))).toDF("t", "fp"), "fps")
    heads = materialise(fps.groupBy("fp").agg(F.min("t").alias("head"), F.count("*").alias("n")), "heads")
    same = fps.join(heads.where("n > 1").select("fp", "head"), "fp").where("t <> head").select(F.col("head").alias("a"), F.col("t").alias("b"))
    side = lambda c: heads.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_t"))
    near = near_pairs(heads, "fp", TAU).join(side("a"), "a").join(side("b"), "b").select(F.col("a_t").alias("a"), F.col("b_t").alias("b"))
    out = materialise(same.unionAll(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "nearby")
    release(fps, heads)
    return out


def sketched(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """(a, b, sketch_a, sketch_b) of pairs (a, b)."""
    side = lambda c: features.select(F.col("t").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sketch_a", "sketch_b")


def near_groups(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """docs: (t, b), one row per distinct text, and firsts: (t, first, ...) with its least doc_id -> (t, first, stays): whether the text is its group's one with the least.

    Candidates come from the pigeonhole search over fingerprints and from buckets of MinHashes. The texts of a bucket are compared with its hub first. Then all pairs that this left in different
    components are compared too; the others can't change the components.
    """
    features = materialise(_features(docs), "features")
    members = buckets(features)
    nearby = fingerprint_pairs(docs)
    links = alike(hub_pairs(members).unionAll(sketched(nearby, features)), docs)
    joined = connected_components(links).toDF("t", "c")
    more = other_links(members, joined, docs)
    if more.take(1):
        joined = connected_components(links.unionAll(more)).toDF("t", "c")
    label = firsts.select("t", "first").join(joined.toDF("t", "component"), "t")
    least = label.groupBy("component").agg(F.min(F.struct("first", "t")).alias("x"))
    moved = materialise(label.join(least, "component").where(F.col("x.t") != F.col("t")).select("t"), "moved")
    release(features, members, nearby, links, more)
    return moved


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, of which one stays from each group of near-duplicates: the one with the least doc_id.

    Groups are the components of links between texts whose sets of five-word shingles (of A-Z
    lower-cased words at ASCII white space; the whole sequence if it is shorter) have a similarity of
    0.8 or more. Equal texts are always grouped, null ones with empty
    ones. Of repeated rows one stays. A row with a null doc_id stays only if its group has no other
    text or identifier before it (nulls come first). An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    t = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62)))
    small = lambda x: F.broadcast(x) if x.count() <= BROADCAST_ROWS else x
    on = (ident == F.col("_meshloom_d")) & (t == F.col("_meshloom_t"))
    # exact copies go first, by hashes alone: of each text the row with the least doc_id stays
    rows = materialise(docs.select(ident.alias("_meshloom_d"), t.alias("_meshloom_t")).groupBy("_meshloom_d", "_meshloom_t").agg(F.count("*").alias("n")), "rows")
    firsts = materialise(rows.groupBy("_meshloom_t").agg(F.min("_meshloom_d").alias("first")).select(F.col("_meshloom_t").alias("t"), "first"), "firsts")
    copies = materialise(rows.join(firsts, F.col("_meshloom_t") == F.col("t")).where("_meshloom_d <> first").select("_meshloom_d", "_meshloom_t"), "copies")
    moved = near_groups(docs.join(small(copies), on, "left_anti").select(t.alias("t"), text_bytes(text_col).alias("b")), firsts)
    out = materialise(copies.unionAll(firsts.join(moved, "t", "left_semi").select(F.col("first").alias("_meshloom_d"), F.col("t").alias("_meshloom_t"))), "drop")
    twice = materialise(rows.where("n > 1").select("_meshloom_d", "_meshloom_t").join(out, ["_meshloom_d", "_meshloom_t"], "left_anti"), "twice")
    release(rows, firsts, copies, moved)
    kept = docs.join(small(out.unionAll(twice)), on, "left_anti")
    again = docs.join(small(twice), on).dropDuplicates(["_meshloom_d", "_meshloom_t"]).select(*[docs[c] for c in docs.columns])
    return kept.unionAll(again)
