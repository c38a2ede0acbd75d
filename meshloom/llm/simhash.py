"""SimHash near-duplicate detection with generalised pigeonhole search."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table, small_batches, text_bytes
from .components import connected_components
from .gph import near_pairs

_CHUNK = 1 << 16


def _majority(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of the shingles of a text: A-Z lower-cased, words split at ASCII white space, XXH64 of each shingle, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    return _majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(words) - width + 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row (doc_id, fp) per document, duplicates included; fp is the unsigned fingerprint held as a long."""

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, width) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t")).mapInArrow(run, "doc_id long, fp long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, tau: int = 2) -> DataFrame:
    """Return doc_id, fingerprint (16 hexadecimal digits) and component_id, the least doc_id that links of at most tau bits reach.

    A null or blank text has fingerprint zero and is linked like any other. Repeated rows stay, each
    with the same result. A null doc_id is kept and never chosen as component_id (null if nothing else
    is reached). Other columns are ignored, whatever their names; an empty table gives an empty result.
    Equal fingerprints are merged by a partial aggregate before anything is paired.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, width), "fps")
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "nodes")
    edges = near_pairs(nodes, "fp", tau)
    joined = connected_components(edges)
    label = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = label.where("component <> fp").groupBy("component").agg(F.min("first").alias("low"))
    label = (
        label.join(least, "component", "left")
        .join(nodes.select(F.col("fp").alias("component"), F.col("first").alias("root")), "component")
        .select("fp", "n", F.least("low", "root").alias("component_id"), "low", (F.col("component") != F.col("fp")).alias("moved"))
        .where("n > 1 or low is not null")
    )
    return fps.join(label.select("fp", "component_id"), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))
