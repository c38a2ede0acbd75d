"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one is made only where none is set in a local session, as executors elsewhere can't read it."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="meshloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/meshloom-{context.applicationId}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write df once as Parquet into the shared folder and read it again.

    Unlike checkpoint(), which runs its plan twice, this computes each partition once; the files
    survive the loss of any executor. release() deletes them.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of tables from materialise() that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(name: str = "text"):
    """The whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"").cast("binary"))


#: Rows and bytes of an Arrow batch: whole texts are long, and two Python workers share an executor with its heap.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches stay small in this session, unless it asks for still smaller ones."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, str(most)).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most or now == str(most):
            spark.conf.set(key, str(most))


#: Bits of a filter that is broadcast: 2 MB, whatever the number of keys.
FILTER_BITS = 1 << 24


def bit_filter(keys: DataFrame, hash_col: str) -> np.ndarray:
    """A one-hash Bloom filter of a long column as FILTER_BITS bits packed into words; at most FILTER_BITS / 64 rows reach the driver.

    It only spares work: with very many keys it lets all through.
    """
    bit = F.col(hash_col).bitwiseAND(F.lit(FILTER_BITS - 1))
    words = keys.select(bit.alias("p")).select(F.expr("CAST(p DIV 64 AS INT)").alias("w"), F.expr("shiftleft(1L, CAST(p % 64 AS INT))").alias("b"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[r.w] = r.b
    return out


def sized_filter(keys: DataFrame, hash_col: str, n: int) -> np.ndarray:
    """The same for n keys at sixteen bits a key, between 8 KB and 8 MB in all."""
    bits = 1 << min(max((n * 16).bit_length(), 16), 26)
    bit = F.col(hash_col).bitwiseAND(F.lit(bits - 1))
    words = keys.select(bit.alias("p")).select(F.expr("CAST(p DIV 64 AS INT)").alias("w"), F.expr("shiftleft(1L, CAST(p % 64 AS INT))").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


def may_hold(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (int64 or uint64) may be among the filter's keys."""
    p = hashes.astype(np.uint64) & np.uint64(len(filter_words) * 64 - 1)
    return (filter_words.view(np.uint64)[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
