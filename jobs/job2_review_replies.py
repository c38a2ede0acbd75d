"""Incremental review of asset records: new record files are matched with model replies and judged, once each.

A file stream over the record table with a checkpoint below the output takes only files that no run before
has seen (`availableNow`: what is there, then it ends). Each micro-batch writes

    reports/batch=<n>/dataset=<d>    one report a record: content hash, parsed reply, reasons, verdict
    contents/batch=<n>               its different contents: first key and number of records
    retention/batch=<n>              its records and accepted ones by dataset

with the stream's own batch number, and overwrites just these folders, so a batch that is run again after a failure
leaves the same files. Sums over batches are made on reading; `summary` (CSV) is written anew by every run.
A record without text, or without a reply, is rejected with an error reason and counts as done. Files that
change under their old name aren't read again. The checkpoint must stay with the output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, main, settings, twice, written
from meshloom.functions import rules, verdicts
from meshloom.sources.files import read_or_empty

NAME = "job2_review_replies"
UNKNOWN = "unknown"
REPORTS = "key long, sha256 string, n_bytes long, aesthetic_quality long, is_noisy_scan boolean, object_class string, parse_error boolean, reasons string, accepted boolean, dataset string"
CONTENTS = "sha256 string, first_key long, records long"
RETENTION = "dataset string, total long, n_accept long"


@dataclass(frozen=True)
class Config:
    """Tables below the source folder and their columns; `reply` is an SQL expression over the reply table's columns."""

    records: str = "documents.parquet"
    replies: str = "replies.parquet"
    key: str = "doc_id"
    text: str = "text"
    dataset: str = "source"
    reply: str = "reply"
    min_quality: int = 2
    files_per_batch: int = 64


def judge(records: DataFrame, replies: DataFrame, config: Config) -> DataFrame:
    """REPORTS for records; a key's replies must agree, else the greatest counts. A null or blank dataset is `unknown`."""
    text, name = F.col(config.text), F.nullif(F.trim(F.col(config.dataset).cast("string")), F.lit(""))
    left = records.select(F.col(config.key).cast("long").alias("key"), F.coalesce(name, F.lit(UNKNOWN)).alias("dataset"), F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("n_bytes"))
    right = replies.select(F.col(config.key).cast("long").alias("key"), F.expr(config.reply).alias("reply")).groupBy("key").agg(F.max("reply").alias("reply"))
    out = left.join(right, "key", "left").withColumn("v", verdicts.parse_reply(F.col("reply")))
    none = F.array().cast("array<string>")
    failed = F.when(F.col("sha256").isNull(), rules.error_reason(F.lit("load"), F.lit("no text"))).when(F.col("reply").isNull(), rules.error_reason(F.lit("vlm_batch_fail"), F.lit("no reply")))
    reasons = F.when(failed.isNotNull(), F.array(failed)).otherwise(rules.merge_batch(verdicts.accept_reasons(F.col("v"), verdicts.AcceptConfig(config.min_quality)), none))
    return out.withColumn("r", reasons).select(
        "key", "sha256", "n_bytes", "v.aesthetic_quality", "v.is_noisy_scan", "v.object_class", F.when(F.col("reply").isNotNull(), F.col("v.parse_error")).alias("parse_error"),
        F.array_join("r", "|").alias("reasons"), (F.size("r") == 0).alias("accepted"), "dataset",
    )


def contents(spark: SparkSession, out: str) -> DataFrame:
    """Each content once: its first key and how many records hold it."""
    return read_or_empty(spark, f"{out}/contents", CONTENTS).groupBy("sha256").agg(F.min("first_key").alias("first_key"), F.sum("records").alias("records"))


def retention(spark: SparkSession, out: str) -> DataFrame:
    sums = read_or_empty(spark, f"{out}/retention", RETENTION).groupBy("dataset").agg(F.sum("total").alias("total"), F.sum("n_accept").alias("n_accept"))
    return sums.withColumn("retention", F.round(F.col("n_accept") / F.col("total"), 4))


def review(spark: SparkSession, source: str, out: str, config: Config) -> None:
    """Judge the records of files that are new since the last run into `out`."""
    path = f"{source}/{config.records}"
    replies = spark.read.parquet(f"{source}/{config.replies}")
    found = f"{path[:-1]}[{path[-1]}]"  # as a pattern, since a file stream takes a single file in no other way
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", config.files_per_batch).parquet(found)

    def batch(rows: DataFrame, n: int) -> None:
        session = rows.sparkSession
        reports = f"{out}/reports/batch={n}"
        judge(rows, replies, config).hint("rebalance", "dataset").write.mode("overwrite").partitionBy("dataset").parquet(reports)
        done = session.read.schema(REPORTS).parquet(reports)
        done.where("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("key").alias("first_key"), F.count("*").alias("records")).write.mode("overwrite").parquet(f"{out}/contents/batch={n}")
        done.groupBy("dataset").agg(F.count("*").alias("total"), F.count_if("accepted").alias("n_accept")).write.mode("overwrite").parquet(f"{out}/retention/batch={n}")
        written(session, done, f"batch {n} from {path}, {reports}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/_checkpoint").queryName(out).trigger(availableNow=True).start()
    query.awaitTermination()
    table = retention(spark, out)
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/summary")  # one row a dataset
    log.info("%d new records; %s/summary: %d datasets", sum(p.numInputRows for p in query.recentProgress), out, table.count())


def read_back(spark: SparkSession, out: str) -> DataFrame:
    """The whole output as one table: every report with its content's first key and records and its dataset's sums."""
    reports = read_or_empty(spark, f"{out}/reports", REPORTS).drop("batch")
    summary = spark.read.schema("dataset string, dataset_total long, dataset_accepted long, retention double").option("header", True).csv(f"{out}/summary")
    return reports.join(contents(spark, out), "sha256", "left").join(summary, "dataset")


def job2_review_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = settings(Config, NAME)
    return read_back(spark, twice(spark, NAME, lambda out: review(spark, sf_dir, out, config)))


ORACLE = """
WITH d AS (SELECT doc_id AS key, coalesce(nullif(trim(source), ''), 'unknown') AS dataset, sha256(text) AS sha256, strlen(text)::BIGINT AS n_bytes, quality, toxic, l.doc_id IS NOT NULL AS known, l.doc_id IS NOT NULL AND l.doc_id % 5 <> 4 AS clear
  FROM documents d LEFT JOIN labels l USING (doc_id)),
v AS (SELECT *, CASE WHEN clear THEN 1 + 3 * quality END::BIGINT AS aesthetic_quality, CASE WHEN clear THEN toxic = 1 END AS is_noisy_scan FROM d),
r AS (SELECT *, CASE WHEN sha256 IS NULL THEN 'error:load:no text' WHEN NOT known THEN 'error:vlm_batch_fail:no reply' ELSE concat_ws('|', CASE WHEN aesthetic_quality < 2 THEN 'stage2:aesthetic_quality=' || aesthetic_quality || ' < 2' END, CASE WHEN is_noisy_scan THEN 'stage2:noisy_scan' END) END AS reasons FROM v),
c AS (SELECT sha256, min(key) AS first_key, count(*) AS records FROM r WHERE sha256 IS NOT NULL GROUP BY sha256),
s AS (SELECT dataset, count(*) AS dataset_total, count(*) FILTER (WHERE reasons = '') AS dataset_accepted FROM r GROUP BY dataset)
SELECT key, sha256, n_bytes, aesthetic_quality, is_noisy_scan, NULL::VARCHAR AS object_class, CASE WHEN known THEN NOT clear END AS parse_error, reasons, reasons = '' AS accepted, dataset, first_key, records, dataset_total, dataset_accepted, round(dataset_accepted / dataset_total, 4) AS retention
FROM r LEFT JOIN c USING (sha256) JOIN s USING (dataset)"""

QUERIES, ORACLE_SQL = {NAME: job2_review_replies}, {NAME: ORACLE}

if __name__ == "__main__":
    main(NAME, Config, review, "Judge new records by model replies, into reports by batch and dataset.")
