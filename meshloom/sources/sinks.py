"""Sinks: mesh tables, JSON reports, CSV summaries, retention text, Markdown report, PNG bytes as base64."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rollups import batch_rows, binary_rates, dataset_rows, retention, stage_stats

#: Columns of the corpus report with what they say: figures of every mesh, and yes-or-no questions. The columns are fixed names.
STATS = (
    ("seconds_total", "seconds, all stages"), ("stage_timings.stage1_watertighten", "seconds, closing the surface"), ("stage_timings.stage2_vlm_filter", "seconds, image model"), ("stage_timings.stage3_canonicalize", "seconds, pose"),
    ("stage_timings.stage4_filter_geometry", "seconds, geometry rules"), ("stage_reports.stage1_watertighten.chamfer_to_input", "distance of the closed surface from its input"),
    ("stage_reports.stage4_filter_geometry.metrics.ray_sign_agreement", "agreement of the two inside tests"), ("stage_reports.stage4_filter_geometry.metrics.vae.chamfer", "distance after the shape model's round trip"),
)
RATES = (
    ("accepted", "kept for training"), ("stage_reports.stage1_watertighten.is_watertight", "closed"), ("stage_reports.stage1_watertighten.is_winding_consistent", "wound one way"),
    ("stage_reports.stage2_vlm_filter.accepted", "passed by the image model"),
)
#: Meshes that a report lists.
PAGE = 1000


def write_meshes(vertices: DataFrame, faces: DataFrame, path: str) -> None:
    vertices.write.mode("overwrite").parquet(f"{path}/vertices")
    faces.write.mode("overwrite").parquet(f"{path}/faces")


def write_reports(reports: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON record per line, in a folder per dataset if `by` names it."""
    writer = reports.write.mode("append")
    (writer.partitionBy(by) if by else writer).json(path)


def write_batch_summary(results: DataFrame, path: str) -> bool:
    """The 11-column CSV; nothing is written without rows."""
    rows = batch_rows(results)
    if not rows.take(1):
        return False
    rows.orderBy("input").write.mode("overwrite").option("header", True).csv(path)
    return True


def write_dataset_summary(reports: DataFrame, path: str) -> None:
    """The 15-column CSV and the retention text of every dataset that has reports (dataset, ...), in a folder for each; a large dataset's rows are several files."""
    rows = dataset_rows(reports, "dataset").repartitionByRange("dataset", "sha256")
    rows.write.mode("overwrite").partitionBy("dataset").option("header", True).csv(f"{path}/summary")
    kept = retention(reports)
    text = F.format_string("dataset: %s\ntotal: %d\naccepted: %d\nretention_rate: %.4f (%.2f%%)", "dataset", "total", "n_accept", F.col("n_accept") / F.col("total"), F.col("n_accept") * 100 / F.col("total"))
    kept.select("dataset", text.alias("value")).write.mode("overwrite").partitionBy("dataset").text(f"{path}/retention")


def markdown_report(results: DataFrame, source: str, page: int = PAGE) -> str:
    """What was kept, why the rest wasn't, how the figures spread, and the first `page` meshes by path; missing figures print as '-'. Only sums and one page of rows come to the driver."""
    flat = results.select(*[F.expr(c).alias(f"s{k}") for k, (c, _) in enumerate(STATS)], *[F.expr(c).alias(f"r{k}") for k, (c, _) in enumerate(RATES)], "input_path", "accepted", "rejection_reasons", "seconds_total")
    stats = {r.metric: r for r in stage_stats(flat, [f"s{k}" for k in range(len(STATS))]).collect()}
    rates = {r.flag: r for r in binary_rates(flat, [f"r{k}" for k in range(len(RATES))]).collect()}
    said = lambda x, places=3: "-" if x is None else f"{x:.{places}f}"
    lines = [f"# Mesh corpus {source}", "", "| question | yes | asked | share |", "| --- | --: | --: | --: |"]
    lines += [f"| {name} | {r.hits} | {r.total} | {r.pct:.1f} % |" for k, (_, name) in enumerate(RATES) if (r := rates.get(f"r{k}"))]
    kind = F.explode(F.transform("rejection_reasons", lambda r: F.regexp_replace(r, r"[=<].*$|\s.*$", ""))).alias("reason")  # without figures
    why = flat.select(kind).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(page).collect()
    lines += ["", "| rejected for | meshes |", "| --- | --: |", *[f"| {r.reason} | {r.n} |" for r in why]] if why else []
    lines += ["", "| figure | meshes | least | median | mean | greatest |", "| --- | --: | --: | --: | --: | --: |"]
    lines += [f"| {name} | {r.n} | {said(r.min)} | {said(r.median)} | {said(r.mean)} | {said(r.max)} |" for k, (_, name) in enumerate(STATS) if (r := stats.get(f"s{k}"))]
    rows = flat.orderBy("input_path").select("input_path", "accepted", "s0", "s5", F.array_join("rejection_reasons", ", ").alias("why")).limit(page).collect()
    lines += ["", f"The first {len(rows)} by path:", "", "| | mesh | kept | seconds | distance | reasons |", "| --: | --- | --- | --: | --: | --- |"]
    lines += [f"| {k} | {r.input_path} | {'yes' if r.accepted else 'no'} | {said(r.s0, 1)} | {said(r.s5, 4)} | {r.why} |" for k, r in enumerate(rows, 1)]
    return "\n".join(lines) + "\n"


def with_base64(images: DataFrame, column: str = "png") -> DataFrame:
    return images.withColumn("base64", F.base64(column))
