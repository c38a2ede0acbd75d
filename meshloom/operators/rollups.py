"""Roll-ups of reports: statistics, rates, retention, numbering, sampling, slicing, resume and comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut


#: Values of a group that percentiles may hold in one task; beyond, they are found by counting. Ranges of one counting pass.
HELD, RANGES = 10_000_000, 1024


def exact_percentiles(rows: DataFrame, by: str, value: str, shares: list[float]) -> DataFrame:
    """(by, share, p): exact percentiles, interpolated between neighbours, of the values that aren't null or NaN, by counting passes.

    A pass counts the values in RANGES equal ranges between bounds and narrows each wanted rank to the least and
    greatest value of the range that holds it, until they are one value. Only counts are shuffled, so a group's size
    and its repeated values don't matter; each pass reads the values once and writes a row for each rank.
    """
    data = rows.select(F.col(by).alias("_g"), F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("_v")).where("_v IS NOT NULL")
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    ends = data.groupBy("_g").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    asked = cut(ends.select("*", wanted.alias("_s")).withColumn("_at", F.col("_s") * (F.col("_n") - 1)))
    ranks = F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_r")
    todo = asked.select("_g", ranks, "_lo", "_hi", F.lit(0).cast("long").alias("_before")).distinct()
    found = todo.where("_lo = _hi").select("_g", "_r", "_lo")
    todo = cut(todo.where("_lo < _hi"))
    inside = Window.partitionBy("_g", "_r").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while todo.take(1):
        t = todo.withColumnRenamed("_g", "_h")
        part = data.join(t, F.col("_g").eqNullSafe(F.col("_h")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop("_h")
        place = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)  # halves, as the difference of two doubles may be too large for one
        place = F.coalesce(F.when((F.col("_hi") / 2 - F.col("_lo") / 2) > 0, F.floor(place * RANGES)), F.when(F.col("_v") > F.col("_lo"), F.lit(RANGES)).otherwise(F.lit(0)))
        counts = part.groupBy("_g", "_r", "_before", F.least(F.lit(RANGES - 1), place).alias("_b")).agg(F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        counts = counts.withColumn("_upto", F.col("_before") + F.sum("_c").over(inside))
        new = cut(counts.where("_upto > _r AND _upto - _c <= _r").select("_g", "_r", "_lo", "_hi", (F.col("_upto") - F.col("_c")).alias("_before")))
        found = found.unionAll(new.where("_lo = _hi").select("_g", "_r", "_lo"))
        todo = new.where("_lo < _hi")
    got = found.withColumnsRenamed({"_g": "_h", "_lo": "_x"})
    out = asked.join(got, F.col("_g").eqNullSafe(F.col("_h")) & F.col("_r").between(F.floor("_at"), F.ceil("_at")))
    weight = F.when(F.floor("_at") == F.ceil("_at"), 1.0).when(F.col("_r") == F.floor("_at"), F.ceil("_at") - F.col("_at")).otherwise(F.col("_at") - F.floor("_at"))
    return out.groupBy("_g", "_s").agg(F.sum(F.col("_x") * weight).alias("p")).select(F.col("_g").alias(by), F.col("_s").alias("share"), "p")


def stage_stats(reports: DataFrame, metrics: list[str], held: int = HELD) -> DataFrame:
    """(metric, mean, median, min, max, n) over the values that aren't null or NaN; metrics without values are left out. Medians of more than `held` values come from counting passes."""
    wide = reports.select([F.nanvl(F.col(m).cast("double"), F.lit(None)).alias(m) for m in metrics])
    v, long = F.col("v"), wide.unpivot([], metrics, "metric", "v").where("v is not null")
    plain = [F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.count("*").alias("n")]
    most = wide.agg(F.greatest(*[F.count(m) for m in metrics], F.lit(0)).alias("n")).first().n
    if most <= held:
        out = long.groupBy("metric").agg(F.median(v).alias("median"), *plain)
    else:
        out = long.groupBy("metric").agg(*plain).join(exact_percentiles(long, "metric", "v", [0.5]).select("metric", F.col("p").alias("median")), "metric")
    return out.select("metric", "mean", "median", "min", "max", "n")


def binary_rates(reports: DataFrame, flags: list[str]) -> DataFrame:
    """(flag, hits, total, pct): true values of those that aren't null; 0 percent of none."""
    wide = reports.agg(*[x for f in flags for x in (F.count_if(F.col(f)).alias(f"h_{f}"), F.count(f).alias(f"t_{f}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"h_{f}").alias("hits"), F.col(f"t_{f}").alias("total")) for f in flags]))
    return wide.select(rows.alias("r")).select("r.*").withColumn("pct", F.coalesce(F.try_divide(F.col("hits") * 100.0, F.col("total")), F.lit(0.0)))


def retention(reports: DataFrame, dataset: str = "dataset", accepted: str = "accepted") -> DataFrame:
    """(dataset, total, n_accept, retention): datasets without reports have no row."""
    return reports.groupBy(dataset).agg(F.count("*").alias("total"), F.count_if(F.col(accepted)).alias("n_accept")).withColumn("retention", F.round(F.col("n_accept") / F.col("total"), 4))


def percentile(reports: DataFrame, by: str, value: str, share: float = 0.95, held: int = HELD) -> DataFrame:
    """Calibration of a threshold: the exact percentile of a value in each group; of groups of more than `held` values by counting passes."""
    most = reports.groupBy(by).agg(F.count(value).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    if most <= held:
        return reports.groupBy(by).agg(F.percentile(value, share).alias("p"))
    found = exact_percentiles(reports, by, value, [share]).select(F.col(by).alias("_h"), "p")  # a group without values keeps its row
    return reports.select(by).distinct().join(found, F.col(by).eqNullSafe(F.col("_h")), "left").select(by, "p")


def numbered(rows: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Rows numbered from 1 in an order, without sorting them in one task: ranks inside range partitions plus the sizes of those before."""
    spread = rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id())
    sizes = spread.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = spread.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return inside.join(F.broadcast(before), "_p").withColumn(name, (F.col("_before") + F.col("_r")).cast("long")).drop("_p", "_r", "_before")  # one row per partition


def shuffled_sample(rows: DataFrame, key: str, seed: int, n: int | None = None) -> DataFrame:
    """A seeded order that any engine can reproduce, by MD5 of seed and key; n rows of it, or all."""
    out = rows.orderBy(F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key)
    return out.limit(n) if n else out


def limit_each(rows: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group; a limit before the shuffle keeps large groups small."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_r") <= n).drop("_r")


def with_slice(rows: DataFrame, order: list[str], n: int, name: str = "slice") -> DataFrame:
    """Round-robin slices: row i of the order goes to slice i mod n."""
    return numbered(rows, order, "_i").withColumn(name, F.pmod(F.col("_i") - 1, F.lit(n))).drop("_i")


def with_device(rows: DataFrame, order: list[str], workers: int, devices: list[str], name: str = "device") -> DataFrame:
    """Round-robin slices as workers (column slice), and worker w on device w mod the number of devices."""
    return with_slice(rows, order, workers).withColumn(name, F.get(F.array(*map(F.lit, devices)), F.pmod("slice", F.lit(len(devices))).cast("int")))


def exit_status(runs: DataFrame, code: str = "code") -> DataFrame:
    """(status): 1 if any worker ended with a code other than 0 or with none, else 0, also without workers."""
    return runs.agg(F.coalesce(F.bool_or(F.coalesce(code, F.lit(1)) != 0), F.lit(False)).cast("int").alias("status"))


def with_page(rows: DataFrame, order: list[str], size: int = 4, name: str = "page") -> DataFrame:
    """Pages of `size` rows, numbered from 0."""
    return numbered(rows, order, "_i").withColumn(name, F.floor((F.col("_i") - 1) / size)).drop("_i")


def page_count(n: Column, size: int = 4) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size))


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: the rows whose key has no report yet; error reports count as done."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def compare_verdicts(old: DataFrame, new: DataFrame, key: str, pairs: dict[str, str]) -> DataFrame:
    """Old and new verdicts side by side: every old row, with old_* and new_* of each pair old -> new column."""
    right = new.select(F.col(key), *[F.col(n).alias(f"new_{o}") for o, n in pairs.items()])
    return old.select(key, *[F.col(o).alias(f"old_{o}") for o in pairs]).join(right, key, "left")


def in_datasets(rows: DataFrame, wanted: str | None, dataset: str = "dataset") -> DataFrame:
    """Only the datasets of a comma-separated list, blanks dropped; none given means all."""
    names = [x.strip() for x in (wanted or "").split(",") if x.strip()]
    return rows.where(F.col(dataset).isin(names)) if names else rows


def distinct_datasets(rows: DataFrame, dataset: str = "dataset") -> DataFrame:
    """The datasets that have rows, in order."""
    return rows.select(dataset).where(F.col(dataset).isNotNull()).distinct().orderBy(dataset)


def with_status(rows: DataFrame, status: str = "all", accepted: str = "accepted") -> DataFrame:
    """All rows, or only the 'accepted' or the 'rejected' ones; a null verdict is neither."""
    if status not in ("all", "accepted", "rejected"):
        raise ValueError(f"unknown status {status!r}")
    return rows if status == "all" else rows.where(F.col(accepted) if status == "accepted" else ~F.col(accepted))


def in_rounds(rows: DataFrame, key: str, rounds: int, commit: Callable[[DataFrame], None]) -> None:
    """Commit the rows in so many rounds, by a hash of the key: a run that breaks off loses one round, and resumes by pending()."""
    for k in range(rounds):
        commit(rows.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == k))


def dataset_rows(reports: DataFrame, *more: str) -> DataFrame:
    """The 15 columns of a dataset's summary from nested reports, after those named in more."""
    v, m = F.col("stage2_vlm"), F.col("stage4_filter.metrics")
    return reports.select(
        *more, "sha256", "accepted", F.array_join(F.coalesce("rejection_reasons", F.array().cast("array<string>")), "|").alias("rejection_reasons"), "seconds_total",
        v["aesthetic_quality"].alias("vlm_quality"), v["object_class"].alias("vlm_class"), v["is_primitive"].alias("vlm_primitive"), v["is_ground_plane"].alias("vlm_ground"),
        v["is_noisy_scan"].alias("vlm_noisy"), v["is_fragmented"].alias("vlm_frag"), m["fraction_inside_gt"].alias("interior_ratio"), m["vae"]["chamfer"].alias("vae_chamfer"),
        m["num_components"].alias("num_components"), m["is_watertight"].alias("is_watertight"), "input_path",
    )


def batch_rows(results: DataFrame) -> DataFrame:
    """The 11 columns of a batch summary from nested results."""
    s = F.col("stage_reports")
    return results.select(
        F.col("input_path").alias("input"), F.col("output_path").alias("output"), F.col("accepted").cast("int").alias("accepted"), F.array_join("rejection_reasons", "|").alias("reasons"),
        F.round("seconds_total", 2).alias("total_s"), s["stage1_watertighten"]["is_watertight"].alias("s1_watertight"), s["stage1_watertighten"]["chamfer_to_input"].alias("s1_chamfer"),
        s["stage2_vlm_filter"]["aesthetic_quality"].alias("s2_quality"), s["stage2_vlm_filter"]["object_class"].alias("s2_class"),
        s["stage4_filter_geometry"]["metrics"]["ray_sign_agreement"].alias("s4_ray_agreement"), s["stage4_filter_geometry"]["metrics"]["vae"]["chamfer"].alias("s4_vae_chamfer"),
    )
