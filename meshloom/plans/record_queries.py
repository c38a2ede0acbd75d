"""Registered queries on records: replies, rules, roll-ups, sampling, resume; and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, verdicts
from ..operators import neighbours, rollups, scorers, voxels
from ..sources.files import resolve_paths

# Replies are made from labels: one form for each remainder of doc_id by 6.
_Q = "(1 + doc_id % 5)"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = lambda c: F.when(c, "true").otherwise("false")
    q, noisy, prim = (F.lit(1) + F.col("doc_id") % 5).cast("string"), F.col("toxic") == 1, F.col("quality") == 0
    forms = [
        F.concat(F.lit('```json\n{"aesthetic_quality": '), q, F.lit(', "is_noisy_scan": '), flag(noisy), F.lit(', "is_primitive": '), flag(prim), F.lit(', "object_class": "chair", "reasoning": "ok"}\n```')),
        F.concat(F.lit('Sure: {"aesthetic_quality": "'), q, F.lit(' of 5", "is_noisy_scan": "'), F.when(noisy, "Yes").otherwise("no"), F.lit('"} done')),
        F.lit("I cannot judge this."),
        F.concat(F.lit('{"aesthetic_quality": '), q, F.lit('.9, "is_primitive": 1, "is_fragmented": "TRUE "}')),
        F.concat(F.lit('{"aesthetic_quality": '), flag(noisy), F.lit(', "is_ground_plane": null}')),
        F.concat(F.lit('{"aesthetic_quality": '), q, F.lit(', "extra": {"a": 1}, "is_ground_plane": '), flag(prim), F.lit("}")),
    ]
    return _read(spark, sf_dir, "labels").select("doc_id", F.get(F.array(*forms), F.col("doc_id") % 6).alias("reply"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", verdicts.parse_reply(F.col("reply")).alias("v"))


def vlm_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("doc_id", "v.*")


def vlm_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _parsed(spark, sf_dir).withColumn("r", verdicts.accept_reasons(F.col("v")))
    return out.select("doc_id", F.array_join("r", "|").alias("reasons"), (F.size("r") == 0).alias("accepted"))


def vlm_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vlm_accept(spark, sf_dir).select(F.explode(rules.split_reasons(F.col("reasons"))).alias("reason"))
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


def events_json_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    return _read(spark, sf_dir, "events").select("event_id", verdicts.to_integer(k).alias("k"), verdicts.to_boolean(k).alias("flag"))


def _stage_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of both stages for parts, by key."""
    p = F.col("p_partkey")
    four = F.array_compact(F.array(F.when(p % 3 == 0, "primitive_like"), F.when(p % 4 == 0, "too_many_components=9")))
    two = F.when(p % 7 != 0, F.array_compact(F.array(F.when(p % 5 == 0, "noisy_scan"))))
    return _read(spark, sf_dir, "part").select("p_partkey", (p % 6 != 0).alias("watertight"), (p % 8 == 0).alias("review"), four.alias("four"), two.alias("two"))


def merge_reasons_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rules.merge_pipeline(F.col("watertight"), F.col("review"), F.col("four"), F.col("two"))
    return _stage_reasons(spark, sf_dir).select("p_partkey", F.array_join(r, "|").alias("reasons"), (F.size(r) == 0).alias("accepted"))


def merge_reasons_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rules.merge_batch(F.col("two"), F.col("four"))
    return _stage_reasons(spark, sf_dir).select("p_partkey", F.array_join(r, "|").alias("reasons"), (F.size(r) == 0).alias("accepted"))


def pose_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(*map(F.lit, ("+x", "-Y ", "+Z", "up")))
    reply = F.concat(F.lit('pose {"up_axis": "'), F.get(labels, F.col("doc_id") % 4), F.lit('", "front_axis": "'), F.get(labels, F.col("doc_id") % 3), F.lit('"}'))
    return _read(spark, sf_dir, "labels").select("doc_id", verdicts.parse_pose(reply).alias("p")).select("doc_id", "p.*")


def content_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha256")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))


def path_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.get(F.array(*map(F.lit, (".glb", ".OBJ", ".Ply", ".gltf.fbx", ".html"))), F.col("page_id") % 5)
    return _read(spark, sf_dir, "pages").select("page_id", rules.strip_extension(F.concat("url", suffix)).alias("name"))


def candidate_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows look for a file under three names, of which some exist."""
    docs = _read(spark, sf_dir, "documents").select("doc_id")
    listing = docs.where("doc_id % 3 = 0").select(F.concat(F.lit("a/"), "doc_id").alias("path")).unionAll(docs.where("doc_id % 4 = 0").select(F.concat(F.lit("b/"), "doc_id")))
    names = F.array(*[F.concat(F.lit(f"{p}/"), "doc_id") for p in "cab"])
    return resolve_paths(docs, names, listing, ["doc_id"])


_CELLS = 16


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("mesh_id"), (F.col("l_quantity") / 51).alias("x"), (F.col("l_discount") * 9).alias("y"), (F.col("l_tax") * 11).alias("z")).where("x < 0.5 OR z < 0.3")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.occupancy(_points(spark, sf_dir), _CELLS)


def voxel_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


def voxel_dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.dilate(_cells(spark, sf_dir), _CELLS)


def voxel_erode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.erode(_cells(spark, sf_dir), _CELLS)


def voxel_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.close_cells(_cells(spark, sf_dir), _CELLS, 1)


def voxel_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.distance_cells(_cells(spark, sf_dir), _CELLS)


def voxel_flood(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = voxels.flood_report(_cells(spark, sf_dir), _CELLS)
    return out.withColumn("interior_frac", F.round("interior_frac", 6))


def voxel_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cells(spark, sf_dir).withColumn("i", voxels.linear_index(_CELLS)).drop("x", "y", "z")
    return voxels.from_index(out, _CELLS)


def surface_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cubes of the grid have each pattern of set corners (bit 0: x, 1: y, 2: z)."""
    cells = _cells(spark, sf_dir)
    shifts = F.explode(F.array(*[F.struct(F.lit(b & 1).alias("dx"), F.lit(b >> 1 & 1).alias("dy"), F.lit(b >> 2).alias("dz"), F.lit(1 << b).alias("bit")) for b in range(8)]))
    cubes = cells.withColumn("s", shifts).select("mesh_id", *[(F.col(d) - F.col(f"s.d{d}")).alias(d) for d in "xyz"], "s.bit").where(" AND ".join(f"{d} >= 0 AND {d} < {_CELLS - 1}" for d in "xyz"))
    return cubes.groupBy("mesh_id", "x", "y", "z").agg(F.sum("bit").alias("pattern")).groupBy("mesh_id", "pattern").agg(F.count("*").alias("n"))


def _vectors(spark: SparkSession, sf_dir: str, label: int, key: str) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").where(F.col("label") == label).select(F.col("vec_id").alias(key), F.col("embedding").cast("array<double>").alias("v"))


def nearest_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vector of label 1 to every one of label 0."""
    return neighbours.nearest_vectors(_vectors(spark, sf_dir, 0, "qid"), _vectors(spark, sf_dir, 1, "tid")).withColumn("d", F.round("d", 6))


def chamfer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = neighbours.nearest_vectors(_vectors(spark, sf_dir, 0, "qid"), _vectors(spark, sf_dir, 1, "tid"))
    two = neighbours.nearest_vectors(_vectors(spark, sf_dir, 1, "qid"), _vectors(spark, sf_dir, 0, "tid"))
    return neighbours.chamfer(one, two).withColumn("chamfer", F.round("chamfer", 6))


def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollups.stage_stats(_read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "median", "min", "max")})


def binary_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("good"), F.when(F.col("doc_id") % 3 > 0, F.col("toxic") == 1).alias("toxic"), F.lit(None).cast("boolean").alias("none"))
    return rollups.binary_rates(rows, ["good", "toxic", "none"]).withColumn("pct", F.round("pct", 6))


def retention_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dataset")).join(vlm_accept(spark, sf_dir), "doc_id")
    return rollups.retention(rows)


def calibrate_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.percentile(_read(spark, sf_dir, "events"), "event_type", "value").withColumn("p", F.round("p", 6))


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.pending(_read(spark, sf_dir, "documents").select("doc_id", "lang"), _read(spark, sf_dir, "labels"), "doc_id")


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached replies for even documents; the rest are scored, here with a fixed text."""
    requests = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("mesh_id"), scorers.cache_key(F.col("doc_id").cast("string"), "m", "en", "512").alias("cache_key"))
    cache = requests.where("mesh_id % 2 = 0").select("cache_key", F.when(F.col("mesh_id") % 10 > 0, F.concat(F.lit("old "), "mesh_id")).alias("raw_response"))
    score = lambda rows: rows.select("mesh_id", F.concat(F.lit("new "), "mesh_id").alias("raw_response"), F.lit(None).cast("string").alias("error"))
    return scorers.with_cache(requests, cache, score).select("mesh_id", "cache_key", "raw_response", "cached")


def caches_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"), (F.col("doc_id") % 100).alias("mesh_id"), F.col("source").alias("cache"))
    requests = docs.withColumn("cache_key", scorers.cache_key(F.col("mesh_id").cast("string"), "m", "en", "512"))
    caches = requests.where("mesh_id % 3 = 0").select("cache", "cache_key", F.concat(F.col("cache"), F.lit(" "), "mesh_id").alias("raw_response"))
    score = lambda rows: rows.select("mesh_id", F.concat(F.lit("request "), "mesh_id").alias("raw_response"), F.lit(None).cast("string").alias("error"))
    return scorers.with_caches(requests, caches, score).drop("error")


def device_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_device(_read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 7, ["d0", "d1", "d2"])


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.exit_status(_read(spark, sf_dir, "labels").select(F.col("toxic").alias("code")))


def verdict_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _read(spark, sf_dir, "labels")
    old = labels.select("doc_id", (F.col("toxic") == 1).alias("noisy"), F.col("quality").alias("q"))
    new = labels.where("doc_id % 5 > 0").select("doc_id", (F.col("quality") == 0).alias("noisy2"), F.col("toxic").alias("q2"))
    out = rollups.compare_verdicts(old, new, "doc_id", {"noisy": "noisy2", "q": "q2"})
    return out.withColumn("flip", rules.flip_label(F.col("old_noisy"), F.col("new_noisy")))


def numbered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.numbered(_read(spark, sf_dir, "documents").select("doc_id", "source"), ["source", "doc_id"])


def round_robin_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_slice(_read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 7)


def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_page(_read(spark, sf_dir, "pages").select("page_id"), ["page_id"])


def limit_per_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.limit_each(_read(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 3)


def hash_shuffle_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.shuffled_sample(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7, 50)


def mesh_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    line = rules.mesh_line(F.when(p % 3 > 0, p * 1000), p * 7, F.when(p % 4 > 0, p % 2 == 0), F.lit(None).cast("double"))
    return _read(spark, sf_dir, "part").select("p_partkey", line.alias("line"))


def accept_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form of the streaming accept rate, by hour of events."""
    from ..streaming.ingest import accept_rate

    out = accept_rate(_read(spark, sf_dir, "events").select("ts", (F.col("value") > 50).alias("accepted")), "1 hour")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "n", "n_accept")


def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.when(F.col("event_id") % 2 == 0, rules.error_reason(F.lit("load"), F.repeat("event_type", 40))).otherwise(rules.exception_reason(F.lit("ValueError"), F.col("props")))
    return _read(spark, sf_dir, "events").select("event_id", e.alias("reason"))


QUERIES = {f.__name__: f for f in (
    vlm_json_parse, vlm_accept, vlm_reason_counts, events_json_coerce, merge_reasons_pipeline, merge_reasons_batch, pose_labels, content_hash_dedup, path_normalise, candidate_resolve,
    voxel_occupancy, voxel_dilate, voxel_erode, voxel_close, voxel_distances, voxel_flood, voxel_index, surface_cases, nearest_neighbour, chamfer_labels, stage_stats, binary_rates, retention_by_dataset,
    calibrate_p95, resume_anti, cache_lookup, caches_lookup, device_slices, run_status, verdict_flip, numbered_table, round_robin_slice, paginate, limit_per_dataset, hash_shuffle_limit, mesh_display, accept_windows, error_rows,
)}

#: The replies' parsed values by construction of the six forms.
_VERDICTS = f"""WITH v AS (SELECT doc_id, doc_id % 6 AS k, toxic = 1 AS noisy, quality = 0 AS prim, {_Q}::BIGINT AS q FROM labels),
p AS (SELECT doc_id, CASE WHEN k IN (0, 1, 3, 5) THEN q END AS aesthetic_quality, CASE WHEN k = 0 THEN prim END AS is_primitive, CASE WHEN k = 5 THEN prim END AS is_ground_plane, CASE WHEN k IN (0, 1) THEN noisy END AS is_noisy_scan,
  CASE WHEN k = 3 THEN true END AS is_fragmented, CASE WHEN k = 0 THEN 'chair' END AS object_class, CASE WHEN k = 0 THEN 'ok' WHEN k = 2 THEN 'I cannot judge this.' ELSE '' END AS reasoning, k = 2 AS parse_error FROM v),
r AS (SELECT doc_id, concat_ws('|', CASE WHEN aesthetic_quality < 2 THEN 'aesthetic_quality=' || aesthetic_quality || ' < 2' END, CASE WHEN is_primitive THEN 'primitive' END, CASE WHEN is_ground_plane THEN 'ground_plane' END,
  CASE WHEN is_noisy_scan THEN 'noisy_scan' END, CASE WHEN is_fragmented THEN 'fragmented' END) AS reasons FROM p)"""
_REASONS = "WITH s AS (SELECT p_partkey AS p, CASE WHEN p_partkey % 6 = 0 THEN 'stage1_not_watertight' END AS a, CASE WHEN p_partkey % 8 = 0 THEN 'stage3_canonicalize_uncertain' END AS b, CASE WHEN p_partkey % 3 = 0 THEN 'stage4:primitive_like' END AS c, CASE WHEN p_partkey % 4 = 0 THEN 'stage4:too_many_components=9' END AS d, CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 = 0 THEN 'stage2:noisy_scan' END AS e FROM part)"
_GRID = """WITH RECURSIVE pts AS (SELECT l_returnflag AS mesh_id, l_quantity / 51 AS x, l_discount * 9 AS y, l_tax * 11 AS z FROM lineitem),
cells AS (SELECT DISTINCT mesh_id, floor(x * 16)::INT AS x, floor(y * 16)::INT AS y, floor(z * 16)::INT AS z FROM pts WHERE (x < 0.5 OR z < 0.3) AND x >= 0 AND x < 1 AND y >= 0 AND y < 1 AND z >= 0 AND z < 1),
o AS (SELECT a - 1 AS dx, b - 1 AS dy, c - 1 AS dz FROM range(3) r(a), range(3) s(b), range(3) t(c))"""
_DILATED = ", dil AS (SELECT DISTINCT mesh_id, (x + dx)::INT AS x, (y + dy)::INT AS y, (z + dz)::INT AS z FROM cells, o WHERE x + dx BETWEEN 0 AND 15 AND y + dy BETWEEN 0 AND 15 AND z + dz BETWEEN 0 AND 15)"
_eroded = lambda t: f"SELECT mesh_id, x, y, z FROM (SELECT mesh_id, (x + dx)::INT AS x, (y + dy)::INT AS y, (z + dz)::INT AS z FROM {t}, o) e WHERE x BETWEEN 0 AND 15 AND y BETWEEN 0 AND 15 AND z BETWEEN 0 AND 15 GROUP BY mesh_id, x, y, z HAVING count(*) = (CASE WHEN x IN (0, 15) THEN 2 ELSE 3 END) * (CASE WHEN y IN (0, 15) THEN 2 ELSE 3 END) * (CASE WHEN z IN (0, 15) THEN 2 ELSE 3 END)"
_NEAR = "WITH d AS (SELECT a.vec_id AS qid, b.vec_id AS tid, a.label AS la, sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE)))) AS d FROM embeddings a, embeddings b WHERE (a.label = 0 AND b.label = 1) OR (a.label = 1 AND b.label = 0)), n AS (SELECT qid, la, arg_min(tid, (d, tid)) AS tid, min(d) AS d FROM d GROUP BY qid, la)"
_stat = lambda c: f"SELECT '{c}' AS metric, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, round(min({c}), 4) AS min, round(max({c}), 4) AS max, count({c}) AS n FROM lineitem"
_rate = lambda n, c: f"SELECT '{n}' AS flag, count(*) FILTER (WHERE {c}) AS hits, count({c}) AS total, coalesce(round(100.0::DOUBLE * count(*) FILTER (WHERE {c}) / nullif(count({c}), 0), 6), 0) AS pct FROM labels"

ORACLE_SQL = {
    "vlm_json_parse": f"{_VERDICTS} SELECT * FROM p",
    "vlm_accept": f"{_VERDICTS} SELECT doc_id, reasons, reasons = '' AS accepted FROM r",
    "vlm_reason_counts": f"{_VERDICTS} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, '|')) AS reason FROM r) WHERE reason <> '' GROUP BY reason",
    "events_json_coerce": "SELECT event_id, try_cast(json_extract(props, '$.k') AS BIGINT) AS k, NULL::BOOLEAN AS flag FROM events",
    "merge_reasons_pipeline": f"{_REASONS} SELECT p AS p_partkey, concat_ws('|', a, b, c, d, e) AS reasons, concat_ws('|', a, b, c, d, e) = '' AS accepted FROM s",
    "merge_reasons_batch": f"{_REASONS} SELECT p AS p_partkey, concat_ws('|', e, c, d) AS reasons, concat_ws('|', e, c, d) = '' AS accepted FROM s",
    "pose_labels": "WITH l AS (SELECT doc_id, ['+X', '-Y', '+Z', 'UP'][(doc_id % 4 + 1)::INT] AS up, ['+X', '-Y', '+Z', 'UP'][(doc_id % 3 + 1)::INT] AS front FROM labels) SELECT doc_id, up, front, up <> 'UP' AND front <> 'UP' AND up[2:2] <> front[2:2] AS ok FROM l",
    "content_hash_dedup": "SELECT sha256(text) AS sha256, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY sha256(text)",
    "path_normalise": "SELECT page_id, regexp_replace(url || ['.glb', '.OBJ', '.Ply', '.gltf.fbx', '.html'][(page_id % 5 + 1)::INT], '\\.(glb|obj|ply|gltf|fbx)$', '', 'i') AS name FROM pages",
    "candidate_resolve": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a/' ELSE 'b/' END || doc_id AS path FROM documents WHERE doc_id % 3 = 0 OR doc_id % 4 = 0",
    "voxel_occupancy": f"{_GRID} SELECT * FROM cells",
    "voxel_dilate": f"{_GRID}{_DILATED} SELECT * FROM dil",
    "voxel_erode": f"{_GRID} {_eroded('cells')}",
    "voxel_close": f"{_GRID}{_DILATED} SELECT * FROM ({_eroded('dil')}) UNION SELECT * FROM cells",
    "voxel_distances": f"""{_GRID}, g AS (SELECT m.mesh_id, a::INT AS x, b::INT AS y, c::INT AS z FROM (SELECT DISTINCT mesh_id FROM cells) m, range(16) r(a), range(16) s(b), range(16) t(c)),
sides AS (SELECT g.*, c.mesh_id IS NOT NULL AS inside FROM g LEFT JOIN cells c ON c.mesh_id = g.mesh_id AND c.x = g.x AND c.y = g.y AND c.z = g.z)
SELECT a.mesh_id, a.x, a.y, a.z, min((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)::BIGINT * CASE WHEN a.inside THEN -1 ELSE 1 END AS d2 FROM sides a JOIN sides b ON b.mesh_id = a.mesh_id AND b.inside <> a.inside GROUP BY a.mesh_id, a.x, a.y, a.z, a.inside""",
    "voxel_flood": f"""{_GRID}, g AS (SELECT m.mesh_id, a::INT AS x, b::INT AS y, c::INT AS z FROM (SELECT DISTINCT mesh_id FROM cells) m, range(16) r(a), range(16) s(b), range(16) t(c)),
free AS (SELECT g.* FROM g ANTI JOIN cells USING (mesh_id, x, y, z)),
outside(mesh_id, x, y, z) AS (SELECT mesh_id, x, y, z FROM free WHERE x IN (0, 15) OR y IN (0, 15) OR z IN (0, 15)
  UNION SELECT f.mesh_id, f.x, f.y, f.z FROM (SELECT q.mesh_id, (q.x + dx)::INT AS x, (q.y + dy)::INT AS y, (q.z + dz)::INT AS z FROM outside q, o) n JOIN free f USING (mesh_id, x, y, z)),
n AS (SELECT mesh_id, (SELECT count(*) FROM cells c WHERE c.mesh_id = m.mesh_id) AS n_shell, (SELECT count(*) FROM outside c WHERE c.mesh_id = m.mesh_id) AS n_outside FROM (SELECT DISTINCT mesh_id FROM cells) m)
SELECT mesh_id, n_shell, n_outside, 4096 - n_shell - n_outside AS n_inside, round((4096 - n_shell - n_outside) / 4096, 6) AS interior_frac FROM n""",
    "voxel_index": f"{_GRID} SELECT mesh_id, (x * 256 + y * 16 + z)::BIGINT AS i, x, y, z FROM cells",
    "surface_cases": f"{_GRID}, c AS (SELECT mesh_id, x - b % 2 AS x, y - b // 2 % 2 AS y, z - b // 4 AS z, 1 << b::INT AS bit FROM cells, range(8) r(b)) SELECT mesh_id, pattern, count(*) AS n FROM (SELECT mesh_id, x, y, z, sum(bit)::BIGINT AS pattern FROM c WHERE x BETWEEN 0 AND 14 AND y BETWEEN 0 AND 14 AND z BETWEEN 0 AND 14 GROUP BY ALL) GROUP BY mesh_id, pattern",
    "nearest_neighbour": f"{_NEAR} SELECT qid, tid, round(d, 6) AS d FROM n WHERE la = 0",
    "chamfer_labels": f"{_NEAR} SELECT round((avg(d) FILTER (WHERE la = 0) + avg(d) FILTER (WHERE la = 1)) / 2, 6) AS chamfer FROM n",
    "stage_stats": " UNION ALL ".join(map(_stat, ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))),
    "binary_rates": " UNION ALL ".join((_rate("good", "(quality = 1)"), _rate("toxic", "(CASE WHEN doc_id % 3 > 0 THEN toxic = 1 END)"), _rate("none", "NULL::BOOLEAN"))),
    "retention_by_dataset": f"{_VERDICTS} SELECT source AS dataset, count(*) AS total, count(*) FILTER (WHERE reasons = '') AS n_accept, round(count(*) FILTER (WHERE reasons = '') / count(*), 4) AS retention FROM r JOIN documents USING (doc_id) GROUP BY source",
    "calibrate_p95": "SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p FROM events GROUP BY event_type",
    "resume_anti": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "cache_lookup": "SELECT doc_id AS mesh_id, sha256(doc_id || '|m|en|512') AS cache_key, CASE WHEN doc_id % 2 = 0 AND doc_id % 10 > 0 THEN 'old ' ELSE 'new ' END || doc_id AS raw_response, doc_id % 2 = 0 AND doc_id % 10 > 0 AS cached FROM labels",
    "caches_lookup": "SELECT doc_id AS n, doc_id % 100 AS mesh_id, source AS cache, sha256((doc_id % 100) || '|m|en|512') AS cache_key, CASE WHEN doc_id % 100 % 3 = 0 AND source IS NOT NULL THEN source || ' ' || (doc_id % 100) ELSE 'request ' || doc_id END AS raw_response, doc_id % 100 % 3 = 0 AND source IS NOT NULL AS cached FROM documents",
    "device_slices": "WITH s AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 7 AS slice FROM documents) SELECT *, 'd' || slice % 3 AS device FROM s",
    "run_status": "SELECT CAST(coalesce(bool_or(coalesce(toxic, 1) <> 0), false) AS INTEGER) AS status FROM labels",
    "verdict_flip": "WITH x AS (SELECT doc_id, toxic = 1 AS old_noisy, quality AS old_q, CASE WHEN doc_id % 5 > 0 THEN quality = 0 END AS new_noisy, CASE WHEN doc_id % 5 > 0 THEN toxic END AS new_q FROM labels) SELECT *, CASE WHEN old_noisy AND NOT coalesce(new_noisy, false) THEN 'noisy->clean' WHEN NOT old_noisy AND coalesce(new_noisy, false) THEN 'clean->noisy' ELSE '' END AS flip FROM x",
    "numbered_table": "SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) AS n FROM documents",
    "round_robin_slice": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 7 AS slice FROM documents",
    "paginate": "SELECT page_id, (row_number() OVER (ORDER BY page_id) - 1) // 4 AS page FROM pages",
    "limit_per_dataset": "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3",
    "hash_shuffle_limit": "SELECT doc_id FROM documents ORDER BY md5('7' || doc_id), doc_id LIMIT 50",
    "mesh_display": "SELECT p_partkey, concat_ws(' | ', CASE WHEN p_partkey % 3 > 0 THEN 'V ' || format('{:,}', p_partkey * 1000) END, 'F ' || format('{:,}', p_partkey * 7), CASE WHEN p_partkey % 4 > 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'watertight' ELSE 'open' END END) AS line FROM part",
    "accept_windows": "SELECT date_trunc('hour', ts) AS start, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_accept FROM events GROUP BY ALL",
    "error_rows": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'error:load:' || left(repeat(event_type, 40), 200) ELSE 'exception:ValueError:' || left(props, 200) END AS reason FROM events",
}
