"""The jobs: against SQL, over growing input, run again, broken off, on awkward rows and from the command line."""

import hashlib
import json
import logging
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from jobs import job1_curate_meshes as job1, job2_review_replies as job2
from jobs.common import settings

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string, reply string, key string"


def rows(df):
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


def files(root):
    return {str(p.relative_to(root)): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


@pytest.mark.parametrize("job", [job1, job2])
def test_jobs_equal_their_sql(spark, job):
    con = duckdb.connect()
    for t in ("part", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(job.ORACLE_SQL[job.NAME])
    names = [c[0] for c in want.description]
    assert rows(job.QUERIES[job.NAME](spark, SF)) == Counter(tuple(sorted(zip(names, r, strict=True))) for r in want.fetchall())


# job 2 -------------------------------------------------------------------------------------------

REPLIES = {1: '{"aesthetic_quality": 5}', 2: '{"aesthetic_quality": 1}', 3: "no idea", 4: 'ok {"aesthetic_quality": "4", "is_noisy_scan": "yes"}', 6: None}
SETTINGS = {"records": "records", "replies": "replies.parquet", "files_per_batch": 1}


def slow(docs):
    """Verdict and reasons of each document, contents and retention."""
    reports, known = [], {}
    for key, text, source, *_ in docs:
        reply = REPLIES.get(key)
        reasons = {1: "", 2: "stage2:aesthetic_quality=1 < 2", 3: "", 4: "stage2:noisy_scan"}.get(key) if reply else "error:vlm_batch_fail:no reply"
        reasons = "error:load:no text" if text is None else reasons
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest()
        dataset = (source or "").strip(" ") or "unknown"
        reports.append((key, digest, reasons, dataset))
        if digest and key is not None:
            known[digest] = min(known.get(digest, key), key)
    copies, total, good = Counter(r[1] for r in reports), Counter(r[3] for r in reports), Counter(r[3] for r in reports if not r[2])
    return Counter((k, d, why, name, known.get(d), copies[d] if d else None, total[name], good[name]) for k, d, why, name in reports)


def seen(spark, out):
    found = job2.read_back(spark, out)
    return Counter((r.key, r.sha256, r.reasons, r.dataset, r.first_key, r.records, r.dataset_total, r.dataset_accepted) for r in found.collect())


PARTS = [
    [(1, "one", "a", "x", "", ""), (2, "two", "a", "x", "", ""), (3, None, None, None, None, None), (5, "", " ", "", "", "")],
    [(4, "one", "b", "x", "", ""), (3, "long " * 30000, "a", "x", "", ""), (6, "six", "a/b=c", "x", "", "")],
    [(0, "two", "new", "x", "", ""), (1, "one", "a", "x", "", ""), (1, "one", "a", "x", "", ""), (None, "no key", "a", "x", "", "")],
]


@pytest.fixture
def place(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([*REPLIES.items(), (2, "")], "doc_id long, reply string").coalesce(1).write.parquet(str(source / "replies.parquet"))
    spark.createDataFrame(PARTS[0], DOCS).coalesce(1).write.parquet(str(source / "records"))
    return str(source), str(tmp_path / "out"), lambda k: spark.createDataFrame(PARTS[k], DOCS).coalesce(1).write.mode("append").parquet(str(source / "records"))


def test_review_takes_only_what_is_new(spark, place):
    source, out, add = place
    config = job2.Config(**SETTINGS)
    job2.review(spark, source, out, config)
    assert seen(spark, out) == slow(PARTS[0])
    first = files(f"{out}/reports")
    job2.review(spark, source, out, config)
    assert files(f"{out}/reports") == first and seen(spark, out) == slow(PARTS[0])
    add(1)
    add(2)
    job2.review(spark, source, out, config)
    both = files(f"{out}/reports")
    assert seen(spark, out) == slow(sum(PARTS, [])) and first.items() <= both.items()
    assert {p.split("/")[0] for p in both} == {"batch=0", "batch=1", "batch=2"}
    assert spark.read.option("header", True).csv(f"{out}/summary").count() == 5
    job2.review(spark, source, f"{out}-whole", job2.Config(**SETTINGS | {"files_per_batch": 10}))
    assert seen(spark, f"{out}-whole") == seen(spark, out)


@pytest.mark.parametrize("breaks_at", ["before", "after"])
def test_review_broken_off_in_a_batch_is_finished_by_the_next_run(spark, place, monkeypatch, breaks_at):
    source, out, add = place
    config = job2.Config(**SETTINGS)
    job2.review(spark, source, out, config)
    add(1)
    name, old = ("judge", job2.judge) if breaks_at == "before" else ("written", job2.written)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(job2, name, fail)
    with pytest.raises(Exception, match="lost"):
        job2.review(spark, source, out, config)
    monkeypatch.setattr(job2, name, old)
    add(2)
    job2.review(spark, source, out, config)
    assert seen(spark, out) == slow(sum(PARTS, []))


def test_review_of_a_table_without_rows(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "records"))
    spark.createDataFrame([], "doc_id long, reply string").write.parquet(str(tmp_path / "replies.parquet"))
    for _ in range(2):
        job2.review(spark, str(tmp_path), str(tmp_path / "out"), job2.Config(**SETTINGS))
    assert job2.read_back(spark, str(tmp_path / "out")).count() == 0


def test_review_from_the_command_line(spark, place, tmp_path):
    source, out, _ = place
    (tmp_path / "settings.json").write_text(json.dumps(SETTINGS))
    for _ in range(2):
        run = subprocess.run([sys.executable, "-m", "jobs.job2_review_replies", source, out, "--config", str(tmp_path / "settings.json")], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=300, env=os.environ | {"SPARK_LOCAL_IP": "127.0.0.1"}, check=True)
    assert "0 new records" in run.stderr and seen(spark, out) == slow(PARTS[0])
    (tmp_path / "bad.json").write_text('{"no_such": 1}')
    with pytest.raises(TypeError, match="no_such"):
        settings(job2.Config, job2.NAME, spark, str(tmp_path / "bad.json"))


# job 1 -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    source = tmp_path_factory.mktemp("meshes")
    brand = "CASE WHEN p_partkey < 4 THEN NULL WHEN p_partkey < 8 THEN ' ' WHEN p_partkey % 3 = 0 THEN 'x/y=1' ELSE '07' END"
    spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 60").selectExpr("*", f"{brand} AS brand", "p_partkey AS mesh_id", "p_size AS x").write.parquet(str(source / "part.parquet"))
    return str(source)


def test_curation_replaces_exactly_the_listed_datasets(spark, corpus, tmp_path, caplog):
    out, base = str(tmp_path), {"dataset": "brand", "primitive_vertices": 0}
    with caplog.at_level(logging.INFO):
        job1.curate(spark, corpus, out, job1.Config(**base))
    assert "59 rows" in caplog.text or "60 rows" in caplog.text
    first, held = rows(job1.read_back(spark, out)), files(out)
    assert {r.dataset for r in job1.read_back(spark, out).collect()} == {"unknown", "07", "x/y=1"}
    job1.curate(spark, corpus, out, job1.Config(**base))
    assert rows(job1.read_back(spark, out)) == first
    held = files(out)
    job1.curate(spark, corpus, out, job1.Config(**base, datasets="07, none", volume_area_ratio_min=1e9))
    after = job1.read_back(spark, out)
    others = lambda found: {p: h for p, h in found.items() if "dataset=07" not in p}
    assert others(files(out)) == others(held)
    mine = after.where("dataset = '07'").collect()
    assert mine and not any(r.accepted for r in mine) and all(r.dataset_accepted == 0 and r.dataset_total == len(mine) for r in mine)
    job1.curate(spark, corpus, out, job1.Config(**base))
    assert rows(job1.read_back(spark, out)) == first


def test_curated_meshes_lie_in_the_unit_cube_and_can_be_put_back(spark, corpus, tmp_path):
    job1.curate(spark, corpus, str(tmp_path), job1.Config(dataset="brand", splits={"a": 50, "b": 50}))
    parts = {r.p_partkey: r for r in spark.read.parquet(f"{corpus}/part.parquet").collect()}
    found = job1.tables(spark, str(tmp_path))["meshes"].collect()
    assert {r.mesh_id for r in found} == set(parts) and {r.split for r in found} == {"a", "b"}
    for r in found:
        assert all(-1e-9 <= c <= 1 + 1e-9 for p in r.vertices for c in p)
        low = min((p.z - 0.5) * r.scale + r.cz for p in r.vertices)
        assert low == pytest.approx(-(r.mesh_id % 9 + 1) / 2)


def test_splits_must_add_up():
    with pytest.raises(ValueError, match="100"):
        job1.Config(splits={"train": 90})


def test_curation_of_no_meshes(spark, corpus, tmp_path):
    spark.read.parquet(f"{corpus}/part.parquet").limit(0).write.parquet(str(tmp_path / "in" / "part.parquet"))
    job1.curate(spark, str(tmp_path / "in"), str(tmp_path / "out"), job1.Config(dataset="brand"))
    assert job1.read_back(spark, str(tmp_path / "out")).count() == 0
