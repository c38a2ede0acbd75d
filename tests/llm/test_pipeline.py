import corpus_pipeline
import __spark_entry__
from meshloom.llm import neardup, pii, simhash

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "mixing"]
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == columns and out.count() > 0, name
        seen = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert {"doc_id", "epoch", "take_tokens"} <= set(last.columns) and last.count() > 0


def test_run_equals_the_stages_and_holds_no_plain_data(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    raw = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.text == pii.pseudonymise(raw[r.doc_id])[0] for r in out)


def test_all_operators_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {n[: n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names


def test_near_dedup_takes_candidates_from_the_pigeonhole_search(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words[:199], "other", *words[200:]]), " ".join(reversed(words)), " ".join(words[:200] * 2), "", "one two"]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    asked, real = [], neardup.near_pairs
    monkeypatch.setattr(neardup, "near_pairs", lambda nodes, fp, tau: asked.append({r.fp for r in nodes.collect()}) or real(nodes, fp, tau))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert kept == {0, 2, 3, 4, 5}
    assert [{f & (2**64 - 1) for f in a} for a in asked] == [{simhash.fingerprint(t.encode()) for t in texts}]


def test_near_dedup_links_by_fingerprints_alone(spark, monkeypatch):
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"])]
    assert (simhash.fingerprint(texts[0].encode()) ^ simhash.fingerprint(texts[1].encode())).bit_count() <= neardup.TAU
    real = neardup.hub_pairs
    monkeypatch.setattr(neardup, "hub_pairs", lambda members: real(members).limit(0))
    monkeypatch.setattr(neardup, "other_links", lambda members, joined, docs: neardup.materialise(joined.limit(0), "none"))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()] == [0]
