"""The pipeline's stages follow from one another."""

import __spark_entry__
import corpus_pipeline
from tadkit.llm.mixing import mix
from tadkit.llm.neardup import near_duplicates
from tadkit.llm.pii import pseudonymise
from tadkit.llm.quality import quality_scores

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        was, d = d, stage(spark, d, SMALL)
        if name != "packing":
            assert d.columns == was.columns
            d = spark.createDataFrame(d.toArrow(), d.schema)
        out[name] = (was, d)
    was, now = out["quality"]
    kept = {r.doc_id for r in quality_scores(was, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in now.collect()} == kept and 0 < len(kept) < was.count()
    was, now = out["near_duplicates"]
    assert {r.doc_id for r in now.collect()} == {r.doc_id for r in near_duplicates(was).where("kept").collect()}
    was, now = out["pii"]
    want = {r.doc_id: r.text for r in pseudonymise(was, corpus_pipeline.PII_KEY).collect()}
    assert {r.doc_id: r.text for r in now.collect()} == want
    was, now = out["mixing"]
    assert {r.doc_id for r in now.collect()} == {r.doc_id for r in mix(was).where("taken > 0").collect()}
    was, now = out["packing"]
    assert {r.doc_id for r in now.collect()} == {r.doc_id for r in was.collect()}


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_run_reads_nothing_that_is_deleted(spark):
    """Stages' own tables and all but the last stage's rows are gone; the result is whole."""
    import glob
    import os
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    scratch = f"{'/' + base.lstrip('/')}/tadkit-scratch"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    left = {p.split("-")[0] for p in set(os.listdir(scratch)) - before if glob.glob(f"{scratch}/{p}/part-*")}
    assert rows and left == {"mixing", "pieces"}
