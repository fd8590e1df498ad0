"""The pipeline, stage by stage, against each stage's rule in plain Python."""

import brute
import corpus_pipeline
from packing_rules import packing_faults


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    good, near, cut, clean = kept.values()
    groups = brute.near_duplicates(list(good.items()))
    assert near == {d: t for d, t in good.items() if groups[d][1] == d}
    want = brute.byte_repeats(list(near.items()))
    assert set(cut) == set(near)
    for d, text in cut.items():
        n, removed, _, sha = want[d]
        assert text == near[d] if not removed else len(text.encode()) <= n - removed
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contamination(list(cut.items()), items)
    assert clean == {d: t for d, t in cut.items() if not found[d][4]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    packing_faults([tuple(r) for r in packed.collect()], list(clean.items()))


def test_run_on_an_empty_table(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        rows = spark.read.parquet(f"{sf}/{name}.parquet")
        (rows.limit(0) if name == "documents" else rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
