"""The pipeline's stages on the smallest tables, each against what it was given."""

import corpus_pipeline
from tablemill.llm import decontam
from tests.llm.test_operators import brute_groups, brute_lines

D = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    names, given = docs.columns, docs
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, given, D).write.parquet(f"{tmp_path}/{k}")
        made = spark.read.parquet(f"{tmp_path}/{k}")
        out[name] = given, made
        if name != "packing":
            assert made.columns == names
        given = made
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = map(rows, out["quality"])
    assert 0.6 * len(before) < len(after) < len(before)
    before, after = map(rows, out["line_dedup"])
    want = brute_lines(sorted(before))
    assert dict(after) == {i: t for i, t in want.items() if t or not dict(before)[i]}
    before, after = map(rows, out["near_dedup"])
    assert {i for i, _ in after} == {g[0] for g in brute_groups(before, 5) if g[3]}
    before, after = map(rows, out["decontamination"])
    tables = decontam.searchers([(str(r.item_id), r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()])
    assert {i for i, _ in after} == {i for i, t in before if not decontam.search(t, tables)["spans"]}
    before, after = out["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
