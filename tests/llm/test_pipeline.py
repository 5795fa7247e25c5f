"""The pipeline's decisions on the small tables, each stage against its own rule."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import decontaminate, neardup, pii, quality
from strata.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.columns[:5] == COLUMNS
    start = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    model = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert kept["quality"].keys() == {i for i, t in start.items() if model.score(t.encode()) >= corpus_pipeline.QUALITY}
    sets = {i: neardup.shingles(start[i].encode()) for i in kept["quality"]}
    stayed = kept["near_duplicates"].keys()
    for i in sets:
        near = [j for j in sets if j != i and neardup.overlap(sets[i], sets[j]) >= 0.8]
        assert (i in stayed) or near
        assert i not in stayed or not any(j in stayed for j in near)
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = decontaminate.words_of(r.text.encode())
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}
    hit = set()
    for i in stayed:
        w = decontaminate.words_of(start[i].encode())
        if any(tuple(w[at:at + 10]) in windows for at in range(len(w))):
            hit.add(i)
    assert kept["decontamination"].keys() == stayed - hit
    for i, r in kept["personal_data"].items():
        assert not pii.base_spans(r.text) and (r.text == start[i] or pii.base_spans(start[i]))
    for r in kept["mixing"].values():
        assert 1 <= r.times <= 3 and r.taken == r.times * r.size == r.times * len(r.text.split())
