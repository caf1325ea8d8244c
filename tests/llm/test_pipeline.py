"""The pipeline's stages, each against brute force on its own input."""

import re

import corpus_pipeline
from carlot.session import scratch_path
from test_operators import fold, jaccard_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before.toPandas(), docs.toPandas())
        if name != "packing":
            assert docs.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().drop_duplicates("doc_id").set_index("doc_id")["quality"]
    before, after = seen["quality"]
    known = before[before.doc_id.isin(labels.index)]
    right = [(labels[i] == 1) == (i in set(after.doc_id)) for i in known.doc_id]
    assert sum(right) / len(right) >= 0.95
    before, after = seen["exact_dedup"]
    assert set(after.doc_id) == set(before.assign(t=before.text.map(fold)).groupby("t").doc_id.max())
    before, after = seen["near_dedup"]
    before = before.sort_values("doc_id")
    _, groups = jaccard_groups(before.text.tolist(), 5, 80)
    assert set(after.doc_id) == {before.doc_id.iloc[g] for g in groups}
    before, after = seen["pii"]
    old, new = before.set_index("doc_id").text, after.set_index("doc_id").text
    assert set(old.index) == set(new.index)
    for i in old.index:
        mails = re.findall(r"[\w.]+@[\w.]+", old[i])
        assert not any(m in new[i] for m in mails) and (mails or "@" in old[i] or re.search(r"\d{3}", old[i]) or old[i] == new[i])
    before, after = seen["packing"]
    assert set(after.doc_id) == set(before.doc_id)
    assert after.groupby("sequence_id").length.sum().max() <= 2048
