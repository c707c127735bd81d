"""Each stage of the pipeline on its predecessor's rows, against plain versions."""

import numpy as np

import corpus_pipeline
from ledgerline.llm import common, mixing, simhash, toxicity, words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    first = {r.doc_id: r for r in common.table(spark, SF, "documents").collect()}
    scores = {r.doc_id: r.score for r in toxicity.scores(common.table(spark, SF, "documents"), common.table(spark, SF, "labels")).collect()}
    assert set(kept["toxicity"]) == {i for i in first if scores[i] < 0.5}
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    last = {}
    for i, r in sorted(kept["toxicity"].items()):
        last[low(r.text)] = i
    assert set(kept["exact_dedup"]) == set(last.values())
    ids = sorted(kept["exact_dedup"])
    fps = np.array([simhash.fingerprint(kept["exact_dedup"][i].text) for i in ids], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    root = np.arange(len(ids))
    while not np.array_equal(root, new := np.where(near, root[None, :], len(ids)).min(axis=1)):
        root = new
    assert set(kept["simhash"]) == {ids[k] for k in set(root.tolist())}
    rows = spark.createDataFrame([tuple(r) for r in kept["simhash"].values()], docs.schema)
    assert set(kept["mixing"]) == {r.doc_id for r in mixing.mixed(rows).where("kept").collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    library = words.library(words.default_vocabulary())
    assert {r.doc_id: r.ids for r in out} == {i: library.encode(r.text, add_special_tokens=False).ids for i, r in kept["mixing"].items()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(kept["mixing"])
