"""Operators and stages against plain versions that share no code with them."""

import math
import zlib

import numpy as np
import pyarrow as pa

import corpus_pipeline
from ledgerline.llm import bpe, common, exact_dedup, mixing, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_plain_ftrl():
    """One dictionary entry a coordinate, one formula at a time."""
    rng = np.random.default_rng(5)
    rows = [(np.unique(rng.integers(0, 40, 12)).astype(np.int32), int(rng.integers(0, 2))) for _ in range(60)]
    model = toxicity.Ftrl()
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= toxicity.L1 else -(zi - math.copysign(toxicity.L1, zi)) / ((toxicity.BETA + math.sqrt(ni)) / toxicity.ALPHA + toxicity.L2)

    for _ in range(20):
        for at, label in rows:
            model.learn(at, label)
            b = -bias[0] / ((toxicity.BETA + math.sqrt(bias[1])) / toxicity.ALPHA)
            ws = {int(i): weight(int(i)) for i in at}
            g = 1 / (1 + math.exp(-(sum(ws.values()) + b))) - label
            for i, w in ws.items():
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w
                n[i] = old + g * g
            bias[0] += g - (math.sqrt(bias[1] + g * g) - math.sqrt(bias[1])) / toxicity.ALPHA * b
            bias[1] += g * g
    assert np.allclose(model.weights(np.arange(40)), [weight(i) for i in range(40)])
    assert any(weight(i) for i in range(40)) and not model.weights(np.arange(40, 1000)).any()


def test_toxicity_learns_one_text_of_a_repeated_id(spark):
    docs = [(i, f"{'vile' if i % 2 else 'kind'} words number {i}", None, None, None) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    once = toxicity.train(spark.createDataFrame(docs, SCHEMA), labels)
    assert once == toxicity.train(spark.createDataFrame(docs * 3, SCHEMA), labels)
    learned = {i for i in range(40) if zlib.crc32(str(i).encode()) % 5}
    fitted = list(toxicity.fit(iter([pa.RecordBatch.from_pydict({"text": [], "toxic": []})])))
    assert learned and fitted[0].column(2)[0].as_py() == -35.0


def _plain_raking(cells, keep, rounds):
    """cells: (source, lang, topic) -> tokens."""
    p, total = dict.fromkeys(cells, keep), sum(cells.values())
    shares = []
    for d in range(3):
        sums = {}
        for c, n in cells.items():
            sums[c[d]] = sums.get(c[d], 0) + n
        whole = sum(s**mixing.TEMPER for s in sums.values())
        shares.append({v: s**mixing.TEMPER / whole for v, s in sums.items()})
    for _ in range(rounds):
        for d in range(3):
            now = {}
            for c, n in cells.items():
                now[c[d]] = now.get(c[d], 0) + n * p[c]
            for c in cells:
                if now[c[d]]:
                    p[c] = min(1.0, p[c] * shares[d][c[d]] * keep * total / now[c[d]])
    return p


def test_plain_raking(spark):
    rng = np.random.default_rng(3)
    cells = {(f"s{i}", f"l{j}", f"t{k}"): int(rng.integers(1, 10_000)) for i in range(5) for j in range(3) for k in range(3)}
    rows = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, n_tokens long")
    want = _plain_raking(cells, mixing.KEEP, mixing.ROUNDS)
    raked = mixing.raked(rows)
    got = {(r.source, r.lang, r.topic): r.probability for r in raked.collect()}
    assert all(abs(got[c] - want[c]) < 1e-6 for c in cells)
    left = {(r.dimension, r.value): r.share - r.reached for r in mixing.residuals(raked).collect()}
    assert all(abs(x) < 1e-6 for x in left.values()) or any(v == 1.0 for v in got.values())
    few, mixing.CELLS = mixing.CELLS, 3  # more cells than that are dealt out
    try:
        dealt = {(r.source, r.lang, r.topic): r.probability for r in mixing.raked(rows).collect()}
    finally:
        mixing.CELLS = few
    assert all(abs(dealt[c] - want[c]) < 1e-6 for c in cells)


def test_names_that_clash_stay(spark):
    docs = spark.createDataFrame([(1, "some words", "own", "mine")], "doc_id long, text string, ids string, decoded string")
    out = bpe.decode(bpe.encode(docs), "ids_").first()
    assert (out.ids, out.decoded, out.decoded_) == ("own", "mine", "some words")


def test_a_small_batch_against_a_long_history(spark):
    """What is broadcast depends on the batch: a text that history holds often is not hot in it."""
    index = exact_dedup.new_index(spark)
    old = spark.range(3000).selectExpr("id as doc_id", "if(id < 2500, 'often', concat('text ', id)) as text")
    assert exact_dedup.verdicts(old, index).where("kept").count() == 501
    new = spark.createDataFrame([(9001, "Often"), (9002, "new"), (9003, "NEW")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.verdicts(new, index).collect()}
    assert got == {9001: (2499, 1, False), 9002: (9003, 2, False), 9003: (9003, 2, True)}
    again = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.verdicts(new, index).collect()}
    assert again == got
    index.drop()
    assert not spark.catalog.tableExists(index.name)


def test_tiled_nodes_lose_no_link(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 3, dtype=np.int64)
    fps = sorted({int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 62, (60, 2))})
    bits = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    want = np.arange(len(fps))
    while not np.array_equal(want, new := np.where(near, want[None, :], len(fps)).min(axis=1)):
        want = new
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), node=8)
    place, root = {f: i for i, f in enumerate(fps)}, np.arange(len(fps))
    pairs = [(place[r.a], place[r.b]) for r in links.collect()]
    while True:
        old = root.copy()
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if np.array_equal(old, root):
            break
    assert np.array_equal(root, want)


def test_pipeline_on_edge_rows(spark, tmp_path):
    long = "word " * 50_000
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, "One two three four five", "en", "a", 0), (3, "One two three four five", "en", "a", 0), (None, "one TWO three four five", "en", "a", 0), (4, long, "en", "a", 0), (None, "quite another text stands here", None, "b", 0)]
    place = str(tmp_path / "sf")
    extra = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", row_key string, probability string")
    extra.write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    docs, columns = common.table(spark, place, "documents"), extra.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = common.stored(stage(spark, docs, place), name)
        assert docs.columns == columns
    kept = sorted((r.doc_id or 0, (r.text or "")[:5]) for r in docs.collect())
    assert [k for k in kept if k[1] not in ("", None)] == [(0, "quite"), (3, "One t"), (4, "word ")] and len(kept) == 4
    none = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
