"""One row of each component stays, whatever the ids."""

from collections import Counter

from ledgerline.llm import simhash


def test_null_and_repeated_ids(spark):
    words = [f"w{i}" for i in range(400)]
    near = lambda k: " ".join([*words, f"end{k}"])
    alone = lambda k: " ".join(f"{k}x{i}" for i in range(60))
    nulls = [" ".join([*(f"n{i}" for i in range(400)), f"end{k}"]) for k in range(2)]
    rows = [(1, near(0)), (None, near(1)), (None, alone("a")), (None, alone("b")), (7, alone("c")), (7, near(2)), (9, alone("d")), (9, alone("d")), (None, nulls[0]), (None, nulls[1]), (None, None)]
    fps = [simhash.fingerprint(t) for _, t in rows]
    assert all((fps[0] ^ fps[i]).bit_count() <= 4 for i in (1, 5)) and (fps[8] ^ fps[9]).bit_count() <= 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    held = [k for k in got if k[1] in nulls]
    assert len(held) == 1 and set(got.values()) == {1}
    assert set(got) - set(held) == {(1, near(0)), (None, alone("a")), (None, alone("b")), (7, alone("c")), (9, alone("d")), (None, None)}
