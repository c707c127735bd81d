"""Mends of earlier operators: op2's sample, op7's overlaps."""

import random
import time

from ledgerline.llm import license_scan, toxicity


def test_labels_of_other_documents_dont_use_up_the_sample(spark):
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'kind'} words number {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    others = spark.range(1000, 30_000).selectExpr("id as doc_id", "0 as toxic")
    want = toxicity.train(docs, labels, 150)
    assert want == toxicity.train(docs, labels.unionByName(others), 150) and want[0]


def _plain_apart(own):
    taken = []
    for find in sorted(own, key=lambda f: (-f.coverage, f.start, f.end)):
        if all(find.end <= t.start or find.start >= t.end for t in taken):
            taken.append(find)
    return taken


def test_finds_apart_against_all_pairs():
    rng = random.Random(7)
    for n in (0, 1, 5, 60, 200):
        own = {license_scan.Find("x", rng.choice([0.8, 0.9, 1.0]), a := rng.randrange(300), a + rng.randrange(1, 20)) for _ in range(n)}
        assert license_scan._apart(own) == _plain_apart(own)


def test_many_copies_of_a_notice_cost_their_number():
    took = []
    for n in (20_000, 80_000):
        own = {license_scan.Find("x", 1.0, 5 * i, 5 * i + 4) for i in range(n)}
        start = time.process_time()
        assert len(license_scan._apart(own)) == n
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0] + 0.5
