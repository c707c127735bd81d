"""Operators over whole tables, against plain versions on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, components, embed, exact_dedup, license_scan, lm, mixing, simhash, token_count, token_store, toxicity

DATA = "/root/testdata"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_components_match_union_find(spark):
    r = random.Random(5)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 201 + i) for i in range(40)] + [(7, 7)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_keys_are_joined_whole(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), "id")
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
    got = common.keyed_join(rows, facts, "k", "n", 5000)
    assert got.count() == 5000 and got.where("k = 1 and most = 2999").count() == 3000


EXACT = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, "ABC"), (2, "abc"), (9, "x" * 100_000)]


def test_exact_dedup_in_batches(spark):
    index = exact_dedup.new_index(spark)
    got = exact_dedup.verdicts(docs_of(spark, EXACT), index).collect()
    groups = defaultdict(list)
    for i, x in EXACT:
        groups[lowered(x)].append(i)
    for r in got:
        text = next(lowered(x) for i, x in EXACT if i == r.doc_id and hashlib.sha256(lowered(x).encode()).hexdigest() == r.text_sha256)
        keep = max((i for i in groups[text] if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(groups[text]), r.doc_id == keep)
    assert len(got) == len(EXACT)
    later = exact_dedup.verdicts(docs_of(spark, [(50, "ABC"), (51, "new")]), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in later} == {(50, 2, False), (51, 51, True)}
    assert index.rows().count() == len(groups) + 1


def test_the_index_is_joined_without_moving_it(spark):
    index = exact_dedup.new_index(spark)
    index.append(exact_dedup.digests(docs_of(spark, EXACT)))
    batch = exact_dedup.digests(docs_of(spark, EXACT)).repartition(index.buckets, "digest")
    plan = batch.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_keep_distinct_keeps_columns_and_one_of_repeated_rows(spark):
    rows = [(1, "a", "x", 1), (2, "A", "y", 2), (2, "A", "y", 2), (None, "q", "z", 3), (None, "q", "z", 3), (4, None, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k_digest string, keep_id int")
    got = exact_dedup.keep_distinct(docs, exact_dedup.new_index(spark))
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, {(2, "A", "y", 2), (None, "q", "z", 3), (4, None, None, 4)}))


def near_copies(seed=2, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(n // 4):
        base = [word() for _ in range(60)]
        for k in range(4):
            text = list(base)
            if k:
                text[r.randrange(60)] = word()
            rows.append((4 * i + k, " ".join(text)))
    return [*rows, (1000, None), (1001, ""), (1002, "one"), (1003, "One"), (1004, rows[0][1].upper())]


@pytest.mark.parametrize("node", [4096, 2])
def test_simhash_groups(spark, node, monkeypatch):
    plain_links = simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps, radius=4: plain_links(fps, radius, node))
    rows = near_copies()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.fingerprint_groups(docs_of(spark, rows)).collect()}
    fps = np.array([simhash.fingerprint(x) for _, x in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.array([i for i, _ in rows])
    while not np.array_equal(label, new := np.where(near, label[None, :], 10**9).min(axis=1)):
        label = new
    assert got == {i: (f"{int(f):016x}", int(c)) for (i, _), f, c in zip(rows, fps, label, strict=True)}
    kept = simhash.keep_one(docs_of(spark, rows).withColumn("k_id", F.lit("clash")))
    assert {r.doc_id for r in kept.collect()} == set(label.tolist()) and kept.columns == ["doc_id", "text", "k_id"]


def test_lm_scores(spark):
    rows = [(i, x) for i, x in near_copies(7, 80)]
    docs = docs_of(spark, rows).withColumn("held_out", common.fold("doc_id", 7) == 2)
    got = {r.doc_id: r for r in lm.score(docs, buckets=3, block_tokens=700).collect()}
    texts = {i: [*lowered(x).split(), None] for i, x in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c, pairs = Counter(), Counter()
    for i, x in texts.items():
        if not held[i]:
            c.update(x)
            pairs.update(zip(x, x[1:], strict=False))
    n, v = sum(c.values()), len(c)
    ones, twos = sum(k == 1 for k in c.values()), sum(k == 2 for k in c.values())
    d = ones / (ones + 2 * twos)
    p = lambda w: ((c[w] - d) if c[w] else d * v) / n
    assert abs(sum(p(w) for w in c) + d * v / n - 1) < 1e-9
    for i, x in texts.items():
        r = got[i]
        want = math.log10(p(x[0])) + sum(math.log10((pairs[h, w] + lm.MU * p(w)) / (c[h] + lm.MU)) for h, w in zip(x, x[1:], strict=False))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(x), sum(c[w] > 0 for w in x), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)) < 1e-7
        assert abs(r.score - want) < 1e-7
    nothing = lm.score(docs_of(spark, [(2, "a b")]).withColumn("held_out", F.lit(True))).first()
    assert (nothing.train_tokens, nothing.n_known, nothing.score) == (0, 0, 0.0)


def vectors(seed=1, dim=24):
    r = np.random.default_rng(seed)
    base = r.normal(size=(12, dim))
    out = []
    for b in base:
        for _ in range(12):
            out.append(b + r.normal(size=dim) * 0.12)
    out += [base[0] * 3, base[0] * 3]
    return out


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embed, "TILE", 5)
    vs = vectors()
    rows = [(i, [float(x) for x in v], i % 2 if i < len(vs) - 2 else 0) for i, v in enumerate(vs)]
    bad = [(900, None, 1), (901, [0.0] * 24, 1), (902, [1.0, None] * 12, 1), (903, [float("nan")] * 24, 1), (904, rows[0][1], None), (905, [], 1), (906, [1.0], 0), (None, [5.0] * 24, 1)]
    got = {r.vec_id: r for r in embed.near_duplicates(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")).collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    link = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    found = sum(got[i].n_links for i, _, _ in rows)
    assert found <= link.sum() - len(rows) and found >= 0.9 * (link.sum() - len(rows))
    assert link.sum() > 2 * len(rows)
    comp = np.arange(len(rows))
    while not np.array_equal(comp, new := np.where(link, comp[None, :], 10**9).min(axis=1)):
        comp = new
    assert [got[i].component_id for i, _, _ in rows] == comp.tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 907))


def test_e8_points_are_nearest():
    r = np.random.default_rng(0)
    y = r.normal(size=(200, 8)) * 3
    p = embed.nearest(y)
    assert len(embed.neighbours()) == 240 and np.allclose((embed.neighbours() ** 2).sum(axis=1), 2)
    others = ((y[:, None, :] - (p[:, None, :] + embed.neighbours()[None])) ** 2).sum(axis=2)
    assert (((y - p) ** 2).sum(axis=1) <= others.min(axis=1) + 1e-9).all()


def test_mixing_meets_its_targets(spark):
    rows = [(i, "a b c d e " * (1 + i % 7), f"s{min(i % 9, 4)}", ["en", "de", None][i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("probability", F.lit("clash"))
    cells = mixing.plan(mixing.described(docs)).collect()
    total = sum(c.n_tokens for c in cells)
    for dimension in ("source", "lang"):
        sums, now = Counter(), Counter()
        for c in cells:
            sums[c[dimension]] += c.n_tokens
            now[c[dimension]] += c.n_tokens * c.probability
        whole = sum(n**mixing.TEMPER for n in sums.values())
        for value, n in sums.items():
            wanted = n**mixing.TEMPER / whole * total * mixing.KEEP
            assert abs(now[value] - wanted) < 0.01 * wanted or all(c.probability > 0.999 for c in cells if c[dimension] == value)
    drawn = mixing.sample(docs)
    assert drawn.columns == docs.columns
    assert abs(drawn.count() / 3000 - mixing.KEEP) < 0.05
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in mixing.mixed(docs).where("kept").collect()}


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (common.table(spark, f"{DATA}/sf0.1", t) for t in ("documents", "labels"))
    got = toxicity.scores(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    hits = Counter((r.predicted, r.toxic) for r in got)
    assert hits[1, 1] >= 0.8 * (hits[1, 1] + hits[0, 1])
    assert hits[1, 0] <= 0.01 * (hits[1, 0] + hits[0, 0])
    none = toxicity.scores(docs.limit(3), labels.limit(0)).collect()
    assert all(r.predicted == 0 for r in none)


def test_ftrl_learns_and_stays_sparse():
    model = toxicity.Ftrl()
    r = random.Random(1)
    for _ in range(400):
        bad = r.random() < 0.3
        model.learn(np.unique(toxicity.features(" ".join(r.choice("abcdefghijklmnop") * 3 for _ in range(30)) + (" awful" if bad else ""))), int(bad))
    p = lambda t: model.weights(np.unique(toxicity.features(t))).sum() + model.bias()
    assert p("aaa bbb awful") > 0 > p("aaa bbb ccc")
    assert (model.weights(slice(None)) != 0).sum() < 400


EDGE = "doc_id long, text string, lang string, source string, score string, fp string, key string, n int, row string"


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None, None, None, None)] * 2, [(1, "", "en", None, "s", "f", "k", 1, "r"), (1, "", "en", None, "s", "f", "k", 1, "r"), (2, "word " * 50_000, None, "s", None, None, None, None, None)]])
def test_edges(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, EDGE)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, toxic int")
    n = len(rows)
    assert exact_dedup.verdicts(docs, exact_dedup.new_index(spark)).count() == n
    assert simhash.fingerprint_groups(docs).count() == n
    assert lm.score(docs.withColumn("held_out", F.lit(False))).count() == n
    assert license_scan.scan(docs).count() == n
    assert token_count.count_tokens(docs).count() == n
    token_store.write(docs, str(tmp_path / "t"))
    assert token_store.summaries(spark, str(tmp_path / "t")).count() == n
    assert toxicity.scores(docs, labels).count() == n
    assert toxicity.reject(docs, labels).columns == docs.columns
    assert mixing.mixed(docs).count() == n
    assert mixing.sample(docs).columns == docs.columns
    assert exact_dedup.keep_distinct(docs, exact_dedup.new_index(spark)).count() == len(set(rows))
    assert simhash.keep_one(docs).columns == docs.columns
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed.near_duplicates(empty).count() == 0


def test_an_index_outlives_its_table_name(spark, tmp_path):
    path = str(tmp_path / "index")
    exact_dedup.DigestIndex(spark, "first_name", path).append(exact_dedup.digests(docs_of(spark, EXACT)))
    again = exact_dedup.DigestIndex(spark, "second_name", path)
    late = exact_dedup.verdicts(docs_of(spark, [(70, "ABC"), (71, "zzz")]), again).collect()
    assert {(r.doc_id, r.keep_id) for r in late} == {(70, 2), (71, 71)}
