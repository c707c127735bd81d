"""Operators 11 to 13 against plain versions that share no code with them, on small tables with every odd row."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import common, decontaminate, filter_audit, importance

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int, text string"


def _docs(spark, texts, sources=("a", "b", None, "")):
    rows = [(i, t, None, sources[i % len(sources)], None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "lost", None, "a", None), (None, None, None, None, None)], SCHEMA)


# ---------------------------------------------------------------- operator 11


def _fails(rows):
    texts = {}
    for d, t, _ in rows:
        if d is not None:
            texts[t] = min(d, texts.get(t, d))
    out = []
    for d, t, part in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" * (len(w) < 200)
        fails += "B" * (100 * len(set(w)) < 50 * len(w))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        fails += "D" * bool(re.search("[#$%&*|]", t))
        fails += "E" * (d is not None and d > texts[t])
        out.append((d, part, fails))
    return out


def _plain_audit(docs, labels):
    rows = _fails([(r.doc_id, r.text or "", r.source or "") for r in docs.collect()])
    good, toxic = ({r.doc_id for r in labels.collect() if r.doc_id is not None and r[c] == 1} for c in ("quality", "toxic"))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [r for r in rows if r[1] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                lost = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(lost), sum(f in r[2] for r in own) - len(lost), sum(r[2] == f for r in own),
                    sum(r[0] in good for r in lost), sum(r[0] in toxic for r in lost),
                ]
    for (part, order, k), row in out.items():
        row.append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == order[k - 1]))
    return out


def test_audit_against_plain(spark):
    rng = random.Random(4)
    texts = ["", None, "#", "A B C", "once   upon\x0ba\ttime\n", "word " * 300, "Ångström $ " * 150, "x" * 50_000]
    texts += [" ".join(rng.choice("to be or not $5 Be".split()) + str(rng.randrange(300)) for _ in range(rng.choice([50, 220]))) for _ in range(20)]
    docs = _docs(spark, texts + texts[:9])
    docs = docs.unionByName(docs.where("doc_id = 3"))  # a repeated row
    marks = [(i, int(i % 3 == 0), int(i % 4 == 0), "clash") for i in range(0, 40, 2)]
    labels = spark.createDataFrame([*marks, (4, 1, 0, None), (4, None, 1, None), (None, 1, 1, "")], LABELS)
    want = _plain_audit(docs, labels)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in filter_audit.audit(docs.withColumn("part", docs.lang), labels).collect()}
    assert got == want


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0


def test_keyed_left_deals_out_hot_and_cold_keys(spark):
    rows = spark.range(5000).selectExpr("id", "if(id < 3000, 'hot', concat('k', id % 700)) as k").unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    facts = rows.where("k is not null and k not in ('k1', 'k2')").groupBy("k").count().withColumnRenamed("count", "n")
    got = common.keyed_left(rows, facts, "k", "n", 5000)
    assert got.count() == 5001 and got.columns == ["id", "k", "n"]
    assert got.where("n is null").selectExpr("k").distinct().count() == 3
    assert got.where("k = 'hot' and n = 3000").count() == 3000


# ---------------------------------------------------------------- operator 12


def _features(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [zlib.crc32(f.encode()) % 10_000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]


def _plain_resampling(docs, bench):
    s, t = (Counter(b for r in rows for b in _features(r.text)[1]) for rows in (docs, bench))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for r in docs:
        w, f = _features(r.text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        out.append((r.doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0]))
    rank = [(*x[:4], i + 1) for i, x in enumerate(able[: 25 * len(able) // 100])]
    return sorted(map(str, rank + [(*x[:4], None) for x in able[len(rank) :]] + [(*x[:4], None) for x in out if not x[4]]))


@pytest.mark.parametrize("block", [64, 1 << 21])
def test_byte_automaton(block, monkeypatch):
    """Every block length gives the same features, whatever stands at its end."""
    monkeypatch.setattr(importance, "BLOCK", block)
    rng = random.Random(block)
    texts = ["", None, "a", "A-Z", "é" * 700 + " zwei", "naïve 日本語テキスト w0rds", "x" * 1000, "y" * 63, " " * 100, "ab", "cd", "Ünder_score {x}"]
    texts += ["".join(rng.choice("aB1é_ \n") for _ in range(rng.randrange(400))) for _ in range(200)]
    for array in (pa.array(texts), pa.array(["before", *texts, "after"])[1:-1], pa.array(texts, pa.large_string())):
        words, buckets = Counter(), [Counter() for _ in texts]
        for of_words, of_features, found in importance.features(array):
            words.update(of_words.tolist())
            for i, b in zip(of_features.tolist(), found.tolist(), strict=True):
                buckets[i][b] += 1
        assert [words[i] for i in range(len(texts))] == [len(_features(t)[0]) for t in texts]
        assert buckets == [Counter(_features(t)[1]) for t in texts]
    assert list(importance.features(pa.array([], pa.string()))) == []


def test_resampling_against_plain(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = _docs(spark, ["", None, "one two", *[" ".join(rng.choices(vocabulary, k=rng.choice([5, 19, 20, 60]))) for _ in range(300)]])
    docs = docs.unionByName(docs.where("doc_id < 40")).withColumn("score", docs.lang).withColumn("row", docs.n_chars)
    bench = spark.createDataFrame([(i, " ".join(rng.choices(vocabulary[:40], k=30))) for i in range(20)] + [(99, None)], "item_id long, text string")
    got = importance.resampled(docs, bench)
    assert sorted(str(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank"))) for r in got.collect()) == _plain_resampling(docs.collect(), bench.collect())
    kept = importance.sample(docs, bench)
    assert kept.columns == docs.columns
    drawn = {r.doc_id for r in got.where("rank is not null").collect()}
    assert {r.doc_id for r in kept.collect()} == drawn and len(drawn) > 10


def test_ranks_of_equal_rows(spark):
    rows = spark.range(900).selectExpr("cast(7 as long) as doc_id", "cast(5 as long) as score").unionByName(spark.createDataFrame([(None, 5), (3, 5), (9, 6)], "doc_id long, score long"))
    got = importance.ranked(rows, 10_000).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 904))
    assert {r["rank"]: r.doc_id for r in got}[1] == 9 and {r["rank"]: r.doc_id for r in got}[2] == 3 and {r["rank"]: r.doc_id for r in got}[903] is None


def test_resampling_of_nothing(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(docs, bench).count() == 0 and importance.sample(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b", None, None, None)], SCHEMA)
    assert importance.resampled(one, bench).first()["rank"] is None


# ---------------------------------------------------------------- operator 13


def _words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _plain_marks(docs, bench):
    windows = {}
    for r in bench:
        w = _words(r.text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if r.item_id is None else str(r.item_id))
    sizes, out = {len(x) for x in windows}, []
    for r in docs:
        w = _words(r.text)
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    items |= own
        out.append((r.doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def _contamination(spark, short):
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz")
    passages = [[word() for _ in range(rng.choice([10, 11, 15, 40]))] for _ in range(30)]
    common_head = [word() for _ in range(12)]  # all of these items share a head
    passages += [common_head + [f"q{i}", word(), word()] for i in range(25)]
    passages += [["one", "two"], ["solo"], [f"s{i}" for i in range(7)]] if short else []
    bench = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(None, " ".join(passages[0][::-1] + ["zz"])), (900, ""), (901, None), (3, "A repeated id, of an item that has more to say than ten words!")]
    texts = ["", None, "Solo!", "x " * 9, "One, TWO three"]
    for i in range(150):
        text = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p)) if rng.random() < 0.4 else 0
            text += p[a : a + rng.choice([5, 9, 10, 12, 60])] + [word() for _ in range(rng.randrange(12))]
        texts.append((" " if i % 2 else ", ").join(w.upper() if i % 3 else w for w in text))
    texts += [" ".join(common_head)] * 40 + [" ".join(passages[1] * 400)]
    return _docs(spark, texts + texts[5:15]), spark.createDataFrame(bench, "item_id long, text string")


@pytest.mark.parametrize("short", [False, True])
def test_winnowing_against_plain(spark, short):
    docs, bench = _contamination(spark, short)
    docs = docs.withColumn("digest", docs.lang).withColumn("words", docs.lang).withColumn("start", docs.lang)
    got = decontaminate.marked(docs, bench)
    assert sorted(str(tuple(r)) for r in got.collect()) == _plain_marks(docs.collect(), bench.collect())
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == got.where("not contaminated").count()


def test_fingerprints_in_blocks(spark, monkeypatch):
    """Past BLOCK fingerprints the documents are passed over more than once, with the same result."""
    docs, bench = _contamination(spark, False)
    want = sorted(str(tuple(r)) for r in decontaminate.marked(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    assert sorted(str(tuple(r)) for r in decontaminate.marked(docs, bench).collect()) == want


def test_spans_merge_overlapping_windows(spark):
    rows = spark.createDataFrame([(b"t", s, n) for s, n in ((0, 10), (3, 10), (13, 10), (30, 10), (31, 2))], "digest binary, start int, size int")
    assert sorted((r["first"], r["end"]) for r in decontaminate.spans(rows).collect()) == [(0, 23), (30, 40)]


def test_decontamination_of_nothing(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    full, items = _contamination(spark, False)
    assert decontaminate.marked(docs, bench).count() == 0 and decontaminate.marked(docs, items).count() == 0
    assert decontaminate.marked(full, bench).where("contaminated").count() == 0
    assert decontaminate.clean(full, bench).count() == full.count()


def test_crc_table_is_zlibs():
    data = np.frombuffer(b"some words of bytes", np.uint8)
    starts, lengths = np.array([0, 5, 11]), np.array([4, 5, 2])
    got = importance.advance(np.full(3, 0xFFFFFFFF, np.uint32), data, starts, lengths) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(x) for x in (b"some", b"words", b"of")]
