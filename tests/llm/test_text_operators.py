"""Operators on single texts: tokenizers, licenses, fingerprints, against the libraries and plain versions."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe, license_scan, simhash, token_count, token_store, words

PATH = words.default_vocabulary()
LETTERS = "aab c\n\t'sre.,12é漢字͸՘\U00010940  \r\n\x1c　<|>"


def library_ids(text):
    return words.library(PATH).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*LETTERS, "<|endoftext|>", "  ", " \n "]), max_size=60).map("".join))
def test_ids_and_counts_match_the_library(text):
    ids = library_ids(text)
    encoded = bpe.pairs(PATH).encode(text)
    assert encoded == array("I", ids).tobytes()
    assert bpe.pairs(PATH).decode(encoded) == words.library(PATH).decode(ids, skip_special_tokens=False)
    assert token_store.encoder(PATH)(text) == encoded
    assert token_count.counter(PATH)(text) == len(ids)


def test_counts_over_chunks_and_random_token_strings():
    whole, cut = token_count.Counter(PATH), token_count.Counter(PATH, chunk=7)
    r = random.Random(1)
    tokens = [b for b in whole.machine.token if len(b) < 12]
    for _ in range(1500):
        text = b"".join(r.choice(tokens) for _ in range(r.randint(1, 6))).decode("utf8", "ignore") + r.choice(["", " x", "aaaaaaaa", "\n \n"])
        assert whole.count(text) == cut.count(text) == len(library_ids(text)), text


def test_states_and_memories_stay_bounded():
    machine = token_count.Transducer(bpe.pairs(PATH), most_states=50)
    for word in ("hello", " world", "internationalisation", "zzzzqqqq"):
        assert machine.count(word) == len(library_ids(word))
    memory = words.WordMemory(len, limit=3)
    for i in range(10):
        assert memory[str(i)] == 1
    assert len(memory) <= 3


def test_a_long_word_takes_no_quadratic_time():
    text = "ab" * 100_000
    ids = bpe.pairs(PATH).encode(text)
    assert bpe.pairs(PATH).decode(ids) == text
    assert token_count.Counter(PATH).count(text) == len(ids) // 4


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 4096, 4097, 10_000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 17, n).astype("<u4")
    assert np.array_equal(token_store.unpack(token_store.pack(ids, planes, block=4096)), ids)


def test_sentencepiece_counts():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    assert token_count.counter(path)("Hello big world") == len(sentencepiece.SentencePieceProcessor(model_file=path).encode("Hello big world"))


def plain_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


@pytest.mark.parametrize("text", [None, "", " \n", "One", "É a B c", "a b c d", "a b c d e a b c d e", "x\x0by\x0cz\x1cw v u t  s"])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def brute_roots(fps, radius=4):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    root = np.arange(len(fps))
    while True:
        new = np.where(near, root[None, :], len(fps)).min(axis=1)
        if np.array_equal(new, root):
            return root
        root = new


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300, 2000])
def test_gray_index_finds_all_links(n):
    r = np.random.default_rng(n)
    base = r.integers(0, 1 << 63, n // 3 + 1, dtype=np.uint64)
    fps = base[r.integers(0, len(base), n)]
    for _ in range(5):
        fps = fps ^ ((np.uint64(1) << r.integers(0, 64, n, dtype=np.uint64)) * (r.random(n) < 0.5).astype(np.uint64))
    index = simhash.GrayIndex(np.unique(fps))
    index.link(4, budget=512)
    assert np.array_equal(index.root, brute_roots(index.fps))


def test_gray_ranks_invert_gray_codes():
    n = np.arange(1000, dtype=np.uint64)
    assert np.array_equal(simhash.gray_rank(n ^ (n >> np.uint64(1))), n)


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_valid_and_equals_the_plain_one_on_unique_words():
    r = random.Random(3)
    for _ in range(300):
        a = [r.choice("abcdefghij") for _ in range(r.randint(0, 12))]
        b = [r.choice("abcdefghij") for _ in range(r.randint(0, 12))]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= longest_common(a, b)
        c, d = r.sample(range(40), 15), r.sample(range(40), 15)
        assert len(license_scan.align(c, d)) == longest_common(c, d)


def test_license_finds():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    mit = license_scan.TEMPLATES["mit"]
    assert [f.license for f in scanner.scan("x " * 50 + mit.lower() + " y" * 50)] == ["mit"]
    changed = mit.replace("Software", "Program")
    assert [f.license for f in scanner.scan(changed)] == ["mit"]
    assert scanner.scan("the license of this software is unclear") == []
    twice = scanner.scan("Released under the MIT License.\nReleased under the MIT License.")
    assert [(f.license, f.start) for f in twice] == [("notice:mit", 0), ("notice:mit", 5)]
    both = scanner.scan("Licensed under the Apache License, Version 2.1. a b c. Licensed under CC BY-NC 4.0.")
    assert [f.license for f in both] == ["notice:apache-2.0", "notice:cc-by-nc"]
    assert scanner.scan(None) == [] and scanner.scan("") == []


def test_digest_columns(spark):
    rows = [(1, "Hello world"), (2, None), (None, "a\n\n b"), (1, "Hello world"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(bpe.round_trips(docs).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    want = sorted(((i, library_ids(x or ""), x or "") for i, x in rows), key=lambda r: (r[0] or 0, len(r[1])))
    for got, (i, ids, text) in zip(out, want, strict=True):
        assert (got.doc_id, got.n_tokens) == (i, len(ids))
        assert got.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs)).collect()
    assert all(r.decoded == (r.text or "") and r.ids == library_ids(r.text or "") for r in back)
    counted = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(docs, limit=2).collect()}
    assert counted == {(i, len((x or "").encode()), len(library_ids(x or "")), len(library_ids(x or "")) > 2) for i, x in rows}


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT", 20)
    rows = [(5, "Hello world " * 9), (2, None), (None, "n"), (9, "b"), (9, "a"), (3, ""), (2**40, "far")]
    path = str(tmp_path / "ids")
    token_store.write(spark.createDataFrame(rows, "doc_id long, text string"), path, planes="bit")
    got = sorted(token_store.summaries(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, x) in zip(got, sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "")), strict=True):
        ids = array("I", [*library_ids(x or ""), 0])
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {bytes(r.ids) for r in token_store.read(spark, path).collect()} == {array("I", [*library_ids(x or ""), 0]).tobytes() for _, x in rows}
