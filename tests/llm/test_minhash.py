"""Fingerprints against plain rules, and likeness against true Jaccard similarity."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import common, minhash
from orderloom.llm.shingles import shingle_hashes, word_hashes


def check(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    got = minhash.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    # among rows of one id the order is the operator's own, so the outcome is compared for each possible next text
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True) + ([None] if any(i is None for i, _ in rows) else [])
    texts = {i: [t for j, t in rows if j == i] for i in ids}
    prints = dict(zip([t for _, t in rows], map(minhash.as_text, minhash.signatures([t.encode() for _, t in rows])), strict=True))
    for r in got:
        after = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]] + texts[r["doc_id"]]
        mine = [t for t in texts[r["doc_id"]] if len(t) == r["n_chars"] and prints[t] == r["fingerprint"]]
        assert mine
        changed = {minhash.edited(mine[0], n): n for n in after}
        match = [(c, n) for c, n in changed.items() if hashlib.sha256(c.encode()).hexdigest() == r["edited_sha256"]]
        assert match
        sig = minhash.signatures([match[0][0].encode()])[0]
        assert minhash.as_text(sig) == r["edited_fingerprint"]
        own = minhash.signatures([mine[0].encode()])[0]
        assert r["near_edited"] == (own == sig).mean()
        assert 0 <= r["near_next"] <= 1
    return got


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(check(docs), key=lambda r: -r["doc_id"])
    for r, n in zip(got, got[1:] + got[:1], strict=True):
        a, b = (np.frombuffer(bytes.fromhex(x["fingerprint"]), ">u2") for x in (r, n))
        assert r["near_next"] == (a == b).mean()


def test_edge_rows(edge_docs, no_docs, make_docs):
    check(edge_docs)
    assert minhash.fingerprint_documents(no_docs).collect() == []
    (alone,) = minhash.fingerprint_documents(make_docs([(7, "abcd", "en", "s")])).collect()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert alone["near_next"] == 1.0


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(5000)]
    base = list(rng.choice(words, 600))
    for changes in (0, 5, 30, 120):
        other = base.copy()
        for k in rng.integers(0, 600, changes):
            other[k] = rng.choice(words)
        sets = [{tuple(x[i : i + 5]) for i in range(596)} for x in (base, other)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        a, b = minhash.signatures([" ".join(x).encode() for x in (base, other)], 512)
        assert abs((a == b).mean() - true) < 0.1


def test_hashes_do_not_depend_on_batches_or_spaces(monkeypatch):
    from orderloom.llm import shingles

    texts = [b"", b" a  bb\nccc\td ", b"x" * 50, b"one two three four five six seven " * 9, b"\xc3\xa9 \xff z"]
    words, counts = word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    whole = [h.tolist() for h in shingle_hashes(texts, 5)]
    monkeypatch.setattr(shingles, "_PIECE", 16)
    assert [h.tolist() for h in shingle_hashes(texts, 5)] == whole
    flat = [b" ".join(t.split()) for t in texts]
    assert [h.tolist() for h in shingle_hashes(flat, 5)] == whole
    by_word = {}
    for w, h in zip(b" ".join(texts).split(), words.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def true_components(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low.setdefault(find(i), []).append(doc)
    return sorted(((doc, min((x for x in low[find(i)] if x is not None), default=None)) for i, (doc, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("hot", [100, 2])
def test_near_duplicates_are_verified_bands(spark, sf_dir, make_docs, monkeypatch, hot):
    monkeypatch.setattr(minhash, "HOT_BAND", hot)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    base = rows[3][1].split()
    for k in range(6):
        other = base.copy()
        other[10 * k + 5] = "changed"
        rows.append((10_000 + k, " ".join(other)))
    got = minhash.near_duplicates(make_docs([(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted(map(tuple, got), key=str) == true_components(rows)


def test_near_duplicates_of_edge_rows(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert sorted(map(tuple, minhash.near_duplicates(edge_docs).collect()), key=str) == true_components(rows)
    assert minhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize(("rounds", "block"), [(8, 1000), (1, 2)])
def test_chains_in_a_hot_band(make_docs, monkeypatch, rounds, block):
    for name, value in (("PERMUTATIONS", 1), ("BANDS", 1), ("HOT_BAND", 2), ("ROUNDS", rounds), ("HOT_BLOCK", block)):  # one band of one value
        monkeypatch.setattr(minhash, name, value, raising=False)
    rng, rows = np.random.default_rng(6), []
    while len(rows) < 36:
        words = [f"w{k}" for k in rng.integers(0, 10**9, 224)]
        chain = [" ".join(words[k : k + 200]) for k in (0, 12, 24)]  # similar to the next but not to the one after it
        if len(set(minhash.signatures([t.encode() for t in chain])[:, 0].tolist())) == 1:
            rows += [(len(rows) + k, t) for k, t in enumerate(chain)]
    want = true_components(rows)
    assert want == sorted(((k, k // 3 * 3) for k in range(36)), key=str)
    got = minhash.near_duplicates(make_docs([(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted(map(tuple, got), key=str) == want


def plain_fingerprints(rows, seed=42):
    """Signatures without numpy's batches: Python integers, one text, permutation and shingle at a time; shingles' hashes are the module's."""
    pairs = np.random.default_rng(seed).integers(0, 1 << 63, (128, 2), np.uint64).tolist()
    found = []
    for text in rows:
        hashes = [int(h) for h in shingle_hashes([text.encode()], 5)[0]]
        least = [min((h * (2 * a + 1) + 2 * b + 1) % 2**64 for h in hashes) if hashes else 2**64 - 1 for a, b in pairs]
        found.append("".join(f"{v >> 48:04x}" for v in least))
    return found


def test_fingerprints_against_plain_integers(make_docs):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(400)] + ["é", "\U0001f600"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 4, 5, 6, 40, 300)]
    rows = list(enumerate(texts))
    got = sorted(minhash.fingerprint_documents(make_docs([(i, t, "en", "s") for i, t in rows])).collect(), key=lambda r: r["doc_id"])
    assert [r["fingerprint"] for r in got] == plain_fingerprints(texts)
    changed = [minhash.edited(t, texts[i - 1]) for i, t in rows]  # the next in descending order; after the last comes the first
    assert [r["edited_sha256"] for r in got] == [hashlib.sha256(c.encode()).hexdigest() for c in changed]
    assert [r["edited_fingerprint"] for r in got] == plain_fingerprints(changed)
    for k, r in enumerate(got):
        values = [[p[j : j + 4] for j in range(0, 512, 4)] for p in (r["fingerprint"], r["edited_fingerprint"], got[k - 1]["fingerprint"])]
        assert r["near_edited"] == sum(a == b for a, b in zip(values[0], values[1], strict=True)) / 128
        assert r["near_next"] == sum(a == b for a, b in zip(values[0], values[2], strict=True)) / 128


def test_hot_and_null_ids_are_several_ranges(spark, make_docs):
    big = (1 << 60) + 1  # not a double
    rows = [(5, f"text {k}") for k in range(400)] + [(None, f"none {k}") for k in range(300)] + [(big + k, f"big {k}") for k in range(40)] + [(k % 4, f"low {k}") for k in range(40)]
    docs = make_docs([(i, t, "en", "s") for i, t in rows]).repartition(7)
    placed = minhash.with_followers(docs).withColumn("task", F.spark_partition_id()).collect()
    by_task = {}
    for r in placed:
        by_task.setdefault(r["task"], []).append(r)
    assert max(map(len, by_task.values())) <= 400  # of 780, in 8 ranges whose limits are sampled
    assert len({r["task"] for r in placed if r["id"] == 5 and not r["copy"]}) > 1
    assert len({r["task"] for r in placed if r["id"] is None and not r["copy"]}) > 1
    hashes = dict(docs.select("text", F.xxhash64("text")).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    for held in by_task.values():
        chain = [(r["id"], r["text"]) for r in held]
        assert held[-1]["copy"] and not any(r["copy"] for r in held[:-1])
        assert all(following[a] == b for a, b in zip(chain, chain[1:], strict=False))
    assert sorted(((r["id"], r["text"]) for r in placed if not r["copy"]), key=str) == sorted(rows, key=str)


def test_ranges_follow_the_size_of_the_input(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    size = common.size_of(docs)
    monkeypatch.setattr(common, "SHUFFLE_TARGET_BYTES", size // 20)
    assert common.partitions_for(docs) >= 20
    assert minhash.with_followers(docs).rdd.getNumPartitions() >= 20
