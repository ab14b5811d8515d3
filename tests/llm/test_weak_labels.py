"""Held-out accuracy, the label model on made votes, and defined edge cases."""

import numpy as np
import pytest

from orderloom.llm import weak_labels as w


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.where("doc_id % 2 = 0")  # toxic words are learned from these only
    return docs, labels, w.fit(docs, half)


def test_held_out_accuracy(fitted):
    docs, labels, classifier = fitted
    judged = w.judge(docs, classifier)
    assert judged.count() == docs.count()
    rows = judged.join(labels, "doc_id").where("doc_id % 2 = 1").collect()
    clean = [r for r in rows if r["quality"] is not None and r["toxic"] == 0]
    good = [r["kept"] for r in judged.join(labels.withColumnRenamed("quality", "form"), "doc_id").where("form = 1 AND toxic = 0").collect()]
    junk = [r["kept"] for r in judged.join(labels.withColumnRenamed("quality", "form"), "doc_id").where("form = 0").collect()]
    toxic = [r["kept"] for r in judged.join(labels.withColumnRenamed("quality", "form"), "doc_id").where("toxic = 1 AND form = 1 AND doc_id % 2 = 1").collect()]
    assert clean and toxic
    assert np.mean(toxic) <= 0.35, "toxic documents whose labels were not seen"
    assert np.mean(good) >= 0.95
    assert np.mean(junk) <= 0.15


def test_filter_keeps_what_the_judgement_keeps(fitted):
    docs, _, classifier = fitted
    kept = w.keep(docs, classifier)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in w.judge(docs, classifier).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == ids


def test_edge_rows(spark, fitted, edge_docs, no_docs):
    _, labels, classifier = fitted
    judged = w.judge(edge_docs, classifier).collect()
    assert len(judged) == 11
    empty = {1, 2, 3}
    assert all(r["quality"] == 0 and not r["kept"] for r in judged if r["doc_id"] in empty)
    assert len({(r["quality"], r["toxicity"]) for r in judged if r["doc_id"] in (5, 6)}) == 1
    assert w.judge(no_docs, classifier).collect() == []
    none = labels.limit(0)
    assert w.judge(edge_docs, w.fit(edge_docs, none)).count() == 11
    assert w.judge(no_docs, w.fit(no_docs, none)).collect() == []


def test_label_model_recovers_error_rates():
    rng = np.random.default_rng(1)
    truth = rng.random(50_000) < 0.8
    bad_no = np.array([0.5, 0.35, 0.2, 0.6])
    votes = np.where(rng.random((50_000, 4)) < np.where(truth[:, None], 0.002, bad_no), w.NO, w.YES)
    votes[rng.random(votes.shape) < 0.1] = w.ABSTAIN
    patterns, counts = np.unique(w.pattern_of(votes), return_counts=True)
    table = w.votes_of(patterns, 4)
    prior, chances = w.fit_label_model(table, counts.astype(float))
    assert abs(prior - 0.8) < 0.1
    assert np.abs(chances[:, w.NO] - bad_no).max() < 0.12
    assert ((w.posterior(votes, prior, chances) > 0.5) == truth).mean() > 0.93


def test_patterns_round_trip():
    votes = np.random.default_rng(2).integers(0, 3, (100, 7))
    assert (w.votes_of(w.pattern_of(votes), 7) == votes).all()


def test_measures():
    m = w.measure([b"The cat THE cat!! a1", b"", b"x x x x"])
    stats = dict(zip(w.STATS, m.stats.T, strict=True))
    assert m.n_words.tolist() == [5, 0, 4]
    assert stats["again"].tolist() == [0, 0, 0.75]
    assert stats["distinct"].tolist() == [0.6, 0, 0.25]
    assert stats["listed"].tolist() == [0.4, 0, 0]
    assert stats["calls"].tolist() == [0.4, 0, 0]
    assert w._shape(b"Hello!! WORLD x12") == b"Aa! A a0"


def test_long_texts_need_no_more_words(make_docs):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(900)]
    for n, words in ((400, 100), (900, 225), (4000, 260), (40000, 260)):
        fine, poor = (" ".join(rng.permutation(np.resize(vocabulary[:k], n))).encode() for k in (words, words // 2))
        assert w.quality_votes(w.measure([fine, poor]))[:, 5].tolist() == [w.ABSTAIN, w.NO]


def test_the_sample_is_bounded_in_bytes(make_docs, monkeypatch):
    monkeypatch.setattr(w, "SAMPLED_BYTES", 8000)
    docs = make_docs([(k, "a b " * (k + 1), "en", "s") for k in range(100)] + [(1000, "c " * 5000, "en", "s"), (None, None, None, None)])
    texts = w._sample(docs, "doc_id", 3000)
    assert 30 < len(texts) and sum(map(len, texts)) <= 8000 and max(map(len, texts)) <= 1000
    assert w._sample(docs.limit(0), "doc_id", 3000) == []


def test_no_word_counts_for_two_toxic_heuristics():
    named = [b"alphaword", b"betaword", b"gammaword", b"deltaword", b"epsilonword"]
    lexicon = np.sort(np.concatenate([w.word_hashes(named)[0], w.word_hashes([b"gammaw"])[0]]))
    votes = w.toxic_votes(w.measure([*named, b"gammawhistle", b"gammaword gammawhistle", b"other words", b""]), lexicon)
    assert ((votes[:5] == w.NO).sum(1) == 1).all() and (votes[:5, 2] == w.YES).all()
    assert votes[5].tolist() == [w.YES, w.YES, w.NO]
    assert (votes[6] == w.NO).sum() == 2
    assert (votes[7:] == w.YES).all()


def test_overlapping_voters_are_told_apart_without_the_prior():
    rng = np.random.default_rng(5)
    clean = rng.random(100_000) < 0.9
    false_no, true_no = np.array([0.01, 0.001, 0.03]), np.array([0.9, 0.7, 0.3])
    votes = np.where(rng.random((100_000, 3)) < np.where(clean[:, None], false_no, true_no), w.NO, w.YES)
    patterns, counts = np.unique(w.pattern_of(votes), return_counts=True)
    _, chances = w.fit_label_model(w.votes_of(patterns, 3), counts.astype(float), trust=w.TOXIC_TRUST)
    assert np.abs(chances[:, w.NO] - true_no).max() < 0.1
    assert np.abs(chances[:, w.YES] - false_no).max() < 0.01
