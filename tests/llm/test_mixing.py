"""Targets against plain water-filling, taken words against targets."""

import re
from collections import defaultdict

import pytest

from orderloom.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, target, free = budget * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


def check(docs):
    rows = mixing.plan_mix(docs).select("row.source", "row.text", "size", "source_size", "target", "epochs", "extra").collect()
    assert len(rows) == docs.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        words = r["epochs"] * r["size"] + r["extra"]
        assert 0 <= r["extra"] <= r["size"]
        assert words <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += words
        target[r["source"]] = (r["source_size"], r["target"])
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == (sizes[s], pytest.approx(want[s]))
        assert taken[s] == pytest.approx(want[s], abs=1)


def test_targets_are_met(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert mixing.plan_mix(no_docs).collect() == []


def test_sources_above_their_cap_hand_their_share_on(make_docs):
    check(make_docs([(k, "w " * n, "en", s) for k, (s, n) in enumerate([("a", 3), ("b", 5), ("c", 400), ("d", 1), (None, 90), ("e", 0)])]))


def test_reruns_agree_and_the_mix_holds_the_planned_words(edge_docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    first = sorted(map(str, mixing.mix(edge_docs).collect()))
    assert first == sorted(map(str, mixing.mix(edge_docs.repartition(5)).collect()))
    mixed = mixing.mix(edge_docs)
    assert mixed.schema == edge_docs.schema or mixed.dtypes == edge_docs.dtypes
    planned = sum(r["w"] for r in mixing.plan_mix(edge_docs).selectExpr("epochs * size + extra w").collect())
    assert sum(words(r["text"]) for r in mixed.collect()) == planned
    assert all(r["n_chars"] == len(r["text"]) for r in mixed.collect() if r["text"] is not None)


@pytest.mark.parametrize("slice_bits", [48, 62])
def test_the_cut_in_a_hot_id_and_in_repeats(make_docs, monkeypatch, slice_bits):
    """One id has most of a source: with unlike texts, and as repeats of one row; some rows are before the cut, one at most is cut."""
    monkeypatch.setattr(mixing, "SLICE", slice_bits)
    unlike = [(7, " ".join(["w"] * (1 + k % 5) + [f"x{k}"]), "en", "a") for k in range(200)] + [(k, "one two", "en", "b") for k in range(100)]
    repeats = [(7, "just the same five words", "en", "a")] * 150 + [(k, "a b c", "en", "b") for k in range(300)] + [(None, None, None, None)] * 3
    for rows in (unlike, repeats):
        docs = make_docs(rows)
        check(docs)
        planned = mixing.plan_mix(docs).selectExpr("row.source", "size", "extra").collect()
        for source in ("a", "b"):
            mine = [r for r in planned if r["source"] == source]
            assert sum(0 < r["extra"] < r["size"] for r in mine) <= 1
        again = mixing.plan_mix(docs.repartition(3)).selectExpr("row.doc_id", "row.text", "size", "extra").collect()
        assert sorted(map(str, again)) == sorted(map(str, mixing.plan_mix(docs).selectExpr("row.doc_id", "row.text", "size", "extra").collect()))
