"""Cuts against a plain search of lines, exact round trips, and defined edge cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import fill_in_middle as fim


def plain(doc_id, text):
    """The row that the rules give, by joining lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return (doc_id, n, "plain", None, None, text, text)
    p, q = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = "".join(units[:p]), "".join(units[p:q]), "".join(units[q:])
    spm = h4 % 100 < 50
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), out, text)


def check(docs):
    found = fim.transform(docs).withColumn("restored", fim.restored(F.col("output"), F.col("form")))
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted((plain(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=str)
    return got


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 255, 256, 257, 4100])
def test_positions_at_every_rank(n):
    rng = random.Random(n)
    lines = ["é\U0001f600x"[: rng.randrange(4)] + "\n" for _ in range(n)]
    for text in ("".join(lines), "".join(lines) + "end"):
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        built = fim.LineList(text)
        assert built.n == len(units)
        at = 0
        for rank in range(len(units) + 1):
            assert built.position(rank) == at
            at += len(units[rank]) if rank < len(units) else 0
        assert all(sum(chars) == len(text) and sum(passed) == built.n for passed, chars in built.lanes)


def test_few_links_are_passed():
    built = fim.LineList("x\n" * 100_000)
    assert [len(lines) for lines, _ in built.lanes] == [100_000, 6250, 391, 25, 2]


def test_documents(spark, sf_dir):
    got = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert {r[2] for r in got} >= {"psm", "spm"}


def test_edge_rows(edge_docs, no_docs, make_docs):
    check(edge_docs)
    assert fim.transform(no_docs).collect() == []
    marks = ["a<P>b\nc", "<S>", "x\n<M>\n", "<P\n>", "<<P>>", "a<\nP>b\n<S\nM>", "\n", "\n\n\n", "no end", "<", "<P", "\r\n \u0085x"]
    check(make_docs([(k * 100 + j, t, "en", "a") for k, t in enumerate(marks) for j in range(12)]))


def test_shares_are_parameters(make_docs):
    docs = make_docs([(k, "a\nb\nc", "en", "s") for k in range(300)])
    assert {r["form"] for r in fim.transform(docs, transformed=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.transform(docs, suffix_first=100).collect()} == {"spm"}
    assert {r["form"] for r in fim.transform(docs, transformed=50).collect()} == {"plain", "psm", "spm"}


def test_long_texts_leave_in_small_batches(make_docs, monkeypatch):
    monkeypatch.setattr(fim, "_BATCH_BYTES", 50)
    check(make_docs([(k, f"line {k}\n" * (k % 9), "en", "s") for k in range(200)]))
