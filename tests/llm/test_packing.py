"""Pieces against the tokenizer's own ids, windows against their rules, and defined edge cases."""

import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(tokenizer, docs):
    pieces = packing.pack(docs, PATH).collect()
    texts = Counter((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert ids
        sequences[p["sequence_id"]].append((p["offset"], len(ids)))
        by_doc[p["doc_id"]].append((p["start"], p["doc_tokens"], ids))
    want, got = defaultdict(Counter), defaultdict(Counter)
    for (doc, text), times in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for at, i in enumerate(ids):
            want[doc][at, len(ids), i] += times
    for doc, parts in by_doc.items():
        for start, total, ids in parts:
            for at, i in enumerate(ids):
                got[doc][start + at, total, i] += 1
    assert got == want
    lengths = []
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        lengths.append(end)
    assert all(n <= 2048 and (n >= 2048 - packing.TOLERATED or n & (n - 1) == 0) for n in lengths)
    return lengths


def test_documents(spark, sf_dir, tokenizer):
    lengths = check(tokenizer, spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5))
    padded = sum(2048 - n for n in lengths if n & (n - 1))
    assert padded < 0.01 * sum(lengths)


def test_edge_rows(edge_docs, no_docs, tokenizer):
    check(tokenizer, edge_docs)
    assert packing.pack(no_docs, PATH).collect() == []


TOLD = open(PATH).read()
PARTS = ["a", "B", " ", "  ", "\n", "\t", " \n", "é", "ß", "1", "'s", "'ll", "'", "!", "<|endoftext|>", "\x1c", "\x85", "\u00a0", "\u3000", "x", "日本", "\U0001f600", "the", "ing", "²", "\u0301"]


def ids_of(found):
    return [np.frombuffer(x, "<u4").tolist() for x in found]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    assert packing.merges_by_rank(TOLD)
    encoder, rng = packing.Encoder(TOLD, True), random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(16))) for _ in range(20000)]
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(1, 30))) for _ in range(20000)]
    texts += [" ".join(words[k : k + 20]) for k in range(0, len(words), 20)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder.encode(pa.array(texts))) == want
    assert ids_of(packing.Encoder(TOLD, False).encode(pa.array(texts))) == want


def test_every_letter_is_split_alike(tokenizer):
    """Each code point of the first planes' assigned blocks, beside letters, digits, marks and spaces."""
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000, 3)]]
    texts = [f"a{c}a 1{c}1 !{c}! {c} {c}{c}  {c}\n{c}  " for c in chars]
    encoder = packing.Encoder(TOLD, True)
    for k in range(0, len(texts), 10000):
        want = [e.ids for e in tokenizer.encode_batch(texts[k : k + 10000], add_special_tokens=False)]
        assert ids_of(encoder.encode(pa.array(texts[k : k + 10000]))) == want


def test_long_pieces_take_the_other_way(tokenizer):
    texts = ["", "a" * 1999, "b " + "a" * 2001, "c" * 1500 + " " + "c" * 1500, " " * 3000, "x y " * 900, "\n" * 2500 + "z", "é" * 1200, ""]
    for kind in (pa.string(), pa.large_string()):
        rows = pa.array(["front", *texts, "a" * 3000], kind).slice(1, len(texts))
        assert packing.rows_with_long_pieces(rows) == {2, 4, 6, 7}
    assert packing.rows_with_long_pieces(pa.array([], pa.string())) == set()
    long = pa.array(["q" * 200_000, " " * 200_000, "\n" * 200_000])  # quadratic would take minutes
    assert ids_of(packing.Encoder(TOLD, True).encode(long)) == [tokenizer.encode(t, add_special_tokens=False).ids for t in long.to_pylist()]


def test_other_tokenizers_use_their_own_encoder():
    told = json.loads(TOLD)
    merges = told["model"]["merges"]
    swapped = told | {"model": told["model"] | {"merges": merges[::-1]}}
    assert not packing.merges_by_rank(json.dumps(swapped)), "tokens that their own bytes do not give"
    assert not packing.merges_by_rank(json.dumps(told | {"normalizer": {"type": "NFC"}}))
    assert not packing.merges_by_rank(json.dumps(told | {"pre_tokenizer": {"type": "Whitespace"}}))
    assert not packing.merges_by_rank(json.dumps(told | {"model": told["model"] | {"merges": merges[:-1]}}))


def test_open_windows_are_bounded():
    rng, packer = random.Random(1), packing.Packer(64, 4)
    packing_sizes = [rng.randrange(1, 150) for _ in range(500)]
    for k, n in enumerate(packing_sizes):
        packer.add(k, 0, bytes(4 * n))
        assert len(packer.room) <= 4
        assert sum(len(v) > 0 for v in packer.held.values()) == len(packer.room)
    packer.finish()
    assert sum(len(p[2]) for _, pieces in packer.out for p in pieces) // 4 == sum(packing_sizes)
