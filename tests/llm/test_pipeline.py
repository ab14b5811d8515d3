"""The pipeline's stages against plain versions, each on its own input."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import weak_labels

from .test_secret_scan import PLAIN
from .test_simhash import plain_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "test")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_each_stage_on_its_input(stages, spark, sf_dir):
    docs, good, single, redacted, mixed, packed = stages
    classifier = weak_labels.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in weak_labels.judge(docs, classifier).where("kept").collect()}
    assert rows(good) == [r for r in rows(docs) if r[0] in kept]

    groups = plain_groups([(r["doc_id"], r["text"]) for r in good.collect()])
    stay = {low for _, _, low in groups}
    assert rows(single) == [r for r in rows(good) if r[0] in stay]

    before, after = {r["doc_id"]: r["text"] for r in single.collect()}, {r["doc_id"]: r["text"] for r in redacted.collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        parts = PLAIN.split(text)
        hidden = [m[0] for m in PLAIN.finditer(text) if re.search(r'token = "$', text[: m.start()])]
        assert after[i] == PLAIN.sub(lambda m, hidden=hidden: "[SECRET]" if m[0] in hidden else m[0], text), parts[0]

    words = lambda t: len(t.split())
    texts = {r["doc_id"]: r["text"] for r in redacted.collect()}
    total = sum(map(words, texts.values()))
    assert sum(words(r["text"]) for r in mixed.collect()) == pytest.approx(1.5 * total, abs=40)
    assert all(texts[r["doc_id"]].startswith(r["text"]) for r in mixed.collect())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(i for r in mixed.collect() for i in [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1])
    got = np.sort(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in packed.collect()]))
    assert got.tolist() == want


def test_run_gives_the_last_stage(stages, spark, sf_dir):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(stages[-1])


def test_edge_rows(spark, sf_dir, edge_docs, no_docs):
    for df in (edge_docs, no_docs):
        columns, docs = df.columns, df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "test")
            assert docs.columns == columns
        corpus_pipeline.pack_sequences(spark, docs, sf_dir).collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, edge_docs, sf_dir).collect()
    assert sum(r["text"] is not None and r["text"].startswith("the cat") for r in kept) == 1
    assert sum(not (r["text"] or "").strip() for r in kept) == 1
