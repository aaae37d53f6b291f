"""Stages with one Python worker a task: two in a row would both come to hold a tokenizer and its words."""

import re

import numpy as np
import pytest

from planeforge.llm import bpe_trie, packing, token_counts, words

from .cases import SCHEMA, rows

WORDS, BYTES = words.public_path("word_bpe_49k.json"), words.public_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("one"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython", plan))


def test_trie_encodes_and_decodes_in_one_worker(spark, folder):
    assert python_nodes(bpe_trie.op5_bpe_trie(spark, folder)) == 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    both = bpe_trie.encode_and_decode(docs, WORDS)
    apart = bpe_trie.decode(bpe_trie.encode(docs, WORDS), WORDS)
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


def test_pieces_are_cut_and_numbered_in_stages_of_one_worker(spark, folder, monkeypatch):
    seen = []

    def noted(df, name):
        seen.append(python_nodes(df))
        return kept(df, name)

    kept = packing.materialize
    monkeypatch.setattr(packing, "materialize", noted)
    packing.op2_best_fit_packing(spark, folder)
    assert seen and max(seen) == 1


def test_sections_are_cut_where_tokens_are_counted(spark, folder):
    assert python_nodes(token_counts.op8_token_counts(spark, folder)) == 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = token_counts.attribute(token_counts.line_sections(docs), BYTES).collect()
    assert sorted(map(str, given)) == sorted(map(str, token_counts.attribute(docs.select("doc_id", "text"), BYTES).collect()))


def test_spans_are_those_of_the_library():
    spans, lib = token_counts.Spans(BYTES), words.load(BYTES)
    for text in [r[1] for r in rows() if r[1]] + ["a" * 3000, " \n\t" * 99 + "é😀x", "a<|endoftext|> b", "\x00\x7f\xad日本"]:
        assert (spans.of(text) == np.array(lib.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)).all()
    assert not hasattr(spans, "memory")  # no chunk is kept between texts


def test_pipeline_finds_near_copies_by_simhash(spark, monkeypatch):
    import random

    import corpus_pipeline
    from planeforge.llm import near_copies, simhash

    rng = random.Random(1)
    base = [f"w{rng.randrange(3000)}" for _ in range(3000)]
    texts = [" ".join(base), " ".join(f"new{i}" if i % 750 == 7 else w for i, w in enumerate(base)), "another text of a few words that has no copy"]
    a, b = (simhash.fingerprint_of(t) for t in texts[:2])
    assert (a ^ b).bit_count() <= simhash.BITS
    # Without what the min-hash bands bring together.
    monkeypatch.setattr(near_copies, "candidates", lambda *_: spark.createDataFrame([], "key long, name long"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [0, 2]


def test_near_copies_never_shuffle_texts(spark):
    from planeforge.llm import near_copies

    docs = spark.createDataFrame([(i, f"text {i % 70} " * 9) for i in range(200)], "doc_id long, text string").repartition(5)
    kept = near_copies.keep_one(docs, bits=3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and len(kept.collect()) == len({r.text for r in docs.collect()})
