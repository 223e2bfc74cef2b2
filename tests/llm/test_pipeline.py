"""The pipeline's stages against brute force, one after the other."""

import zlib

import numpy as np

import corpus_pipeline
from cellbulk.llm import quality
from cellbulk.llm.queries import tokenizer_file
from cellbulk.session import saved
from tests.llm.conftest import components_of
from tests.llm.test_decontamination import words
from tests.llm.test_near_duplicates import plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality", "near-duplicates", "decontamination", "mixing", "token-files"]
    stages = dict(corpus_pipeline.STAGES)
    good = saved(stages["quality"](spark, docs, SF), "quality")
    scores = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.where("predicted = 1").collect()}

    rows = good.collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    single = saved(stages["near-duplicates"](spark, good, SF), "single")
    assert {r.doc_id for r in single.collect()} == set(components_of(fps, pairs).values()) and pairs

    windows = set()
    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(item.text)
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(w) for w in windows}

    def dirty(text):
        w = words(text)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    clean = saved(stages["decontamination"](spark, single, SF), "clean")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect() if not dirty(r.text)}

    mixed = saved(stages["mixing"](spark, clean, SF), "mixed")
    assert sorted(map(str, mixed.collect())) == sorted(map(str, clean.collect()))
    assert all(s.columns == columns for s in (good, single, clean, mixed))
    order = [r.doc_id for r in mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").sort(
        "file_name", "row_index").collect()]

    from tokenizers import Tokenizer

    tokenizer, texts = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")), {r.doc_id: r.text for r in rows}
    got = {r.doc_id: r for r in stages["token-files"](spark, mixed, SF).collect()}
    start = 0
    for doc_id in order:
        ids = np.array(tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [1], "<u4")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert len(got) == len(order)


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_rows_that_come_from_no_file(spark):
    rows = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert corpus_pipeline.in_stored_order(rows)[1] == ["doc_id"]
