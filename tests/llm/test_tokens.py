"""Token counts and token files against the tokenizer on whole texts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellbulk.llm import token_count, token_files
from cellbulk.llm.queries import tokenizer_file
from cellbulk.session import new_folder

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
TOKENIZERS = {path: token_count.loaded(path) for path in (BYTES, WORDS)}


def ids(path, text):
    return TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids


def test_counts_equal_whole_encoding(docs, sample):
    for frame in (docs, sample):
        want = Counter((r.doc_id, len((r.text or "").encode()), len(ids(BYTES, r.text))) for r in frame.collect())
        got = token_count.token_counts(frame, BYTES, chunk=2000, overlap=32).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_empty_table(no_docs):
    assert token_count.token_counts(no_docs, BYTES).collect() == []


@pytest.mark.parametrize("text", ["x" * 5000, "ab " * 3000, "a  b\n \n c" * 900, "日本語 テキスト" * 800,
                                  "<|endoftext|>" * 400, " " * 3000 + "end", "don't we'll " * 700])
def test_overlaps_are_widened_until_they_align(text):
    for chunk, overlap in ((64, 8), (300, 16), (1000, 1)):
        assert token_count.count_huge(TOKENIZERS[BYTES], text, chunk, overlap) == len(ids(BYTES, text))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1'sTéÉß²ªİΣ\u0301日 \n\t\u00a0\x1c._<|>"), max_size=400))
def test_any_text(text):
    assert token_count.count_huge(TOKENIZERS[BYTES], text, 40, 4) == len(ids(BYTES, text))
    assert token_count.PieceCounter(TOKENIZERS[BYTES]).counts([text]) == [len(ids(BYTES, text))]
    for path in (BYTES, WORDS):
        encoder = token_files.PieceEncoder(TOKENIZERS[path])
        assert np.frombuffer(next(encoder.encode([text])), encoder.kind).tolist() == ids(path, text)


def test_words_are_split_as_the_vocabulary_does():
    assert token_files.without_splitting(TOKENIZERS[WORDS]) and not token_files.without_splitting(TOKENIZERS[BYTES])
    text = "Don't ÉCOLE_9 ''s <|startoftext|> x<|endoftext|>'LL Straße... a1b22 'S\tœuvre E\u0301"
    assert np.frombuffer(next(token_files.PieceEncoder(TOKENIZERS[WORDS]).encode([text])), "<u2").tolist() == ids(WORDS, text)


def test_memory_of_pieces_is_bounded():
    counter = token_count.PieceCounter(TOKENIZERS[BYTES], memory=5)
    texts = ["one two three four", "five six seven eight", "one two nine"]
    assert [counter.counts([t])[0] for t in texts] == [len(ids(BYTES, t)) for t in texts]
    assert len(counter.young) <= 5 and len(counter.old) <= 5


def written(spark, docs):
    path = new_folder(spark, "token-test")
    token_files.write_tokens(docs, path, WORDS)
    return path, token_files.write_index(spark, path).collect()


@pytest.mark.parametrize("frame", ["docs", "sample"])
def test_round_trip(spark, request, frame):
    frame = request.getfixturevalue(frame)
    path, rows = written(spark, frame)
    order = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.text or ""))
    got, start = sorted(rows, key=lambda r: r.start), 0
    assert len(got) == len(order)
    for row, doc in zip(got, order):
        want = np.array(ids(WORDS, doc.text) + [1], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, start, len(want), zlib.crc32(want))
        start += len(want)
    some = [d for d in order if d.doc_id is not None][:3]
    read = token_files.read_tokens(spark, path, [d.doc_id for d in some]).collect()
    assert {r.doc_id: r.ids for r in read} == {d.doc_id: ids(WORDS, d.text) + [1] for d in some}


def test_empty_table_has_empty_files(spark, no_docs):
    path, rows = written(spark, no_docs)
    assert rows == [] and token_files.read_tokens(spark, path, [1]).collect() == []


def test_another_dictionary_is_refused():
    import zstandard

    samples = [np.arange(i, i + 200, dtype="<u2").tobytes() for i in range(300)]
    dictionary = zstandard.train_dictionary(4096, samples).as_bytes()
    with pytest.raises(ValueError, match="dictionary"):
        token_files.opener(dictionary)(memoryview(b""), 2, 1, 5)


def test_words_listed_together_have_their_own_ids():
    tokenizer = TOKENIZERS[WORDS]
    listed = token_files.ListedWords(token_files.without_splitting(tokenizer), 1000)
    words = {"the", "th", "été", "ß", "x" * 300, "!", "'s", "7", "!?#", "zukeitpf", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))}
    found = listed.fresh(words)
    assert {w: np.frombuffer(found[w], listed.kind).tolist() for w in words} == {
        w: tokenizer.encode(w, add_special_tokens=False).ids for w in words}
    assert listed.fresh(set()) == {}
    spaced = listed.fresh({"a b", "c"})  # not a clean word: encoded one by one
    assert np.frombuffer(spaced["a b"], listed.kind).tolist() == tokenizer.encode("a b", add_special_tokens=False).ids


def test_pieces_of_plain_words_are_not_remembered():
    encoder = token_files.PieceEncoder(TOKENIZERS[WORDS])
    texts = ["Don't stop, (word) 12", "", "日本 mixed text\nWord", "a\tb  c"]
    assert [np.frombuffer(i, "<u2").tolist() for i in encoder.encode(texts)] == [ids(WORDS, t) for t in texts]
    assert set(encoder.young) == {"日本"}
