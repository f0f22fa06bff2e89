import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from strata.llm import token_files
from strata.llm.blobs import read_blobs
from strata.llm.token_files import TokenFile, WordEncoder, encoder, read_token_spans, write_token_files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return encoder(VOCABULARY).tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abÄé'.,!s tTİΣß\n\t\x85\xa0́4٣漢字<|>🙂K")), max_size=40), max_size=6))
def test_words_encode_like_whole_texts(texts):
    assert [x.tolist() for x in encoder(VOCABULARY).encode_all(texts)] == [whole(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_encodes_like_whole_texts(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert [x.tolist() for x in encoder(VOCABULARY).encode_all(texts)] == [whole(t) for t in texts]


def test_special_token_strings_and_long_texts(monkeypatch):
    monkeypatch.setattr(token_files, "CUT_AT_ONCE", 50)
    words = WordEncoder(VOCABULARY)
    texts = ["<|endoftext|> a<|startoftext|>b", "", "word, " * 40, "x" * 300, "it's " * 30]
    assert [x.tolist() for x in words.encode_all(texts)] == [whole(t) for t in texts]


ROWS = [
    (5, "five six seven", "x"),
    (-1, "minus", "x"),
    (None, "no id", "x"),
    (3, None, "x"),
    (4, "", "x"),
    (2, 'two " quoted', "x"),
    (2, "two again", "x"),
    (7, "long text here " * 500, "x"),
    (8, "same", "x"),
    (8, "same", "x"),
]


@pytest.mark.parametrize("file_tokens", [1, 40, 1 << 20])
def test_round_trip(spark, tmp_path, file_tokens):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string")
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs, path, VOCABULARY, length=16, batch_rows=3, file_tokens=file_tokens)
    got = sorted(read_token_spans(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    texts = {}
    for doc_id, text, _ in ROWS:
        texts.setdefault(doc_id, []).append(whole(text or "") + [1])
    start = 0
    for r in got:
        crc = {zlib.crc32(np.array(ids, "<u4").tobytes()): len(ids) for ids in texts[r["doc_id"]]}
        assert crc[r["ids_crc32"]] == r["n_tokens"] and r["start"] == start
        start += r["n_tokens"]


def test_random_access_is_a_view_with_masks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word {i} " * i) for i in range(30)], "doc_id long, text string")
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs.coalesce(1), path, VOCABULARY, length=32, batch_rows=4)
    stream = []
    contents = [r["content"] for r in read_blobs(spark, path).collect()]
    for name, content in sorted((TokenFile(bytes(c)).file_no, bytes(c)) for c in contents):
        local = tmp_path / f"{name}.arrow"
        local.write_bytes(content)
        file = TokenFile(str(local))
        for i in range(len(file)):
            ids, valid, ends = file.sequence(i)
            assert len(ids) == len(valid) == len(ends) == 32 and not ids.flags.owndata
            stream += ids[np.array(valid)].tolist()
        with pytest.raises(IndexError):
            file.sequence(len(file))
    assert stream == [t for i in range(30) for t in [*whole(f"word {i} " * i), 1]]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs, path, VOCABULARY)
    assert read_token_spans(spark, path).count() == 0
