import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerframe.llm.pieces import PieceModel, decode, encode, op1_sentencepiece

path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
LIBRARY = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)
MODEL = PieceModel(path)


def ids_of(text):
    return np.frombuffer(MODEL.encode([text])[0], np.uint32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_characters="\x00", max_codepoint=0xFFFF), max_size=30))
def test_ids_equal_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["in", "ter", "na", "tion", "al", " ", "  ", "the", "er", "é", "ß", "\n", "=", "==", "A", "日", "①"]), max_size=25))
def test_ids_of_joined_syllables(parts):
    text = "".join(parts)
    assert ids_of(text) == LIBRARY.encode(text)
    assert MODEL.decode(MODEL.encode([text])[0]) == text


@pytest.mark.parametrize("text", ["", " ", "a", "x" * 2000, "-" * 100, "Hello  world \n\t ", "▁a ▁", "<s> </s> <unk> <0x41>", "\U0001f600 ok"])
def test_named_texts(text):
    assert ids_of(text) == LIBRARY.encode(text)
    assert MODEL.decode(MODEL.encode([text])[0]) == LIBRARY.decode(LIBRARY.encode(text))


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id])
        data = docs[r.doc_id].encode()
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (r.decoded_crc32, r.decoded_bytes) == (zlib.crc32(data), len(data))


def test_round_trip_with_edge_rows(spark):
    texts = [None, "", "a b", "a b", "Ünï  códe ①", "y" * 500]
    df = spark.createDataFrame([(i % 5, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    back = decode(encode(df)).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i % 5, t or "") for i, t in enumerate(texts))
    assert encode(df.limit(0)).count() == 0
