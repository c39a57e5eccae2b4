import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerframe.llm.counts import MergeCounter, count_tokens, op8_token_counts

path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
tokenizers = pytest.importorskip("tokenizers")
LIBRARY = tokenizers.Tokenizer.from_file(path)
COUNTER = MergeCounter(path)


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF, categories=("L", "N", "P", "S", "Zs")), max_size=40))
def test_counts_equal_the_library(text):
    assert COUNTER.count(text) == expected(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "hello world", "It's  we'll\n\nGO", "a<|endoftext|>b <|startoftext|>", "<|", "x" * 5000, "ΟΔΟΣ İ", "naïve café 12345", "日本"],
)
def test_named_texts(text):
    assert COUNTER.count(text) == expected(text)


def test_query_matches_library(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), expected(text))
        assert r.over_limit == (r.n_tokens > 2048)


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "hi", 6), (1, "hi", 6), (None, "", 7)], "doc_id long, text string, n_tokens int")
    rows = sorted((tuple(r) for r in count_tokens(df).collect()), key=str)
    assert rows == sorted([(1, 0, 0, False), (1, 2, 1, False), (1, 2, 1, False), (None, 0, 0, False)], key=str)
    assert count_tokens(df.limit(0)).count() == 0
