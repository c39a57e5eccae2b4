import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layerframe.llm import language, text, toxicity
from test_near_duplicates import brute_force
from test_packing import check


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """The table with edge rows and columns named like those that stages make."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edge = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "12 %"), (10**6 + 3, "one two three four five six"), (10**6 + 3, "one two three four five six"), (10**6 + 4, "long text here " * 9000)]
    more = spark.createDataFrame(edge, "doc_id long, text string").selectExpr("doc_id", "text", "CAST(NULL AS STRING) lang", "'s' source", "0L n_chars")
    return rows.unionByName(more).selectExpr("*", "'kept' AS score", "1 AS predicted", "'x' AS node", "2 AS class_id").cache()


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def texts_of(rows):
    return text.texts_of(pa.array([r.text for r in rows], pa.string()))


def test_toxic_documents_go(spark, docs, sf_dir):
    kept = corpus_pipeline.not_toxic(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.collect()
    scores = toxicity.score_texts(model, texts_of(rows))
    sure = np.abs(scores - 0.5) > 1e-4
    assert {r.doc_id for r, s, k in zip(rows, scores, sure) if k and s < 0.5} <= set(ids(kept)) <= {r.doc_id for r, s, k in zip(rows, scores, sure) if not k or s < 0.5}


def test_documents_without_a_language_go(spark, docs, sf_dir):
    kept = corpus_pipeline.in_a_language(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    want = [r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    assert ids(kept) == sorted(want)
    assert language.learn(docs.limit(0), text.remainder("doc_id", 3) != 1) is None


def test_without_stated_languages_only_texts_without_a_letter_go(spark, docs, sf_dir):
    unstated = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.in_a_language(spark, unstated, sf_dir)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))


def test_one_of_each_class_stays(spark, docs, sf_dir):
    kept = corpus_pipeline.without_near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    classes = brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").distinct().collect()])
    assert ids(kept) == sorted({c for _, c in classes})


def test_one_of_each_class_stays_whatever_the_ids(spark, sf_dir):
    words = [f"w{i}" for i in range(100)]
    near = [" ".join([*words[:i], "new", *words[i + 1 :]]) for i in (10, 40, 70)]
    rows = [(7, " ".join(words)), (7, "a clean text that is near nothing else"), (7, "a clean text that is near nothing else"), (7, "one more of its own kind here")]
    rows += [(None, near[0]), (8, near[1]), (None, near[2])]
    bare = [t.replace("w", "bare") for t in near]
    rows += [(None, t) for t in [*bare, bare[0]]] + [(None, "all alone without an id of its own")]
    rows += [(9, ""), (9, " "), (9, "nine has words"), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS mark", "1 AS label")
    kept = corpus_pipeline.without_near_duplicates(spark, df, sf_dir)
    assert kept.columns == df.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(t for k, t in found if k == 7) == sorted({t for k, t in rows if k == 7})
    assert sum(k == 8 for k, _ in found) == 0
    assert sum(t in bare for _, t in found) == 1 and not any(t in near for _, t in found)
    assert sum(k == 9 for k, _ in found) == 2 and (9, "nine has words") in found
    assert (None, "all alone without an id of its own") in found and sum(k is None for k, _ in found) == 4


def test_empty_tables(spark, docs, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_whole_run(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    left = {r.doc_id for r in pieces}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id in left]
    check(pieces, docs)
    kept = brute_force(docs)
    assert len({c for _, c in kept}) == len(kept) > 100
