import re
import zlib

import numpy as np
import pytest
import regex

from layerframe.llm import packing
from layerframe.llm.packing import PieceIds, hilbert_key, op3_curve_packing, pack

path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
LIBRARY = pytest.importorskip("tokenizers").Tokenizer.from_file(path)


def test_both_patterns_agree_on_plain_characters():
    for c in map(chr, range(0x250)):
        if packing._NOT_PLAIN.search(c):
            continue
        assert bool(regex.match(r"\p{L}", c)) == bool(re.match(r"[^\W\d_]", c)), hex(ord(c))
        assert bool(regex.match(r"\p{N}", c)) == bool(re.match(r"\d", c)), hex(ord(c))
        assert bool(regex.match(r"\s", c)) == bool(re.match(r"\s", c)), hex(ord(c))


@pytest.mark.parametrize(
    "text", ["", "a", "Hello  world\n\n x", "it's we'll", "½ ² ³ 日本 é ñ", "a<|endoftext|>b", "  \t ", "x" * 3000, "<|no|>", "é\x1c\x85"]
)
def test_ids_equal_the_library(text):
    ids = np.frombuffer(PieceIds(path).encode(text), np.uint32).tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_each_cell_once_by_single_steps():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1).T
    order = np.argsort(hilbert_key(cells, 3))
    assert sorted(hilbert_key(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def check(rows, docs):
    """docs: (id, text) of every row."""
    want = sorted(len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    whole = {}
    for k, t in docs:
        whole.setdefault(k, []).append(np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids + [0], np.uint32))
    assert sum(r.length for r in rows) == sum(want)
    for r in rows:
        found = [ids for ids in whole[r.doc_id] if len(ids) == r.doc_tokens and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
        assert found and r.length > 0
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
        short += at < 1024
    return short, len(sequences)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = op3_curve_packing(spark, sf_dir)
    short, n = check(df.collect(), docs)
    assert short <= 8 < n


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "x y z" * 2000), (3, "x y z" * 2000), (4, "日本 <|endoftext|>"), (5, "a")]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, start long")
    check(pack(df).collect(), docs)
    assert pack(df.limit(0)).count() == 0
    ids = pack(df.where("doc_id = 5"), with_ids=True).first().ids
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode("a").ids + [0]


def test_pieces_equal_the_library():
    """Every pre-token's ids, whatever its bytes, are those of the tokenizer's own merging."""
    import random

    from tokenizers import Tokenizer

    from layerframe.llm.counts import vocabulary
    from layerframe.llm.packing import PieceIds

    path = vocabulary("byte_bpe_50k.json", None)
    pieces, library = PieceIds(path), Tokenizer.from_file(path)
    rng = random.Random(4)
    words = ["".join(chr(rng.choice([rng.randrange(33, 127), rng.randrange(0xA1, 0x600), rng.randrange(0x4E00, 0x4F00)])) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    words += ["aaaa" * n for n in range(1, 60)] + ["the of and" * 9, "\U0001f600" * 7, "x" * 3000, "\u00e9\u0301" * 40]
    for word in words:
        assert np.frombuffer(pieces.encode(word), np.uint32).tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_equal_rows_spread(spark):
    """Rows that agree in text and key, or have none, still fill several ranges."""
    from layerframe.llm.packing import pack
    from layerframe.session import setting

    docs = spark.range(0, 4000, 1, 8).selectExpr("cast(null as long) as doc_id", "'the same words again and again' as text")
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        pieces = pack(docs).selectExpr("sequence_id >> 32 as part", "length").groupBy("part").sum("length").collect()
    assert len(pieces) > 4 and max(p[1] for p in pieces) < 2 * min(p[1] for p in pieces)
