"""The audit of filter interactions against a plain restatement."""

from collections import Counter
from itertools import permutations

import oracle

from layerframe.llm import audit
from layerframe.llm.queries import ORACLE, QUERIES

NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def plain(docs, labels):
    """Applies the five filters row by row in all 120 orders."""
    firsts, marks = {}, {}
    for key, text, _ in docs:
        if key is not None:
            firsts[text or ""] = min(key, firsts.get(text or "", key))
    for key, quality, toxic in labels:
        good, bad = marks.get(key, (False, False))
        marks[key] = (good or quality == 1, bad or toxic == 1)
    rows = []
    for key, text, part in docs:
        text = text or ""
        words = text.encode().split()
        capitals = sum("A" <= c <= "Z" for c in text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * capitals > 3 * len(text))
        fails += "D" * any(c in "#$%&*|" for c in text) + "E" * (key is not None and key > firsts[text])
        rows.append((part or "", fails, *(marks.get(key, (False, False)) if key is not None else (False, False))))
    out, shares = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            alive = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [r for r in alive if letter in r[1]]
                redundant = sum(letter in r[1] for r in gone)
                alive = [r for r in alive if letter not in r[1]]
                gone += removed
                unique = sum(r[0] == part and r[1] == letter for r in rows)
                out[part, order, step] = [len(alive), len(removed), redundant, unique, sum(r[2] for r in removed), sum(r[3] for r in removed)]
                shares[part, letter] += len(removed)
    return {(p, o, s): (*counts, shares[p, o[s - 1]]) for (p, o, s), counts in out.items()}


def answer(df):
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in [*NAMES, "shapley"]) for r in df.collect()}


def test_query_equals_sql_and_restatement(spark, sf_dir):
    con = oracle.connect(sf_dir)
    n, found = oracle.differences(spark, con, "op12", QUERIES["op12_filter_audit"], ORACLE["op12_filter_audit"], sf_dir)
    assert found == [] and n % 600 == 0
    docs = con.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    labels = con.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()
    assert answer(QUERIES["op12_filter_audit"](spark, sf_dir)) == plain(docs, labels)


def made():
    many = " ".join(f"word{i}" for i in range(250))
    docs = [(i, many, "en") for i in range(5, 60)] + [(5, many, "fr"), (5, many, "en"), (None, many, "en"), (None, None, None)]
    docs += [(70, None, "en"), (71, "", "en"), (72, " \t\n", None), (73, "A" * 30, ""), (74, "a# " * 300, "de"), (74, "a# " * 300, "de")]
    docs += [(80, "x \x0b\x0c\ry " * 150, "de"), (81, many.upper(), "en"), (82, f" {many}\n", "en"), (83, many + " é" * 20_000, "en")]
    labels = [(5, 1, 0), (5, 0, 1), (6, 1, 1), (None, 1, 1), (70, None, 1), (74, 0, 0), (99, 1, 1), (6, 1, 1)]
    return docs, labels


def test_ties_nulls_repeats_and_clashing_names(spark):
    docs, labels = made()
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain(docs, labels)
    assert answer(audit.interactions(audit.mask_cells(table, marks))) == want
    for extra in ("_key", "_digest", "mask", "quality", "part"):
        table, marks = table.withColumn(extra, table.text), marks.withColumn(extra, marks.quality)
    assert answer(audit.interactions(audit.mask_cells(table, marks))) == want


def test_empty_tables(spark):
    docs, labels = made()
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.mask_cells(table.limit(0), marks)).count() == 0
    assert answer(audit.interactions(audit.mask_cells(table, marks.limit(0)))) == plain(docs, [])


def test_other_columns(spark):
    docs, labels = made()
    table = spark.createDataFrame([(k, t, p, "") for k, t, p in docs], "`row id` long, `the.text` string, `in` string, text string")
    marks = spark.createDataFrame(labels, "`row id` long, quality int, toxic int")
    cells = audit.mask_cells(table, marks, key="row id", column="the.text", part="in")
    assert answer(audit.interactions(cells)) == plain(docs, labels)
