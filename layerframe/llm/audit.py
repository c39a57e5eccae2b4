"""How filters interact: what each removes, in every order in which they may be applied.

A document's failures form a mask, one bit per filter.  Documents are counted by part
and mask first, so at most 32 cells per part remain, however large the table.  Each
cell is then folded across the array of all orders with ``transform`` and ``aggregate``:
at every step of an order the fold knows whether the cell is still kept and whether it
fails the step's filter, which gives one weighted struct per order and step.  A part's
cells are merged by elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerframe.llm import text

LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_SPACE = r"[ \t-\r]"


def text_failures(column: str | Column) -> dict[str, Column]:
    """Conditions A to D of the audit on a text column without nulls."""
    whole = F.col(column) if isinstance(column, str) else column
    trimmed = F.regexp_replace(whole, f"^{_SPACE}+|{_SPACE}+$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_SPACE}+"))
    capitals = F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.char_length(whole),
        "D": whole.rlike(r"[#$%&*|]"),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents by part and by the set of filters they fail.

    Bit i of ``mask`` is the failure of letter i; E holds for every row whose text
    belongs to a smaller key anywhere in the table.  A null text is empty, a null part
    the empty string.  A row without a key has no smaller one and is smaller than none,
    so it never fails E.  Rows that repeat key and text are counted each; labels that
    repeat a key count as good or toxic if one of them says so.

    Rows of equal key, part and text collapse before the first shuffle, which spreads
    by all of them; copies of one text then meet as one row per part, mask and label,
    and never in a window over the copies.
    """
    whole = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(whole).values())), F.lit(0))
    rows = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        F.sha2(whole, 256).alias("_digest"),
        mask.alias("_mask"),
    )
    counted = rows.groupBy("_key", "_part", "_digest", "_mask").agg(F.count("*").alias("_n"))
    # rows without a key meet no label; their digests keep them from meeting in one task
    meet = F.coalesce(F.col("_key").cast("string"), F.concat(F.lit("?"), F.col("_digest")))
    marks = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast("string").alias("_meet")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    # of one text, per part, mask and label: its rows, those without a key, and how many have the smallest key
    groups = (
        counted.withColumn("_meet", meet)
        .join(marks, "_meet", "left")
        .groupBy("_digest", "_mask", "_part", F.coalesce("_good", F.lit(0)).alias("_good"), F.coalesce("_toxic", F.lit(0)).alias("_toxic"))
        .agg(
            F.sum("_n").alias("_n"),
            F.sum(F.when(F.col("_key").isNull(), F.col("_n")).otherwise(0)).alias("_unkeyed"),
            F.min(F.when(F.col("_key").isNotNull(), F.struct("_key", "_n"))).alias("_first"),
        )
    )
    smallest = F.min("_first._key").over(Window.partitionBy("_digest"))
    alone = F.col("_unkeyed") + F.when(F.col("_first._key") == smallest, F.col("_first._n")).otherwise(0)
    counts = groups.withColumn("_alone", alone).groupBy("_part", "_mask").agg(
        *(
            F.sum(F.col(rows) * weight).alias(f"{rows}{name}")
            for rows in ("_n", "_alone")
            for name, weight in (("", F.lit(1)), ("_good", F.col("_good")), ("_toxic", F.col("_toxic")))
        )
    )
    kept = F.struct(F.col("_mask").alias("mask"), *(F.col(f"_alone{s}").alias(f"n{s}") for s in ("", "_good", "_toxic")))
    copies = F.struct(
        (F.col("_mask") + 16).alias("mask"), *((F.col(f"_n{s}") - F.col(f"_alone{s}")).alias(f"n{s}") for s in ("", "_good", "_toxic"))
    )
    return counts.select(F.col("_part").alias("part"), F.inline(F.array(kept, copies))).where("n > 0")


def _orders() -> Column:
    """All orders of the five filters, as arrays of their numbers."""
    every = permutations(range(len(LETTERS)))
    return F.array(*(F.array(*(F.lit(i) for i in order)) for order in every))


def _fold(cell: Column, orders: Column) -> Column:
    """The weighted structs of one cell: one per order and step, in that sequence."""

    def step(state: Column, number: Column) -> Column:
        fails = F.getbit(cell["mask"], number) == 1
        here, before = state["kept"] & fails, ~state["kept"] & fails
        # F.when keeps zero as zero: a count weighs in where its condition holds
        weigh = {
            "kept": (state["kept"] & ~fails, "n"),
            "removed": (here, "n"),
            "redundant": (before, "n"),
            "unique_fails": (fails & (F.bit_count(cell["mask"]) == 1), "n"),
            "good_lost": (here, "n_good"),
            "toxic_lost": (here, "n_toxic"),
        }
        counts = F.struct(*(F.when(holds, cell[n]).otherwise(F.lit(0).cast("long")).alias(name) for name, (holds, n) in weigh.items()))
        return F.struct((state["kept"] & ~fails).alias("kept"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    begin = F.struct(F.lit(True).alias("kept"), F.array().cast(f"array<{_COUNTS}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, begin, step, lambda state: state["steps"])))


def _share(placed: str, number: int) -> Column:
    """What one filter removes, over all orders and steps."""
    none = F.lit(0).cast("long")
    removed = F.transform(placed, lambda p: F.when(p["number"] == number, p["counts"]["removed"]).otherwise(none))
    return F.aggregate(removed, none, lambda total, n: total + n)


_COUNTS = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"


def interactions(cells: DataFrame) -> DataFrame:
    """(part, filter_order, step, the counts of ``COUNTS``, shapley): 600 rows per part.

    ``cells`` are those of ``mask_cells``, at most 32 per part.  An empty table gives no row.
    """
    orders = _orders()
    nothing = F.array_repeat(F.struct(*(F.lit(0).cast("long").alias(name) for name in COUNTS)), 600)

    def add(left: Column, right: Column) -> Column:
        return F.struct(*((left[name] + right[name]).alias(name) for name in COUNTS))

    merged = F.aggregate("cells", nothing, lambda sums, cell: F.zip_with(sums, _fold(cell, orders), add))
    placed = F.zip_with(merged, F.flatten(orders), lambda counts, number: F.struct(number.alias("number"), counts.alias("counts")))
    shares = F.array(*(_share("placed", i) for i in range(len(LETTERS))))
    spelled = F.array_join(F.transform(F.get(orders, (F.col("at") / 5).cast("int")), lambda i: F.substring(F.lit(LETTERS), i + 1, F.lit(1))), "")
    return (
        cells.groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("cells"))
        .select("part", placed.alias("placed"))
        .select("part", shares.alias("shares"), F.posexplode("placed").alias("at", "placed"))
        .select(
            "part",
            spelled.alias("filter_order"),
            (F.col("at") % 5 + 1).alias("step"),
            *(F.col(f"placed.counts.{name}").alias(name) for name in COUNTS),
            F.get("shares", F.col("placed.number")).alias("shapley"),
        )
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(mask_cells(text.table(spark, sf_dir, "documents"), text.table(spark, sf_dir, "labels")))


_ORDERS_SQL = ", ".join(f"('{''.join(o)}')" for o in permutations(LETTERS))
OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
m AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END ||
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
steps AS (
  SELECT o AS filter_order, step, substr(o, step, 1) AS letter, substr(o, 1, step - 1) AS earlier
  FROM (VALUES {_ORDERS_SQL}) AS orders(o), (VALUES (1), (2), (3), (4), (5)) AS s(step)),
folded AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
    CASE WHEN fails = '' OR translate(fails, earlier || letter, '') = fails THEN n ELSE 0 END AS kept,
    CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN n ELSE 0 END AS removed,
    CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') <> fails THEN n ELSE 0 END AS redundant,
    CASE WHEN fails = letter THEN n ELSE 0 END AS unique_fails,
    CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN good ELSE 0 END AS good_lost,
    CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN toxic ELSE 0 END AS toxic_lost
  FROM cells, steps),
summed AS (
  SELECT part, filter_order, step, letter,
    CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(removed) AS BIGINT) AS removed, CAST(sum(redundant) AS BIGINT) AS redundant,
    CAST(sum(unique_fails) AS BIGINT) AS unique_fails, CAST(sum(good_lost) AS BIGINT) AS good_lost,
    CAST(sum(toxic_lost) AS BIGINT) AS toxic_lost
  FROM folded GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""
