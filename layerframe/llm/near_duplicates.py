"""Near duplicates by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five words.  Its signature has ``m`` registers.
Every shingle of weight w owns a Poisson process over (weight, time), cut into the
dyadic weight bands [0,1), [1,2), [2,4), ...; within a band points arrive at the band's
width as rate, each with a random register and a random weight level, and count where
the level is below w.  A register keeps its earliest time.  Two registers agree with
the probability of the weighted Jaccard similarity.  Times beyond a limit at which a
register is all but surely filled are never made.

Registers are banded; texts that agree in a band are candidates.  A bucket of
candidates is never expanded into its pairs: its members are compared with one of them,
then, in buckets whose members are not yet all connected, with another.  What is open after
that is dealt into blocks of bags, and blocks of a bucket meet in pairs: a task counts what
all bags of two blocks share at once and passes on only links that connect what was not
connected.  So every pair of a bucket is compared, or known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.llm import text
from layerframe.plans.scratch import cut_lineage

SHINGLE = 5
THRESHOLD = (4, 5)  # similarity 0.8, as whole numbers
BANDS, BAND_ROWS = 25, 5
PIVOT_ROUNDS = 2
GROUP_SHINGLES, GROUP_ROWS = 2_000_000, 256  # of one pivot's members that one task compares in a row
BLOCK_ROWS, BLOCK_SHINGLES = 256, 400_000  # of a bucket's members in one block, on average
STAR_LINKS = 200_000  # that one task contracts together
_COLUMNS = 4096  # shingles of two blocks that are counted at once
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _nth(k: int) -> np.uint64:
    """A different 64-bit constant for each k."""
    return np.uint64((k * int(_GOLDEN)) & (2**64 - 1))


# --- bags and signatures ---------------------------------------------------------------


def bags(texts: text.Texts, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight) of all distinct shingles, by row and shingle.

    Words are runs without white space, ASCII letters in lower case.  A text with fewer
    words than a shingle has one shingle of them all; without words it has none.
    """
    data = text.ascii_lower(texts.data)
    words = text.words_of(texts)
    hashes = text.span_hashes(data, words.starts, words.ends)
    n = np.diff(words.first)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    left = words.first[words.row + 1] - np.arange(len(hashes))  # words from here to the row's end
    total = np.zeros(len(hashes), np.uint64)
    for k in range(shingle):
        part = np.zeros(len(hashes), np.uint64)
        part[: max(0, len(hashes) - k)] = hashes[k:]
        total += np.where(left > k, text.mix(part + _nth(k)), np.uint64(0))
    begins = (left >= shingle) | ((n[words.row] < shingle) & (left == n[words.row]))
    row = words.row[begins]
    # 44 bits of a shingle's hash and the row, so that one sort groups both
    key = (row.astype(np.uint64) << np.uint64(44)) | (text.mix(total[begins]) >> np.uint64(20))
    key.sort()
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    held = key[at]
    return (held >> np.uint64(44)).astype(np.int64), held & np.uint64((1 << 44) - 1), np.diff(np.append(at, len(key)))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Earliest times, (n, m); infinite throughout for a row without shingles."""
    times = np.full((n, m), np.inf)
    total = np.bincount(row, weight, n)
    todo = np.flatnonzero(total > 0)
    reach = 3.0
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = m * (np.log(m) + reach) / total[todo]
        mine = limit[row] > 0
        _points(times, row[mine], shingle[mine], weight[mine], limit, m)
        todo = todo[np.isinf(times[todo]).any(1)]
        reach *= 2
    return times


def _points(times: np.ndarray, row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, limit: np.ndarray, m: int) -> None:
    flat = times.reshape(-1)
    low, width, band = 0, 1, 0
    while len(row):
        seed = text.mix(shingle + _nth(band + 1))
        r, w, s, t = row, weight, seed, np.zeros(len(row))
        step = 0
        while len(r):
            drawn = text.mix(s + _nth(step + 1))
            t = t - np.log1p(-((drawn >> np.uint64(11)).astype(np.float64) / (1 << 53))) / width
            early = t <= limit[r]
            r, w, s, t, drawn = r[early], w[early], s[early], t[early], drawn[early]
            place = text.mix(drawn ^ _GOLDEN)
            counts = low + width * ((place >> np.uint64(32)).astype(np.float64) / (1 << 32)) < w
            register = (place & np.uint64(0xFFFFFFFF)) % np.uint64(m)
            np.minimum.at(flat, r[counts] * m + register[counts].astype(np.int64), t[counts])
            step += 1
        low, width, band = low + width, width if band == 0 else 2 * width, band + 1
        more = weight > low
        row, shingle, weight = row[more], shingle[more], weight[more]


def band_keys(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (len(times), 1))
    for k in range(rows):
        key = text.mix(key ^ bits[:, :, k]) * _GOLDEN
    return key.view(np.int64)


def digests(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> list[bytes | None]:
    """128 bits of each whole bag; None for an empty one."""
    out = np.zeros((n, 2), np.uint64)
    first = np.searchsorted(row, np.arange(n))
    held = np.bincount(row, minlength=n) > 0
    for k in range(2):
        part = text.mix(shingle * np.uint64(2 * k + 1) + weight.astype(np.uint64) * _GOLDEN + np.uint64(k))
        if len(part):
            out[held, k] = np.add.reduceat(text.mix(part), first[held])
    return [d.tobytes() if h else None for d, h in zip(out, held)]


def elements(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A bag as a set: one 64-bit value for each shingle and each of its occurrences, ascending."""
    again = np.repeat(np.arange(len(weight)), weight)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.sort(text.mix(shingle[again] + nth.astype(np.uint64) * _GOLDEN))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two bags have in common, both as ``elements``."""
    if not len(a) or not len(b):
        return 0
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum())


def shared_by_all(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many elements each bag of one block has in common with each of another.

    Elements that both blocks hold are numbered; slice by slice of the numbers, products of
    0/1 matrices count them.
    """
    held = [(np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.concatenate([*bags, np.zeros(0, np.uint64)])) for bags in (rows, columns)]
    both = np.intersect1d(held[0][1], held[1][1])
    out = np.zeros((len(rows), len(columns)), np.float32)
    placed = []
    for owner, values in held:
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        known = both[at] == values if len(both) else np.zeros(len(values), bool)
        owner, at = owner[known], at[known]
        order = np.argsort(at, kind="stable")
        placed.append((owner[order], at[order]))
    for low in range(0, len(both), _COLUMNS):
        sides = []
        for (owner, at), bags in zip(placed, (rows, columns)):
            first, last = np.searchsorted(at, [low, low + _COLUMNS])
            side = np.zeros((len(bags), min(_COLUMNS, len(both) - low)), np.float32)
            side[owner[first:last], at[first:last] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


class _Sets:
    """Disjoint sets with merging."""

    def __init__(self) -> None:
        self._up: dict = {}

    def top(self, x):
        while (up := self._up.get(x, x)) != x:
            self._up[x] = x = self._up.get(up, up)
        return x

    def join(self, a, b) -> bool:
        a, b = self.top(a), self.top(b)
        self._up[a] = b
        return a != b

    def below(self) -> list:
        """What has been merged into another."""
        return [x for x, up in self._up.items() if x != up]


# --- on tables -------------------------------------------------------------------------


def mark(column: str) -> Column:
    """128 bits of a text; with the key it finds a row's text again, whether or not keys are null or repeated."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))))


def signed(docs: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(id, mark, node, n, bands) of each row: node is the bag's digest, n its size; null for an empty bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, "_text", 2 << 20):
            texts = text.texts_of(batch.column("_text"))
            row, held, weight = bags(texts, shingle)
            keys = band_keys(signatures(row, held, weight, len(texts), bands * rows), bands, rows)
            node = digests(row, held, weight, len(texts))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
            size = np.bincount(row, weight, len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(node, pa.binary()), pa.array(size), lists], ["id", "mark", "node", "n", "bands"]
            )

    held = docs.select(docs[f"`{key}`"].alias("id"), mark(column).alias("mark"), docs[f"`{column}`"].alias("_text"))
    return held.mapInArrow(run, f"id {held.schema['id'].dataType.simpleString()}, mark binary, node binary, n long, bands array<long>")


def bags_of(docs: DataFrame, nodes: DataFrame, key: str, column: str, shingle: int) -> DataFrame:
    """(node, bag) of ``nodes`` (node, rep, mark), made again from the text of each one's representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, "_text", 2 << 20):
            texts = text.texts_of(batch.column("_text"))
            row, held, weight = bags(texts, shingle)
            node = digests(row, held, weight, len(texts))
            ends = np.searchsorted(row, np.arange(len(texts) + 1))
            bag = [elements(held[a:b], weight[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            mine = pa.array([x == y for x, y in zip(node, batch.column("node").to_pylist())])
            out = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(bag, pa.binary())], ["node", "bag"])
            yield out.filter(mine)

    held = docs.select(docs[f"`{key}`"].alias("id"), mark(column).alias("m"), docs[f"`{column}`"].alias("_text"))
    # any number of rows without a key may share a text
    unkeyed = held.where("id IS NULL").dropDuplicates(["m"]).join(nodes.where("rep IS NULL"), F.col("m") == F.col("mark"))
    keyed = held.join(nodes, (F.col("id") == F.col("rep")) & (F.col("m") == F.col("mark")))
    made = keyed.unionByName(unkeyed).select("node", "_text").mapInArrow(run, "node binary, bag binary")
    return made.dropDuplicates(["node"])


def reaches(both: Column, a: Column, b: Column, threshold: tuple[int, int]) -> Column:
    """Whether bags of sizes a and b with so much in common are at least so similar."""
    num, den = threshold
    return both * (den + num) >= (a + b) * num


def verified(pairs: DataFrame, bag: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(pivot, node, alike) of pairs (pivot, node, n): whether their bags reach the threshold.

    A pivot's members are dealt out in parts of bounded size, each with the pivot's bag first.
    """
    num, den = threshold
    size = F.greatest(F.floor(F.sum("n") / GROUP_SHINGLES), F.floor(F.count(F.lit(1)) / GROUP_ROWS))
    parts = pairs.groupBy("pivot").agg((size + 1).cast("int").alias("parts"))
    members = pairs.join(parts, "pivot").select("pivot", "node", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(1).alias("role"))
    leading = parts.select("pivot", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    rows = members.unionByName(leading).join(bag, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None
        for batch in batches:
            keep, alike = [], []
            for i, (role, data) in enumerate(zip(batch.column("role").to_pylist(), batch.column("bag"))):
                own = np.frombuffer(data.as_buffer(), np.uint64)
                if role == 0:
                    lead = own.copy()
                    continue
                keep.append(i)
                alike.append(shared(lead, own) * (den + num) >= (len(lead) + len(own)) * num)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("pivot").take(at), batch.column("node").take(at), pa.array(alike, pa.bool_())], ["pivot", "node", "alike"])

    dealt = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "role")
    return dealt.select("pivot", "node", "role", "bag").mapInArrow(run, "pivot binary, node binary, alike boolean")


def linked_blocks(open_members: DataFrame, bag: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(a, b): links between members (bucket, node, n, label) of a bucket whose labels differ.

    Every pair of a bucket with different labels is compared; of the links found in a pair
    of blocks only those stay that connect labels not connected by others of them.

    The members of a bucket outside its largest label are dealt into blocks, and so are
    those of that label, which need not meet each other.  A member goes to as many tasks as
    there are blocks for its own to meet.
    """
    num, den = threshold
    size = open_members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.sum("size") / BLOCK_ROWS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("int")
    most = size.groupBy("bucket").agg(F.max_by("label", F.struct("size", "label")).alias("most"))
    size = size.join(most, "bucket")
    minor = F.col("label") != F.col("most")
    dealt = size.groupBy("bucket", "most", minor.alias("minor")).agg(blocks.alias("blocks"))
    dealt = dealt.groupBy("bucket", "most").agg(
        F.max(F.when(F.col("minor"), F.col("blocks"))).alias("minors"), F.max(F.when(~F.col("minor"), F.col("blocks"))).alias("others")
    )
    # blocks are numbered with those outside the largest label first
    own = F.when(minor, F.pmod(F.xxhash64("node"), "minors")).otherwise(F.col("minors") + F.pmod(F.xxhash64("node"), "others"))
    met = F.sequence(F.lit(0), F.when(minor, F.col("minors") + F.col("others")).otherwise(F.col("minors")).cast("int") - 1)
    placed = open_members.join(dealt, "bucket").select("bucket", "node", "label", own.cast("int").alias("own"), met.alias("met")).join(bag, "node")
    spread = placed.select("bucket", "node", "label", "bag", "own", F.explode("met").alias("other"))
    spread = spread.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "label", "bag")

    def links(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        low, high = rows[0][1], rows[0][2]
        sides = [[r for r in rows if r[3] == block] for block in (low, high)]
        if not sides[0] or not sides[1]:
            return
        bags = [[np.frombuffer(r[6], np.uint64) for r in side] for side in sides]
        number: dict[bytes, int] = {}
        label = [np.array([number.setdefault(r[5], len(number)) for r in side]) for side in sides]
        sizes = [np.array([len(b) for b in side]) for side in bags]
        apart = label[0][:, None] != label[1][None, :]
        near = apart & (den * np.minimum.outer(*sizes) >= num * np.maximum.outer(*sizes))
        if not near.any():
            return
        both = shared_by_all(*bags)
        sets = _Sets()
        for i, j in np.argwhere(near & (both * (den + num) >= np.add.outer(*sizes) * num)).tolist():
            if sets.join(label[0][i], label[1][j]):
                yield sides[0][i][4], sides[1][j][4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    found += links(held)
                    held = []
                held.append(row)
            yield _pairs(found)
        yield _pairs(links(held) if held else [])

    sorted_rows = spread.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    return sorted_rows.mapInArrow(run, "a binary, b binary")


def _pairs(found: Iterable[tuple[bytes, bytes]], names: tuple[str, str] = ("a", "b")) -> pa.RecordBatch:
    first, second = list(zip(*found)) or ((), ())
    return pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary())], names)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) that connect what the links (u, v) of a task connect: each node with the smallest it reaches there.

    No more than ``STAR_LINKS`` links are held together.
    """

    def ends() -> Iterator[tuple[bytes, bytes]]:
        return ((u, sets.top(u)) for u in sets.below())

    sets, held = _Sets(), 0
    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            low, high = sorted((sets.top(u), sets.top(v)))
            sets.join(high, low)
        held += batch.num_rows
        if held >= STAR_LINKS:
            yield _pairs(ends(), ("u", "v"))
            sets, held = _Sets(), 0
    yield _pairs(ends(), ("u", "v"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), "v").unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("binary").alias("v")))
    ends = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max(F.col("v").isNull()).alias("centre"))
    return ends.where("low <> high OR low IS NOT NULL AND centre").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, label) of links (a, b): the smallest node of each connected component.

    Each task first turns its own links into stars.  Where these meet, two contractions
    alternate until all are stars: every larger neighbour, then every smaller one is linked
    to a node's smallest neighbour instead.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut_lineage(edges.mapInArrow(_stars, "u binary, v binary"), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    ).distinct()


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    shingle: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(id, mark, label, least) of each row: the class of its text, and the class's smallest key.

    label and least are null for a text without words.  See ``near_duplicates``.
    """
    rows = cut_lineage(signed(docs, key, column, shingle, bands, band_rows), "bagminhash")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    nodes = cut_lineage(nodes.select("node", F.col("rep.id").alias("rep"), F.col("rep.mark").alias("mark"), "n", "bands"), "bags")
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut_lineage(members.join(several, "bucket").select("bucket", "node", "n", "size"), "buckets")
    # what a group of copies was made from shares more, and larger, buckets than any copy
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    members = cut_lineage(members.join(weight, "node").select("bucket", "node", "n", "weight"), "buckets")
    candidates = members.select("node").distinct().join(nodes.select("node", "rep", "mark"), "node")
    bag = cut_lineage(bags_of(docs, candidates, key, column, shingle), "candidates")
    links = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    label = members.select("node", F.col("node").alias("label")).limit(0)
    num, den = threshold
    for turn in range(PIVOT_ROUNDS + 1):
        open_members = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        split = open_members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        open_members = open_members.join(split.select("bucket"), "bucket")
        if turn == PIVOT_ROUNDS:
            found = linked_blocks(cut_lineage(open_members.select("bucket", "node", "n", "label"), "open"), bag, threshold)
        else:
            order = F.struct(F.lit(0) if turn else -F.col("weight"), F.xxhash64("node", F.lit(turn)), "node")
            pivots = open_members.groupBy("bucket").agg(F.min_by(F.struct("node", "n", "label"), order).alias("p"))
            # no two bags of sizes further apart can reach the threshold
            may = den * F.least("n", "p.n") >= num * F.greatest("n", "p.n")
            pairs = open_members.join(pivots, "bucket").where("p.label <> label").where(may)
            pairs = pairs.groupBy(F.col("p.node").alias("pivot"), "node").agg(F.first("n").alias("n"))
            found = verified(cut_lineage(pairs, "pairs"), bag, threshold).where("alike").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        found = cut_lineage(found, "found")
        if found.isEmpty():
            continue  # the next turn may still find some
        links = links.unionByName(found)
        label = components(links)
    named = nodes.select("node", "rep").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("rep").alias("least"))
    named = named.join(least, "label").select("node", "label", "least")
    return rows.select("id", "mark", "node").join(named, "node", "left").select("id", "mark", "label", "least")


def near_duplicates(docs: DataFrame, key: str = "doc_id", column: str = "text", **settings) -> DataFrame:
    """(key, class_id) of each row: the smallest key of the texts it is connected with.

    Texts with equal bags are one node from the start.  Links are pairs that share a
    band and whose weighted Jaccard similarity is at least the threshold, without
    exception; at 0.8 a pair shares a band with probability 0.99995.  Texts without words are
    alone: class_id is their own key.  A null key is never a class_id unless all keys of
    the class are null.  Repeated rows are in one class; other columns are not read.
    ``settings`` are those of ``classes``.
    """
    return classes(docs, key, column, **settings).select(F.col("id").alias(key), F.coalesce("least", "id").alias("class_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", column: str = "text", unkeyed: bool = True) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: one of the smallest key.

    Rows are told apart by key and text, so rows that repeat a key stay if their classes
    differ.  Rows without a key all stay; with ``unkeyed`` false they are members like
    others, chosen where no row of the class has a key.  A text without words is alone: of
    those that repeat a key one stays, of those without a key all.
    """
    of = cut_lineage(classes(docs, key, column), "classes")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "mark")
    worded = of.where("label IS NOT NULL").groupBy("label").agg(F.min(row).alias("row"))
    wordless = of.where("label IS NULL AND id IS NOT NULL").groupBy("id").agg(F.min(row).alias("row"))
    kept = worded.select("row.*").unionByName(wordless.select("row.*"))
    own = text.fresh(docs, "mark")
    marked = docs.withColumn(own, mark(column)).alias("d")
    alone = F.col(f"`{key}`").isNull()
    if not unkeyed:
        alone = alone & F.coalesce(F.col(f"`{column}`"), F.lit("")).rlike(r"\A[\t-\r ]*\z")
    taken = kept.where("NOT none").select(F.col("id").alias("k_id"), F.col("mark").alias("k_mark"))
    one = marked.join(taken, (F.col(f"d.`{key}`") == F.col("k_id")) & (F.col(f"d.`{own}`") == F.col("k_mark")), "left_semi")
    one = one.dropDuplicates([key, own]).unionByName(marked.where(alone))
    if not unkeyed:
        # any number of rows without a key may share a text
        taken = kept.where("none").select(F.col("mark").alias("k_mark"))
        bare = marked.where(F.col(f"d.`{key}`").isNull()).dropDuplicates([own])
        one = one.unionByName(bare.join(taken, F.col(own) == F.col("k_mark"), "left_semi"))
    return one.select(*(f"`{c}`" for c in docs.columns))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(text.table(spark, sf_dir, "documents"))
