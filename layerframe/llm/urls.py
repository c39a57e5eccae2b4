"""URL filter: allow and block rules, and a character language-model ratio for the rest.

Only DataFrame and SQL functions.  The urls that a rule accepts or rejects are what the
two models learn from: per class, counts of characters after contexts of 0 to ``ORDER``
characters, smoothed from each order to the next shorter one (Witten-Bell), so that a
context never seen leaves the shorter one in place.  A url without a rule is judged by
its log-likelihood ratio per character against a calibrated threshold.

The alphabet is fixed, so there are at most 41**3 counts per class at the default
order whatever the input's size: the model is collected as one row and every url is
scored in place, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.llm import text

#: Characters of the models; position + 1 is a character's number.  Upper case counts as
#: lower, digits are one, and any other character is the last.  Number 0 precedes a url.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-:?=&#%_~+*"
SYMBOLS = len(ALPHABET) + 1
ORDER = 2


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``; longest wins."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("net", "/", False),
    Rule("example.net", "/en/", True),
    Rule("example.com", "/de/", False),
    Rule("org", "/fr/", True),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(found, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name of the longest fitting rule, else null.  Of equally long ones the first."""
    name = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
    return name


def symbols(url: Column) -> Column:
    """Numbers of a url's characters; null where the url is null or empty."""
    plain = F.translate(F.lower(url), "123456789", "000000000")
    # a character outside the alphabet: the last symbol
    known = F.regexp_replace(plain, r"(?s)[^a-z0/.\-:?=&#%_~+*]", "*")
    letters = F.split(F.when(F.length(known) > 0, known), "")
    codes = {c: i + 1 for i, c in enumerate(ALPHABET)}
    table = F.split(F.lit(",".join(str(codes.get(chr(i), 0)) for i in range(128))), ",").cast("array<int>")
    return F.transform(letters, lambda c: F.element_at(table, F.ascii(c) + 1))


def _context(codes: Column, at: Column, length: int) -> Column:
    """Number of the ``length`` symbols before place ``at`` (from 1), 0 where there are none."""
    out = F.lit(0)
    for back in range(length, 0, -1):
        out = out * SYMBOLS + F.when(at > back, F.get(codes, at - 1 - back)).otherwise(0)
    return out


def gram_counts(labelled: DataFrame, order: int) -> DataFrame:
    """(allow, length, context, symbol, n): how often a symbol followed a context."""
    places = F.sequence(F.lit(1), F.size("codes"))
    full = labelled.where("size(codes) > 0").select(
        "allow",
        F.explode(
            F.transform(places, lambda at: F.struct(_context(F.col("codes"), at, order).alias("context"), F.get("codes", at - 1).alias("symbol")))
        ).alias("g"),
    )
    longest = full.groupBy("allow", "g.context", "g.symbol").agg(F.count(F.lit(1)).alias("n"))
    lengths = F.explode(F.array(*(F.struct(F.lit(k).alias("length"), (F.col("context") % SYMBOLS**k).alias("part")) for k in range(order + 1)))).alias("l")
    return (
        longest.select("allow", "symbol", "n", "context", lengths)
        .groupBy("allow", "l.length", F.col("l.part").alias("context"), "symbol")
        .agg(F.sum("n").alias("n"))
    )


def log_ratios(counts: DataFrame, order: int) -> DataFrame:
    """(context, symbol, ratio) for all contexts of the full order and all symbols.

    ratio: log of the symbol's probability in the accepted model less that in the other.
    """
    spark = counts.sparkSession
    totals = counts.groupBy("allow", "length", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
    # the grid of the fixed alphabet
    grid = (
        spark.range(SYMBOLS ** (order + 1))
        .select(F.explode(F.array(F.lit(True), F.lit(False))).alias("allow"), (F.col("id") / SYMBOLS).cast("int").alias("whole"), (F.col("id") % SYMBOLS).cast("int").alias("symbol"))
        .withColumn("p", F.lit(1.0 / SYMBOLS))
    )
    for length in range(order + 1):
        mine = counts.where(F.col("length") == length).select("allow", "context", "symbol", "n")
        of = totals.where(F.col("length") == length).select("allow", "context", "total", "distinct")
        grid = (
            grid.withColumn("context", F.col("whole") % SYMBOLS**length)
            .join(of, ["allow", "context"], "left")
            .join(mine, ["allow", "context", "symbol"], "left")
            .withColumn(
                "p",
                F.when(F.col("total").isNull(), F.col("p")).otherwise(
                    (F.coalesce("n", F.lit(0)) + F.col("distinct") * F.col("p")) / (F.col("total") + F.col("distinct"))
                ),
            )
            .select("allow", "whole", "symbol", "p")
        )
    sign = F.when(F.col("allow"), F.log("p")).otherwise(-F.log("p"))
    return grid.groupBy(F.col("whole").alias("context"), "symbol").agg(F.sum(sign).alias("ratio"))


def _as_literal(ratios: DataFrame) -> Column:
    """The ratios in grid order, as one constant array of fixed size."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("context", "symbol", "ratio"))), lambda x: F.round(x["ratio"], 9))
    written = ratios.agg(F.to_json(ordered).alias("all")).first()["all"]
    return F.from_json(F.lit(written), "array<double>")


def mean_ratio(codes: Column, model: Column, order: int) -> Column:
    """Log-likelihood ratio per character; null for an empty url."""
    places = F.sequence(F.lit(1), F.size(codes))
    index = lambda at: _context(codes, at, order) * SYMBOLS + F.get(codes, at - 1)
    total = F.aggregate(places, F.lit(0.0), lambda total, at: total + F.get(model, index(at)))
    return F.when(F.size(codes) > 0, total / F.size(codes))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, order: int = ORDER, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row's url.

    Null urls, and urls without ``://``, have empty host and path.  ``score`` is the
    ratio per character less the threshold: the middle between the mean ratios of
    accepted and rejected urls.  Without a rule a url is allowed from 0 on; null and
    empty urls, and all urls where no rule accepts or none rejects any, are allowed.
    Repeated rows are judged alike; other columns are not read.
    """
    at = F.col("_url")
    rows = pages.select(F.col(f"`{key}`"), F.col(f"`{url}`").alias("_url")).withColumns({"host": host_of(at), "path": path_of(at)})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r.name for r in rules if r.allow])
    labelled = rows.where(F.col("rule").isNotNull()).select(allowed.alias("allow"), symbols(at).alias("codes"))
    model = _as_literal(log_ratios(gram_counts(labelled, order), order))
    means = labelled.groupBy("allow").agg(F.avg(mean_ratio(F.col("codes"), model, order)).alias("mean")).collect()
    means = {r["allow"]: r["mean"] for r in means if r["mean"] is not None}
    score = F.lit(None).cast("double")
    if len(means) == 2:
        # as a column of its own, the symbols are made once and not at each of their uses
        rows = rows.withColumn("codes", symbols(at))
        score = mean_ratio(F.col("codes"), model, order) - (means[True] + means[False]) / 2
    scored = rows.withColumn("score", score)
    by_rule = F.when(allowed, F.lit("allow")).otherwise(F.lit("block"))
    by_score = F.when(F.col("score") < 0, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_score)
    return scored.select(f"`{key}`", "host", "path", "rule", verdict.alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(text.table(spark, sf_dir, "pages"))
