"""URL filter: allow and block rules, and for the rest the ratio of two character language models.

URLs that a rule allows or blocks train one variable-order Markov model each: a character's probability after two
characters, after one and alone are interpolated by Witten-Bell weights, so contexts that were seldom seen fall back to
shorter ones. A URL's score is the log-likelihood difference per character; the threshold lies the same number of
standard deviations from the mean score of either class. Built-in functions only.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import materialize


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str


# The rules of the production query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

# Characters the models tell apart. Digits are one, everything else is another, "^" and "$" mark the ends.
LETTERS = string.ascii_lowercase + "./-_?=&#%:"
SYMBOLS = LETTERS + "0~$"
# At most (len(SYMBOLS) + 1) ** 3 rows, whatever the size of the table: small enough to send to every executor.
GRAM = 3


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; then what

    follows up to ``?``, ``#`` or the end. Both are empty for a null URL or one without ``://``.
    """
    begin = F.locate("://", url)
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _first_fit(host: Column, path: Column, rules: list[Rule], give) -> Column:
    """``give(rule)`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(give(rule))).otherwise(found)
    return found


def _grams(url: Column) -> Column:
    """Each character of the URL with the two before it."""
    kept = F.translate(F.lower(F.coalesce(url, F.lit(""))), string.digits, "0" * 10)
    marked = F.concat(F.lit("^^"), F.regexp_replace(kept, "[^" + LETTERS.replace("-", "\\-") + "0]", "~"), F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(marked) - GRAM + 1), lambda i: F.substring(marked, i, F.lit(GRAM)))


def _probability(counts: DataFrame, n: str) -> DataFrame:
    """``gram`` and the interpolated log probability of its last character, from the counts in column ``n``."""
    total, kinds = counts.groupBy(F.substring("gram", 3, 1).alias("c")).agg(F.sum(n).alias("n")).agg(F.sum("n"), F.sum((F.col("n") > 0).cast("int"))).first()
    if not total:
        return counts.select("gram", F.lit(None).cast("double").alias(f"log_{n}"))
    last = Window.partitionBy("c")
    before, pair = Window.partitionBy("b"), Window.partitionBy("b", "c")
    two = Window.partitionBy("a", "b")
    frame = counts.select(
        "gram", F.col(n).alias("n_abc"), *[F.substring("gram", i + 1, 1).alias(x) for i, x in enumerate("abc")]
    )
    frame = frame.withColumn("n_c", F.sum("n_abc").over(last)).withColumn("n_bc", F.sum("n_abc").over(pair)).withColumn("n_b", F.sum("n_abc").over(before))
    # Each distinct follower of b stands in several rows; one of them counts it.
    frame = frame.withColumn("one", ((F.row_number().over(pair.orderBy("a")) == 1) & (F.col("n_bc") > 0)).cast("int"))
    frame = frame.withColumn("t_b", F.sum("one").over(before)).withColumn("n_ab", F.sum("n_abc").over(two)).withColumn("t_ab", F.sum((F.col("n_abc") > 0).cast("int")).over(two))
    p0 = (F.col("n_c") + kinds / len(SYMBOLS)) / (total + kinds)
    p1 = F.when(F.col("n_b") > 0, (F.col("n_bc") + F.col("t_b") * p0) / (F.col("n_b") + F.col("t_b"))).otherwise(p0)
    p2 = F.when(F.col("n_ab") > 0, (F.col("n_abc") + F.col("t_ab") * p1) / (F.col("n_ab") + F.col("t_ab"))).otherwise(p1)
    return frame.select("gram", F.log(p2).alias(f"log_{n}"))


def judge(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row ``id, host, path, rule, verdict, score`` per input row.

    ``rule`` is the host and path of the longest rule that fits, or null; ``verdict`` is its verdict, else "allow" if
    the score reaches the calibrated threshold and "block" if not. The score is rounded to nine digits. Models and
    threshold come from all rows that a rule judges; a URL counts as often as it occurs. Where rules judge no row of
    one of the two classes the score is null and the verdict of the rest "allow". Null ids are passed on, a null URL
    is judged like an empty one, other columns are ignored, an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    seen = pages.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), host.alias("host"), path.alias("path"), _grams(F.col(url_col)).alias("grams")
    )
    seen = seen.withColumns({
        "rule": _first_fit(F.col("host"), F.col("path"), rules, lambda r: r.host + r.path),
        "ruled": _first_fit(F.col("host"), F.col("path"), rules, lambda r: r.verdict),
    })
    placed = seen.withColumn("gram", F.explode("grams")).drop("grams")
    counts = materialize(
        placed.groupBy("gram").agg(*[F.sum((F.coalesce(F.col("ruled") == v, F.lit(False))).cast("long")).alias(v) for v in ("allow", "block")]),
        "url_grams",
    )
    ratios = _probability(counts, "allow").join(_probability(counts, "block"), "gram")
    ratios = materialize(ratios.select("gram", (F.col("log_allow") - F.col("log_block")).alias("ratio")), "url_ratios")
    keys = ["row", "id", "host", "path", "rule", "ruled"]
    scored = placed.join(F.broadcast(ratios), "gram").groupBy(*keys).agg(F.round(F.sum("ratio") / F.count("*"), 9).alias("score"))
    scored = materialize(scored, "url_scores")
    stats = {r["ruled"]: r for r in scored.groupBy("ruled").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("dev")).collect()}
    threshold = -math.inf
    if "allow" in stats and "block" in stats:
        good, bad = stats["allow"], stats["block"]
        spread = good["dev"] + bad["dev"]
        threshold = (good["mean"] * bad["dev"] + bad["mean"] * good["dev"]) / spread if spread else (good["mean"] + bad["mean"]) / 2
    other = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", other).alias("verdict"), "score")
