"""URL filter: host and path rules first, then a character language-model ratio.

The urls that rules allow or block train two variable-order Markov models over
characters: the probability after four characters is smoothed with that after
three, and so on down to an even distribution. All models are tables of n-gram
counts that follow from one table of distinct five-character pieces, which is
aggregated map-side, so a host of a third of all urls leaves each task once per
piece. A url's score is its log-likelihood difference per character, calibrated
by the means and variance of both classes; it is allowed from 0.5 on.

Only DataFrame functions are used.

Contract for unusual input: a null url, or one without "://", has empty host and
path and no rule, and scores as the empty text, whose difference is 0; a class
without any url leaves every difference at 0; rows that repeat an id are judged
each; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import small_if_counted
from riskframe.session import durable

ORDER = 5
SMOOTH = 2.0
#: Characters an unseen character is taken from.
ALPHABET = 128.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def parts(url: str) -> tuple[Column, Column, Column]:
    """(what follows the scheme, host, path); all empty without "://"."""
    at = F.coalesce(F.locate("://", F.col(url)), F.lit(0))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return rest, F.translate(host, _UPPER, _LOWER), path


def longest_rule(rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits ``host`` and ``path``: a struct of rule and verdict, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) & F.startswith(F.col("path"), F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def pieces(text: str) -> Column:
    """Every character of a text and an end, with the four before it: arrays of five characters."""
    padded = F.concat(F.array(*[F.lit("\x02")] * (ORDER - 1)), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit("\x03")))
    return F.transform(F.sequence(F.lit(1), F.size(padded) - (ORDER - 1)), lambda i: F.array_join(F.slice(padded, i, ORDER), ""))


def piece_ratios(urls: DataFrame) -> DataFrame:
    """(piece, ratio): log probability of a piece's last character among allowed urls less that among blocked.

    ``urls``: distinct texts ``rest`` with the numbers of rows ``good`` and ``bad``.
    """
    counts = durable(
        urls.select("good", "bad", F.explode(pieces("rest")).alias("piece"))
        .groupBy("piece").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    table = counts.select("piece", *[F.lit(1 / ALPHABET).alias(f"p_{c}") for c in ("good", "bad")])
    for k in range(ORDER):  # k characters of context
        gram, context = F.substring("piece", ORDER - k, k + 1), F.substring("piece", ORDER - k, k)
        by_gram = counts.groupBy(gram.alias("gram")).agg(F.sum("good").alias("g_good"), F.sum("bad").alias("g_bad"))
        by_context = counts.groupBy(context.alias("context")).agg(F.sum("good").alias("c_good"), F.sum("bad").alias("c_bad"))
        table = (
            table.withColumns({"gram": gram, "context": context}).join(by_gram, "gram").join(by_context, "context")
            .select("piece", *[((F.col(f"g_{c}") + SMOOTH * F.col(f"p_{c}")) / (F.col(f"c_{c}") + SMOOTH)).alias(f"p_{c}")
                               for c in ("good", "bad")])
        )
    return table.select("piece", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row."""
    rest, host, path = parts(url)
    rows = (
        pages.select(F.col(page_id), rest.alias("rest"), host.alias("host"), path.alias("path"))
        .withColumn("r", longest_rule(rules)).select("*", "r.rule", F.col("r.verdict").alias("ruled")).drop("r")
    )
    # Few bytes of urls make many pieces, so they are dealt over all tasks before they are cut.
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = durable(
        rows.groupBy("rest").agg(F.count(F.when(F.col("ruled") == "allow", 1)).alias("good"),
                                 F.count(F.when(F.col("ruled") == "block", 1)).alias("bad"))
        .repartition(tasks, "rest")
    )
    ratios = small_if_counted(durable(piece_ratios(urls)))
    scored = durable(
        urls.where("rest <> ''").select("rest", "good", "bad", F.explode(pieces("rest")).alias("piece"))
        .join(ratios, "piece").groupBy("rest").agg(F.avg("ratio").alias("mean"), F.first("good").alias("good"), F.first("bad").alias("bad"))
    )
    stats = scored.agg(*[
        f.alias(f"{n}_{c}") for c in ("good", "bad") for n, f in (
            ("n", F.sum(c)), ("s", F.sum(F.col(c) * F.col("mean"))), ("q", F.sum(F.col(c) * F.col("mean") * F.col("mean"))))
    ]).first()
    slope, middle = 0.0, 0.0
    if (stats["n_good"] or 0) > 0 and (stats["n_bad"] or 0) > 0:
        good, bad = stats["s_good"] / stats["n_good"], stats["s_bad"] / stats["n_bad"]
        spread = (stats["q_good"] + stats["q_bad"] - stats["n_good"] * good**2 - stats["n_bad"] * bad**2)
        variance = max(spread / (stats["n_good"] + stats["n_bad"]), 1e-9)
        slope, middle = (good - bad) / variance, (good + bad) / 2
    difference = F.coalesce("mean", F.lit(0.0))
    score = 1 / (1 + F.exp(-F.least(F.greatest(F.lit(slope) * (difference - F.lit(middle)), F.lit(-30.0)), F.lit(30.0))))
    return (
        rows.join(scored.select("rest", "mean"), "rest", "left").withColumn("score", score)
        .select(page_id, "host", "path", "rule",
                F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block")).alias("verdict"), "score")
    )
