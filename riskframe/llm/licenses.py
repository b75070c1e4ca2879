"""Licence scans: ordered signature rules with priorities and containment suppression.

A text becomes lower-case words with one space between them. Texts without any
gate word stop there. The others meet the rules whose keyword they contain; a
rule's regex cuts the text into gaps and matches, whose running word counts
give each detection's interval. A detection is dropped if it lies inside another
one of higher priority, or of equal priority that is longer or comes first in
the rule list. Base phrases are counted at all places and never dropped.

Only DataFrame functions are used; detections of one document are compared
through running maxima in a window, never pair by pair.

Contract for unusual input: null and empty texts have no words and no labels
(empty strings) and score 0; rows that repeat an id are scanned each; a null id
is scanned like any other; empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.license_rules import BASE, RULES, Rule, gates
from riskframe.session import durable

#: How sure a detection is, by priority; a base phrase counts like a named licence.
CONFIDENCE = {1: 0.5, 2: 0.8, 3: 0.95}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_only(text: Column) -> Column:
    """'word word ... word': words are runs of digits, letters and characters over 0x7F."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))


def normal(words: Column) -> Column:
    """The same in lower case, with a space at both ends."""
    return F.concat(F.lit(" "), F.translate(words, _UPPER, _LOWER), F.lit(" "))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def rule_array(rules: Sequence[Rule]) -> Column:
    """The rules, and the base phrases as rules without priority, as one constant array."""
    def entry(number: int, label: str, priority: int, keyword: str, pattern: str) -> Column:
        return F.struct(
            F.lit(number).alias("number"), F.lit(label).alias("label"), F.lit(priority).alias("priority"),
            F.lit(keyword).alias("keyword"), F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"),
        )

    listed = [entry(i, r.label, r.priority, r.keyword, r.pattern) for i, r in enumerate(rules)]
    listed += [entry(-1 - i, label, 0, f" {phrase} ", phrase) for i, (label, phrase) in enumerate(BASE)]
    return F.array(*listed)


def detections(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(doc, body, number, label, priority, first, last): every match, as word numbers."""
    pieces = (
        texts.withColumn("r", F.explode(F.filter(rule_array(rules), lambda r: F.contains(F.col("norm"), r["keyword"]))))
        .withColumn("found", F.regexp_extract_all("norm", F.col("r.pattern"), F.lit(0)))
        .where(F.size("found") > 0)
        .withColumn("gaps", F.split("norm", F.col("r.pattern"), -1))
        .select("doc", "body", "r.number", "r.label", "r.priority",
                F.posexplode(F.zip_with("found", F.slice("gaps", F.lit(1), F.size("found")), lambda f, g: F.struct(
                    (spaces(f) + 1).alias("size"), spaces(g).alias("gap")))).alias("at", "m"))
        .distinct()  # exact repeats of a row count once here and get the same result
    )
    # Every gap ends with the space before the match, and but for the first one it begins with one as well.
    before = Window.partitionBy("doc", "body", "number").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    first = F.sum(F.col("m.gap") + F.col("m.size") - 1).over(before) - F.col("m.size")
    return pieces.withColumn("first", first).select(
        "doc", "body", "number", "label", "priority", "first", (F.col("first") + F.col("m.size") - 1).alias("last")
    )


def kept(found: DataFrame) -> DataFrame:
    """Detections that lie inside no stronger one; base phrases stay."""
    order = Window.partitionBy("doc", "body").orderBy(
        "first", F.col("last").desc(), F.col("priority").desc(), "number"
    ).rowsBetween(Window.unboundedPreceding, -1)

    def reached(priority: int) -> Column:
        return F.max(F.when(F.col("priority") >= priority, F.col("last"))).over(order)

    inside = F.lit(False)
    for p in CONFIDENCE:
        inside = F.when(F.col("priority") == p, reached(p) >= F.col("last")).otherwise(inside)
    # What starts earlier or with the same word and ends no earlier precedes in this order.
    return found.withColumn("inside", F.coalesce(inside, F.lit(False))).where(~F.col("inside")).drop("inside")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    # As a plain filter, the lower-case text would be computed once for every gate word.
    passed = F.exists(F.array(F.lower(F.coalesce(F.col(text), F.lit("")))),
                      lambda n: reduce(Column.__or__, [F.contains(n, F.lit(g)) for g in gates()]))
    texts = durable(
        docs.select(F.col(doc_id).alias("doc"), body.alias("body"), words_only(F.col(text)).alias("w"), passed.alias("passed"))
        .select("doc", "body", F.when(F.col("w") == "", 0).otherwise(spaces(F.col("w")) + 1).cast("long").alias("n_words"),
                F.when(F.col("passed"), normal(F.col("w"))).alias("norm"))
    )
    found = durable(detections(texts.where(F.col("norm").isNotNull()).select("doc", "body", "norm"), rules))
    base = F.col("priority") == 0
    sure = F.lit(CONFIDENCE[2])
    for p, c in CONFIDENCE.items():
        sure = F.when(F.col("priority") == p, F.lit(c)).otherwise(sure)
    by_doc = kept(found).groupBy("doc", "body").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(sure).alias("score"),
    )
    words = texts.select("doc", "body", "n_words")
    r = by_doc.withColumnsRenamed({"doc": "r_doc", "body": "r_body"})
    return words.join(r, F.col("doc").eqNullSafe(F.col("r_doc")) & (F.col("body") == F.col("r_body")), "left").select(
        F.col("doc").alias(doc_id), "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
