"""Line de-duplication with a suffix array over line-id sequences.

1. Every line that is not blank gets an id; lines that occur once end a
   sequence, so only stretches of repeated lines with enough words remain.
2. Prefix doubling ranks the suffixes of all stretches: the rank over 2^(k+1)
   lines is the rank of the pair of ranks over 2^k lines, taken from the sorted
   distinct pairs (one row per pair, however many copies it has).
3. A repeated run matters from ``min_words`` words on. For every line, the
   shortest window with so many words that begins there and the one that ends
   there are looked at. Suffixes that share a window of t lines form an interval
   of the suffix array with a common prefix of at least t lines; the interval is
   named by the ranks of the two overlapping 2^k-line pieces that make up t.
4. In each interval the first occurrence by (doc_id, line) stays and all later
   ones are deleted. Windows cover exactly the maximal repeated runs of at least
   ``min_words`` words: from any line of such a run, the shortest window from
   there, or the one that ends with the run, lies inside it.

Only DataFrame functions are used. One copy of every line always remains, as
its first occurrence cannot belong to a later copy.

Contract for unusual input: a null text stays null and an empty one empty;
blank lines belong to no run, and go with a shortest window that encloses them; white space
at the ends of lines is ignored in comparisons; rows with a null id are kept as
they are and are nobody's copy; rows that repeat an id count as documents of
their own, ordered by a hash of their text, except exact repeats, which are one
document and get one result; further columns pass through, and columns named
``n_lines`` or ``n_deleted`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.frames import small_if_counted
from riskframe.session import durable

MIN_WORDS = 50


def numbered_lines(text: str) -> Column:
    """Non-blank lines of a text in order: their number in the text and what they say."""
    lines = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(i.alias("line"), F.trim(x, F.lit(" \t\n\x0b\x0c\r")).alias("said")),
    )
    return F.filter(lines, lambda x: x["said"] != "")


def ranked(distinct: DataFrame, *order: str) -> DataFrame:
    """``distinct`` with a positive rank that follows the order of its (unique) rows."""
    return distinct.orderBy(*order).withColumn("rank", F.monotonically_increasing_id() + 1)


def stretches(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """(doc, body, run, place, line, words, r0): repeated lines in stretches of enough words."""
    lines = durable(
        docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"), F.posexplode(numbered_lines(text)).alias("place", "l"))
        .select("doc", "body", "place", "l.line", F.xxhash64("l.said").alias("h1"), F.xxhash64(F.lit(1), "l.said").alias("h2"),
                F.regexp_count("l.said", F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    )
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("words").alias("words")).where(F.col("n") > 1)
    ids = ranked(durable(often.select("h1", "h2")), "h1", "h2").withColumnRenamed("rank", "r0")
    by_place = Window.partitionBy("doc", "body").orderBy("place")
    whole = Window.partitionBy("doc", "body", "run")
    return (
        lines.join(ids, ["h1", "h2"]).select("doc", "body", "place", "line", "words", "r0").distinct()
        .withColumn("run", F.col("place") - F.row_number().over(by_place))
        .withColumn("total", F.sum("words").over(whole)).where(F.col("total") >= min_words).drop("total")
    )


def doubled(suffixes: DataFrame, level: int) -> DataFrame:
    """``suffixes`` with the rank over twice as many lines; a suffix that ends early ranks lowest."""
    step = 1 << level
    in_run = Window.partitionBy("doc", "body", "run").orderBy("place")
    pairs = suffixes.withColumn("next", F.coalesce(F.lead(f"r{level}", step).over(in_run), F.lit(0)))
    pairs = durable(pairs)
    new = ranked(pairs.select(f"r{level}", "next").distinct(), f"r{level}", "next")
    return durable(
        pairs.join(new.withColumnRenamed("rank", f"r{level + 1}"), [f"r{level}", "next"]).drop("next")
    )


def windows(min_words: int) -> Column:
    """For an array ``s`` of (place, line, words, ranks...): distinct (start, size) of the shortest windows, from 0."""
    def total(a: Column, n: Column) -> Column:
        return F.get("c", a + n) - F.get("c", a)

    size = F.size("s")
    sizes = F.sequence(F.lit(1), F.least(size, F.lit(min_words)))
    forward = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        i.alias("start"),
        F.get(F.filter(sizes, lambda n: (i + n <= size) & (total(i, F.least(n, size - i)) >= min_words)), F.lit(0)).alias("size")))
    backward = F.transform(F.sequence(F.lit(1), size), lambda e: F.named_struct(F.lit("n"), F.get(
        F.filter(sizes, lambda n: (n <= e) & (total(F.greatest(e - n, F.lit(0)), n) >= min_words)), F.lit(0)), F.lit("e"), e))
    backward = F.transform(backward, lambda x: F.struct((x["e"] - x["n"]).alias("start"), x["n"].alias("size")))
    return F.array_distinct(F.filter(F.concat(forward, backward), lambda x: x["size"].isNotNull()))


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, first, last): line numbers of the maximal runs to delete, disjoint."""
    suffixes = durable(stretches(docs, doc_id, text, min_words))

    # Running word counts come from a window before the lines of a run are put together.
    in_run = Window.partitionBy("doc", "body", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    suffixes = suffixes.withColumn("so_far", F.sum("words").over(in_run))

    def runs(levels: int) -> DataFrame:
        held = F.array_sort(F.collect_list(F.struct("place", "line", "so_far", *[f"r{k}" for k in range(levels)])))
        return (
            suffixes.groupBy("doc", "body", "run").agg(held.alias("s"))
            .withColumn("c", F.concat(F.array(F.lit(0).cast("long")), F.transform("s", lambda x: x["so_far"])))
            .withColumn("w", F.explode(windows(min_words)))
        )

    longest = runs(1).agg(F.max("w.size")).first()[0] or 1
    levels = 1
    while (1 << levels) <= longest:
        suffixes = doubled(suffixes, levels - 1)
        levels += 1

    def rank(level: int, at: Column) -> Column:
        return F.get("s", at)[f"r{level}"]

    name, other = rank(0, F.col("w.start")), rank(0, F.col("w.start"))
    for k in range(1, levels):
        name = F.when(F.col("w.size") >= 1 << k, rank(k, F.col("w.start"))).otherwise(name)
        other = F.when(F.col("w.size") >= 1 << k, rank(k, F.col("w.start") + F.col("w.size") - (1 << k))).otherwise(other)
    found = durable(runs(levels).select(
        "doc", "body", F.col("w.size").alias("size"), name.alias("name"), other.alias("other"),
        F.get("s", F.col("w.start"))["line"].alias("first"),
        F.get("s", F.col("w.start") + F.col("w.size") - 1)["line"].alias("last"),
    ))
    interval = ["size", "name", "other"]
    original = found.groupBy(*interval).agg(F.min(F.struct("doc", "body", "first")).alias("original"), F.count("*").alias("n"))
    copies = (
        found.join(original.where(F.col("n") > 1), interval)
        .where(F.struct("doc", "body", "first") != F.col("original")).select("doc", "body", "first", "last")
    )
    before = Window.partitionBy("doc", "body").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("doc", "body").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    return (
        copies.withColumn("new", (F.col("first") > F.coalesce(F.max("last").over(before), F.lit(-2)) + 1).cast("int"))
        .withColumn("piece", F.sum("new").over(so_far))
        .groupBy("doc", "body", "piece").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("piece")
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later copies of repeated line runs, and n_lines (before) and n_deleted."""
    docs = docs.drop("n_lines", "n_deleted")
    gone = (
        later_copies(docs, min_words, doc_id, text).groupBy("doc", "body")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("gone"))
    )
    key = docs.withColumn("__body", F.xxhash64(text))
    gone = small_if_counted(durable(gone)).withColumnsRenamed({"doc": "__doc", "body": "__key", "gone": "__gone"})
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x, i: ~F.exists("__gone", lambda g: (g["first"] <= i) & (i <= g["last"])))
    n_gone = F.aggregate("__gone", F.lit(0), lambda n, g: n + g["last"] - g["first"] + 1)
    return (
        key.join(gone, (F.col(doc_id) == F.col("__doc")) & (F.col("__body") == F.col("__key")), "left")
        .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long"))
        .withColumn("n_deleted", F.coalesce(n_gone, F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
        .drop("__body", "__doc", "__key", "__gone")
    )
