"""Order statistics and running totals that never put all rows in one task.

A running total over a sorted column is built in two levels: rows collapse to
one cell per distinct value, in the only scan of the source; the cells, kept in
the shared folder, are cut into value ranges of similar size, running sums run
inside each range in parallel, and the (few) range totals give each range its
starting offset.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.session import durable

MAX_RANGES = 8192
SKETCH_ACCURACY = 10_000


def range_count(df: DataFrame) -> int:
    """Value ranges to cut: several per shuffle partition, bounded."""
    return min(MAX_RANGES, 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_edges(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """Inner edges of value ranges with similar row counts, from a mergeable sketch.

    Only the edges (at most ``MAX_RANGES``) reach the driver.  A value repeated
    many times takes several edges at once; they collapse into one.
    """
    parts = ranges or range_count(df)
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    row = df.agg(
        F.percentile_approx(
            F.col(value).cast("double"), probs, max(SKETCH_ACCURACY, 4 * parts)
        ).alias("edges")
    ).first()
    return sorted({e for e in row.edges or [] if math.isfinite(e)})


def running_totals(
    df: DataFrame,
    value: str,
    measures: dict[str, str],
    descending: bool = False,
    ranges: int | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Per distinct value: each measure, its running total and its grand total.

    ``measures`` maps an output name to an aggregate expression that adds up
    over rows.  Adds ``<name>_run`` (inclusive) and ``<name>_all``.  Missing
    values of the sort column are left out.  ``by`` names columns of which
    every combination has running totals of its own, all from one scan.
    """
    rows = df.withColumn(value, _number(value)).where(F.col(value).isNotNull())
    added = [F.expr(e).cast("double").alias(n) for n, e in measures.items()]
    return totals_of_cells(
        durable(rows.groupBy(*by, value).agg(*added)), value, list(measures), descending, ranges, by
    )


def totals_of_cells(
    cells: DataFrame,
    value: str,
    measures: list[str],
    descending: bool = False,
    ranges: int | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``running_totals`` of a kept table that has one row per value (and combination of ``by``)."""
    edges = range_edges(cells, value, ranges)
    if edges:
        splits = [-math.inf, *edges, math.inf]
        ranged = Bucketizer(
            splits=splits, inputCol=value, outputCol="_range", handleInvalid="keep"
        ).transform(cells)
    else:
        ranged = cells.withColumn("_range", F.lit(0.0))

    def ordered(c):
        return F.desc(c) if descending else F.asc(c)

    # The ranges are those of all cells together, so no combination of ``by``
    # has more cells in one of them than a range is meant to hold.
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(ordered(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per combination and range, MAX_RANGES + 2 of each at most.
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(n).alias(n) for n in measures])
    over = Window.partitionBy(*by).orderBy(ordered("_range"))
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    everything = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(n).over(before), F.lit(0.0)).alias(f"_{n}_before") for n in measures],
        *[F.sum(n).over(everything).alias(f"{n}_all") for n in measures],
    )
    running = ranged.withColumns({f"_{n}_in": F.sum(n).over(inside) for n in measures})
    if not by:  # the number of combinations has no bound
        offsets = F.broadcast(offsets)
    return running.join(offsets, [*by, "_range"]).select(
        *by,
        value,
        *measures,
        *[(F.col(f"_{n}_in") + F.col(f"_{n}_before")).alias(f"{n}_run") for n in measures],
        *[f"{n}_all" for n in measures],
    )


@dataclass
class _Rank:
    """One order statistic being located: zero-based rank inside an open value interval."""

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    slack: float = 2.0 / SKETCH_ACCURACY
    value: float | None = None

    @property
    def interval(self):
        return (self.column, self.low, self.high)


def exact_quantiles(
    df: DataFrame, columns, probs, gather_rows: int = 1_000_000
) -> dict[str, list[float | None]]:
    """Exact quantiles by linear interpolation between order statistics.

    Position of probability p among n values is (n - 1) * p.  A sketch proposes
    an interval around every wanted rank, one counting pass proves it right,
    and it shrinks until at most ``gather_rows`` rows are inside; only those are
    sorted.  An interval that misses its rank is widened and tried again, so
    the answer never depends on the sketch error.  A value repeated so often
    that it spans an interval edge is recognised by its count.
    """
    columns = list(columns)
    data = df.select(*[_number(c).alias(c) for c in columns])
    sizes = data.agg(*[F.count(c).alias(c) for c in columns]).first()
    spans = {}
    for c in columns:
        for p in probs:
            position = (sizes[c] - 1) * p
            low = math.floor(position + 1e-9)
            weight = position - low if position - low > 1e-9 else 0.0
            spans[(c, p)] = (low, low + 1 if weight else low, weight)
    wanted = {(c, r) for (c, _), span in spans.items() if sizes[c] for r in span[:2]}
    ranks = {key: _Rank(*key, inside=sizes[key[0]]) for key in sorted(wanted)}
    while wide := [r for r in ranks.values() if r.value is None and r.inside > gather_rows]:
        _narrow(data, wide)
    _gather(data, [r for r in ranks.values() if r.value is None])

    def quantile(c, p):
        if not sizes[c]:
            return None
        low, high, weight = spans[(c, p)]
        a, b = ranks[(c, low)].value, ranks[(c, high)].value
        # Between infinities there is nothing to interpolate.
        return a if a == b or not weight else a + weight * (b - a)

    return {c: [quantile(c, p) for p in probs] for c in columns}


def _number(column: str):
    """The column as a double; not-a-number counts as missing."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), c)


def _within(column: str, low: float | None, high: float | None):
    c = F.col(column)
    cond = c.isNotNull()
    if low is not None:
        cond &= c > low
    if high is not None:
        cond &= c < high
    return cond


def _narrow(data: DataFrame, ranks: list[_Rank]) -> None:
    """Propose a tighter interval for each rank, then count it."""
    # Ranks with one interval share one sketch.
    probs: dict[tuple, list[float]] = {}
    for r in ranks:
        at = (r.rank - r.below) / r.inside
        probs.setdefault(r.interval, []).extend([max(at - r.slack, 0.0), min(at + r.slack, 1.0)])
    sketches = [
        F.percentile_approx(F.when(_within(*i), F.col(i[0])), ps, SKETCH_ACCURACY).alias(f"s{k}")
        for k, (i, ps) in enumerate(probs.items())
    ]
    row = data.agg(*sketches).first()
    found = {i: iter(row[f"s{k}"]) for k, i in enumerate(probs)}
    proposed = [(next(found[r.interval]), next(found[r.interval])) for r in ranks]
    counts = []
    for k, (r, (low, high)) in enumerate(zip(ranks, proposed)):
        c = F.col(r.column)
        tests = (c < low, c == low, c < high, c == high)
        counts += [F.count_if(t).alias(f"{name}{k}") for name, t in zip("abde", tests)]
    counted = data.agg(*counts).first()
    for k, (r, (low, high)) in enumerate(zip(ranks, proposed)):
        under_low, at_low, under_high, at_high = (counted[f"{name}{k}"] for name in "abde")
        if not under_low <= r.rank < under_high + at_high:
            r.slack *= 4
        elif r.rank < under_low + at_low:
            r.value = low
        elif r.rank >= under_high:
            r.value = high
        else:
            r.low, r.high = low, high
            r.below = under_low + at_low
            r.inside = under_high - r.below


def _gather(data: DataFrame, ranks: list[_Rank]) -> None:
    """Read the ranks off the sorted values of their intervals."""
    if not ranks:
        return
    # Ranks that share an interval share its cells.
    names = {i: str(k) for k, i in enumerate(dict.fromkeys(r.interval for r in ranks))}
    picks = [F.when(_within(*i), F.col(i[0])).alias(name) for i, name in names.items()]
    cells = (
        unpivot_doubles(data.select(*picks))
        .groupBy("variable", "level")
        .agg(F.count("*").cast("double").alias("n"))
    )
    # Ranges of values, not whole columns, are sorted; all columns share one set of them.
    running = totals_of_cells(durable(cells), "level", ["n"], by=("variable",))
    reached = [
        (F.col("variable") == names[r.interval]) & (F.col("n_run") > r.rank - r.below) for r in ranks
    ]
    row = running.agg(*[F.min(F.when(hit, F.col("level"))).alias(str(k)) for k, hit in enumerate(reached)]).first()
    for k, r in enumerate(ranks):
        r.value = row[str(k)]


def unpivot_doubles(df: DataFrame) -> DataFrame:
    """Numeric columns to (variable, level) rows without nulls."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("double").alias("level"))
            for c in df.columns
        ]
    )
    return df.select(F.inline(pairs)).where(F.col("level").isNotNull())
