"""Manual, quantile and target-aware binning."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numbers import ratio
from riskframe.operators.ranking import exact_quantiles, running_totals
from riskframe.session import durable


def break_labels(breaks, include_lowest: bool = True) -> list[str]:
    """Interval names for right-closed bins, with the fewest digits that tell edges apart."""
    edges = [float(b) for b in breaks]
    for digits in range(3, 13):
        text = [f"{b:.{digits}g}" for b in edges]
        if all(a != b for a, b in zip(text, text[1:])):
            break
    labels = [f"({a},{b}]" for a, b in zip(text, text[1:])]
    if include_lowest:
        labels[0] = "[" + labels[0][1:]
    return labels


def cut(
    c: Column, breaks, include_lowest: bool = True, labels: list[str] | None | bool = None
) -> Column:
    """Right-closed bins; outside the breaks or null gives null.

    ``labels=False`` gives bin numbers from 1.
    """
    edges = [float(b) for b in breaks]
    if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("breaks must be at least two increasing numbers")
    if labels is False:
        names = list(range(1, len(edges)))
    else:
        names = labels or break_labels(edges, include_lowest)
    # Ordered chain: each test only needs its upper edge.
    floor = c < edges[0] if include_lowest else c <= edges[0]
    out = F.when(floor, F.lit(None))
    for upper, name in zip(edges[1:], names):
        out = out.when(c <= upper, F.lit(name))
    return out


def quantile_breaks(df: DataFrame, columns, probs=(0, 0.25, 0.5, 0.75, 1)) -> dict[str, list]:
    """Distinct quantiles of each column, ready to be used as breaks."""
    found = exact_quantiles(df, columns, probs)
    return {c: sorted({q for q in values if q is not None}) for c, values in found.items()}


def quantile_cut(
    df: DataFrame, name: str, probs=(0, 0.25, 0.5, 0.75, 1), out: str | None = None, labels=None
) -> DataFrame:
    """Add the quantile bin of a column; a constant column gets a single null bin."""
    breaks = quantile_breaks(df, [name], probs)[name]
    bins = cut(F.col(name), breaks, labels=labels) if len(breaks) > 1 else F.lit(None).cast("string")
    return df.withColumn(out or f"{name}_cat", bins)


@dataclass(frozen=True)
class Bins:
    """Cut points of one variable, inner edges only."""

    name: str
    cuts: tuple[float, ...]

    def shown(self) -> list[str]:
        """The cuts with the fewest digits, six at least, that tell them apart."""
        for digits in range(6, 18):
            text = [f"{v:.{digits}g}" for v in self.cuts]
            if all(a != b for a, b in zip(text, text[1:])):
                break
        return text

    def label(self, c: Column) -> Column:
        """Bin label; everything below the first cut and above the last one is a bin."""
        if not self.cuts:
            return F.when(c.isNotNull(), F.lit("all"))
        text = self.shown()
        out = F.when(c <= self.cuts[0], F.lit(f"<= {text[0]}"))
        for upper, shown in zip(self.cuts[1:], text[1:]):
            out = out.when(c <= upper, F.lit(f"<= {shown}"))
        return out.when(c > self.cuts[-1], F.lit(f"> {text[-1]}"))


def optimal_bin(
    df: DataFrame,
    x: str,
    y: str,
    min_share: float = 0.05,
    alpha: float = 0.05,
    min_split: int = 20,
) -> Bins:
    """Target-aware cuts by recursive two-sample splits.

    A segment splits when x and y are associated in it (permutation test of the
    linear statistic, one degree of freedom) and some cut leaves at least
    ``min_share`` of all rows on both sides; the cut with the largest
    two-sample statistic wins.  Running totals over distinct values are built
    once; each round then scores every candidate of every open segment in one
    job and returns one row per segment.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    rows = rows.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    # Squares of values far from zero cancel; those of deviations do not.
    middle = rows.agg(F.avg("_x")).first()[0] or 0.0
    rows = rows.withColumn("_d", F.col("_x") - F.lit(middle))
    table = durable(
        running_totals(
            rows,
            "_x",
            {
                "n": "count(*)",
                "n1": "sum(_y)",
                "sx": "sum(_d)",
                "sxx": "sum(_d * _d)",
                "sxy": "sum(_d * _y)",
            },
        )
    )
    min_rows = math.ceil(round(min_share * df.count()))
    critical = _chi2_one_df_quantile(alpha)
    open_segments, cuts = [(-math.inf, math.inf)], []
    while open_segments:
        found = _best_cuts(table, open_segments, min_rows)
        following = []
        for (low, high), best in zip(open_segments, found):
            if best is None or best["n"] < min_split or best["linear"] < critical:
                continue
            if best["cut"] is None:
                continue
            cuts.append(best["cut"])
            following += [(low, best["cut"]), (best["cut"], high)]
        open_segments = following
    return Bins(x, tuple(sorted(cuts)))


def _best_cuts(table: DataFrame, segments, min_rows: int):
    """For each segment: size, linear statistic and best admissible cut."""
    c = F.col("_x")
    segment = None
    for i, (low, high) in enumerate(segments):
        inside = F.lit(True)
        if low > -math.inf:
            inside &= c > low
        if high < math.inf:
            inside &= c <= high
        segment = F.when(inside, i) if segment is None else segment.when(inside, i)
    names = ("n", "n1", "sx", "sxx", "sxy")
    tagged = table.withColumn("_segment", segment).where(F.col("_segment").isNotNull())
    ends = tagged.groupBy("_segment").agg(
        *[F.sum(m).alias(f"{m}_seg") for m in names],
        *[F.min(F.col(f"{m}_run") - F.col(m)).alias(f"{m}_before") for m in ("n", "n1")],
    )
    # One row per open segment: at most 1 / min_share of them.
    scored = tagged.join(F.broadcast(ends), "_segment").withColumns(
        {
            "nl": F.col("n_run") - F.col("n_before"),
            "n1l": F.col("n1_run") - F.col("n1_before"),
        }
    )
    n, n1 = F.col("n_seg"), F.col("n1_seg")
    nl, n1l = F.col("nl"), F.col("n1l")
    gap = n1l * n - n1 * nl
    chi = ratio(gap * gap * n, nl * (n - nl) * n1 * (n - n1))
    admissible = (nl >= min_rows) & (n - nl >= min_rows)
    cov = F.col("sxy_seg") - F.col("sx_seg") * n1 / n
    var_x = F.col("sxx_seg") - F.col("sx_seg") * F.col("sx_seg") / n
    var_y = n1 - n1 * n1 / n
    linear = ratio((n - 1) * cov * cov, var_x * var_y)
    best = (
        scored.groupBy("_segment")
        .agg(
            F.max(n).alias("n"),
            F.max(F.coalesce(linear, F.lit(0.0))).alias("linear"),
            F.max(F.when(admissible, F.struct(chi.alias("chi"), (-c).alias("neg")))).alias("best"),
        )
        .collect()
    )
    out = [None] * len(segments)
    for row in best:
        hit = row.best
        out[row["_segment"]] = {
            "n": row.n,
            "linear": row.linear,
            "cut": None if hit is None or hit.chi is None or hit.chi <= 0 else -hit.neg,
        }
    return out


def _chi2_one_df_quantile(alpha: float) -> float:
    """Upper quantile of chi-square with one degree of freedom, by bisection on erfc."""
    low, high = 0.0, 1500.0
    for _ in range(200):
        mid = (low + high) / 2
        if math.erfc(math.sqrt(mid / 2)) > alpha:
            low = mid
        else:
            high = mid
    return high


def apply_bins(df: DataFrame, bins: Bins, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{bins.name}_optbin_cat", bins.label(F.col(bins.name)))
