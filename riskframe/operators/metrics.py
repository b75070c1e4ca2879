"""Discrimination and classification metrics of a score against a 0/1 target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numbers import ratio
from riskframe.operators.ranking import running_totals, totals_of_cells
from riskframe.session import durable


def score_curve(
    df: DataFrame, y: str, p: str, counts: tuple[str, str] | None = None
) -> DataFrame:
    """Per distinct score, from the highest down: rows, events and running sums.

    Rows without score or target are left out.  ``counts`` names the row and
    event count columns of an already grouped table, used instead of ``y``.
    """
    score = F.col(p).cast("double").alias("score")
    if counts:
        n, n1 = (F.col(c).cast("double") for c in counts)
        rows = df.where(F.col(p).isNotNull()).select(score, n.alias("_n"), n1.alias("_n1"))
        measures = {"n": "sum(_n)", "n1": "sum(_n1)"}
    else:
        rows = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).select(
            score, F.col(y).cast("double").alias("_y")
        )
        measures = {"n": "count(*)", "n1": "sum(_y)"}
    return _with_non_events(running_totals(rows, "score", measures, descending=True))


def _with_non_events(curve: DataFrame) -> DataFrame:
    return curve.withColumns(
        {
            "n0": F.col("n") - F.col("n1"),
            "n0_run": F.col("n_run") - F.col("n1_run"),
            "n0_all": F.col("n_all") - F.col("n1_all"),
        }
    )


def _gap() -> Column:
    return F.abs(ratio(F.col("n1_run"), F.col("n1_all")) - ratio(F.col("n0_run"), F.col("n0_all")))


def _grouped_gap(groups: int) -> Column:
    """Largest gap at the edges of equal-size score groups that fall on a score."""
    start, n_all = F.col("n_run") - F.col("n"), F.col("n_all")
    first = F.floor(start * groups / n_all) + 1
    last = F.floor(F.col("n_run") * groups / n_all)

    def gap(g: Column) -> Column:
        at = g * n_all / groups
        taken = F.col("n1_run") - F.col("n1") + F.col("n1") * ratio(at - start, F.col("n"))
        return F.abs(ratio(taken, F.col("n1_all")) - ratio(at - taken, F.col("n0_all")))

    return F.when(first <= last, F.array_max(F.transform(F.sequence(first, F.greatest(first, last)), gap)))


def _median(run: str, every: str) -> Column:
    """Exact median score of the rows a running count counts, from the highest score down."""
    def at(rank: Column) -> Column:
        return F.max(F.when(F.col(run) >= rank, F.col("score")))

    n = F.col(every)
    return (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2


def _auc(direction: bool | str) -> Column:
    """Share of (event, non-event) pairs ranked right, ties counting half.

    ``direction=True`` counts low scores as events where the median of the events is below
    that of the non-events; ``'half'`` takes whichever direction gives at least one half.
    """
    below = F.col("n0_all") - F.col("n0_run")
    pairs = F.sum(F.col("n1") * (below + F.col("n0") / 2))
    value = ratio(pairs, F.max(F.col("n1_all") * F.col("n0_all")))
    if direction not in (True, False, "half"):
        raise ValueError("the direction must be True, False or 'half'")
    if direction == "half":
        return F.greatest(value, 1 - value)
    if direction:
        return F.when(_median("n1_run", "n1_all") < _median("n0_run", "n0_all"), 1 - value).otherwise(value)
    return value


def ks(df: DataFrame, y: str, p: str, groups: int | None = None, counts=None) -> DataFrame:
    """Largest gap between the cumulative event and non-event shares, one row.

    ``groups`` reads the gap only at that many equal-size score groups.  A group
    edge inside a tied score takes the tied rows' events in proportion.
    """
    curve = score_curve(df, y, p, counts)
    return curve.agg(F.max(_gap() if groups is None else _grouped_gap(groups)).alias("ks"))


def auc(
    df: DataFrame, y: str, p: str, auto_direction: bool | str = False, counts=None
) -> DataFrame:
    """Area under the ROC curve, one row.

    ``auto_direction`` lets the exact medians of events and non-events decide
    which scores speak for an event, so a curve near the diagonal may stay below
    one half; ``'half'`` flips to at least one half.
    """
    return score_curve(df, y, p, counts).agg(_auc(auto_direction).alias("auc"))


def discrimination(df: DataFrame, y: str, p: str, counts=None) -> DataFrame:
    """Rows, events, KS and AUC from one curve, one row."""
    return score_curve(df, y, p, counts).agg(
        F.max("n_all").cast("long").alias("n"),
        F.max("n1_all").cast("long").alias("events"),
        F.max(_gap()).alias("ks"),
        _auc(False).alias("auc"),
    )


def roc_points(df: DataFrame, y: str, p: str, counts=None) -> DataFrame:
    """One point per distinct score (rows at or above it are positive) plus the origin.

    The cutoff of the origin is infinite: nobody is positive.
    """
    curve = score_curve(df, y, p, counts)
    # The row of the highest score also yields the origin.
    top = F.col("n_run") == F.col("n")
    kinds = F.when(top, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    origin = F.col("_origin")

    def count(running):
        return F.when(origin, 0.0).otherwise(running)

    tp, fp = count(F.col("n1_run")), count(F.col("n0_run"))
    return (
        curve.withColumn("_origin", F.explode(kinds))
        .select(
            F.when(origin, float("inf")).otherwise(F.col("score")).alias("cutoff"),
            tp.alias("tp"),
            fp.alias("fp"),
            (F.col("n1_all") - tp).alias("fn"),
            (F.col("n0_all") - fp).alias("tn"),
        )
        .withColumns(
            {
                "sensitivity": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
                "specificity": ratio(F.col("tn"), F.col("tn") + F.col("fp")),
            }
        )
    )


def _criterion(metric: str) -> Column:
    """Value to maximise."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    if metric == "abs_d_sens_spec":
        return -F.abs(F.col("sensitivity") - F.col("specificity"))
    if metric == "accuracy":
        return ratio(tp + tn, tp + fp + fn + tn)
    if metric == "f1":
        return ratio(2 * tp, 2 * tp + fp + fn)
    if metric == "youden":
        return F.col("sensitivity") + F.col("specificity") - 1
    raise ValueError(f"unknown metric {metric!r}")


def best_cutoff(df: DataFrame, y: str, p: str, *metrics: str, counts=None) -> DataFrame:
    """Best cutoff per metric with its sensitivity and specificity.

    Candidates are the distinct scores and infinity; among equals the highest
    cutoff is taken.
    """
    points = roc_points(df, y, p, counts)
    picks = [
        F.max(F.struct(_criterion(m).alias("value"), "cutoff", "sensitivity", "specificity")).alias(m)
        for m in metrics
    ]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("best")) for m in metrics])
    sign = F.when(F.col("metric") == "abs_d_sens_spec", -1.0).otherwise(1.0)
    return (
        points.agg(*picks)
        .select(F.inline(rows))
        .select(
            "metric",
            F.col("best.cutoff").alias("cutoff"),
            (sign * F.col("best.value")).alias("value"),
            F.col("best.sensitivity").alias("sensitivity"),
            F.col("best.specificity").alias("specificity"),
        )
    )


def base_rate(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.avg(F.col(y).cast("double")).alias("base_rate"))


def confusion(df: DataFrame, y: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Cell counts of a 0/1 prediction; rows without one are counted as unscored."""
    real, guess = F.col(y), F.col(predicted)
    cells = [
        F.count_if((real == 1) & (guess == 1)).alias("tp"),
        F.count_if((real == 0) & (guess == 1)).alias("fp"),
        F.count_if((real == 1) & (guess == 0)).alias("fn"),
        F.count_if((real == 0) & (guess == 0)).alias("tn"),
        F.count_if(real.isNull() | guess.isNull()).alias("unscored"),
    ]
    return df.groupBy(*(by or [])).agg(*cells)


def class_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, sensitivity, specificity and precision of confusion rows."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "sensitivity": ratio(tp, tp + fn),
            "specificity": ratio(tn, tn + fp),
            "precision": ratio(tp, tp + fp),
        }
    )


@dataclass(frozen=True)
class Sample:
    """A score to measure: its column, its cutoff, and which rows it is measured on."""

    name: str
    p: str
    cut: float
    strict: bool = True
    where: Column | None = None


def evaluate_all(
    df: DataFrame,
    y: str,
    samples: list[Sample],
    counts=None,
    groups: int = 10,
    auto_direction: bool | str = False,
) -> DataFrame:
    """One comparison row per sample: discrimination and class metrics.

    KS is given exactly and read at ``groups`` equal-size score groups.

    All samples and scores are collapsed to cells (sample, score) in one scan;
    curves, confusion cells and unscored rows are read off these.
    """
    names = [F.struct(F.lit(i).alias("_sample"), F.col(s.p).cast("double").alias("score")) for i, s in enumerate(samples)]
    taken = [n if s.where is None else F.when(s.where, n) for n, s in zip(names, samples)]
    if counts:
        n, n1 = (F.col(c).cast("double") for c in counts)
        known = F.lit(True)
    else:
        n, n1, known = F.lit(1.0), F.coalesce(F.col(y).cast("double"), F.lit(0.0)), F.col(y).isNotNull()
    rows = df.select(n.alias("n"), n1.alias("n1"), known.alias("_known"), F.explode(F.array(*taken)).alias("s")).where("s IS NOT NULL")
    score = F.when(F.col("_known") & ~F.isnan("s.score"), F.col("s.score"))
    cells = durable(
        rows.select(F.col("s._sample").alias("_sample"), score.alias("score"), "n", "n1")
        .groupBy("_sample", "score").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    )
    curve = _with_non_events(
        totals_of_cells(cells.where(F.col("score").isNotNull()), "score", ["n", "n1"], descending=True, by=("_sample",))
    )

    def of_sample(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_sample"))

    cut = of_sample([float(s.cut) for s in samples])
    hit = F.when(of_sample([s.strict for s in samples]), F.col("score") > cut).otherwise(F.col("score") >= cut)

    def cell(column, cond):
        return F.sum(F.when(cond, F.col(column)).otherwise(0.0)).cast("long")

    scored = curve.groupBy("_sample").agg(
        F.max(_gap()).alias("ks"),
        F.max(_grouped_gap(groups)).alias("ks_grouped"),
        _auc(auto_direction).alias("auc"),
        cell("n1", hit).alias("tp"),
        cell("n0", hit).alias("fp"),
        cell("n1", ~hit).alias("fn"),
        cell("n0", ~hit).alias("tn"),
    )
    missing = F.coalesce(F.sum(F.when(F.col("score").isNull(), F.col("n"))), F.lit(0.0)).cast("long")
    left_out = cells.groupBy("_sample").agg(missing.alias("unscored"))
    every = df.sparkSession.createDataFrame([(i,) for i in range(len(samples))], "_sample int")
    merged = F.broadcast(every).join(left_out, "_sample", "left").join(scored, "_sample", "left").select(
        of_sample([s.name for s in samples]).alias("sample"),
        cut.alias("cutoff"),
        "ks", "ks_grouped", "auc", "tp", "fp", "fn", "tn",
        F.coalesce("unscored", F.lit(0)).alias("unscored"),
    )
    return class_metrics(merged)


def evaluate(
    df: DataFrame,
    y: str,
    p: str,
    cut: float,
    name: str,
    strict: bool = True,
    counts=None,
    groups: int = 10,
    auto_direction: bool | str = False,
) -> DataFrame:
    """One comparison row for a scored sample: discrimination and class metrics."""
    return evaluate_all(df, y, [Sample(name, p, cut, strict)], counts, groups, auto_direction)


def compare(*samples: DataFrame) -> DataFrame:
    """Comparison table of metric rows."""
    out = samples[0]
    for other in samples[1:]:
        out = out.unionByName(other)
    return out
