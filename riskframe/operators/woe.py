"""Weight of evidence, information value and rule-based feature selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.flags import iv_label
from riskframe.functions.numbers import ratio
from riskframe.operators.binning import cut, quantile_breaks

MISSING = "NA"


def _binned(df, y, categorical, numeric, bins, breaks) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with a target, and the bin of each variable; null for a missing value."""
    rows = df.where(F.col(y).isNotNull())
    given = dict(breaks or {})
    unknown = [c for c in numeric if c not in given]
    if unknown:
        given |= quantile_breaks(rows, unknown, [i / bins for i in range(bins + 1)])
    labelled = {c: F.col(c).cast("string") for c in categorical}
    for c in numeric:
        edges = given[c]
        one_bin = F.when(F.col(c).isNotNull(), F.lit("all"))
        labelled[c] = cut(F.col(c), edges) if len(edges) > 1 else one_bin
    return rows, labelled


def woe_table(
    df: DataFrame,
    y: str,
    categorical=(),
    numeric=(),
    bins: int = 10,
    breaks: dict[str, list] | None = None,
    smoothing: float = 0.0,
) -> DataFrame:
    """Counts, WOE and IV share of every bin of every variable, in one pass.

    Numeric variables are cut at quantiles (or at the given breaks);
    categoricals count per level; nulls are a bin of their own, told from a level
    of the same name by ``missing``.  A bin with no
    event or no non-event has an undefined WOE: it contributes 0 and is flagged,
    unless ``smoothing`` adds that many rows to each cell.
    """
    rows, labelled = _binned(df, y, categorical, numeric, bins, breaks)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.coalesce(label, F.lit(MISSING)).alias("bin"),
                label.isNull().cast("int").alias("missing"),
            )
            for c, label in labelled.items()
        ]
    )
    cells = (
        rows.select(F.col(y).cast("double").alias("_y"), F.inline(pairs))
        .groupBy("variable", "bin", "missing")
        .agg(F.count("*").alias("n"), F.sum("_y").cast("long").alias("n1"))
    )
    # One row per variable: bounded by the number of columns.
    totals = cells.groupBy("variable").agg(
        F.sum("n").alias("_n"), F.sum("n1").alias("_n1"), F.count("*").alias("_bins")
    )
    s = F.lit(float(smoothing))
    n1, n0 = F.col("n1") + s, F.col("n") - F.col("n1") + s
    all1 = F.col("_n1") + s * F.col("_bins")
    all0 = F.col("_n") - F.col("_n1") + s * F.col("_bins")
    share1, share0 = ratio(n1, all1), ratio(n0, all0)
    usable = (n1 > 0) & (n0 > 0)
    woe = F.when(usable, F.ln(share1) - F.ln(share0)).otherwise(F.lit(0.0))
    return cells.join(F.broadcast(totals), "variable").select(
        "variable",
        "bin",
        "missing",
        "n",
        "n1",
        ratio(F.col("n"), F.col("_n")).alias("share"),
        woe.alias("woe"),
        ((share1 - share0) * woe).alias("iv"),
        (~usable).cast("int").alias("empty_cell"),
    )


def iv_summary(table: DataFrame) -> DataFrame:
    """Information value and strength class per variable."""
    return (
        table.groupBy("variable")
        .agg(F.sum("iv").alias("iv"), F.sum("empty_cell").alias("empty_cells"))
        .withColumn("strength", iv_label(F.col("iv")))
    )


def information_classes(
    df: DataFrame,
    y: str,
    categorical=(),
    numeric=(),
    bins: int = 10,
    breaks: dict[str, list] | None = None,
) -> dict[str, str]:
    """For each variable, the first by name of those that carry the same information.

    Two variables do if each one's bin determines the other's: they have as many
    bins, and there are no more pairs of bins than that.  Only variables whose
    bins have the same numbers of rows and events can; their pairs are
    counted in one more scan.  Variables of equal information value by chance
    stay apart.
    """
    cells = woe_table(df, y, categorical, numeric, bins, breaks)
    marks = cells.groupBy("variable").agg(
        F.count("*").alias("bins"), F.sum(F.xxhash64("n", "n1").cast("decimal(38,0)")).alias("mark")
    ).orderBy("variable").collect()  # one row per variable
    first = {r["variable"]: r["variable"] for r in marks}
    pairs = [
        (a["variable"], b["variable"], a["bins"])
        for i, a in enumerate(marks) for b in marks[i + 1 :] if (a["bins"], a["mark"]) == (b["bins"], b["mark"])
    ]
    if not pairs:
        return first
    rows, labelled = _binned(df, y, categorical, numeric, bins, breaks)
    met = F.array(*[F.struct(F.lit(k).alias("k"), labelled[a].alias("a"), labelled[b].alias("b")) for k, (a, b, _) in enumerate(pairs)])
    joint = rows.select(F.inline(met)).distinct().groupBy("k").agg(F.count("*").alias("n"))
    found = {r["k"]: r["n"] for r in joint.collect()}
    for k, (a, b, n) in enumerate(pairs):
        if found.get(k) == n:
            first[b] = min(first[a], first[b])
    return first


def select_features(
    iv: DataFrame,
    roles: dict[str, str],
    leakage=(),
    keep=(),
    weak: float = 0.1,
    suspicious: float = 0.5,
    classes: dict[str, str] | None = None,
) -> DataFrame:
    """Decision per variable: leakage, duplicate information, weak, suspicious or kept.

    Of variables with the same information the numeric form outranks the
    categorical, and that the binary one.  ``classes`` tells which these are
    (``information_classes``); without it, equal information values are taken
    for the same information.  ``keep`` names business overrides of the weak
    and suspicious rules.
    """
    ranks = {"numeric": 0, "categorical": 1, "binary": 2}
    name = F.col("variable")
    rank: Column = F.lit(len(ranks))
    for variable, role in roles.items():
        rank = F.when(name == variable, ranks[role]).otherwise(rank)
    leaking = name.isin(*leakage) if leakage else F.lit(False)
    told: Column = F.round("iv", 8)
    if classes is not None:
        told = name
        for variable, first in classes.items():
            told = F.when(name == variable, first).otherwise(told)
    same = Window.partitionBy(told, leaking).orderBy(rank, "variable")
    override = name.isin(*keep) if keep else F.lit(False)
    rule = (
        F.when(leaking, "leakage")
        .when(F.col("_nth") > 1, "duplicate")
        .when(override, "business")
        .when(F.col("iv") < weak, "weak")
        .when(F.col("iv") > suspicious, "suspicious")
        .otherwise("kept")
    )
    return (
        iv.withColumn("_nth", F.row_number().over(same))
        .withColumn("rule", rule)
        .select(
            "variable", "iv", "rule", F.col("rule").isin("kept", "business").cast("int").alias("kept")
        )
    )
