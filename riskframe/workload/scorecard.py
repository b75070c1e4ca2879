"""Binning, evidence tables, selection, splits, discrimination and cutoffs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions import flags
from riskframe.operators import binning, metrics, woe
from riskframe.operators.columns import align_levels
from riskframe.operators.split import exact_split, hash_share, simulate_batch
from riskframe.plans import cleaning as plan
from riskframe.plans import crash_schema as cs
from riskframe.session import durable
from riskframe.spec import FeatureSpec
from riskframe.workload import sqltext as sq
from riskframe.workload.registry import feed, planted, query, rounded, scored, table

c = F.col


@query(
    "bin1_quantile_cut",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a,
      quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.75) AS d
      FROM lineitem)
    SELECT CAST(CASE WHEN l_extendedprice <= a THEN 1 WHEN l_extendedprice <= b THEN 2
      WHEN l_extendedprice <= d THEN 3 ELSE 4 END AS BIGINT) AS bin, count(*) AS n,
      min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest
    FROM lineitem, q GROUP BY 1""",
)
def bin1(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    cut = binning.quantile_cut(rows, "l_extendedprice", out="bin", labels=False)
    return cut.groupBy(c("bin").cast("long").alias("bin")).agg(
        F.count("*").alias("n"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
    )


def _cut_sql(x, breaks, labels):
    whens = " ".join(f"WHEN {x} <= {b} THEN '{lab}'" for b, lab in zip(breaks[1:], labels))
    return f"CASE WHEN {x} < {breaks[0]} THEN NULL {whens} END"


_FIRST_LABELS = binning.break_labels(cs.KM_BREAKS_FIRST)


@query(
    "bin2_manual_cut",
    f"""WITH {sq.FEED}, f AS (SELECT {sq.km("Km")} AS km FROM feed)
    SELECT {_cut_sql("km", cs.KM_BREAKS_FIRST, _FIRST_LABELS)} AS wide,
      {_cut_sql("km", cs.KM_BREAKS, cs.KM_LEVELS)} AS fine, count(*) AS n
    FROM f GROUP BY 1, 2""",
)
def bin2(spark, sf_dir):
    from riskframe.functions.numbers import parse_km

    rows = feed(spark, sf_dir).select(parse_km(c("Km")).alias("km"))
    return (
        rows.select(
            binning.cut(c("km"), cs.KM_BREAKS_FIRST).alias("wide"),
            binning.cut(c("km"), cs.KM_BREAKS).alias("fine"),
        )
        .groupBy("wide", "fine")
        .agg(F.count("*").alias("n"))
    )


@query(
    "bin3_optimal_bin",
    f"""WITH {sq.PLANTED},
    cells AS (SELECT l_quantity AS x, CAST(count(*) AS DOUBLE) AS n,
      CAST(sum(y_quantity) AS DOUBLE) AS n1 FROM planted GROUP BY l_quantity),
    run AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(n1) OVER (ORDER BY x) AS n1l,
      sum(n) OVER () AS n, sum(n1) OVER () AS n1 FROM cells),
    chi AS (SELECT x, (n1l * n - n1 * nl) * (n1l * n - n1 * nl) * n
      / (nl * (n - nl) * n1 * (n - n1)) AS v FROM run
      WHERE nl >= round(0.05 * n) AND n - nl >= round(0.05 * n)),
    best AS (SELECT x AS cut FROM chi ORDER BY v DESC, x LIMIT 1)
    SELECT CASE WHEN l_quantity <= cut THEN '<= ' || CAST(CAST(cut AS BIGINT) AS VARCHAR)
      ELSE '> ' || CAST(CAST(cut AS BIGINT) AS VARCHAR) END AS bin, count(*) AS n,
      CAST(sum(y_quantity) AS BIGINT) AS n1 FROM planted, best GROUP BY 1""",
)
def bin3(spark, sf_dir):
    rows = planted(spark, sf_dir)
    bins = binning.optimal_bin(rows, "l_quantity", "y_quantity", alpha=1e-6)
    return (
        binning.apply_bins(rows, bins, "bin")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("y_quantity").alias("n1"))
    )


_FAR = 1_000_000_000_000


@query(
    "bin3_far_from_zero",
    f"""WITH {sq.PLANTED}, marked AS (SELECT *, CASE WHEN l_quantity > 35 THEN 1 WHEN l_quantity > 15
      THEN CASE WHEN l_partkey % 10 < 5 THEN 1 ELSE 0 END ELSE 0 END AS t FROM planted)
    SELECT CASE WHEN l_quantity <= 15 THEN 1 WHEN l_quantity <= 35 THEN 2 ELSE 3 END AS bin,
      count(*) AS n, CAST(sum(t) AS BIGINT) AS n1 FROM marked GROUP BY 1""",
)
def bin3_far(spark, sf_dir):
    """Two cuts in values as large as a time in milliseconds."""
    step = F.when(c("l_partkey") % 10 < 5, 1).otherwise(0)
    rows = planted(spark, sf_dir).select(
        (c("l_quantity") + _FAR).alias("x"),
        F.when(c("l_quantity") > 35, 1).when(c("l_quantity") > 15, step).otherwise(0).alias("t"),
    )
    bins = binning.optimal_bin(rows, "x", "t", alpha=1e-6)
    number = F.lit(1)
    for cut in bins.cuts:
        number = number + (c("x") > cut).cast("int")
    return rows.groupBy(number.alias("bin")).agg(F.count("*").alias("n"), F.sum("t").alias("n1"))


@query(
    "bin4_apply_bins",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 10 THEN '<= 10'
    WHEN l_quantity <= 25 THEN '<= 25' WHEN l_quantity > 25 THEN '> 25' END AS bin FROM lineitem""",
)
def bin4(spark, sf_dir):
    bins = binning.Bins("l_quantity", (10.0, 25.0))
    return binning.apply_bins(table(spark, sf_dir, "lineitem"), bins, "bin").select(
        "l_orderkey", "l_linenumber", "bin"
    )


@query(
    "enc2_reference_level",
    """SELECT l_orderkey, l_linenumber,
      CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "l_returnflagA",
      CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "l_returnflagR"
    FROM lineitem""",
)
def enc2(spark, sf_dir):
    from riskframe.operators.design import design_table

    spec = FeatureSpec(target="y", levels={"l_returnflag": ("A", "N", "R")})
    return design_table(
        table(spark, sf_dir, "lineitem"),
        spec.relevel("l_returnflag", "N"),
        ["l_orderkey", "l_linenumber"],
    )


@query(
    "enc3_design_matrix",
    """SELECT l_orderkey, l_linenumber, l_quantity,
      CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "l_returnflagN",
      CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "l_returnflagR",
      CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "l_linestatusO"
    FROM lineitem""",
)
def enc3(spark, sf_dir):
    from riskframe.operators.design import design_table

    spec = FeatureSpec(
        target="y",
        numeric=("l_quantity",),
        levels={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")},
    )
    return design_table(
        table(spark, sf_dir, "lineitem"), spec, ["l_orderkey", "l_linenumber"]
    )


@query(
    "enc4_align_levels",
    """SELECT l_orderkey, l_linenumber,
      CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS l_returnflag FROM lineitem""",
)
def enc4_align(spark, sf_dir):
    spec = FeatureSpec(target="y", levels={"l_returnflag": ("A", "N")})
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return align_levels(rows, spec)


# --- evidence ------------------------------------------------------------------------

_QUANTITY_BREAKS = (0, 10, 20, 30, 40, 50)
_QUANTITY_LABELS = binning.break_labels(_QUANTITY_BREAKS)


def _evidence(source, y, variables):
    """CTE ``evidence``: one row per (variable, bin) with WOE and IV share."""
    union = " UNION ALL ".join(
        f"SELECT '{v}' AS variable, coalesce({expr}, 'NA') AS bin, "
        f"CASE WHEN ({expr}) IS NULL THEN 1 ELSE 0 END AS missing, {y} AS y FROM {source}"
        for v, expr in variables.items()
    )
    return f"""
u AS ({union}),
g AS (SELECT variable, bin, missing, count(*) AS n, CAST(sum(y) AS BIGINT) AS n1
  FROM u WHERE y IS NOT NULL GROUP BY variable, bin, missing),
s AS (SELECT *, CAST(n1 AS DOUBLE) / CAST(sum(n1) OVER v AS DOUBLE) AS s1,
  CAST(n - n1 AS DOUBLE) / CAST(sum(n - n1) OVER v AS DOUBLE) AS s0,
  CAST(n AS DOUBLE) / CAST(sum(n) OVER v AS DOUBLE) AS share
  FROM g WINDOW v AS (PARTITION BY variable)),
evidence AS (SELECT variable, bin, missing, n, n1, share,
  CASE WHEN n1 > 0 AND n > n1 THEN ln(s1) - ln(s0) ELSE 0 END AS woe,
  CASE WHEN n1 > 0 AND n > n1 THEN (s1 - s0) * (ln(s1) - ln(s0)) ELSE 0 END AS iv,
  CASE WHEN n1 > 0 AND n > n1 THEN 0 ELSE 1 END AS empty_cell FROM s)"""


_VARIABLES = {
    "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus",
    "l_linenumber": "CAST(l_linenumber AS VARCHAR)",
    "l_quantity": _cut_sql("l_quantity", _QUANTITY_BREAKS, _QUANTITY_LABELS),
}
_CATEGORICAL = ("l_returnflag", "l_linestatus", "l_linenumber")


def _evidence_table(spark, sf_dir):
    return woe.woe_table(
        planted(spark, sf_dir),
        "y",
        categorical=_CATEGORICAL,
        numeric=("l_quantity",),
        breaks={"l_quantity": _QUANTITY_BREAKS},
    )


@query(
    "iv1_woe_table",
    f"""WITH {sq.PLANTED}, {_evidence("planted", "y", _VARIABLES)}
    SELECT variable, bin, missing, n, n1, round(share, 6) AS share, round(woe, 6) AS woe,
      round(iv, 6) AS iv, empty_cell FROM evidence""",
)
def iv1(spark, sf_dir):
    return rounded(_evidence_table(spark, sf_dir))


# A level that is called like the bin of the nulls, and nulls.
_NAMED_NA = "CASE WHEN l_linenumber = 1 THEN 'NA' WHEN l_linenumber > 2 THEN l_returnflag END"


@query(
    "iv1_level_named_na",
    f"""WITH {sq.PLANTED}, {_evidence("planted", "y", {"flag": _NAMED_NA})}
    SELECT variable, bin, missing, n, n1, round(share, 6) AS share, round(woe, 6) AS woe,
      round(iv, 6) AS iv, empty_cell FROM evidence""",
)
def iv1_named_na(spark, sf_dir):
    rows = planted(spark, sf_dir).withColumn("flag", F.expr(_NAMED_NA))
    return rounded(woe.woe_table(rows, "y", categorical=("flag",)))


_DECILES = """
q AS (SELECT quantile_cont(l_extendedprice,
    [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS d FROM lineitem),
binned AS (SELECT y, CAST(len(list_filter(d, lambda x: x < l_extendedprice)) AS VARCHAR) AS b
  FROM planted, q)"""


@query(
    "iv1_quantile_iv",
    f"""WITH {sq.PLANTED}, {_DECILES}, {_evidence("binned", "y", {"l_extendedprice": "b"})}
    SELECT variable, count(*) AS bins, round(sum(iv), 6) AS iv FROM evidence GROUP BY variable""",
)
def iv1_quantile(spark, sf_dir):
    evidence = woe.woe_table(planted(spark, sf_dir), "y", numeric=("l_extendedprice",))
    return rounded(
        evidence.groupBy("variable").agg(F.count("*").alias("bins"), F.sum("iv").alias("iv"))
    )


_LABEL = (
    "CASE WHEN iv <= 0.02 THEN 'Fraquissimo' WHEN iv <= 0.1 THEN 'Fraco' "
    "WHEN iv <= 0.3 THEN 'Média' WHEN iv <= 0.5 THEN 'Forte' ELSE 'Suspeita' END"
)
_IV_SUMMARY = f"""WITH {sq.PLANTED}, {_evidence("planted", "y", _VARIABLES)},
iv AS (SELECT variable, sum(iv) AS iv, CAST(sum(empty_cell) AS BIGINT) AS empty_cells
  FROM evidence GROUP BY variable)"""


@query(
    "iv2_strength",
    f"{_IV_SUMMARY} SELECT variable, round(iv, 6) AS iv, empty_cells, {_LABEL} AS strength FROM iv",
)
def iv2(spark, sf_dir):
    return rounded(woe.iv_summary(_evidence_table(spark, sf_dir)))


@query(
    "prj25_iv_label",
    "SELECT l_orderkey, l_linenumber, "
    + _LABEL.replace("iv <=", "l_quantity / 60 <=")
    + " AS label FROM lineitem",
)
def prj25(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", flags.iv_label(c("l_quantity") / 60).alias("label")
    )


@query(
    "sel1_select_features",
    f"""{_IV_SUMMARY} SELECT variable, round(iv, 6) AS iv,
      CASE WHEN variable = 'l_linestatus' THEN 'leakage' WHEN variable = 'l_quantity' THEN 'business'
        WHEN iv < 0.1 THEN 'weak' WHEN iv > 0.5 THEN 'suspicious' ELSE 'kept' END AS rule,
      CASE WHEN variable = 'l_linestatus' THEN 0 WHEN variable = 'l_quantity' THEN 1
        WHEN iv < 0.1 OR iv > 0.5 THEN 0 ELSE 1 END AS kept FROM iv""",
)
def sel1(spark, sf_dir):
    roles = {v: "numeric" if v == "l_quantity" else "categorical" for v in _VARIABLES}
    return rounded(
        woe.select_features(
            woe.iv_summary(_evidence_table(spark, sf_dir)),
            roles,
            leakage=["l_linestatus"],
            keep=["l_quantity"],
        )
    )


_SHIFTED = """coalesce(lag(l_returnflag) OVER w, last_value(l_returnflag) OVER (PARTITION BY l_orderkey, y ORDER BY l_linenumber
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""
_TWINS = {"l_returnflag": "l_returnflag", "mirrored": "mirrored", "shifted": "shifted", "l_linestatus": "l_linestatus"}


@query(
    "sel1_true_duplicate",
    f"""WITH {sq.PLANTED}, t AS (SELECT *, 'is ' || lower(l_returnflag) AS mirrored, {_SHIFTED} AS shifted FROM planted
      WINDOW w AS (PARTITION BY l_orderkey, y ORDER BY l_linenumber)),
    {_evidence("t", "y", _TWINS)}, iv AS (SELECT variable, sum(iv) AS iv FROM evidence GROUP BY variable)
    SELECT variable, round(iv, 6) AS iv, CASE WHEN variable = 'mirrored' THEN 'duplicate'
        WHEN iv < 0.1 THEN 'weak' WHEN iv > 0.5 THEN 'suspicious' ELSE 'kept' END AS rule,
      CASE WHEN variable = 'mirrored' OR iv < 0.1 OR iv > 0.5 THEN 0 ELSE 1 END AS kept FROM iv""",
)
def sel1_duplicate(spark, sf_dir):
    """A renamed copy of a variable is a duplicate; one of equal information value, dealt to other rows, is not."""
    rows = planted(spark, sf_dir)
    within = Window.partitionBy("l_orderkey", "y").orderBy("l_linenumber")
    ends = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "mirrored": F.concat(F.lit("is "), F.lower("l_returnflag")),
        "shifted": F.coalesce(F.lag("l_returnflag").over(within), F.last_value("l_returnflag").over(ends)),
    })
    rows = durable(rows.select("y", *_TWINS))
    classes = woe.information_classes(rows, "y", categorical=_TWINS)
    found = woe.iv_summary(woe.woe_table(rows, "y", categorical=_TWINS))
    return rounded(woe.select_features(found, {v: "categorical" for v in _TWINS}, classes=classes))


_FEW = (0, 0.5, 1.5, 100)
_CRASH_VARIABLES = {v: _cut_sql(v, _FEW, binning.break_labels(_FEW)) for v in cs.VEHICLES} | {"Periodo": "Periodo", "Km_cat": "Km_cat"}


@query(
    "e2_screening",
    f"""WITH {sq.FEATURES}, n AS (SELECT Periodo, KmDecimal AS km,
      {", ".join(f"CASE WHEN regexp_full_match({v}, ' *[0-9]+ *') THEN CAST(trim({v}) AS DOUBLE) END AS {v}" for v in cs.VEHICLES)},
      CAST(nullif(Gravemente_feridos_Mortos, '') AS INT) AS y FROM features),
    t AS (SELECT *, {_cut_sql("km", cs.KM_BREAKS, cs.KM_LEVELS)} AS Km_cat FROM n),
    {_evidence("t", "y", _CRASH_VARIABLES)},
    iv AS (SELECT variable, sum(iv) AS iv FROM evidence GROUP BY variable)
    SELECT variable, round(iv, 6) AS iv, CASE WHEN variable = 'Periodo' THEN 'business'
        WHEN iv < 0.001 THEN 'weak' WHEN iv > 0.5 THEN 'suspicious' ELSE 'kept' END AS rule,
      CASE WHEN variable = 'Periodo' THEN 1 WHEN iv < 0.001 OR iv > 0.5 THEN 0 ELSE 1 END AS kept,
      (SELECT count(*) FROM t) AS n_rows FROM iv""",
)
def e2_screening(spark, sf_dir):
    """The decision log of the crash features, and the rows its complete-case report covers."""
    from riskframe.plans.screening import screen
    from riskframe.session import durable

    typed = plan.typed_features(durable(plan.feature_table(feed(spark, sf_dir))))
    rows = typed.select(*cs.MODEL_COLUMNS)
    found = screen(
        rows, cs.CRASH_SPEC, keep=["Periodo"], breaks={v: list(_FEW) for v in cs.VEHICLES}, weak=0.001
    )
    covered = found.dropped.agg(F.sum("n")).first()[0]
    return rounded(found.decisions.withColumn("n_rows", F.lit(covered)))


# --- splits --------------------------------------------------------------------------

_SPLIT = """
ranked AS (SELECT o_orderkey, o_custkey, row_number() OVER (
    ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey) AS r,
    count(*) OVER () AS n FROM orders)"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


@query(
    "smp1_exact_split",
    f"WITH {_SPLIT} SELECT o_orderkey, o_custkey FROM ranked WHERE r <= floor(0.8 * n)",
)
def smp1(spark, sf_dir):
    return exact_split(_orders(spark, sf_dir), "o_orderkey", 0.8)[0]


@query(
    "set2_split_complement",
    f"WITH {_SPLIT} SELECT o_orderkey, o_custkey FROM ranked WHERE r > floor(0.8 * n)",
)
def set2(spark, sf_dir):
    return exact_split(_orders(spark, sf_dir), "o_orderkey", 0.8)[1]


@query(
    "smp1_hash_share",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE left(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 8) < 'cccccccc'""",
)
def smp1_share(spark, sf_dir):
    return hash_share(_orders(spark, sf_dir), "o_orderkey", 0.8)[0]


@query(
    "smp2_simulate_batch",
    f"""SELECT o_orderkey, o_custkey FROM orders
    ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|7'), o_orderkey
    LIMIT {random.Random("7").randint(150, 200)}""",
)
def smp2(spark, sf_dir):
    return simulate_batch(_orders(spark, sf_dir), "o_orderkey", seed=7)


# --- discrimination and cutoffs ------------------------------------------------------

_CURVE = f"WITH {sq.SCORED}, {sq.curve('scored')}"


@query("evl1_ks", f"{_CURVE} SELECT round({sq.KS}, 6) AS ks FROM curve")
def evl1(spark, sf_dir):
    return rounded(metrics.ks(scored(spark, sf_dir), "y", "p"))


@query(
    "evl1_ks_ten_groups",
    f"""{_CURVE}, e AS (SELECT *, unnest(range(1, 11)) AS g FROM curve),
    t AS (SELECT *, n1_run - n1 + n1 * (g * n_all / 10 - (n_run - n)) / n AS taken FROM e
      WHERE g * n_all / 10 > n_run - n AND g * n_all / 10 <= n_run)
    SELECT round(max(abs(taken / n1_all - (g * n_all / 10 - taken) / n0_all)), 6) AS ks FROM t""",
)
def evl1_groups(spark, sf_dir):
    return rounded(metrics.ks(scored(spark, sf_dir), "y", "p", groups=10))


@query("evl2_auc", f"{_CURVE} SELECT round({sq.AUC}, 6) AS auc FROM curve")
def evl2(spark, sf_dir):
    return rounded(metrics.auc(scored(spark, sf_dir), "y", "p"))


# A score whose events have the lower median but still win more pairs, by a part of very high scores; and its reverse.
_TILTED = """tilted AS (SELECT l_linenumber % 7 = 0 OR l_orderkey % 5 < 2 AS e, l_quantity + CASE
    WHEN l_linenumber % 7 = 0 OR l_orderkey % 5 < 2 THEN CASE WHEN l_partkey % 20 < 9 THEN 60 ELSE -22 END ELSE 0 END AS p FROM lineitem)"""
_TILTED_AUC = """r AS (SELECT CAST({y} AS DOUBLE) AS y, {p} AS p FROM tilted),
  q AS (SELECT p, sum(y) AS n1, sum(1 - y) AS n0 FROM r GROUP BY p),
  c AS (SELECT *, sum(n0) OVER (ORDER BY p) - n0 / 2 AS below FROM q),
  a AS (SELECT sum(n1 * below) / (sum(n1) * sum(n0)) AS auc FROM c),
  m AS (SELECT median(p) FILTER (y = 1) AS m1, median(p) FILTER (y = 0) AS m0 FROM r)
  SELECT '{name}' AS score, round(auc, 6) AS as_scored, round(CASE WHEN m1 < m0 THEN 1 - auc ELSE auc END, 6) AS by_medians,
    round(greatest(auc, 1 - auc), 6) AS at_least_half FROM a, m"""


@query(
    "evl2_auc_direction",
    " UNION ALL ".join(
        f"(WITH {_TILTED}, {_TILTED_AUC.format(y=y, p=p, name=n)})"
        for n, y, p in (("tilted", "e", "p"), ("reversed", "e", "-p"))
    ),
)
def evl2_direction(spark, sf_dir):
    """Where the medians and the area disagree about the direction of a score."""
    event = (c("l_linenumber") % 7 == 0) | (c("l_orderkey") % 5 < 2)
    lift = F.when(event, F.when(c("l_partkey") % 20 < 9, 60).otherwise(-22)).otherwise(0)
    rows = table(spark, sf_dir, "lineitem").select(event.cast("int").alias("y"), (c("l_quantity") + lift).alias("p"))
    out = None
    for name, sign in (("tilted", 1), ("reversed", -1)):
        signed = rows.withColumn("p", c("p") * sign)
        areas = {"as_scored": False, "by_medians": True, "at_least_half": "half"}
        row = metrics.auc(signed, "y", "p").select(F.lit(name).alias("score"))
        for label, direction in areas.items():
            row = row.join(F.broadcast(metrics.auc(signed, "y", "p", direction).select(F.lit(name).alias("score"), c("auc").alias(label))), "score")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


_ROC = f"""{_CURVE}, points AS (
  SELECT score AS cutoff, n1_run AS tp, n0_run AS fp, n1_all - n1_run AS fn, n0_all - n0_run AS tn
  FROM curve UNION ALL
  SELECT 'Infinity'::DOUBLE, 0, 0, max(n1_all), max(n0_all) FROM curve),
roc AS (SELECT *, tp / (tp + fn) AS sensitivity, tn / (tn + fp) AS specificity FROM points)"""


_SHOWN_CUTOFF = (
    "CASE WHEN cutoff = 'Infinity'::DOUBLE THEN 'Inf' ELSE CAST(round(cutoff, 2) AS VARCHAR) END"
)


def _cutoff_text():
    return F.when(c("cutoff") == float("inf"), "Inf").otherwise(F.round("cutoff", 2).cast("string"))


@query(
    "evl3_roc_points",
    f"""{_ROC} SELECT {_SHOWN_CUTOFF} AS cutoff, tp, fp, fn, tn, round(sensitivity, 6) AS sensitivity,
    round(specificity, 6) AS specificity FROM roc""",
)
def evl3(spark, sf_dir):
    points = metrics.roc_points(scored(spark, sf_dir), "y", "p")
    return rounded(points.withColumn("cutoff", _cutoff_text()))


_CRITERIA = {
    "cut1_equal_rates": ("abs_d_sens_spec", "-abs(sensitivity - specificity)", "-"),
    "cut2_accuracy": ("accuracy", "(tp + tn) / (tp + fp + fn + tn)", ""),
    "cut3_f1": ("f1", "2 * tp / (2 * tp + fp + fn)", ""),
    "cut4_youden": ("youden", "sensitivity + specificity - 1", ""),
}


def _cutoff_query(name, metric, expr, sign):
    @query(
        name,
        f"""{_ROC} SELECT '{metric}' AS metric, {_SHOWN_CUTOFF} AS cutoff,
        round({sign}({expr}), 6) AS value, round(sensitivity, 6) AS sensitivity,
        round(specificity, 6) AS specificity FROM roc ORDER BY {expr} DESC, roc.cutoff DESC LIMIT 1""",
    )
    def run(spark, sf_dir):
        best = metrics.best_cutoff(scored(spark, sf_dir), "y", "p", metric)
        return rounded(best.withColumn("cutoff", _cutoff_text()))


for _name, _args in _CRITERIA.items():
    _cutoff_query(_name, *_args)


@query("cut5_base_rate", f"WITH {sq.SCORED} SELECT round(avg(y), 6) AS base_rate FROM scored")
def cut5(spark, sf_dir):
    return rounded(metrics.base_rate(scored(spark, sf_dir), "y"))


@query(
    "prj21_apply_cutoff",
    f"""WITH {sq.SCORED} SELECT l_orderkey, l_linenumber, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS above,
    CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS from_cut FROM scored""",
)
def prj21(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        flags.apply_cutoff(c("p"), 0.5).alias("above"),
        flags.apply_cutoff(c("p"), 0.5, strict=False).alias("from_cut"),
    )


_CELLS = """count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
  count(*) FILTER (y = 1 AND p <= 0.5) AS fn, count(*) FILTER (y = 0 AND p <= 0.5) AS tn,
  count(*) FILTER (p IS NULL OR y IS NULL) AS unscored"""


def _predicted(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("predicted", flags.apply_cutoff(c("p"), 0.5))


@query("evl4_confusion", f"WITH {sq.SCORED} SELECT {_CELLS} FROM scored")
def evl4(spark, sf_dir):
    return metrics.confusion(_predicted(spark, sf_dir), "y", "predicted")


_CLASS = """round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy,
  round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS sensitivity,
  round(CAST(tn AS DOUBLE) / (tn + fp), 6) AS specificity,
  round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision" """


@query(
    "evl5_class_metrics",
    f"""WITH {sq.SCORED}, cm AS (SELECT l_returnflag, {_CELLS} FROM scored GROUP BY l_returnflag)
    SELECT *, {_CLASS} FROM cm""",
)
def evl5(spark, sf_dir):
    cells = metrics.confusion(_predicted(spark, sf_dir), "y", "predicted", ["l_returnflag"])
    return rounded(metrics.class_metrics(cells))


@query(
    "evl6_compare",
    f"""WITH {sq.SCORED}, f AS (SELECT * FROM scored WHERE l_linestatus = 'F'),
    o AS (SELECT * FROM scored WHERE l_linestatus = 'O'),
    cf AS (SELECT {_CELLS} FROM f), co AS (SELECT {_CELLS} FROM o),
    kf AS (WITH {sq.curve("f")} SELECT {sq.KS} AS ks, {sq.ks_in_groups()} AS ks_grouped, {sq.AUC} AS auc FROM curve),
    ko AS (WITH {sq.curve("o")} SELECT {sq.KS} AS ks, {sq.ks_in_groups()} AS ks_grouped, {sq.AUC} AS auc FROM curve),
    a AS (SELECT 'train' AS sample, 0.5::DOUBLE AS cutoff, * FROM kf, cf
      UNION ALL SELECT 'test', 0.5, * FROM ko, co)
    SELECT sample, cutoff, round(ks, 6) AS ks, round(ks_grouped, 6) AS ks_grouped, round(auc, 6) AS auc, tp, fp, fn, tn, unscored,
      {_CLASS} FROM a""",
)
def evl6(spark, sf_dir):
    rows = scored(spark, sf_dir)
    samples = [
        metrics.Sample(name, "p", 0.5, where=c("l_linestatus") == status)
        for name, status in (("train", "F"), ("test", "O"))
    ]
    return rounded(metrics.evaluate_all(rows, "y", samples))


@query(
    "e2_model_table",
    f"""WITH {sq.FEATURES}, n AS (SELECT Periodo, KmDecimal AS km,
      {", ".join(f"CASE WHEN regexp_full_match({v}, ' *[0-9]+ *') THEN CAST(trim({v}) AS DOUBLE) END AS {v}" for v in cs.VEHICLES)},
      CAST(nullif(Gravemente_feridos_Mortos, '') AS INT) AS y FROM features),
    t AS (SELECT *, {_cut_sql("km", cs.KM_BREAKS, cs.KM_LEVELS)} AS Km_cat FROM n)
    SELECT Periodo, Km_cat, count(*) AS n, CAST(sum(y) AS BIGINT) AS events,
      CAST(sum(Automovel + Bicicleta + Caminhao + Moto + Onibus + Outros + Utilitario) AS DOUBLE)
        AS vehicles
    FROM t WHERE y IS NOT NULL AND Periodo IS NOT NULL AND Km_cat IS NOT NULL
      AND {" AND ".join(f"{v} IS NOT NULL" for v in cs.VEHICLES)} GROUP BY Periodo, Km_cat""",
)
def e2_model_table(spark, sf_dir):
    from riskframe.session import durable

    rows = plan.model_table(durable(plan.feature_table(feed(spark, sf_dir))))
    vehicles = sum((c(v) for v in cs.VEHICLES[1:]), c(cs.VEHICLES[0]))
    return rows.groupBy("Periodo", "Km_cat").agg(
        F.count("*").alias("n"),
        F.sum(cs.SEVERE).alias("events"),
        F.sum(vehicles).alias("vehicles"),
    )
