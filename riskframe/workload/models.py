"""Logistic regression, collinearity, CHAID tree and monitoring."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.operators import chaid, glm
from riskframe.operators.collinearity import vif
from riskframe.operators.dedupe import keep_first
from riskframe.plans import cleaning as plan
from riskframe.plans import crash_schema as cs
from riskframe.plans.modelling import run_study
from riskframe.plans.monitoring import latest_baseline, monitor
from riskframe.session import durable
from riskframe.spec import FeatureSpec
from riskframe.workload import sqltext as sq
from riskframe.workload.cleaning import KEY_SQL
from riskframe.workload.registry import feed, planted, query, rounded, table

c = F.col

FLAG_SPEC = FeatureSpec(target="y", levels={"l_returnflag": ("A", "N", "R")})
_RATES = f"""WITH {sq.PLANTED}, r AS (
  SELECT l_returnflag AS level, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1
  FROM planted GROUP BY l_returnflag),
m AS (SELECT level, n, n1, n1 / n AS p, ln(n1 / n / (1 - n1 / n)) AS logit,
  1 / n1 + 1 / (n - n1) AS v FROM r),
a AS (SELECT logit AS base, v AS base_v FROM m WHERE level = 'A')"""
_LOGLIK = "sum(n1 * ln(p) + (n - n1) * ln(1 - p))"


@query(
    "glm1_fit_logit",
    f"""{_RATES}, t AS (
      SELECT CASE WHEN level = 'A' THEN '(Intercept)' ELSE 'l_returnflag' || level END AS term,
        CASE WHEN level = 'A' THEN logit ELSE logit - base END AS estimate,
        CASE WHEN level = 'A' THEN sqrt(v) ELSE sqrt(v + base_v) END AS std_error FROM m, a)
    SELECT term, round(estimate, 4) AS estimate, round(std_error, 4) AS std_error,
      round(estimate / std_error, 3) AS z, 1 AS converged,
      (SELECT round(-2 * {_LOGLIK} + 6, 3) FROM m) AS aic FROM t""",
)
def glm1(spark, sf_dir):
    fit = glm.fit_logit(planted(spark, sf_dir), FLAG_SPEC)
    return fit.coef_table(spark).select(
        "term",
        F.round("estimate", 4).alias("estimate"),
        F.round("std_error", 4).alias("std_error"),
        F.round("z", 3).alias("z"),
        F.lit(int(fit.converged)).alias("converged"),
        F.lit(round(fit.aic, 3)).alias("aic"),
    )


TWO_FACTORS = FeatureSpec(
    target="y", numeric=("l_quantity",), levels={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")}
)


@query(
    "glm1_score_equations",
    f"""WITH {sq.PLANTED}, u AS (
      SELECT 'l_returnflag' AS term, l_returnflag AS level FROM planted
      UNION ALL SELECT 'l_linestatus', l_linestatus FROM planted)
    SELECT term, level, count(*) AS n, 0.0::DOUBLE AS residual, 0.0::DOUBLE AS with_quantity FROM u
    GROUP BY term, level""",
)
def glm1_score_equations(spark, sf_dir):
    """A fit of one number and two factors is the maximum where, in every level, the residuals
    add up to 0, and weighted with the number over all rows."""
    rows = planted(spark, sf_dir)
    fitted = glm.fit_logit(rows, TWO_FACTORS).score(rows)
    gap = c("y") - c("probability")
    levels = fitted.select(
        gap.alias("gap"), (gap * c("l_quantity")).alias("moment"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("term"), c(n).alias("level")) for n in TWO_FACTORS.levels])),
    )
    whole = F.sum("moment").over(Window.partitionBy("term"))
    sums = levels.groupBy("term", "level").agg(
        F.count("*").alias("n"), F.sum("gap").alias("gap"), F.sum("moment").alias("moment")
    )
    return sums.withColumn("all_moments", whole).select(
        "term", "level", "n", (F.round("gap", 2) + 0.0).alias("residual"),
        (F.round(c("all_moments"), 1) + 0.0).alias("with_quantity"),
    )


@query(
    "glm2_compare_models",
    f"""{_RATES}, full_model AS (SELECT {_LOGLIK} AS ll FROM m),
    t AS (SELECT sum(n) AS n, sum(n1) AS n1 FROM m),
    l AS (SELECT l_linestatus, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1
      FROM planted GROUP BY l_linestatus),
    status_model AS (SELECT sum(n1 * ln(n1 / n) + (n - n1) * ln(1 - n1 / n)) AS ll FROM l)
    SELECT 'flag' AS model, 3 AS terms, 'l_linestatus' AS dropped, round(-2 * ll, 3) AS deviance,
      round(-2 * ll + 6, 3) AS aic FROM full_model
    UNION ALL SELECT 'status', 2, 'l_returnflag', round(-2 * ll, 3), round(-2 * ll + 4, 3)
    FROM status_model""",
)
def glm2(spark, sf_dir):
    rows = planted(spark, sf_dir)
    status = FeatureSpec(target="y", levels={"l_linestatus": ("F", "O")})
    fits = {"flag": glm.fit_logit(rows, FLAG_SPEC), "status": glm.fit_logit(rows, status)}
    return rounded(glm.compare_models(spark, fits).drop("converged"), 3)


@query(
    "glm3_score",
    f"""{_RATES} SELECT l_orderkey, l_linenumber, round(p, 5) AS probability
    FROM planted JOIN m ON l_returnflag = level""",
)
def glm3(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return rounded(
        glm.fit_logit(rows, FLAG_SPEC)
        .score(rows)
        .select("l_orderkey", "l_linenumber", "probability"),
        5,
    )


@query(
    "prj24_bind_predictions",
    f"""{_RATES} SELECT l_orderkey, l_linenumber, y, round(1 - p, 5) AS "P_0", round(p, 5) AS "P_1"
    FROM planted JOIN m ON l_returnflag = level""",
)
def prj24(spark, sf_dir):
    rows = planted(spark, sf_dir)
    tree = chaid.fit_chaid(rows, "y", ["l_returnflag"], alpha_merge=1e-4, alpha_split=1e-4)
    scored = chaid.tree_score(rows, tree)
    return rounded(scored.select("l_orderkey", "l_linenumber", "y", "P_0", "P_1"), 5)


@query(
    "glm4_scoring_expr",
    f"""{_RATES} SELECT l_returnflag, count(*) AS n, round(avg(logit), 4) AS eta
    FROM planted JOIN m ON l_returnflag = level GROUP BY l_returnflag""",
)
def glm4(spark, sf_dir):
    rows = planted(spark, sf_dir)
    fit = glm.fit_logit(rows, FLAG_SPEC)
    return rounded(
        rows.groupBy("l_returnflag").agg(
            F.count("*").alias("n"), F.avg(fit.linear_predictor()).alias("eta")
        ),
        4,
    )


@query(
    "vif1_collinearity",
    """WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem),
    v AS (SELECT 1 / (1 - r * r) AS vif FROM r)
    SELECT name AS variable, name AS term, round(vif, 4) AS vif, 1 AS df, round(vif, 4) AS gvif,
      round(sqrt(vif), 4) AS gvif_root FROM v, (VALUES ('l_quantity'), ('l_extendedprice')) t(name)""",
)
def vif1(spark, sf_dir):
    spec = FeatureSpec(target="y", numeric=("l_quantity", "l_extendedprice"))
    report = vif(table(spark, sf_dir, "lineitem"), spec)
    return rounded(report, 4)


@query(
    "vif1_fitted_model",
    f"""{_RATES}, l AS (SELECT level, v, base_v FROM m, a WHERE level <> 'A'),
    shared AS (SELECT any_value(base_v) * any_value(base_v) / product(v + base_v) AS r2 FROM l)
    SELECT 'l_returnflag' AS variable, 'l_returnflag' || level AS term, round(1 / (1 - r2), 4) AS vif, 2 AS df,
      1.0::DOUBLE AS gvif, 1.0::DOUBLE AS gvif_root, round(sqrt(v + base_v), 4) AS std_error FROM l, shared""",
)
def vif1_fitted(spark, sf_dir):
    """Collinearity of a fitted logit on one factor: its slopes share the reference level's variance."""
    patterns = durable(glm.covariate_patterns(planted(spark, sf_dir), FLAG_SPEC))
    fit = glm.fit_logit(patterns, FLAG_SPEC, counts=glm.PATTERN_COUNTS)
    return rounded(vif(patterns, FLAG_SPEC, fit, glm.PATTERN_COUNTS), 4)


# --- tree ----------------------------------------------------------------------------

_TREE_VARIABLES = ("l_returnflag", "l_linestatus", "l_linenumber")


def _tree(rows):
    return chaid.fit_chaid(rows, "y", _TREE_VARIABLES, alpha_merge=1e-4, alpha_split=1e-4)


_NODE = "CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 WHEN 'R' THEN 4 END"


@query(
    "tree1_fit_chaid",
    f"""WITH {sq.PLANTED} SELECT 1 AS node, 'all' AS rule, count(*) AS n,
      CAST(sum(y) AS BIGINT) AS n1, 'l_returnflag' AS split_on FROM planted
    UNION ALL SELECT {_NODE}, 'l_returnflag in {{' || l_returnflag || '}}', count(*),
      CAST(sum(y) AS BIGINT), NULL FROM planted GROUP BY l_returnflag""",
)
def tree1(spark, sf_dir):
    tree = _tree(planted(spark, sf_dir))
    return chaid.tree_rules(spark, tree).select("node", "rule", "n", "n1", "split_on")


@query(
    "tree2_assign_node",
    f"WITH {sq.PLANTED} SELECT l_orderkey, l_linenumber, {_NODE} AS node FROM planted",
)
def tree2(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return chaid.assign_node(rows, _tree(rows)).select("l_orderkey", "l_linenumber", "node")


@query(
    "tree3_score",
    f"""{_RATES} SELECT l_orderkey, l_linenumber, round(p, 6) AS "P_1"
    FROM planted JOIN m ON l_returnflag = level""",
)
def tree3(spark, sf_dir):
    rows = planted(spark, sf_dir)
    scored = chaid.tree_score(rows, _tree(rows))
    return rounded(scored.select("l_orderkey", "l_linenumber", "P_1"))


@query(
    "tree4_node_profile",
    f"""WITH {sq.PLANTED} SELECT {_NODE} AS node, 1 AS depth, count(*) AS n,
      CAST(sum(y) AS BIGINT) AS n1, round(avg(y), 6) AS rate FROM planted GROUP BY l_returnflag""",
)
def tree4(spark, sf_dir):
    rules = chaid.tree_rules(spark, _tree(planted(spark, sf_dir)))
    return rounded(rules.where("leaf").select("node", "depth", "n", "n1", "rate"))


# --- deeper tree: merging and a second level ------------------------------------------


def _merging(rows):
    """Rates of 2, 2 and 20 % by flag; under the third, 5 and 35 % by the size of the quantity."""
    draw = c("l_partkey") * 7919 % 100
    large = c("l_quantity") > 25
    limit = F.when(c("l_returnflag") != "R", 2).when(large, 35).otherwise(5)
    return rows.select(
        "l_returnflag", F.when(large, "large").otherwise("small").alias("amount"),
        F.when(draw < limit, 1).otherwise(0).alias("t"),
    )


_MERGING = f"""WITH {sq.PLANTED}, rows AS (SELECT l_returnflag AS flag,
  CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS amount,
  CASE WHEN l_partkey * 7919 % 100 < CASE WHEN l_returnflag <> 'R' THEN 2
    WHEN l_quantity > 25 THEN 35 ELSE 5 END THEN 1 ELSE 0 END AS t FROM planted)"""


@query(
    "tree1_merged_categories",
    f"""{_MERGING}
    SELECT 0 AS depth, 'all' AS rule, count(*) AS n, CAST(sum(t) AS BIGINT) AS n1 FROM rows
    UNION ALL SELECT 1, CASE WHEN flag = 'R' THEN 'l_returnflag in {{R}}' ELSE 'l_returnflag in {{A, N}}' END,
      count(*), CAST(sum(t) AS BIGINT) FROM rows GROUP BY 2
    UNION ALL SELECT 2, 'l_returnflag in {{R}} & amount in {{' || amount || '}}', count(*),
      CAST(sum(t) AS BIGINT) FROM rows WHERE flag = 'R' GROUP BY amount""",
)
def tree1_merged(spark, sf_dir):
    rows = _merging(planted(spark, sf_dir))
    tree = chaid.fit_chaid(rows, "t", ["l_returnflag", "amount"], alpha_merge=1e-6, alpha_split=1e-6)
    return chaid.tree_rules(spark, tree).select("depth", "rule", "n", "n1")


# --- monitoring ----------------------------------------------------------------------


def _baselines(spark, sf_dir):
    """Baseline log with one row per order, newest last."""
    return table(spark, sf_dir, "orders").select(
        F.timestamp_add(
            "SECOND", (c("o_orderkey") % 86400).cast("int"), c("o_orderdate").cast("timestamp")
        ).alias("data_treinamento"),
        F.round(c("o_custkey") % 100 / 100, 2).alias("auc_treino"),
        F.round(c("o_orderkey") % 100 / 100, 2).alias("auc_teste"),
        F.lit(0.1).alias("ks_treino"),
        F.lit(0.1).alias("ks_teste"),
        F.lit(0.1).alias("cutoff"),
    )


@query(
    "mon1_latest_baseline",
    """SELECT round((o_custkey % 100) / 100.0::DOUBLE, 2) AS auc_treino,
      round((o_orderkey % 100) / 100.0::DOUBLE, 2) AS auc_teste, 0.1::DOUBLE AS cutoff FROM orders
    ORDER BY o_orderdate + to_seconds(o_orderkey % 86400) DESC, 1 DESC, 2 DESC LIMIT 1""",
)
def mon1(spark, sf_dir):
    return latest_baseline(_baselines(spark, sf_dir)).select("auc_treino", "auc_teste", "cutoff")


@query(
    "mon2_monitor",
    f"""{_RATES}, live AS (SELECT planted.*, p FROM planted JOIN m ON l_returnflag = level),
    {sq.curve("live")},
    f AS (SELECT CAST(strftime(max(l_shipdate), '%Y-%m-%d') AS VARCHAR) AS carga_id,
      count(*) AS n_linhas_base_viva,
      CAST(count(*) FILTER (y = 1 AND p > 0.1) AS DOUBLE) / count(*) FILTER (y = 1) AS sens FROM live),
    k AS (SELECT {sq.KS} AS ks, {sq.ks_in_groups()} AS ks_grouped, {sq.AUC} AS auc FROM curve)
    SELECT carga_id, '2026-02-12 08:00:00' AS data_execucao, n_linhas_base_viva,
      round(auc, 5) AS auc_viva, round(ks, 5) AS ks_viva, round(ks_grouped, 5) AS ks_grouped, round(sens, 5) AS sensibilidade_viva,
      0.1::DOUBLE AS cutoff_usado FROM f, k""",
)
def mon2(spark, sf_dir):
    live = planted(spark, sf_dir).withColumn(
        "carga_id", c("l_shipdate").cast("date").cast("string")
    )
    run = monitor(
        live, _baselines(spark, sf_dir), FLAG_SPEC, run_at=datetime(2026, 2, 12, 8, 0, 0)
    )
    record = [tuple(run.record[f.name] for f in cs.MONITORING_SCHEMA.fields)]
    shown = spark.createDataFrame(record, cs.MONITORING_SCHEMA)
    return rounded(shown.withColumn("ks_grouped", F.lit(run.ks_grouped)), 5)


_STUDY_ROWS = f"""WITH {sq.FEATURES}, n AS (SELECT {KEY_SQL} AS key, Periodo, KmDecimal AS km,
  {", ".join(f"CASE WHEN regexp_full_match({v}, ' *[0-9]+ *') THEN CAST(trim({v}) AS DOUBLE) END AS {v}" for v in cs.VEHICLES)},
  CAST(nullif(Gravemente_feridos_Mortos, '') AS INT) AS y FROM features)
  SELECT y, row_number() OVER (ORDER BY md5(key || '|42')) AS r, count(*) OVER () AS n
  FROM n WHERE y IS NOT NULL AND Periodo IS NOT NULL AND km BETWEEN {cs.KM_BREAKS[0]} AND {cs.KM_BREAKS[-1]}
    AND {" AND ".join(f"{v} IS NOT NULL" for v in cs.VEHICLES)}"""


@query(
    "e2_crash_study",
    f"""WITH s AS ({_STUDY_ROWS}), p AS (SELECT y, CASE WHEN r <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS part FROM s),
    k AS (SELECT part, count(*) AS n, CAST(sum(y) AS BIGINT) AS events FROM p GROUP BY part)
    SELECT model || '/' || part AS sample, n, events, 0 AS unscored,
      CASE WHEN model = 'chaid' THEN round((SELECT events / n FROM k WHERE part = 'train'), 9) END AS base_cutoff
    FROM k, (VALUES ('logit'), ('chaid')) t(model)""",
)
def e2_study(spark, sf_dir):
    """Whole study on the crash feed: each sample's rows, events and unscored rows, and the tree's cutoff, its base rate.

    Figures of the iterative fit are compared in ``e2_saturated_study``, where they have a closed form.
    """
    features = durable(plan.feature_table(feed(spark, sf_dir)))
    comparison = run_study(plan.model_table(features), cs.CRASH_SPEC).comparison
    return comparison.select(
        "sample", (c("tp") + c("fp") + c("fn") + c("tn") + c("unscored")).alias("n"), (c("tp") + c("fn")).alias("events"),
        "unscored", F.when(c("sample").startswith("chaid"), F.round("cutoff", 9)).alias("base_cutoff"),
    )


FULL_SPEC = FeatureSpec(target="y", levels={"l_returnflag": ("A", "N", "R")}, key="key")


@query(
    "e2_saturated_study",
    f"""WITH {sq.PLANTED}, k AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber || '-' || l_partkey
        || '-' || l_suppkey || '-' || CAST(l_quantity AS BIGINT) AS key FROM planted),
    d AS (SELECT key, l_returnflag, y FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY l_returnflag, y) = 1),
    r AS (SELECT *, row_number() OVER (ORDER BY md5(key || '|42'), key) AS r, count(*) OVER () AS n FROM d),
    tr AS (SELECT * FROM r WHERE r <= floor(0.8 * n)),
    rate AS (SELECT l_returnflag, avg(y) AS p FROM tr GROUP BY l_returnflag),
    base AS (SELECT avg(y) AS b FROM tr),
    s AS (SELECT CASE WHEN r <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS part, r.y, p FROM r JOIN rate USING (l_returnflag)),
    f AS (SELECT y, p FROM s WHERE part = 'train'), o AS (SELECT y, p FROM s WHERE part = 'test'),
    kf AS (WITH {{sq_f}} SELECT 'train' AS part, {sq.KS} AS ks, {sq.ks_in_groups()} AS ks_grouped, {sq.AUC} AS auc FROM curve),
    ko AS (WITH {{sq_o}} SELECT 'test' AS part, {sq.KS} AS ks, {sq.ks_in_groups()} AS ks_grouped, {sq.AUC} AS auc FROM curve),
    m AS (SELECT * FROM kf UNION ALL SELECT * FROM ko),
    cells AS (SELECT part, count(*) FILTER (y = 1 AND p >= b) AS tp, count(*) FILTER (y = 0 AND p >= b) AS fp,
      count(*) FILTER (y = 1 AND p < b) AS fn, count(*) FILTER (y = 0 AND p < b) AS tn FROM s, base GROUP BY part)
    SELECT 'chaid/' || part AS sample, round(ks, 5) AS ks, round(ks_grouped, 5) AS ks_grouped, round(auc, 5) AS auc,
      tp, fp, fn, tn FROM m JOIN cells USING (part)
    UNION ALL SELECT 'logit/' || part, round(ks, 5), round(ks_grouped, 5), round(auc, 5), NULL, NULL, NULL, NULL FROM m
    """.replace("{sq_f}", sq.curve("f")).replace("{sq_o}", sq.curve("o")),
)
def e2_saturated(spark, sf_dir):
    """The study on one factor, where every model's probabilities are the training means of its levels."""
    rows = planted(spark, sf_dir)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c("l_quantity").cast("long"))
    rows = keep_first(rows.select(key.alias("key"), "l_returnflag", "y"), ["key"], ["l_returnflag", "y"])
    study = run_study(rows, FULL_SPEC)
    tree = c("sample").startswith("chaid")
    return rounded(
        study.comparison.select(
            "sample", "ks", "ks_grouped", "auc", *[F.when(tree, c(x)).alias(x) for x in ("tp", "fp", "fn", "tn")]
        ),
        5,
    )
