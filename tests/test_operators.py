"""Operators against brute force, closed forms and invariants."""

import math
import random

import numpy as np
import pytest
from conftest import SF001, SF01, plan_text
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskframe.operators import binning, chaid, glm, metrics, woe
from riskframe.operators import columns as cols
from riskframe.operators import profile as prof
from riskframe.operators.collinearity import vif
from riskframe.operators.dedupe import distinct_rows, duplicate_report, keep_first
from riskframe.operators.design import design_terms
from riskframe.operators.joins import new_rows
from riskframe.operators.ranking import exact_quantiles, running_totals
from riskframe.operators.split import exact_split, simulate_batch
from riskframe.plans import cleaning as plan
from riskframe.plans import crash_schema as cs
from riskframe.session import durable
from riskframe.spec import FeatureSpec
from riskframe.workload.registry import feed, planted, scored, table

c = F.col


# --- spec ----------------------------------------------------------------------------


def test_spec_checks_roles():
    spec = FeatureSpec(target="y", numeric=["a"], levels={"b": ["x", "z"]}, key="k")
    assert spec.predictors == ("a", "b") and spec.reference("b") == "x"
    assert spec.relevel("b", "z").levels["b"] == ("z", "x")
    assert spec.without("a", "nothing").predictors == ("b",)
    with pytest.raises(ValueError):
        FeatureSpec(target="y", numeric=["a", "y"])
    with pytest.raises(ValueError):
        FeatureSpec(target="y", levels={"b": ["x", "x"]})
    with pytest.raises(ValueError):
        spec.relevel("b", "q")


# --- de-duplication ------------------------------------------------------------------


def test_duplicate_report_and_null_positions(spark):
    rows = spark.createDataFrame([("x", None), (None, "x"), ("x", None)], "a string, b string")
    assert tuple(duplicate_report(rows).first()) == (3, 1, 2)
    assert tuple(duplicate_report(rows, null_safe=False).first()) == (3, 2, 1)
    assert distinct_rows(rows).count() == 2


def test_fold_case(spark):
    rows = spark.createDataFrame([("Abc ",), ("aBC",), ("b",), (None,)], "a string")
    assert distinct_rows(rows, fold_case=True).count() == 3
    assert distinct_rows(rows).count() == 4


def test_report_predicts_removal(spark):
    raw = feed(spark, SF001)
    report = duplicate_report(plan.clean_number(raw)).first()
    assert report.total == raw.count()
    assert report.remaining == plan.distinct_records(raw).count()
    assert report.total == report.duplicated + report.remaining


def test_keep_first_is_stable(spark):
    rows = [(k, v, w) for k in range(3) for v, w in ((None, 2), (1, 1), (1, 0))]
    random.Random(1).shuffle(rows)
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "k int, v int, w int").repartition(parts)
        assert sorted(map(tuple, keep_first(df, ["k"], ["v"]).collect())) == [
            (k, None, 2) for k in range(3)
        ]


def test_one_shuffle_feature_table_equals_two_step_form(spark):
    raw = feed(spark, SF001)
    staged = plan.cleaned_table(raw).select(*cs.FEATURE_COLUMNS)
    keys = [x for x in cs.FEATURE_COLUMNS if x not in cs.UNTRUSTED]
    two_steps = keep_first(staged, keys, cs.UNTRUSTED)
    one_step = plan.feature_table(raw)
    assert one_step.exceptAll(two_steps).count() == 0
    assert two_steps.exceptAll(one_step).count() == 0
    # Exact copies merge map-side in a hash aggregate, then rows meet by their keys.
    assert plan_text(one_step).count("Exchange") == 2


def test_victim_counts_dominate_wording(spark):
    cleaned = plan.cleaned_table(feed(spark, SF001))
    assert cleaned.where((c("Vitimas") == "1") & (c("TipoDeOcorrenciaPadrao") != cs.WITH_VICTIM)).count() == 0


def test_model_table_keeps_key_and_is_complete(spark):
    model = plan.model_table(_saved(spark))
    assert model.columns == list(cs.MODEL_COLUMNS)
    assert prof.null_report(model.drop("Chave")).agg(F.sum("n_null")).first()[0] == 0


def _saved(spark):
    from riskframe.session import durable

    return durable(plan.feature_table(feed(spark, SF001)))


# --- ranking -------------------------------------------------------------------------


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_running_totals_equal_brute_force(spark, descending, ranges):
    rng = random.Random(3)
    values = [rng.choice([0.5, 0.5, 0.5, rng.random(), None]) for _ in range(2000)]
    df = spark.createDataFrame([(v, rng.randint(0, 1)) for v in values], "v double, y int").repartition(6)
    got = running_totals(df, "v", {"n": "count(*)", "n1": "sum(y)"}, descending, ranges)
    rows = {r.v: (r.n, r.n_run, r.n1_run, r.n_all) for r in got.collect()}
    data = [(r.v, r.y) for r in df.collect() if r.v is not None]
    assert len(rows) == len({v for v, _ in data})
    for v, (n, n_run, n1_run, n_all) in rows.items():
        upto = [y for x, y in data if (x >= v if descending else x <= v)]
        assert (n_run, n1_run, n_all) == (len(upto), sum(upto), len(data))
        assert n == sum(x == v for x, _ in data)


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_exact_quantiles_equal_numpy(spark, limit):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=5000), 6)
    x[:1700] = 0.25  # one value holds a third of the rows
    df = spark.createDataFrame([(float(v), float(i % 3)) for i, v in enumerate(x)], "x double, k double")
    df = df.unionByName(spark.createDataFrame([(None, None)], "x double, k double"))
    probs = [0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1]
    got = exact_quantiles(df, ["x", "k"], probs, gather_rows=limit)
    np.testing.assert_allclose(got["x"], np.quantile(x, probs), rtol=0, atol=1e-12)
    np.testing.assert_allclose(got["k"], np.quantile(np.arange(5000) % 3, probs), atol=1e-12)


def test_narrowing_survives_heavy_values(spark):
    # Two heavy neighbours with the median between them, and a long thin tail.
    values = [1.0] * 3000 + [2.0] * 3000 + [2 + i / 1000 for i in range(1, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    probs = [0, 0.1, 2999.5 / 6998, 0.5, 0.9, 0.9999, 1]
    got = exact_quantiles(df, ["x"], probs, gather_rows=20)["x"]
    np.testing.assert_allclose(got, np.quantile(values, probs), atol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


# --- binning -------------------------------------------------------------------------


def test_cut_edges(spark):
    values = [0.0, 25.0, 25.01, 600.0, 600.1, -1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = df.select("i", binning.cut(c("v"), cs.KM_BREAKS).alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == ["[0,25]", "[0,25]", "(25,50]", "(500,600]", None, None, None]
    open_low = df.select("i", binning.cut(c("v"), [0, 25], include_lowest=False).alias("b")).orderBy("i")
    assert [r.b for r in open_low.collect()][:2] == [None, "(0,25]"]
    assert len(cs.KM_LEVELS) == 14 and len(binning.break_labels(cs.KM_BREAKS_FIRST)) == 12
    with pytest.raises(ValueError):
        binning.cut(c("v"), [1, 1])


def test_labels_gain_digits_until_distinct():
    assert binning.break_labels([1000.1, 1000.2])[0] == "[1000.1,1000.2]"
    assert binning.break_labels([1, 12345])[0] == "[1,1.23e+04]"


def test_quantile_cut_drops_repeated_breaks(spark):
    df = spark.createDataFrame([(float(v),) for v in [0] * 8 + [1, 2]], "v double")
    assert binning.quantile_breaks(df, ["v"])["v"] == [0.0, 2.0]
    constant = spark.createDataFrame([(1.0,)] * 4, "v double")
    assert binning.quantile_cut(constant, "v").select("v_cat").distinct().collect()[0][0] is None


def test_optimal_bin_finds_planted_cuts(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(6000):
        x = rng.randint(0, 99)
        rate = 0.05 if x <= 30 else 0.3 if x <= 70 else 0.6
        rows.append((float(x), int(rng.random() < rate)))
    df = spark.createDataFrame(rows, "x double, y int")
    assert binning.optimal_bin(df, "x", "y", alpha=1e-6).cuts == (30.0, 70.0)
    flat = df.withColumn("y", F.lit(0))
    assert binning.optimal_bin(flat, "x", "y").cuts == ()
    bins = binning.optimal_bin(df, "x", "y", min_share=0.2)
    sizes = binning.apply_bins(df, bins, "b").groupBy("b").count().collect()
    assert min(r["count"] for r in sizes) >= 0.2 * 6000


# --- evidence ------------------------------------------------------------------------


def test_empty_cell_contributes_nothing(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] * 7 + [("b", 0)] * 10 + [(None, 1)] * 2 + [(None, 0)] * 8
    df = spark.createDataFrame(rows, "v string, y int")
    bins = {r.bin: r for r in woe.woe_table(df, "y", ["v"]).collect()}
    assert bins["b"].woe == 0 and bins["b"].iv == 0 and bins["b"].empty_cell == 1
    assert bins["a"].woe == pytest.approx(math.log((3 / 5) / (7 / 25)))
    assert bins["NA"].n == 10
    smooth = {r.bin: r for r in woe.woe_table(df, "y", ["v"], smoothing=0.5).collect()}
    assert smooth["b"].woe < 0 and smooth["b"].empty_cell == 0


def test_selection_rules(spark):
    iv = spark.createDataFrame(
        [
            ("Moto", 0.25), ("Moto_bin", 0.25), ("Ilesos_bin", 0.12), ("Km_cat", 0.05),
            ("KmDecimal", 0.03), ("Caminhao", 2.4), ("Onibus_Caminhao_Bin", 2.3), ("Outros", 0.24),
        ],
        "variable string, iv double",
    )
    roles = {v: "binary" if v.lower().endswith("_bin") else "numeric" for v, in iv.select("variable").collect()}
    picked = woe.select_features(iv, roles, leakage=["Ilesos_bin"], keep=["Km_cat", "Caminhao"])
    assert {r.variable: r.rule for r in picked.collect()} == {
        "Moto": "kept", "Moto_bin": "duplicate", "Ilesos_bin": "leakage", "Km_cat": "business",
        "KmDecimal": "weak", "Caminhao": "business", "Onibus_Caminhao_Bin": "suspicious",
        "Outros": "kept",
    }


def test_information_classes_tell_duplicates_from_coincidence(spark):
    rows = spark.createDataFrame(
        [(i % 2, i % 4 // 2, "no yes".split()[i % 4 // 2], i % 4 // 2 if i % 8 < 4 else 1 - i % 4 // 2, None if i % 5 else i % 3)
         for i in range(80)],
        "y int, count int, flag string, other int, gaps int",
    )
    names = ("flag", "other", "gaps")
    classes = woe.information_classes(rows, "y", names, ("count",), breaks={"count": [-1, 0.5, 2]})
    assert classes == {"count": "count", "flag": "count", "other": "other", "gaps": "gaps"}
    iv = woe.iv_summary(woe.woe_table(rows, "y", names, ("count",), breaks={"count": [-1, 0.5, 2]}))
    picked = woe.select_features(iv, {"count": "numeric", "flag": "binary"}, weak=0, classes=classes)
    assert {r.variable: r.rule == "duplicate" for r in picked.collect()} == {
        "count": False, "flag": True, "other": False, "gaps": False}


def test_drop_report_shows_informative_loss(spark):
    rows = spark.createDataFrame([(None, 1)] * 5 + [(1, 0)] * 10 + [(1, 1)], "x int, y int")
    report = {r.part: (r.n, r.events, round(r.rate, 3)) for r in cols.drop_report(rows, ["x"], "y").collect()}
    assert report == {"dropped": (5, 5, 1.0), "kept": (11, 1, 0.091)}


# --- splits --------------------------------------------------------------------------


def test_split_is_exact_disjoint_and_repeatable(spark):
    orders = table(spark, SF001, "orders").select("o_orderkey", "o_custkey")
    n = orders.count()
    train, test = exact_split(orders, "o_orderkey", 0.8)
    assert train.count() == math.floor(0.8 * n) and test.count() == n - math.floor(0.8 * n)
    assert train.join(test, "o_orderkey").count() == 0
    again, _ = exact_split(orders.repartition(7), "o_orderkey", 0.8)
    assert train.exceptAll(again).count() == 0
    other, _ = exact_split(orders, "o_orderkey", 0.8, seed=43)
    assert train.exceptAll(other).count() > 0


@pytest.mark.parametrize("frac", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_split_of_repeated_rows(spark, frac):
    # One key holds most rows, half of them equal in every column.
    rows = [("hot", 0)] * 300 + [("hot", i) for i in range(300)] + [(str(i), i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    train, test = exact_split(df, "k", frac)
    assert train.count() == math.floor(frac * 700)
    assert train.unionAll(test).exceptAll(df).count() == 0
    assert df.exceptAll(train.unionAll(test)).count() == 0


def test_split_plan_moves_no_rows(spark):
    train, test = exact_split(table(spark, SF001, "orders"), "o_orderkey", 0.8)
    assert "Exchange" not in plan_text(train) + plan_text(test)


def test_simulated_batch(spark):
    orders = table(spark, SF001, "orders")
    batch = simulate_batch(orders, "o_orderkey", seed=11)
    assert 150 <= batch.count() <= 200 and batch.distinct().count() == batch.count()
    assert "TakeOrderedAndProject" in plan_text(batch)


# --- anti-join -----------------------------------------------------------------------


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_new_rows(spark, limit):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3)], "k string, v int")
    live = spark.createDataFrame([("a",), (None,), ("z",)] * 3, "k string")
    fresh = new_rows(batch, live, "k", broadcast_bytes=limit)
    assert sorted(map(tuple, fresh.collect())) == [("b", 2), ("b", 2)]
    single = new_rows(batch, live, "k", dedupe_batch=True, broadcast_bytes=limit)
    assert list(map(tuple, single.collect())) == [("b", 2)]


def test_small_batch_never_shuffles_live_rows(spark):
    batch = table(spark, SF001, "customer").select(c("c_custkey").alias("k"))
    live = table(spark, SF001, "events").select(c("user_id").alias("k"))
    text = plan_text(new_rows(batch, live, "k"))
    scan = text[: text.index("events.parquet")].rsplit("Exchange hashpartitioning", 1)[1]
    assert "BroadcastHashJoin" in scan  # reduced to the batch's keys before any exchange


# --- discrimination ------------------------------------------------------------------


def test_auc_equals_evaluator_and_youden_equals_ks(spark):
    rows = scored(spark, SF001)
    ours = metrics.auc(rows, "y", "p").first().auc
    library = BinaryClassificationEvaluator(
        rawPredictionCol="p", labelCol="y", metricName="areaUnderROC", numBins=0
    ).evaluate(rows.withColumn("p", c("p").cast("double")))
    assert ours == pytest.approx(library, abs=1e-9)
    best = metrics.best_cutoff(rows, "y", "p", "youden").first()
    points = metrics.roc_points(rows, "y", "p")
    signed = points.agg(F.max(c("sensitivity") + c("specificity") - 1)).first()[0]
    assert best.value == pytest.approx(signed)
    both = metrics.discrimination(rows, "y", "p").first()
    assert both.ks >= best.value - 1e-12 and both.auc == ours and both.n == rows.count()


def test_flipped_score(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1), (0.9, 0), (0.8, 0)], "p double, y int")
    assert metrics.auc(df, "y", "p").first().auc == 0.0
    assert metrics.auc(df, "y", "p", auto_direction=True).first().auc == 1.0
    assert metrics.ks(df, "y", "p").first().ks == 1.0


def test_rare_events_get_infinite_accuracy_cutoff(spark):
    df = spark.createDataFrame([(0.9, 0)] * 5 + [(0.8, 1)] + [(0.1, 0)] * 94, "p double, y int")
    best = metrics.best_cutoff(df, "y", "p", "accuracy").first()
    assert best.cutoff == math.inf and best.sensitivity == 0 and best.specificity == 1


def test_evaluate_counts_every_row(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (0.7, 0), (None, 1), (0.2, 1)], "p double, y int")
    row = metrics.evaluate(df, "y", "p", 0.5, "s").first()
    assert (row.tp, row.fp, row.fn, row.tn, row.unscored) == (1, 1, 1, 1, 1)
    assert row.accuracy == 0.5


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0.9, 0), (0.1, 0)], "p double, y int")
    row = metrics.evaluate(df, "y", "p", 0.5, "s").first()
    assert row.auc is None and row.ks is None and row.sensitivity is None and row.specificity == 0.5


# --- models --------------------------------------------------------------------------


def test_logit_score_equations(spark):
    rows = planted(spark, SF001)
    spec = FeatureSpec(
        target="y",
        numeric=("l_quantity", "l_linenumber"),
        levels={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")},
    )
    fits = [glm.fit_logit(rows, spec, collapse=flag) for flag in (True, False)]
    np.testing.assert_allclose(fits[0].coefficients, fits[1].coefficients, atol=1e-6)
    np.testing.assert_allclose(fits[0].std_errors, fits[1].std_errors, rtol=1e-4)
    assert fits[0].aic == pytest.approx(fits[1].aic, rel=1e-9)
    assert fits[0].converged and fits[0].rows == rows.count()
    residual = c("y") - fits[0].scoring_expr()
    terms = [F.sum(residual * t).alias(n) for n, t in design_terms(spec)]
    for value in rows.agg(F.sum(residual), *terms).first():
        assert abs(value) < 1e-2
    p = fits[0].scoring_expr()
    loglik = F.sum(c("y") * F.ln(p) + (1 - c("y")) * F.ln(1 - p))
    assert fits[0].aic == pytest.approx(-2 * rows.agg(loglik).first()[0] + 2 * 6, rel=1e-9)
    assert fits[0].equation().startswith("logit(p) = ")


def test_missing_or_undeclared_predictor_is_unscored(spark):
    fit = glm.fit_logit(planted(spark, SF001), FeatureSpec(target="y", levels={"l_returnflag": ("A", "N", "R")}))
    rows = spark.createDataFrame([("A",), (None,), ("?",)], "l_returnflag string")
    assert [r.probability is None for r in fit.score(rows).collect()] == [False, True, True]


def test_vif_of_grouped_terms(spark):
    rows = table(spark, SF001, "lineitem").withColumn("constant", F.lit(1.0))
    spec = FeatureSpec(
        target="y",
        numeric=("l_quantity", "l_extendedprice", "constant"),
        levels={"l_returnflag": ("A", "N", "R")},
    )
    report = {r.term: r for r in vif(rows, spec).collect()}
    r = rows.stat.corr("l_quantity", "l_extendedprice")
    assert report["l_quantity"].vif == pytest.approx(1 / (1 - r * r), rel=0.02)
    assert report["l_quantity"].gvif == pytest.approx(report["l_quantity"].vif)
    assert report["constant"].vif is None
    assert report["l_returnflagN"].df == 2
    assert report["l_returnflagN"].gvif_root == pytest.approx(1, abs=0.05)


def test_the_tree_is_the_same_with_and_without_tasks(spark, monkeypatch):
    rng = random.Random(23)
    rows = [(int(rng.random() < 0.05 + 0.1 * (a % 3) + 0.2 * (b > 4)), f"a{a}", f"b{b}") for a, b in
            ((rng.randrange(9), rng.randrange(8)) for _ in range(4000))]
    df = spark.createDataFrame(rows, "y int, a string, b string")
    found = []
    for few in (2000, 0):
        monkeypatch.setattr(chaid, "FEW_CELLS", few)
        tree = chaid.fit_chaid(df, "y", ("a", "b"))
        found.append([(n.rule, n.n, n.n1, n.split_on, n.log_p) for n in tree.nodes()])
    assert found[0] == found[1] and len(found[0]) > 4


def test_quantiles_sort_ranges_not_columns(spark, monkeypatch):
    from riskframe.operators import ranking

    made = []
    totals = ranking.totals_of_cells
    monkeypatch.setattr(ranking, "totals_of_cells", lambda *a, **k: made.append(totals(*a, **k)) or made[-1])
    rows = spark.range(20_000).selectExpr("cast(id as double) a", "cast((id * 7919) % 20011 as double) b")
    got = exact_quantiles(rows, ["a", "b"], [0, 0.25, 0.5, 1])
    assert got["a"] == [0, 4999.75, 9999.5, 19999]
    values = sorted((i * 7919) % 20011 for i in range(20_000))
    assert got["b"][2] == (values[9999] + values[10000]) / 2
    text = plan_text(made[0])
    assert "Scan" in text and "windowspecdefinition(variable" in text and "_range" in text.split("windowspecdefinition(variable")[1]


def test_vif_of_a_fitted_model_equals_dense_algebra(spark):
    rng = np.random.default_rng(4)
    n = 3000
    a, g = rng.normal(size=n), rng.integers(0, 3, n)
    b = 0.7 * a + 0.5 * g + rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(1 - a - 0.3 * b + g))).astype(int)
    rows = spark.createDataFrame(
        [(int(y[i]), float(a[i]), float(b[i]), "uvw"[g[i]], 2.0) for i in range(n)] + [(1, None, 0.0, "u", 2.0)],
        "y int, a double, b double, g string, same double",
    )
    spec = FeatureSpec(target="y", numeric=("a", "b"), levels={"g": ("u", "v", "w")})
    fit = glm.fit_logit(rows.dropna(), spec, collapse=False)
    x = np.column_stack([np.ones(n), a, b, g == 1, g == 2]).astype(float)
    p = 1 / (1 + np.exp(-x @ np.array(fit.coefficients)))
    cov = np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None]))
    error = np.sqrt(np.diag(cov))
    corr = (cov / np.outer(error, error))[1:, 1:]
    report = {r.term: r for r in vif(rows, spec, fit).collect()}
    assert [report[t].std_error for t in ("a", "b", "gv", "gw")] == pytest.approx(error[1:].tolist())
    assert report["a"].std_error == pytest.approx(fit.std_errors[1], rel=1e-4)
    det = np.linalg.det
    assert report["gv"].gvif == pytest.approx(det(corr[2:, 2:]) * det(corr[:2, :2]) / det(corr))
    assert report["a"].gvif == report["a"].vif == pytest.approx(np.linalg.inv(corr)[0, 0])


def test_direction_follows_the_medians(spark):
    rows = spark.createDataFrame([(1, s) for s in (1.0, 2.0, 9.0)] + [(0, s) for s in (1.5, 3.0, 4.0, 0.5)], "y int, p double")
    plain = metrics.auc(rows, "y", "p").first().auc
    assert plain == pytest.approx(7 / 12)
    assert metrics.auc(rows, "y", "p", auto_direction=True).first().auc == pytest.approx(1 - 7 / 12 if 2.0 < 2.25 else 7 / 12)
    assert metrics.auc(rows, "y", "p", auto_direction="half").first().auc == pytest.approx(7 / 12)


def test_chaid_recovers_planted_groups(spark):
    rng = random.Random(17)
    rates = {"a": 0.02, "b": 0.02, "c": 0.2}
    rows = []
    for _ in range(9000):
        g = rng.choice("abc")
        rows.append((g, rng.choice("xyz"), int(rng.random() < rates[g])))
    df = spark.createDataFrame(rows, "g string, noise string, y int")
    tree = chaid.fit_chaid(df, "y", ["g", "noise"], alpha_split=0.001)
    assert [leaf.rule for leaf in tree.leaves()] == [(("g", ("a", "b")),), (("g", ("c",)),)]
    placed = chaid.tree_score(chaid.assign_node(df, tree), tree)
    for r in placed.groupBy("node").agg(F.avg("y").alias("m"), F.first("P_1").alias("p")).collect():
        assert r.p == pytest.approx(r.m)
    unseen = spark.createDataFrame([("q", "x")], "g string, noise string")
    assert chaid.assign_node(unseen, tree).first().node is None
    assert chaid.tree_score(unseen, tree).first().P_1 is None
    rules = chaid.tree_rules(spark, tree).collect()
    assert sum(r.n for r in rules if r.leaf) == 9000 and rules[0].rule == "all"


def test_chaid_limits(spark):
    df = planted(spark, SF001)
    stump = chaid.fit_chaid(df, "y", ["l_returnflag"], max_height=0)
    assert len(stump.nodes()) == 1
    wide = chaid.fit_chaid(df, "y", ["l_returnflag"], min_prob=0.6)
    assert len(wide.nodes()) == 1


@pytest.mark.parametrize(
    "x,df,p",
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (6.634897, 1, 0.01)],
)
def test_chi_square_tail(x, df, p):
    assert math.exp(chaid.log_chi2_tail(x, df)) == pytest.approx(p, rel=1e-5)


def test_chi_square_tail_stays_finite():
    small, large = chaid.log_chi2_tail(1240, 1), chaid.log_chi2_tail(1260, 1)
    assert -634 < large < small < -623
    assert chaid.log_chi2_tail(1e6, 5) > -1e6


def test_group_counting():
    assert math.exp(chaid._log_ways(4, 2)) == pytest.approx(7)
    assert math.exp(chaid._log_ways(5, 3)) == pytest.approx(25)


# --- plans at scale ------------------------------------------------------------------


def test_road_filter_and_columns_reach_the_scan(spark):
    from riskframe.session import scratch_path

    path = scratch_path(spark, "raw")
    feed(spark, SF001).write.parquet(path)
    raw = spark.read.parquet(path)
    text = plan_text(plan.feature_table(raw))
    assert "In(Trecho" in text
    assert "Tracao_animal" not in text.split("ReadSchema")[-1]
    assert "In(Trecho" in plan_text(plan.cleaned_table(raw))


def test_crosstab_cells_add_up_to_the_rows(spark):
    rows = spark.createDataFrame(
        [("a", "x"), ("a", "other"), ("a", "NA"), ("b", "y"), ("b", "z"), ("b", None), (None, "x")], "r string, k string"
    )
    for listed, nulls in ((None, False), (None, True), (["x"], False), (["other", "q"], True), ([], True)):
        table = prof.crosstab(rows, "r", "k", listed, nulls=nulls).collect()
        n = 7 if nulls else 5
        assert sum(sum(v for v in r[1:]) for r in table) == n
        shares = prof.crosstab(rows, "r", "k", listed, pct="row", nulls=nulls).collect()
        assert all(abs(sum(r[1:]) - 100) < 1e-9 for r in shares)
    assert prof.crosstab(rows, "r", "k").columns == ["r", "k_NA", "k_other", "k_x", "k_y", "k_z"]
    assert "k_other_" in prof.crosstab(rows, "r", "k", ["other"]).columns
    assert prof.crosstab(rows.limit(0), "r", "k").count() == 0


def test_a_comparison_scans_its_source_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(metrics, "durable", lambda df: kept.append(plan_text(df)) or durable(df))
    rows = scored(spark, SF001)
    samples = [metrics.Sample(f"{s}{k}", "p", 0.5, where=c("l_linestatus") == s) for s in "FO" for k in range(2)]
    got = metrics.evaluate_all(rows, "y", samples)
    assert len(kept) == 1 and kept[0].count("Scan parquet") == 1
    text = plan_text(got)
    assert "Scan parquet" not in text and text.count("SinglePartition") == 0
    assert {r["sample"] for r in got.collect()} == {"F0", "F1", "O0", "O1"}


def test_no_cartesian_products(spark):
    rows = scored(spark, SF01)
    frames = [
        metrics.score_curve(rows, "y", "p"),
        metrics.evaluate(rows, "y", "p", 0.5, "s"),
        woe.woe_table(rows, "y", ["l_returnflag"]),
        prof.freq_pct(rows, "l_returnflag"),
        prof.profile(rows, ["l_quantity", "l_returnflag"]),
    ]
    for df in frames:
        text = plan_text(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_curve_windows_run_inside_ranges(spark):
    # The only window without a partition sees one row per value range.
    text = plan_text(metrics.score_curve(scored(spark, SF001), "y", "p"))
    assert "Window" in text and text.count("SinglePartition") <= 1


def test_hot_group_is_collapsed_before_the_shuffle(spark):
    hot = spark.range(200_000).select(
        F.when(c("id") % 3 == 0, c("id")).otherwise(-1).alias("k"), F.lit("x").alias("v")
    )
    for df in (distinct_rows(hot), keep_first(hot, ["k"], ["v"])):
        text = plan_text(df)
        assert text.index("Aggregate(") < text.index("Exchange") < text.rindex("Aggregate(")
        assert df.count() == hot.select("k").distinct().count()


def test_merging_a_thousand_categories_is_quick_and_right():
    import time

    levels = [f"c{i:04d}" for i in range(1000)]
    n = [200] * 1000
    n1 = [4 if i % 3 else 60 for i in range(1000)]
    started = time.perf_counter()
    groups, log_p = chaid.merge_categories(levels, n, n1, 0.05)
    assert time.perf_counter() - started < 20
    assert [len(g[0]) for g in groups] == [334, 666] and log_p < -1000


def test_merging_equals_all_pairs_recomputed():
    import random

    rng = random.Random(5)
    for _ in range(40):
        k = rng.randint(2, 9)
        levels = [f"l{i}" for i in range(k)]
        n = [rng.randint(20, 300) for _ in levels]
        n1 = [rng.randint(0, x) for x in n]
        groups = [((v,), a, b) for v, a, b in zip(levels, n, n1)]
        while len(groups) > 1:
            pairs = [
                (chaid.log_chi2_tail(chaid.pearson([groups[a], groups[b]]), 1), -a, -b)
                for a in range(len(groups))
                for b in range(a + 1, len(groups))
            ]
            log_p, a, b = max(pairs)
            if log_p <= math.log(0.05):
                break
            a, b = -a, -b
            joined = tuple(x + y for x, y in zip(groups[a], groups[b]))
            joined = (tuple(sorted(joined[0])), *joined[1:])
            groups = sorted([g for i, g in enumerate(groups) if i not in (a, b)] + [joined])
        assert chaid.merge_categories(levels, n, n1, 0.05)[0] == groups


def test_equal_rates_merge_first_and_change_nothing(monkeypatch):
    import time

    def categories(seed, count):
        rng = np.random.default_rng(seed)
        n = rng.integers(1, 40, count)
        return [f"c{i:06d}" for i in range(count)], n, rng.binomial(n, rng.choice([0.1, 0.3, 0.8], count))

    for seed in range(4):
        drawn = categories(seed, 400)
        quick = chaid.merge_categories(*drawn, 0.05)
        with monkeypatch.context() as plain:
            plain.setattr(chaid, "_same_rates", lambda v, n, n1, alpha: (n.astype(float), n1.astype(float), [[x] for x in v]))
            assert chaid.merge_categories(*drawn, 0.05) == quick
    started = time.perf_counter()
    groups, _ = chaid.merge_categories(*categories(9, 100_000), 0.05)
    assert time.perf_counter() - started < 120
    assert 1 < len(groups) < 200 and sum(len(g[0]) for g in groups) == 100_000


def test_quantiles_between_infinities(spark):
    rows = spark.createDataFrame([(1.0,), (math.inf,), (math.inf,)], "x double")
    assert exact_quantiles(rows, ["x"], [0.5, 0.75, 1])["x"] == [math.inf] * 3


def test_feature_dedupe_hashes_before_it_sorts(spark):
    rows = spark.range(100).selectExpr("id % 7 AS k", "cast(id % 3 AS string) AS t", "id AS v")
    plan = plan_text(keep_first(rows, ["k"], ["t", "v"]))
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest
    # Groups are dealt and ordered by one fixed-width number first.
    assert sum("Exchange hashpartitioning(_hash" in line for line in plan.splitlines()) == 1
    assert "Sort [_hash" in plan
