"""Counts, frequencies, profiles, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import flags, text
from riskframe.operators import columns as cols
from riskframe.operators import profile as prof
from riskframe.plans import crash_schema as cs
from riskframe.workload import sqltext as sq
from riskframe.workload.registry import feed, query, rounded, scored, table

c = F.col


@query(
    "agg1_row_counts",
    f"WITH {sq.FEED} SELECT count(*) AS n_rows, count(Km) AS n_values FROM feed",
)
def agg1(spark, sf_dir):
    return prof.row_counts(feed(spark, sf_dir), "Km")


@query(
    "agg2_distinct_ratio",
    f"""WITH {sq.FEED} SELECT count(*) AS n_rows,
    count(DISTINCT No_DaOcorrencia) AS n_distinct FROM feed""",
)
def agg2(spark, sf_dir):
    return prof.distinct_ratio(feed(spark, sf_dir), "No_DaOcorrencia")


@query(
    "agg4_rollup",
    f"""WITH {sq.FEED} SELECT CASE WHEN grouping(Km) = 1 THEN 'Total Geral'
      WHEN Km IS NULL THEN 'Valor Nulo' ELSE Km END AS label, count(*) AS n,
      CAST(grouping(Km) AS INT) AS is_total FROM feed GROUP BY ROLLUP (Km)""",
)
def agg4(spark, sf_dir):
    return prof.rollup_counts(feed(spark, sf_dir), "Km")


@query(
    "agg5_rollup_merged",
    f"""WITH {sq.FEED} SELECT coalesce(Sentido, 'Total') AS label, count(Sentido) AS n
    FROM feed GROUP BY ROLLUP (Sentido)""",
)
def agg5(spark, sf_dir):
    return prof.rollup_counts_merged(feed(spark, sf_dir), "Sentido")


@query(
    "agg6_value_profile",
    f"""WITH {sq.FEED} SELECT Concessionaria, Km,
    CAST(length(rtrim(Km, ' ')) AS DOUBLE) AS size, count(*) AS n
    FROM feed GROUP BY Concessionaria, Km, length(rtrim(Km, ' '))""",
)
def agg6(spark, sf_dir):
    return prof.value_profile(feed(spark, sf_dir), ["Concessionaria", "Km"]).withColumn(
        "size", c("size").cast("double")
    )


@query(
    "agg7_counts_by",
    f"""WITH {sq.FEED} SELECT Sentido, {sq.DIRECTION} AS SentidoPadrao, count(*) AS n
    FROM feed GROUP BY 1, 2""",
)
def agg7(spark, sf_dir):
    directed = feed(spark, sf_dir).withColumn(
        "SentidoPadrao", flags.classify_contains(c("Sentido"), list(cs.DIRECTIONS))
    )
    return prof.counts_by(directed, "Sentido", "SentidoPadrao")


@query(
    "agg8_date_range",
    """SELECT CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS lowest,
    CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS highest FROM orders""",
)
def agg8(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(c("o_orderdate").cast("date").alias("d"))
    return prof.date_range(dated, "d").select(
        c("lowest").cast("string").alias("lowest"), c("highest").cast("string").alias("highest")
    )


def _null_cell(n):
    return (
        f"SELECT '{n}' AS variable, count(*) FILTER ({n} IS NULL) AS n_null, "
        f"count(*) FILTER ({n} = '') AS n_blank, count(*) AS n_rows FROM feed"
    )


@query(
    "agg9_null_report",
    f"WITH {sq.FEED} " + " UNION ALL ".join(_null_cell(n) for n in cs.RAW_COLUMNS),
)
def agg9(spark, sf_dir):
    return prof.null_report(feed(spark, sf_dir))


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


def _summary_cell(n):
    return (
        f"SELECT '{n}' AS variable, CAST(min({n}) AS DOUBLE) AS min, "
        f"round(quantile_cont(CAST({n} AS DOUBLE), 0.25), 6) AS q1, "
        f"round(quantile_cont(CAST({n} AS DOUBLE), 0.5), 6) AS median, "
        f"round(avg({n}), 6) AS mean, round(quantile_cont(CAST({n} AS DOUBLE), 0.75), 6) AS q3, "
        f"CAST(max({n}) AS DOUBLE) AS max, count(*) FILTER ({n} IS NULL) AS n_null FROM lineitem"
    )


@query("agg10_summary", " UNION ALL ".join(_summary_cell(n) for n in _NUMBERS))
def agg10(spark, sf_dir):
    return rounded(prof.summary(table(spark, sf_dir, "lineitem"), _NUMBERS))


def _profile_cell(n, number):
    stats = (
        f"round(avg({n}), 4) AS mean, round(stddev_samp({n}), 4) AS sd, "
        + ", ".join(
            f"round(quantile_cont(CAST({n} AS DOUBLE), {p / 100}), 4) AS p{p}"
            for p in (0, 25, 50, 75, 100)
        )
        + ", CAST(NULL AS DOUBLE) AS min_length, CAST(NULL AS DOUBLE) AS max_length"
        if number
        else "NULL, NULL, NULL, NULL, NULL, NULL, NULL, "
        f"CAST(min(length({n})) AS DOUBLE), CAST(max(length({n})) AS DOUBLE)"
    )
    return (
        f"SELECT '{n}' AS variable, count(*) FILTER ({n} IS NULL) AS n_missing, "
        f"round(CAST(count({n}) AS DOUBLE) / count(*), 4) AS complete_rate, {stats}, "
        f"count(DISTINCT {n}) AS n_distinct FROM lineitem"
    )


_PROFILED = {"l_quantity": True, "l_extendedprice": True, "l_tax": True, "l_returnflag": False}


@query("agg11_profile", " UNION ALL ".join(_profile_cell(n, k) for n, k in _PROFILED.items()))
def agg11(spark, sf_dir):
    report = prof.profile(table(spark, sf_dir, "lineitem"), list(_PROFILED))
    return rounded(
        report.withColumns(
            {n: c(n).cast("double") for n in ("min_length", "max_length")}
        ),
        4,
    )


@query(
    "agg12_freq",
    f"""WITH {sq.FEED} SELECT Automovel, count(*) AS n FROM feed
    WHERE Automovel IS NOT NULL GROUP BY Automovel""",
)
def agg12(spark, sf_dir):
    return prof.freq(feed(spark, sf_dir), "Automovel")


@query(
    "agg13_freq_with_nulls",
    f"WITH {sq.FEED} SELECT Automovel, count(*) AS n FROM feed GROUP BY Automovel",
)
def agg13(spark, sf_dir):
    return prof.freq(feed(spark, sf_dir), "Automovel", nulls=True)


@query(
    "agg14_freq_pct",
    f"""WITH {sq.FEED} SELECT Trecho, count(*) AS n,
    round(100 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS pct
    FROM feed WHERE Trecho IS NOT NULL GROUP BY Trecho""",
)
def agg14(spark, sf_dir):
    return rounded(prof.freq_pct(feed(spark, sf_dir), "Trecho"))


@query(
    "agg14_freq_many",
    f"WITH {sq.FEED}, u AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS variable, {n} AS level FROM feed" for n in cs.VEHICLES)
    + """) SELECT variable, level, count(*) AS n,
    round(100 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY variable), 6) AS pct
    FROM u WHERE level IS NOT NULL GROUP BY variable, level""",
)
def agg14_many(spark, sf_dir):
    return rounded(prof.freq_many(feed(spark, sf_dir), cs.VEHICLES))


@query(
    "agg15_crosstab",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "l_linestatus_F",
    count(*) FILTER (l_linestatus = 'O') AS "l_linestatus_O" FROM lineitem GROUP BY l_returnflag""",
)
def agg15(spark, sf_dir):
    return prof.crosstab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query(
    "agg16_crosstab_row_pct",
    f"""WITH {sq.SCORED} SELECT l_returnflag,
    round(100 * CAST(count(*) FILTER (y = 0) AS DOUBLE) / count(*), 6) AS "y_0",
    round(100 * CAST(count(*) FILTER (y = 1) AS DOUBLE) / count(*), 6) AS "y_1"
    FROM scored GROUP BY l_returnflag""",
)
def agg16(spark, sf_dir):
    return rounded(prof.crosstab(scored(spark, sf_dir), "l_returnflag", "y", [0, 1], pct="row"))


@query(
    "agg15_crosstab_all_values",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "o_orderstatus_F",
    count(*) FILTER (o_orderstatus = 'O') AS "o_orderstatus_O", count(*) FILTER (o_orderstatus = 'P') AS "o_orderstatus_P"
    FROM orders GROUP BY o_orderpriority""",
)
def agg15_all(spark, sf_dir):
    """No values are listed: those that are there become the columns."""
    return prof.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


_CUSTOMERS = """WITH t AS (SELECT c_mktsegment, CASE WHEN c_custkey % 9 > 0 THEN c_nationkey END AS nation FROM customer)"""


def _customers(spark, sf_dir):
    nation = F.when(c("c_custkey") % 9 > 0, c("c_nationkey")).alias("nation")
    return table(spark, sf_dir, "customer").select("c_mktsegment", nation)


@query(
    "agg15_crosstab_listed",
    f"""{_CUSTOMERS} SELECT c_mktsegment, count(*) FILTER (nation = 3) AS "nation_3", count(*) FILTER (nation = 99) AS "nation_99",
    count(*) FILTER (nation <> 3) AS "nation_other", count(*) FILTER (nation IS NULL) AS "nation_NA" FROM t GROUP BY c_mktsegment""",
)
def agg15_listed(spark, sf_dir):
    """Fewer values are listed than there are, and one that is not there: all rows are in some cell."""
    return prof.crosstab(_customers(spark, sf_dir), "c_mktsegment", "nation", [3, 99], nulls=True)


@query(
    "agg16_crosstab_row_pct_most",
    f"""{_CUSTOMERS}, v AS (SELECT nation, row_number() OVER (ORDER BY count(*) DESC, nation) AS r FROM t WHERE nation IS NOT NULL GROUP BY 1),
    p AS (SELECT c_mktsegment, r, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM t JOIN v USING (nation))
    SELECT c_mktsegment, round(100.0 * count(*) FILTER (r <= 4) / any_value(n), 6) AS shown,
      round(100.0 * count(*) FILTER (r > 4) / any_value(n), 6) AS nation_other FROM p GROUP BY c_mktsegment""",
)
def agg16_most(spark, sf_dir):
    """The four most frequent of 25 values have columns; the row shares still add up to 100."""
    shares = prof.crosstab(_customers(spark, sf_dir), "c_mktsegment", "nation", pct="row", most=4)
    shown = [n for n in shares.columns if n not in ("c_mktsegment", "nation_other")]
    assert len(shown) == 4
    return rounded(shares.select("c_mktsegment", sum(c(n) for n in shown).alias("shown"), "nation_other"))


@query(
    "agg17_count_where",
    f"""WITH {sq.SCORED} SELECT count(*) FILTER (y = 1 AND p > 0.5) AS high_events,
    count(*) FILTER (l_returnflag = 'R') AS returned FROM scored""",
)
def agg17(spark, sf_dir):
    return prof.count_where(
        scored(spark, sf_dir),
        high_events=(c("y") == 1) & (c("p") > 0.5),
        returned=c("l_returnflag") == "R",
    )


@query(
    "agg18_conditional_freq",
    """SELECT l_linenumber, count(*) AS n FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_linenumber""",
)
def agg18(spark, sf_dir):
    inside = table(spark, sf_dir, "lineitem").where(
        (c("l_returnflag") == "R") & (c("l_linestatus") == "F")
    )
    return prof.freq(inside, "l_linenumber")


@query(
    "agg19_rate",
    f"""WITH {sq.SCORED} SELECT l_returnflag, count(y) AS n, round(avg(y), 6) AS rate
    FROM scored GROUP BY l_returnflag""",
)
def agg19(spark, sf_dir):
    return rounded(prof.rate(scored(spark, sf_dir), "y", ["l_returnflag"]))


# --- sorts and limits ----------------------------------------------------------------


@query(
    "srt1_order_by",
    f"""WITH {sq.FEED} SELECT Trecho, Concessionaria, count(*) AS n FROM feed
    GROUP BY Trecho, Concessionaria ORDER BY length(Trecho), n DESC""",
)
def srt1(spark, sf_dir):
    return prof.counts_by(feed(spark, sf_dir), "Trecho", "Concessionaria").orderBy(
        F.length("Trecho"), F.desc("n")
    )


@query(
    "srt2_nulls_last",
    f"""WITH {sq.FEED} SELECT Sentido, count(*) AS n FROM feed GROUP BY Sentido
    ORDER BY Sentido NULLS LAST""",
)
def srt2(spark, sf_dir):
    return prof.counts_by(feed(spark, sf_dir), "Sentido").orderBy(F.asc_nulls_last("Sentido"))


@query(
    "srt3_top_n",
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def srt3(spark, sf_dir):
    return prof.preview(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
        100,
        [F.desc("o_totalprice"), "o_orderkey"],
    )


@query(
    "srt4_latest_row",
    """SELECT CAST(o_orderdate AS VARCHAR)[1:10] AS day, o_orderkey, o_custkey FROM orders
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
)
def srt4(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return prof.latest(orders, "o_orderdate").select(
        c("o_orderdate").cast("date").cast("string").alias("day"), "o_orderkey", "o_custkey"
    )


@query(
    "srt5_head",
    "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 6",
)
def srt5(spark, sf_dir):
    return prof.preview(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 6, ["c_custkey"]
    )


@query("srt6_distinct", f"WITH {sq.FEED} SELECT DISTINCT Horario FROM feed")
def srt6(spark, sf_dir):
    return feed(spark, sf_dir).select("Horario").distinct()


# --- set operations ------------------------------------------------------------------


@query(
    "set1_bag_union",
    """SELECT c_custkey AS key, c_name AS name FROM customer
    UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def set1(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("key"), c("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        c("s_name").alias("name"), c("s_suppkey").alias("key")
    )
    return customers.unionByName(suppliers)


@query(
    "set3_new_levels",
    "SELECT DISTINCT c_custkey AS user_id FROM customer EXCEPT SELECT user_id FROM events",
)
def set3(spark, sf_dir):
    batch = table(spark, sf_dir, "customer").select(c("c_custkey").alias("user_id"))
    return cols.new_levels(batch, "user_id", table(spark, sf_dir, "events"))


@query(
    "enc1_declared_levels",
    f"""WITH {sq.FEED} SELECT CASE WHEN Trecho IN ({sq._ROAD_LIST}) THEN Trecho END AS road,
    count(*) AS n FROM feed GROUP BY 1""",
)
def enc1(spark, sf_dir):
    road = flags.with_levels(c("Trecho"), cs.ROADS).alias("road")
    return prof.counts_by(feed(spark, sf_dir).select(road), "road")


@query(
    "enc4_unlisted_levels",
    f"""WITH {sq.FEED} SELECT 'Trecho' AS variable, Trecho AS level, count(*) AS n FROM feed
    WHERE Trecho NOT IN ({sq._ROAD_LIST}) GROUP BY Trecho
    UNION ALL SELECT 'Sentido', Sentido, count(*) FROM feed
    WHERE Sentido NOT IN ('Norte', 'SUL') GROUP BY Sentido""",
)
def enc4(spark, sf_dir):
    from riskframe.spec import FeatureSpec

    spec = FeatureSpec(target="y", levels={"Trecho": cs.ROADS, "Sentido": ("Norte", "SUL")})
    return cols.unlisted_levels(feed(spark, sf_dir), spec)


@query(
    "flt10_scored_rows",
    f"""WITH {sq.FEED}, f AS (
      SELECT Trecho, CASE WHEN regexp_full_match(Moto, ' *[0-9]+ *')
        THEN CAST(trim(Moto) AS DOUBLE) END AS score,
        nullif({sq.any_flag("Gravemente_feridos", "Mortos")}, '') AS target FROM feed)
    SELECT * FROM f WHERE score IS NOT NULL AND target IS NOT NULL""",
)
def flt10(spark, sf_dir):
    from riskframe.functions.numbers import parse_double

    target = text.blank_to_null(flags.any_at_least_one(c("Gravemente_feridos"), c("Mortos")))
    rows = feed(spark, sf_dir).select(
        "Trecho", parse_double(c("Moto")).alias("score"), target.alias("target")
    )
    return cols.complete_cases(rows, ["score", "target"])


@query(
    "flt11_delete_where_present",
    f"WITH {sq.FEED} SELECT Trecho, Km, Sentido FROM feed WHERE Sentido IS NULL",
)
def flt11(spark, sf_dir):
    from riskframe.sources.writers import delete_where_present

    return delete_where_present(feed(spark, sf_dir).select("Trecho", "Km", "Sentido"), "Sentido")
