"""Counts, frequencies, cross-tabulations, rollups and column profiles.

Every report is one aggregate over the table; columns that share a report are
unpivoted rather than scanned one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from riskframe.functions.numbers import ratio
from riskframe.functions.text import visible_length
from riskframe.operators.columns import unpivot
from riskframe.operators.ranking import exact_quantiles
from riskframe.session import durable


def row_counts(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count(name).alias("n_values"))


def distinct_ratio(df: DataFrame, name: str) -> DataFrame:
    """Rows beside distinct non-null values."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(name).alias("n_distinct"))


def rollup_counts(
    df: DataFrame, name: str, total: str = "Total Geral", null: str = "Valor Nulo"
) -> DataFrame:
    """Rows per value plus a grand total, telling the total from a real null."""
    grouped = df.rollup(name).agg(F.count("*").alias("n"), F.grouping(name).alias("is_total"))
    label = F.when(F.col("is_total") == 1, total).otherwise(F.coalesce(F.col(name), F.lit(null)))
    return grouped.select(
        label.alias("label"), "n", F.col("is_total").cast("int").alias("is_total")
    ).orderBy("is_total", F.desc("n"), "label")


def rollup_counts_merged(df: DataFrame, name: str, total: str = "Total") -> DataFrame:
    """Rollup that shows nulls as another 'total' row and counts them as 0."""
    grouped = df.rollup(name).agg(F.count(name).alias("n"))
    return grouped.orderBy(F.asc_nulls_last(name), F.desc("n")).select(
        F.coalesce(F.col(name), F.lit(total)).alias("label"), "n"
    )


def value_profile(df: DataFrame, names, length_of: str | None = None) -> DataFrame:
    """Rows per value combination with the visible length of one column."""
    names = [names] if isinstance(names, str) else list(names)
    measured = visible_length(F.col(length_of or names[-1]).cast("string")).alias("size")
    return (
        df.groupBy(*names, measured).agg(F.count("*").alias("n")).orderBy("size", *names)
    )


def counts_by(df: DataFrame, *names: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count("*").alias("n"))


def date_range(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.min(name).alias("lowest"), F.max(name).alias("highest"))


def null_report(df: DataFrame, names=None) -> DataFrame:
    """Null and blank counts of each column, from one pass over the table."""
    fields = [f for f in df.schema.fields if names is None or f.name in names]
    cells = []
    for f in fields:
        c = F.col(f.name)
        blank = F.count_if(c == "") if isinstance(f.dataType, StringType) else F.lit(0)
        cells.append(
            F.struct(
                F.lit(f.name).alias("variable"),
                F.count_if(c.isNull()).alias("n_null"),
                blank.cast("long").alias("n_blank"),
                F.count("*").alias("n_rows"),
            )
        )
    return df.agg(F.array(*cells).alias("report")).select(F.inline("report"))


def freq(df: DataFrame, name: str, nulls: bool = False) -> DataFrame:
    """Rows per value; nulls hidden unless asked for."""
    rows = df if nulls else df.where(F.col(name).isNotNull())
    return counts_by(rows, name)


def freq_many(df: DataFrame, names, nulls: bool = False) -> DataFrame:
    """One-way frequencies and percentages of many columns from a single scan.

    Totals are a one-row-per-variable aggregate joined back, not a window, so a
    column with very many values is not gathered into one task.
    """
    long = unpivot(df, names)
    rows = long if nulls else long.where(F.col("level").isNotNull())
    cells = rows.groupBy("variable", "level").agg(F.count("*").alias("n"))
    totals = cells.groupBy("variable").agg(F.sum("n").alias("_total"))
    share = (ratio(F.col("n"), F.col("_total")) * 100).alias("pct")
    return cells.join(F.broadcast(totals), "variable").select("variable", "level", "n", share)


def freq_pct(df: DataFrame, name: str, nulls: bool = False) -> DataFrame:
    """Rows and percentage per value."""
    kind = df.schema[name].dataType
    return freq_many(df, [name], nulls).select(F.col("level").cast(kind).alias(name), "n", "pct")


def crosstab(
    df: DataFrame,
    a: str,
    b: str,
    columns=None,
    pct: str | None = None,
    nulls: bool = False,
    most: int = 200,
) -> DataFrame:
    """Two-way table: values of ``a`` as rows, values of ``b`` as columns named ``b_value``.

    Without ``columns`` every value of ``b`` has one, in order, up to ``most`` (the
    most frequent, ties to the smaller value); with them, these have. All
    other values are counted in ``b_other``, which is there only if there are any, so
    the cells of a row always add up to its rows. ``nulls`` makes missing
    values a row and a column (``b_NA``) of their own instead of leaving them out.
    ``pct='row'`` shows each cell as a percentage of its row.

    Rows collapse to one cell per pair in the only scan; the values are read
    off the cells, and no more than ``most`` of them reach the driver.
    """
    if pct not in (None, "row"):
        raise ValueError("pct must be None or 'row'")
    rows = df if nulls else df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = durable(rows.groupBy(F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").alias("_n")))
    values = cells.where(F.col("_b").isNotNull()).groupBy("_b").agg(F.sum("_n").alias("_n"))
    if columns is None:
        shown = sorted(r["_b"] for r in values.orderBy(F.desc("_n"), "_b").limit(most).collect())
    else:
        shown = list(columns)
    other = ~F.col("_b").isin(shown) if shown else F.lit(True)
    left = cells.agg(F.max(F.col("_b").isNull()).alias("null"), F.max(F.col("_b").isNotNull() & other).alias("other")).first()
    parts = {f"{b}_{v}": F.col("_b") == F.lit(v) for v in shown}
    for name, there, test in (
        (f"{b}_other", left["other"], F.col("_b").isNotNull() & other),
        (f"{b}_NA", left["null"], F.col("_b").isNull()),
    ):
        if there:
            while name in parts:  # a value of that name
                name += "_"
            parts[name] = test
    sums = {name: F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0)) for name, test in parts.items()}
    table = cells.groupBy("_a").agg(*[e.alias(name) for name, e in sums.items()], F.sum("_n").alias("_n"))
    shares = {name: (ratio(F.col(name), F.col("_n")) * 100).alias(name) if pct else F.col(name) for name in parts}
    return table.select(F.col("_a").alias(a), *shares.values())


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def rate(df: DataFrame, y: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count(y).alias("n"), F.avg(F.col(y).cast("double")).alias("rate")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def summary(df: DataFrame, names=None) -> DataFrame:
    """Minimum, quartiles, mean and maximum of numeric columns, one row each."""
    names = list(names or numeric_columns(df))
    quartiles = exact_quantiles(df, names, (0.25, 0.5, 0.75))
    cells = []
    for c in names:
        q1, median, q3 = quartiles[c]
        value = F.col(c).cast("double")
        cells.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.min(value).alias("min"),
                F.lit(q1).cast("double").alias("q1"),
                F.lit(median).cast("double").alias("median"),
                F.avg(value).alias("mean"),
                F.lit(q3).cast("double").alias("q3"),
                F.max(value).alias("max"),
                F.count_if(value.isNull()).alias("n_null"),
            )
        )
    return df.agg(F.array(*cells).alias("report")).select(F.inline("report"))


def profile(df: DataFrame, names=None) -> DataFrame:
    """Completeness, moments, quantiles and distinct counts, one row per column.

    Text columns have completeness, distinct count and length range only.
    """
    fields = [f for f in df.schema.fields if names is None or f.name in names]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    quantiles = exact_quantiles(df, numeric, (0, 0.25, 0.5, 0.75, 1)) if numeric else {}
    none = F.lit(None).cast("double")
    cells = []
    for f in fields:
        c = F.col(f.name)
        is_number = f.name in quantiles
        value = c.cast("double") if is_number else none
        found = quantiles.get(f.name, [None] * 5)
        shown = [
            F.lit(q).cast("double").alias(p)
            for p, q in zip(("p0", "p25", "p50", "p75", "p100"), found)
        ]
        length = none.cast("int") if is_number else F.length(c.cast("string"))
        cells.append(
            F.struct(
                F.lit(f.name).alias("variable"),
                F.count_if(c.isNull()).alias("n_missing"),
                ratio(F.count(c), F.count("*")).alias("complete_rate"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("sd"),
                *shown,
                F.min(length).alias("min_length"),
                F.max(length).alias("max_length"),
            )
        )
    report = df.agg(F.array(*cells).alias("report")).select(F.inline("report"))
    # Distinct values are grouped once for all columns; several COUNT(DISTINCT)
    # in one aggregate would multiply every row by the number of columns anyway.
    distinct = (
        unpivot(df, [f.name for f in fields])
        .where(F.col("level").isNotNull())
        .groupBy("variable", "level")
        .agg(F.lit(1).alias("_one"))
        .groupBy("variable")
        .agg(F.count("*").alias("n_distinct"))
    )
    return report.join(F.broadcast(distinct), "variable", "left").withColumn(
        "n_distinct", F.coalesce("n_distinct", F.lit(0).cast("long"))
    )


def latest(df: DataFrame, order: str) -> DataFrame:
    """The newest row, found by a mergeable maximum rather than a sort."""
    rest = [c for c in df.columns if c != order]
    newest = df.where(F.col(order).isNotNull()).agg(F.max(F.struct(order, *rest)).alias("row"))
    return newest.where(F.col("row").isNotNull()).select(*[f"row.{c}" for c in df.columns])


def preview(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """First ``n`` rows, in the given order when there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def list_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of the columns."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )


def dimensions(df: DataFrame) -> DataFrame:
    """Rows and columns of a table, as one row."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def column_levels(df: DataFrame, columns) -> DataFrame:
    """(name, level, n): the values of each column, merged map-side; nulls are a level."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("level")) for n in columns])
    return df.select(F.inline(pairs)).groupBy("name", "level").agg(F.count("*").alias("n"))
