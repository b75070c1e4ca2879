"""Whole-table column operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskframe.functions.clock import month_label, weekday_label
from riskframe.functions.flags import with_levels
from riskframe.functions.numbers import parse_double
from riskframe.functions.text import blank_to_null
from riskframe.spec import FeatureSpec


def rewrite(df: DataFrame, name: str, value: Column, where: Column | None = None) -> DataFrame:
    """Replace a column everywhere, or only in the rows where a condition holds."""
    new = value if where is None else F.when(where, value).otherwise(F.col(name))
    return df.withColumn(name, new)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text to null in every string column, in one projection."""
    return df.withColumns(
        {
            f.name: blank_to_null(F.col(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, StringType)
        }
    )


def cast_roles(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Cast every column to the type of its role; text that does not fit is null."""
    types = dict(df.dtypes)

    def number(name, kind):
        c = F.col(name)
        return (parse_double(c) if types[name] == "string" else c).cast(kind)

    casts = {c: number(c, "double") for c in spec.numeric if c in types}
    casts |= {c: number(c, "int") for c in (*spec.binary, spec.target) if c in types}
    casts |= {c: F.col(c).cast("string") for c in spec.categorical if c in types}
    casts |= {c: F.col(c).try_cast("date") for c in spec.dates if c in types}
    return df.withColumns(casts)


def align_levels(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Null out categories that the spec does not declare."""
    return df.withColumns({c: with_levels(F.col(c), d) for c, d in spec.levels.items()})


def unlisted_levels(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows per category that ``align_levels`` would null out (variable, level, n)."""
    return (
        unpivot(df, spec.categorical)
        .where(
            F.col("level").isNotNull()
            & ~_any([(F.col("variable") == c) & F.col("level").isin(*d) for c, d in spec.levels.items()])
        )
        .groupBy("variable", "level")
        .agg(F.count("*").alias("n"))
    )


def new_levels(df: DataFrame, name: str, known: DataFrame) -> DataFrame:
    """Distinct values of a column that never occur in ``known``."""
    return df.select(name).distinct().exceptAll(known.select(name).distinct())


def unpivot(df: DataFrame, names, keep=()) -> DataFrame:
    """Columns to rows as text: kept columns, ``variable``, ``level``."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"))
            for c in names
        ]
    )
    return df.select(*keep, F.inline(pairs))


def complete_cases(df: DataFrame, names) -> DataFrame:
    return df.dropna("any", subset=list(names))


def drop_report(df: DataFrame, names, target: str) -> DataFrame:
    """Rows, events and event rate of the rows a complete-case filter keeps and drops."""
    missing = _any([F.col(c).isNull() for c in names])
    return (
        df.groupBy(F.when(missing, "dropped").otherwise("kept").alias("part"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col(target)).cast("long").alias("events"),
            F.avg(F.col(target).cast("double")).alias("rate"),
        )
    )


def calendar_parts(df: DataFrame, day: str, month: str = "Mes", weekday: str = "DiaSemana") -> DataFrame:
    return df.withColumns({month: month_label(F.col(day)), weekday: weekday_label(F.col(day))})


def stamp_load(df: DataFrame, load_id: str, name: str = "carga_id") -> DataFrame:
    """One constant load id for the whole run."""
    return df.drop(name).withColumn(name, F.lit(load_id))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
