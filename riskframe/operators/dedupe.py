"""De-duplication and duplicate accounting.

Both operators aggregate before they shuffle, so a row repeated a billion
times leaves each map task once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, fold_case: bool = False) -> DataFrame:
    """One copy of every distinct row; nulls compare equal.

    ``fold_case`` treats text that differs only in letter case or trailing
    blanks as equal and keeps the smallest spelling.
    """
    if not fold_case:
        return df.distinct()
    folds = {
        f"_k{i}": F.lower(F.rtrim(F.col(c))) if kind == "string" else F.col(c)
        for i, (c, kind) in enumerate(df.dtypes)
    }
    keyed = df.withColumns(folds)
    return keep_first(keyed, list(folds), df.columns).select(*df.columns)


def keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """The first row of each key group in ``order_by`` order (nulls first).

    The remaining columns break ties, so the survivor never depends on how the
    input was partitioned.  Exact copies go first, in a hash aggregate.  Spark
    computes the ordered minimum over sorted groups; a 64-bit hash of the keys
    leads their order and their shuffle, so rows are placed by one fixed-width
    number and the wide keys are compared only where it is equal.
    """
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = [c for c in (*order, *rest) if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    # Distinct rows merge map-side in hash tables and are then dealt by the hash of the keys.
    rows = df.select(F.xxhash64(*keys).alias("_hash"), *keys, *payload).distinct().repartition("_hash")
    best = rows.groupBy("_hash", *keys).agg(F.min(F.struct(*payload)).alias("_first"))
    return best.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, keys=None, null_safe: bool = True) -> DataFrame:
    """Total, duplicated and remaining rows over the given columns, as one row.

    ``null_safe=False`` compares the columns joined into one text that skips
    nulls, which merges rows such as ('x', null) and (null, 'x').
    """
    names = list(keys or df.columns)
    if null_safe:
        identity = F.struct(*names)
    else:
        identity = F.concat_ws("|", *[F.col(c).cast("string") for c in names])
    return df.agg(
        F.count("*").alias("total"), F.countDistinct(identity).alias("remaining")
    ).select("total", (F.col("total") - F.col("remaining")).alias("duplicated"), "remaining")
