"""Keyed anti-join of a batch against a live table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: Distinct keys of a batch that are pushed into the scan of the live table.
PUSHED_KEYS = 1000
_ROW_OVERHEAD = 64
_EXACT = (T.StringType, T.IntegralType, T.DateType)


def new_rows(
    batch: DataFrame,
    live: DataFrame,
    key: str,
    dedupe_batch: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``live``; missing keys match each other.

    A batch is normally tiny beside the live table.  Up to ``PUSHED_KEYS``
    distinct keys become a filter of the scan, so files and row groups whose
    statistics, dictionaries or Bloom filters (``key_filters``) exclude them are
    not read.  When the measured key volume fits ``broadcast_bytes``, the live
    table is reduced to the batch's keys where it is read and is never shuffled;
    a larger batch takes a shuffled anti-join.
    """
    rows = keep_one_per_key(batch, key) if dedupe_batch else batch
    known = live.select(F.col(key).alias("_live_key"))
    size = batch.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(F.col(key).cast("string"))).alias("bytes"),
    ).first()
    few = pushed_keys(batch, key) if (size.bytes or 0) <= PUSHED_KEYS * 1024 else None
    if few is not None and isinstance(live.schema[key].dataType, _EXACT):
        known = known.where(_any_of(F.col("_live_key"), few))
    if (size.bytes or 0) + size.n * _ROW_OVERHEAD <= broadcast_bytes:
        wanted = batch.select(F.col(key).alias("_batch_key")).distinct()
        known = known.join(
            F.broadcast(wanted), F.col("_live_key").eqNullSafe(F.col("_batch_key")), "left_semi"
        )
    # A live key repeated many times merges before it is shuffled.
    known = known.distinct()
    return rows.join(known, F.col(key).eqNullSafe(F.col("_live_key")), "left_anti")


def pushed_keys(batch: DataFrame, key: str) -> list | None:
    """The distinct keys of a batch, or nothing if there are more than ``PUSHED_KEYS``."""
    found = batch.select(key).distinct().limit(PUSHED_KEYS + 1).collect()
    return [r[0] for r in found] if len(found) <= PUSHED_KEYS else None


def _any_of(column: Column, values: list) -> Column:
    """``column`` is one of the values, as a balanced tree: a long IN list reaches the scan as a range only."""
    tests = [column.isNull() if v is None else column == F.lit(v) for v in sorted(values, key=lambda v: (v is None, v))]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) & ~1 :]
    return tests[0] if tests else F.lit(False)


def key_filters(key: str) -> dict[str, str]:
    """Writer options that give each row group a Bloom filter of a column, as large as its values need."""
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.fpp#{key}": "0.0001",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }


def keep_one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by the remaining columns."""
    from riskframe.operators.dedupe import keep_first

    return keep_first(df, [key], [c for c in df.columns if c != key])
