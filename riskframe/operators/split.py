"""Seeded exact-size splits and small seeded samples."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_DIGITS = 4  # hex digits resolved per pass: at most 65,536 cells


def seed_hash(key: str, seed) -> Column:
    """Uniform text hash of key and seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def _order_hash(df: DataFrame, key: str, seed, digits: int) -> Column:
    """Leading digits of the rank of a row: key hash first, whole-row hash after it.

    The whole row is hashed only when key hashes alone cannot tell rows apart.
    """
    by_key = F.coalesce(seed_hash(key, seed), F.md5(F.lit(f"NA|{seed}")))
    if digits <= 32:
        return F.left(by_key, F.lit(digits))
    whole = F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    return F.left(F.concat(by_key, whole), F.lit(digits))


def exact_split(df: DataFrame, key: str, frac: float, seed=42) -> tuple[DataFrame, DataFrame]:
    """Split into floor(frac * n) rows and the rest, the same rows on every run.

    Rows rank by a seeded hash.  The rank boundary is located digit by digit
    from grouped counts, so no pass sorts or moves the rows, and both parts are
    plain filters on the source.  Rows that are equal in every column and
    straddle the boundary are interchangeable: their copies are dealt out by
    count.
    """
    n = df.count()
    wanted = math.floor(frac * n + 1e-9)
    if wanted <= 0 or wanted >= n:
        none = df.where(F.lit(False))
        return (none, df) if wanted <= 0 else (df, none)
    edge, into_edge, at_edge = _boundary(df, key, seed, wanted)
    head = _order_hash(df, key, seed, len(edge))
    if into_edge == at_edge:
        return df.where(head <= edge), df.where(head > edge)
    tied = df.where(head == edge)
    return (
        df.where(head < edge).unionByName(_copies(tied, into_edge)),
        df.where(head > edge).unionByName(_copies(tied, at_edge - into_edge)),
    )


def _boundary(df: DataFrame, key: str, seed, wanted: int) -> tuple[str, int, int]:
    """Shortest hash prefix that decides the boundary: (prefix, rows of it taken, rows in it)."""
    edge, missing = "", wanted
    while True:
        width = len(edge) + _DIGITS
        here = df.where(_order_hash(df, key, seed, len(edge)) == edge) if edge else df
        cells = here.groupBy(_order_hash(df, key, seed, width).alias("cell")).agg(
            F.count("*").alias("n")
        )
        # At most 16 ** _DIGITS cells, whatever the number of rows.
        run = F.sum("n").over(Window.orderBy("cell"))
        hit = (
            cells.withColumn("upto", run)
            .where(F.col("upto") >= missing)
            .orderBy("upto")
            .select("cell", "n", "upto")
            .first()
        )
        edge = hit.cell
        missing -= hit.upto - hit.n
        if missing == hit.n or width >= 64:
            return edge, missing, hit.n


def _copies(tied: DataFrame, n: int, chunk: int = 100_000) -> DataFrame:
    """``n`` copies of the one distinct row in ``tied``, generated in parallel chunks."""
    chunks = math.ceil(n / chunk)
    size = F.least(F.lit(chunk).cast("long"), F.lit(n).cast("long") - F.col("_chunk") * chunk)
    spread = tied.limit(1).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    )
    if chunks > 1:
        spread = spread.repartition("_chunk")
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(
        *tied.columns
    )


def hash_share(df: DataFrame, key: str, frac: float, seed=42) -> tuple[DataFrame, DataFrame]:
    """Approximate-size split that needs no counting pass; a key never straddles it."""
    limit = f"{min(int(frac * 16**8), 16**8 - 1):08x}"
    taken = F.coalesce(F.left(seed_hash(key, seed), F.lit(8)) < limit, F.lit(False))
    return df.where(taken), df.where(~taken)


def simulate_batch(df: DataFrame, key: str, low: int = 150, high: int = 200, seed=42) -> DataFrame:
    """Between ``low`` and ``high`` rows drawn without replacement, as a top-k."""
    n = random.Random(str(seed)).randint(low, high)
    return df.orderBy(seed_hash(key, seed), *df.columns).limit(n)
