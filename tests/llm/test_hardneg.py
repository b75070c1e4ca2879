import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import hardneg


def by_hand(rows, divisor, positives=5, negatives=3, low=50, high=95):
    sound = [(i, y, [int(np.floor(256 * float(c))) for c in v]) for i, v, y in rows
             if i is not None and y is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, label, x in sound:
        if a % divisor:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, z, strict=True)), i, y == label) for i, y, z in sound
                        if i != a and len(z) == len(x))
        for s, pos, _ in [r for r in scored if r[2]][:positives]:
            found = [(i, -t) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, pos, n + 1, i, -s, t) for n, (i, t) in enumerate(found)]
    return sorted(out)


def clustered(seed, n, length=8, classes=4, noise=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes * 2, length))
    which = rng.integers(0, len(centres), n)
    x = (centres[which] + noise * rng.normal(size=(n, length))).round(2)
    return [(i, x[i].tolist(), int(which[i] % classes)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize(("shard_rows", "block"), [(1 << 14, 1 << 12), (40, 7)])
def test_negatives_equal_brute_force(spark, shard_rows, block):
    rows = clustered(3, 500)
    rows += [(600 + i, [0.5] * 8, i % 3) for i in range(90)]  # one hot vector: ties, and a cell beyond a shard
    rows += [(700, None, 1), (701, [], 1), (702, [None] * 8, 1), (703, [float("nan")] + [0.0] * 7, 1), (704, [float("inf")] * 8, 1),
             (705, [1.0] * 8, None), (None, [9.0] * 8, 1), (710, [3.0, 3.0], 1), (720, [2.0, 3.0], 1), (721, [2.0, 2.0], 2),
             (730, [0.0] * 8, 1), (740, [4.0], 1), (741, [2.0], 2), (742, [5.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("x", F.lit(1)).withColumn("w", F.lit(2))
    got = hardneg.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), shard_rows=shard_rows, anchor_block=block).collect()
    want = by_hand(rows, 10)
    assert sorted(tuple(r) for r in got) == want and len(want) > 300
    assert got[0].asDict().keys() == {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"}


def test_empty_tables_repeated_rows_and_huge_components(spark):
    df = spark.createDataFrame(clustered(1, 20), SCHEMA)
    assert hardneg.mine(df.limit(0), F.col("vec_id") % 2 == 0, F.col("label")).count() == 0
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.25], 2), (2, [1.0, 0.25], 2)]
    got = hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, F.col("label")).collect()
    # Both copies of row 1 are positives, both copies of row 2 negatives of each; the two anchors are one.
    assert sorted((r["positive_id"], r["rank"], r["negative_id"]) for r in got) == [(1, 1, 2), (1, 1, 2), (1, 2, 2), (1, 2, 2)]
    huge = [(0, [1e5, 1e5], 1), (1, [1e5, 1e5], 1), (2, [8e4, 8e4], 2), (3, [1e5, 8e4], 2), (4, [1e5, 9.1e4], 2)]
    got = hardneg.mine(spark.createDataFrame(huge, SCHEMA), F.col("vec_id") == 0, F.col("label")).collect()
    assert sorted(tuple(r) for r in got) == by_hand(huge, 10)


def test_cells_come_in_order_of_their_bounds():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (1, 7), (6, 1), (9, 12)):
        u1, u2 = rng.integers(0, 6, n).astype(float), rng.integers(0, 6, m).astype(float)
        got = list(hardneg.by_descending_bound(u1, u2))
        assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(n) for j in range(m)]
        assert [b for b, _, _ in got] == sorted((u1[:, None] + u2[None, :]).ravel().tolist(), reverse=True)
        assert all(b == u1[i] + u2[j] for b, i, j in got)


def test_bounds_hold_and_cells_and_shards_are_skipped(spark):
    rows = [(i, [c * 5 for c in v], y) for i, v, y in clustered(7, 3000, classes=20, noise=0.1)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = hardneg.Index(df, F.col("vec_id") % 50 == 0, F.col("label"), "vec_id", "embedding", 400)
    books = index.books
    packed = {r["shard"]: r for r in index.shards.collect()}
    assert sum(len(r["dims"]) // 4 for r in packed.values()) == 3000
    shards = {s: hardneg.Shard(r, books, 8) for s, r in packed.items()}
    seen = visited = asked = 0
    for i, v, label in rows[::50]:
        q = np.floor(256 * np.array(v)).astype(np.int64)
        bounds = books.shard_bounds(q.astype(float))
        every = np.concatenate([s.x @ q for s in shards.values()])
        assert all((s.x @ q).max() <= bounds[n] for n, s in shards.items())
        kth = int(np.sort(every)[-6])
        for n in np.flatnonzero(bounds >= kth):
            cells = []
            list(shards[n].search(q, i, label, [hardneg.Window(0, -hardneg.EDGE, hardneg.EDGE, kth)], True, 5, cells))
            visited += sum(b - a for a, b in cells)
            asked += 1
        seen += 1
    assert asked < 0.7 * seen * len(shards)
    assert visited < 0.4 * seen * 3000
