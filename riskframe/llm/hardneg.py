"""Hard negatives by an inverted multi-index: exact score windows around each anchor's positives.

1. Vectors are cut into two halves; each half has a codebook of its own (k-means
   on a bounded sample). A row's cell is its pair of nearest codewords. Every
   row is indexed, and each codeword's radius is the largest distance of any row's half.
2. Cells, in their order, are packed into shards of bounded size; a cell with
   more rows than a shard is dealt over several. A shard is one row of packed arrays.
3. For an anchor, no row of a cell scores more than the sum of two half-score
   bounds, (anchor half . codeword) + |anchor half| * radius. An anchor first goes to
   the shard with its greatest bound; what it finds there tells which other
   shards can still matter, and only to those it goes. In a shard, cells are visited in order
   of their bound by a heap over the two sorted lists of half bounds, until the
   next bound is below what every window still needs: the result is then certified.
4. Positives are one open window over rows of the anchor's label; their scores make the
   windows of its negatives, which are searched in the same way.

Contract for unusual input: rows with a null id, a null label, or a vector that
is null, empty or holds a null, NaN or infinite component take no part; labels
are whole numbers; vectors of another length than an anchor's are no candidates
for it; those of another than the commonest length share one cell. Rows that
repeat an id are candidates each, though never for their own id; an anchor row that repeats
whole is one anchor. Ties go to the smaller id. Scores beyond 62 bits count as the nearest
62-bit number. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import renewed
from riskframe.llm.kdtree import exact_kind, integer_vectors
from riskframe.session import durable

#: Rows the codebooks are fitted on, and rounds of k-means.
SAMPLE, ROUNDS = 8192, 8
#: Rows a cell should have; codewords of a half follow from it, within these limits.
CELL_ROWS, FEWEST, MOST = 64, 4, 256
SHARD_ROWS = 1 << 14
ANCHOR_BLOCK = 1 << 12
#: Rows of cells in order scored at once: the first time, and at most.
FIRST, AT_ONCE = 256, 4096
EDGE = (1 << 62) - 1
_WINDOWS = "array<struct<w:int,low:long,high:long,need:long>>"
_FOUND = "aid long, w int, vec_id long, score long"


def trained(halves: np.ndarray, k: int) -> np.ndarray:
    """Codewords of some half vectors: Lloyd's rounds from the first k distinct ones."""
    if not halves.size:  # an empty table, or the empty half of a single component
        return np.zeros((1, halves.shape[1]))
    _, first = np.unique(halves, axis=0, return_index=True)
    words = halves[np.sort(first)[:k]].astype(np.float64)
    for _ in range(ROUNDS):
        near = nearest(halves, words)
        size = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, halves)
        words = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], words)
    # In order along their main axis, so that cells that follow each other, and share a shard, are near.
    axis = np.linalg.svd(words - words.mean(axis=0), full_matrices=False)[2][0]
    return words[np.argsort(words @ axis, kind="stable")]


def nearest(halves: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(axis=1)[None, :] - 2 * halves @ words.T).argmin(axis=1)


@dataclass
class Codebooks:
    """Two codebooks for vectors of the commonest length; the codeword after the last is for all others."""

    length: int
    words: tuple[np.ndarray, np.ndarray]
    #: Once all rows are assigned: radii of both halves' codewords, and each shard's cells.
    radii: tuple[np.ndarray, np.ndarray] | None = None
    cells: np.ndarray | None = None  # c1, c2 of all cells, by shard
    shards: np.ndarray | None = None  # first place of each shard in ``cells``

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]

    def place(self, x: np.ndarray):
        """Codeword and distance to it, half by half, of vectors of one length."""
        for half, words in zip(self.halves(x), self.words, strict=True):
            if x.shape[1] == self.length:
                near = nearest(half, words)
                gap = half - words[near]
            else:
                near, gap = np.full(len(x), len(words)), half
            yield near, np.sqrt((gap**2).sum(axis=1))

    def half_bounds(self, q: np.ndarray):
        """For each half: (upper, lower) bounds of the score with any row of each codeword."""
        for half, words, radius in zip(self.halves(q[None, :]), self.words, self.radii, strict=True):
            middle = np.full(len(words) + 1, -np.inf)
            if len(q) == self.length:
                middle[:-1] = words @ half[0]
            else:
                middle[-1] = 0.0
            reach = np.sqrt((half[0] ** 2).sum()) * radius
            slack = 1e-9 * (np.abs(np.where(np.isfinite(middle), middle, 0)) + reach)
            yield middle + reach + slack, middle - reach - slack

    def shard_bounds(self, q: np.ndarray) -> np.ndarray:
        (u1, _), (u2, _) = self.half_bounds(q)
        return np.maximum.reduceat(u1[self.cells[:, 0]] + u2[self.cells[:, 1]], self.shards)


def by_descending_bound(u1: np.ndarray, u2: np.ndarray):
    """(bound, i, j) in descending order of u1[i] + u2[j], one pair at a time (multi-sequence)."""
    o1, o2 = np.argsort(-u1, kind="stable"), np.argsort(-u2, kind="stable")
    s1, s2 = u1[o1], u2[o2]
    heap, reached = [(-(s1[0] + s2[0]), 0, 0)], np.zeros(len(s1), np.int64)
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, o1[a], o2[b]
        # reached[a]: pairs of the a-th row taken; a pair enters when both its neighbours have left.
        reached[a] = b + 1
        if b + 1 < len(s2) and (a == 0 or reached[a - 1] > b + 1):
            heapq.heappush(heap, (-(s1[a] + s2[b + 1]), a, b + 1))
        if a + 1 < len(s1) and reached[a + 1] == b:
            heapq.heappush(heap, (-(s1[a + 1] + s2[b]), a + 1, b))


class Shard:
    """The rows of some cells, cell after cell."""

    def __init__(self, row, books: Codebooks, length: int):
        """Of a packed row, those vectors that have a given length."""
        dims = np.frombuffer(row.dims, np.int32)
        ends = np.cumsum(dims.astype(np.int64))
        own = np.flatnonzero(dims == length)
        flat = np.frombuffer(row.x, np.int64)
        self.x = np.stack([flat[e - length : e] for e in ends[own]]) if len(own) else np.zeros((0, length), np.int64)
        self.ids, self.labels = (np.frombuffer(b, np.int64)[own] for b in (row.ids, row.labels))
        c = np.frombuffer(row.cells, np.int32).reshape(-1, 2)[own]
        order = np.lexsort((c[:, 1], c[:, 0]))
        self.x, self.ids, self.labels, c = self.x[order], self.ids[order], self.labels[order], c[order]
        self.books = books
        (self.c1, at1), (self.c2, at2) = (np.unique(c[:, i], return_inverse=True) for i in (0, 1))
        cell = at1 * len(self.c2) + at2
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
        after = np.append(first[1:], len(cell))
        self.places = np.arange(len(cell))
        self.cells = {int(cell[a]): (int(a), int(b)) for a, b in zip(first, after, strict=True)}

    def search(self, q, own_id: int, label: int, windows: list, same: bool, k: int, visited: list | None = None):
        """(w, vec_id, score): up to k best rows for each window (w, low, high, need)."""
        if not self.cells:
            return
        (u1, l1), (u2, l2) = self.books.half_bounds(q.astype(np.float64))
        u1, u2, l1, l2 = u1[self.c1], u2[self.c2], l1[self.c1], l2[self.c2]
        need = [w.need for w in windows]
        top = max(w.high for w in windows)
        held = [(np.zeros(0, q.dtype), np.zeros(0, np.int64)) for _ in windows]

        def look(cells: list[tuple[int, int]]) -> None:
            """Score the rows of some cells at once and keep each window's best."""
            scores = np.clip(np.concatenate([self.x[a:b] @ q for a, b in cells]), -EDGE, EDGE)
            at = np.concatenate([self.places[a:b] for a, b in cells])
            some = np.flatnonzero((scores >= min(need)) & (scores <= top))
            scores, at = scores[some], at[some]
            some = ((self.labels[at] == label) == same) & (self.ids[at] != own_id)
            scores, ids = scores[some], self.ids[at[some]]
            for n, w in enumerate(windows):
                good = (scores >= need[n]) & (scores <= w.high)
                if not good.any():
                    continue
                s, i = np.append(held[n][0], scores[good]), np.append(held[n][1], ids[good])
                best = np.lexsort((i, -s))[:k]
                held[n] = s[best], i[best]
                if len(best) == k:
                    need[n] = max(need[n], int(s[best].min()))

        waiting, rows, enough = [], 0, FIRST
        for bound, i, j in by_descending_bound(u1, u2):
            if bound < min(need):
                break
            cell = self.cells.get(i * len(self.c2) + j)
            if cell is None or l1[i] + l2[j] > top:
                continue
            waiting.append(cell)
            rows += cell[1] - cell[0]
            if rows >= enough:
                look(waiting)
                if visited is not None:
                    visited += waiting
                waiting, rows, enough = [], 0, min(2 * enough, AT_ONCE)
        if waiting:
            look(waiting)
            if visited is not None:
                visited += waiting
        for w, (s, ids) in zip(windows, held, strict=True):
            for score, i in zip(s, ids, strict=True):
                yield w.w, int(i), int(score)


@dataclass
class Window:
    w: int
    low: int
    high: int
    need: int


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard as one row; its vectors one after the other."""
    return pd.DataFrame({
        "shard": rows["shard"].iloc[:1], "dims": [rows["dim"].to_numpy(np.int32).tobytes()],
        "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "labels": [rows["label"].to_numpy(np.int64).tobytes()],
        "cells": [rows[["c1", "c2"]].to_numpy(np.int32).tobytes()], "x": [b"".join(rows["x"])],
    })


class Index:
    """All usable rows of a table, by cell and shard; built by a few jobs and kept in the shared folder."""

    def __init__(self, df: DataFrame, is_anchor: Column, label: Column, vec_id: str, vector: str, shard_rows: int):
        spark = df.sparkSession
        rows = integer_vectors(df.where(label.isNotNull()), vec_id, vector, label.cast("long").alias("label"),
                               F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
        sample = [np.array(r["x"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(SAMPLE).select("x").collect()]
        self.n = rows.count()
        books = self._fitted(sample)
        schema = "vec_id long, label long, anchor boolean, dim int, c1 int, c2 int, r1 double, r2 double, x binary"

        def assign(parts):
            for part in parts:
                part = part.assign(dim=part["x"].map(len))
                for dim, own in part.groupby("dim"):
                    x = np.stack(own["x"].to_numpy()).astype(np.int64)
                    (c1, r1), (c2, r2) = books.place(x.astype(np.float64))
                    yield pd.DataFrame({
                        "vec_id": own["vec_id"], "label": own["label"], "anchor": own["anchor"], "dim": dim, "c1": c1, "c2": c2,
                        "r1": r1, "r2": r2, "x": [v.tobytes() for v in x],
                    })

        self.rows = durable(rows.mapInPandas(assign, schema))
        stats = self.rows.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2"))
        stats = stats.orderBy("c1", "c2").toPandas()  # one row a cell: at most (MOST + 1) squared
        radii = []
        for c, r, words in (("c1", "r1", books.words[0]), ("c2", "r2", books.words[1])):
            radius = np.zeros(len(words) + 1)
            np.maximum.at(radius, stats[c].to_numpy(int), stats[r].to_numpy())
            radii.append(radius)
        books.radii = tuple(radii)
        base, parts, cells, starts = self._sharded(stats, shard_rows)
        books.cells, books.shards, self.books = cells, starts, books
        where = spark.createDataFrame(
            pd.DataFrame({"c1": stats["c1"], "c2": stats["c2"], "base": base, "parts": parts}), "c1 int, c2 int, base int, parts int"
        )
        placed = self.rows.join(F.broadcast(where), ["c1", "c2"]).withColumn(
            "shard", (F.col("base") + F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("parts"))).cast("int")
        )
        self.shards = durable(
            placed.select("shard", "dim", "vec_id", "label", "c1", "c2", "x").groupBy("shard").applyInPandas(
                _packed, "shard int, dims binary, ids binary, labels binary, cells binary, x binary"
            )
        )

    def _fitted(self, sample: list[np.ndarray]) -> Codebooks:
        lengths = [len(x) for x in sample]
        length = max(set(lengths), key=lambda n: (lengths.count(n), -n)) if lengths else 1
        x = np.array([v for v in sample if len(v) == length], np.float64).reshape(-1, length)
        k = int(np.clip(2 ** np.round(np.log2(max(1.0, self.n / CELL_ROWS)) / 2), FEWEST, MOST))
        half = length // 2
        return Codebooks(length, (trained(x[:, :half], k), trained(x[:, half:], k)))

    @staticmethod
    def _sharded(stats: pd.DataFrame, shard_rows: int):
        """Each cell's first shard and how many it is dealt over, and the cells of all shards."""
        base, parts, cells, starts, room, shard = [], [], [], [], 0, -1
        for r in stats.itertuples():
            n = -(-r.n // shard_rows)
            if n > 1 or r.n > room:
                shard, room = shard + 1, shard_rows
                base.append(shard)
                starts += [len(cells) + i for i in range(n)]
                cells += [(r.c1, r.c2)] * n
                shard, room = shard + n - 1, 0 if n > 1 else room - r.n
            else:
                base.append(shard)
                cells.append((r.c1, r.c2))
                room -= r.n
            parts.append(n)
        return base, parts, np.array(cells, np.int64).reshape(-1, 2), np.array(starts, np.int64)

    def search(self, asks: DataFrame, same: bool, k: int, block_rows: int) -> DataFrame:
        """(aid, w, vec_id, score) of each ask's windows, at least the k best of each.

        ``asks``: aid, vec_id, label, x, windows.
        """
        books, keys = self.books, ["shard", "block"]
        # Read by both routes.
        asks = durable(asks.withColumn("block", F.pmod(F.xxhash64("aid"), F.lit(self.blocks(asks, block_rows))).cast("int")))
        schema = f"aid long, vec_id long, label long, x binary, windows {_WINDOWS}, block int, shard int"

        def routed(home: bool):
            def route(parts):
                for part in parts:
                    picks, shards = [], []
                    for i, (x, windows) in enumerate(zip(part["x"], part["windows"], strict=True)):
                        bounds = books.shard_bounds(np.frombuffer(x, np.int64).astype(np.float64))
                        best = int(bounds.argmax())
                        go = bounds >= min(w["need"] for w in windows)
                        if home:
                            go = np.arange(len(bounds)) == best
                        else:
                            go[best] = False
                        found = np.flatnonzero(go)
                        picks += [i] * len(found)
                        shards += found.tolist()
                    yield part.iloc[picks].assign(shard=np.array(shards, np.int32))

            return route

        def visit(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(shard) and len(asked):
                packed = next(shard.itertuples())
                sizes = asked["x"].map(len).to_numpy() // 8
                for length in np.unique(sizes).tolist():
                    own = Shard(packed, books, length)
                    some = asked[sizes == length]
                    q = np.stack([np.frombuffer(x, np.int64) for x in some["x"]])
                    kind = exact_kind(own.x, q)
                    own.x, q = own.x.astype(kind), q.astype(kind)
                    for r, v in zip(some.itertuples(), q, strict=True):
                        windows = [Window(**w) for w in r.windows]
                        out += [(r.aid, *f) for f in own.search(v, r.vec_id, r.label, windows, same, k)]
            return pd.DataFrame(out, columns=["aid", "w", "vec_id", "score"]).astype(
                {"aid": "int64", "w": "int32", "vec_id": "int64", "score": "int64"}
            )

        def found(asked: DataFrame) -> DataFrame:
            # A shard meets each block of anchors that come to it once, and no other block.
            met = self.shards.join(asked.select(*keys).distinct(), "shard")
            return renewed(met).groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(visit, _FOUND)

        columns = asks.select("aid", "vec_id", "label", "x", "windows", "block")
        first = durable(found(durable(columns.mapInPandas(routed(True), schema))))
        kth = first.groupBy("aid", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        kth = kth.groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth"))
        needing = F.transform("windows", lambda w: F.struct(
            w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"),
            F.greatest(w["need"], F.coalesce(F.element_at("kth", w["w"]), w["need"])).alias("need"),
        ))
        left = columns.join(kth, "aid", "left").withColumn("windows", needing.cast(_WINDOWS)).drop("kth")
        rest = durable(left.select(*columns.columns).mapInPandas(routed(False), schema))
        return first.unionByName(found(rest))

    @staticmethod
    def blocks(asks: DataFrame, block_rows: int) -> int:
        return max(1, -(-asks.count() // block_rows))


def _best(found: DataFrame, k: int) -> DataFrame:
    """(aid, w, rank, vec_id, score): the k best of each window, ranks from 1."""
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    return (
        found.groupBy("aid", "w").agg(F.slice(order, 1, k).alias("b"))
        .select("aid", "w", F.posexplode("b").alias("rank", "b"))
        .select("aid", "w", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
    )


def mine(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its best other rows of the same label; its negatives for one of
    them are the best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    index = Index(df, is_anchor, label, vec_id, vector, shard_rows)
    anchors = durable(
        index.rows.where("anchor").select(F.xxhash64("vec_id", "label", "x").alias("aid"), "vec_id", "label", "x").dropDuplicates(["aid"])
    )
    edge = F.lit(EDGE)
    open_window = F.array(F.struct(F.lit(0).alias("w"), (-edge).alias("low"), edge.alias("high"), (-edge).alias("need")))
    near = index.search(anchors.withColumn("windows", open_window.cast(_WINDOWS)), True, positives, anchor_block)
    # Whole percents of the positive's score, rounded inwards without a product beyond 64 bits.
    def percent(p: int, up: bool) -> Column:
        s = F.col("score")
        rest = F.pmod(s, F.lit(100))
        whole = ((s - rest) / 100).cast("decimal(38,0)").cast("long")
        part = rest * p
        return whole * p + (F.ceil(part / 100) if up else F.floor(part / 100))

    chosen = durable(_best(near, positives).select("aid", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), "score",
                                                   percent(low, True).alias("low"), percent(high, False).alias("high")))
    windows = chosen.where("low <= high").groupBy("aid").agg(
        F.sort_array(F.collect_list(F.struct("w", "low", "high", F.col("low").alias("need")))).cast(_WINDOWS).alias("windows")
    )
    far = index.search(anchors.join(windows, "aid"), False, negatives, anchor_block)
    found = _best(far, negatives).select("aid", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(chosen, ["aid", "w"]).join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
