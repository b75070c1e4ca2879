"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are put into bands by the number of their shingles. For a band whose
items have fewer than B shingles, a document is read as consecutive blocks of B
shingles, so that items and blocks have comparable sizes however long the
document is. An item is a candidate for a document when one of their
``HASHES`` minima agrees in any block; what the item shares with the document
adds up over the blocks, so a passage across a block edge is found as well.
Candidates are verified by exact containment against the whole document.
Items under ``TINY`` shingles are looked up by every one of their shingles.

Only the items travel: in slices of at most ``SLICE`` shingles, one pass over
the documents for each slice (a benchmark is one slice). Documents are not
shuffled.

Contract for unusual input: null and empty texts have no shingles and match
nothing; a text of fewer than five words is one shingle of all its words; rows
with a null id are skipped; items or documents that repeat an id are matched
row by row and reported once for each; empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words
from riskframe.llm.frames import trimmed

SHINGLE = 5
LEAST = 0.8
HASHES = 48
TINY = 8
SLICE = 1 << 20
_rng = np.random.default_rng(8)
_FLIP = _rng.integers(0, 1 << 63, HASHES).astype(np.uint64)
_TURN = _rng.integers(0, 1 << 63, HASHES).astype(np.uint64) | np.uint64(1)


def item_sets(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item_id, shingles): sorted distinct shingles of every item that has any."""

    def run(batches):
        for batch in batches:
            ids, sets = batch.column(1).to_pylist(), []
            for t in words.tokens(batch.column(0)):
                made, bounds = words.shingles(t, size)
                sets += [np.unique(x) for x in np.split(made, bounds[1:-1])]
            some = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in some], pa.int64()),
                 pa.array([sets[i].view(np.int64) for i in some], pa.list_(pa.int64()))],
                names=["item_id", "shingles"],
            )
        batch = t = made = bounds = None
        trimmed()

    rows = items.where(F.col(item_id).isNotNull()).select(text, F.col(item_id).cast("long"))
    return rows.mapInArrow(run, "item_id long, shingles array<long>")


class Signatures:
    """Minima of the items of one slice, by band and hash function."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.sets = np.array(ids, dtype=np.int64), sets
        sizes = np.array([len(s) for s in sets])
        tiny = np.flatnonzero(sizes < TINY)
        self.tiny = self._sorted([(x, i) for i in tiny for x in sets[i]])
        self.bands = []
        for width in 2 ** np.arange(4, 40):
            own = np.flatnonzero((sizes >= width // 2) & (sizes < width))
            if len(own):
                minima = np.stack([[((s ^ f) * t).min() for f, t in zip(_FLIP, _TURN, strict=True)]
                                   for s in (sets[i] for i in own)])
                self.bands.append((int(width), [self._sorted(list(zip(minima[:, k], own))) for k in range(HASHES)]))
            if not (sizes >= width).any():
                break

    @staticmethod
    def _sorted(pairs):
        """Values in order, their items, and a filter on their leading 16 bits."""
        value = np.array([p[0] for p in pairs], dtype=np.uint64)
        item = np.array([p[1] for p in pairs], dtype=np.int64)
        order = np.argsort(value, kind="stable")
        seen = np.zeros(1 << 16, dtype=bool)
        seen[value >> np.uint64(48)] = True
        return value[order], item[order], seen

    @staticmethod
    def _look_up(index, values: np.ndarray, rows: np.ndarray):
        value, item, seen = index
        hit = np.flatnonzero(seen[values >> np.uint64(48)])
        low = np.searchsorted(value, values[hit], "left")
        count = np.searchsorted(value, values[hit], "right") - low
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(rows[hit], count), item[at]

    def candidates(self, made: np.ndarray, bounds: np.ndarray):
        """(row, item) pairs that share a minimum in some block."""
        rows = len(bounds) - 1
        found = []
        row_of = np.repeat(np.arange(rows), np.diff(bounds))
        if len(self.tiny[0]):
            found.append(self._look_up(self.tiny, made, row_of))
        if self.bands and len(made):
            # Blocks of the narrowest band start anew in every row; wider ones join two at a time.
            width = self.bands[0][0]
            blocks = -(-np.diff(bounds) // width)
            first = np.concatenate([[0], np.cumsum(blocks)])
            inside = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
            starts = np.repeat(bounds[:-1], blocks) + inside * width
            minima = [np.minimum.reduceat((made ^ f) * t, starts) for f, t in zip(_FLIP, _TURN, strict=True)]
            owner = np.repeat(np.arange(rows), blocks)
            for band, index in self.bands:
                while width < band:
                    keep = np.flatnonzero(inside % 2 == 0)
                    minima = [np.minimum.reduceat(m, keep) for m in minima]
                    owner, inside, width = owner[keep], inside[keep] // 2, width * 2
                found += [self._look_up(index[k], minima[k], owner) for k in range(HASHES)]
        if not found:
            return np.zeros((0, 2), np.int64)
        return np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], axis=1), axis=0)

    def contained(self, made: np.ndarray, bounds: np.ndarray, least: float):
        """(row, item, shingles found) of the pairs whose exact containment is at least ``least``."""
        pairs = self.candidates(made, bounds)
        last, own = -1, None
        for row, item in pairs:
            if row != last:
                last, own = row, np.unique(made[bounds[row] : bounds[row + 1]])
            want = self.sets[item]
            at = np.minimum(np.searchsorted(own, want), len(own) - 1)
            n = int((own[at] == want).sum())
            if n >= least * len(want) - 1e-9:
                yield int(row), int(item), n


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                    text: str = "text", item_text: str = "text", size: int = SHINGLE, least: float = LEAST,
                    slice_shingles: int = SLICE) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): every item found in a document."""
    spark = docs.sparkSession
    sets = item_sets(items, item_id, item_text, size)
    total = sets.agg(F.sum(F.size("shingles").cast("long"))).first()[0] or 0
    slices = max(1, -(-2 * total // slice_shingles) if total > slice_shingles else 1)
    part = F.pmod(F.xxhash64("item_id"), F.lit(slices))
    rows = docs.where(F.col(doc_id).isNotNull()).select(text, F.col(doc_id).cast("long").alias("doc_id"))
    schema = "doc_id long, item_id long, n_shingles long, n_found long, containment double"

    def search(n: int) -> DataFrame:
        got = sorted((r[0], tuple(r[1])) for r in sets.where(part == n).toLocalIterator())
        index = Signatures([g[0] for g in got], [np.array(g[1], np.int64).view(np.uint64) for g in got])
        shared = spark.sparkContext.broadcast(index)

        def run(batches):
            index = shared.value
            for batch in batches:
                out, ids = [], batch.column(1).to_pylist()
                for t in words.tokens(batch.column(0)):
                    made, bounds = words.shingles(t, size)
                    for row, item, n_found in index.contained(made, bounds, least):
                        m = len(index.sets[item])
                        out.append((ids[t.first + row], int(index.ids[item]), m, n_found, n_found / m))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "n_shingles", "n_found", "containment"), o, strict=True)) for o in out],
                    schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()),
                                      ("n_found", pa.int64()), ("containment", pa.float64())]),
                )
            batch = t = made = bounds = None
            trimmed()

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [search(n) for n in range(slices)])
