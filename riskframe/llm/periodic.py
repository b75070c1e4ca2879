"""Periodic runs of words by multi-scale minimizers, and texts without their repetitions.

A run is a stretch of words with smallest period q (words q apart are equal) of
at least ``min_exponent`` periods that no neighbouring word extends.

1. Periods up to ``DIRECT`` are read off direct scans: where words q apart are
   equal, stretch by stretch.
2. Longer periods have one scale for each doubling: w < q <= 2w. At a scale,
   sequences of k = 2w words are hashed and the least hash of every window of
   w starts is a minimizer. As k >= q, no sequence occurs twice in one period
   of a run; as w < q and the run has four periods, a window and the window
   one period on both lie inside the run, so their minimizers are equal and next
   to each other among equal ones. Neighbouring equal minimizers at a distance in
   (w, 2w] are thus seeds of all runs of these periods, none missed. As k >= q, a
   seed is itself a square (two periods), which ordinary text hardly has.
3. A seed is extended word by word, in blocks, and what is long enough and has
   no smaller period is a run. Words are compared exactly.

Work and memory are those of some passes over the words of a few texts at a
time; a text is never cut. Rows stay where they are: nothing is shuffled.

Contract for unusual input: null and empty texts have no words, no runs and an
empty collapsed text; letter case counts; rows that repeat are treated each;
nulls elsewhere pass through; empty tables stay empty; columns whose names
clash with an output are replaced by it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.words import mixed

#: Longest period found by direct scans; a power of two.
DIRECT = 8
#: Words of consecutive texts searched together; a longer text is searched by itself.
TOGETHER = 1 << 18
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")]))


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and places after the last of all stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def has_smaller_period(word: np.ndarray) -> bool:
    """Whether a stretch of several periods ``word`` has a smaller one, which then divides its length."""
    n, rest, factor = len(word), len(word), 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor:
            factor += 1
            continue
        while rest % factor == 0:
            rest //= factor
        d = n // factor
        if np.array_equal(word[d:], word[:-d]):
            return True
    return False


def minimizers(hashes: np.ndarray, usable: np.ndarray, w: int) -> np.ndarray:
    """Places whose hash is the least of some window of w places (a power of two)."""
    held = np.where(usable, hashes, _TOP)
    least = held.copy()
    step = 1
    while step < w:
        np.minimum(least[:-step], least[step:], out=least[:-step])
        step *= 2
    # A place is the least of a window where the greatest of its windows' minima is its own hash.
    most, step = least, 1
    while step < w:
        most = np.concatenate([most[:step], np.maximum(most[step:], most[:-step])])
        step *= 2
    return np.flatnonzero((most == held) & usable)


def seeds(ids: np.ndarray, bounds: np.ndarray, exponent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Scale by scale: (w, places, distances) of neighbouring equal minimizers of one text."""
    hashes = mixed(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, ends, k = np.arange(len(ids)), np.repeat(bounds[1:], np.diff(bounds)), 1
    sizes = np.repeat(np.diff(bounds), np.diff(bounds))
    w = DIRECT
    while True:
        long = sizes >= exponent * (w + 1)
        if not long.any():
            return
        if not long.all():  # whole texts go, so places that stay keep their neighbours
            hashes, at, ends, sizes = hashes[long], at[long], ends[long], sizes[long]
        while k < 2 * w:
            there = np.append(hashes[k:], np.zeros(min(k, len(hashes)), np.uint64))
            hashes = mixed(hashes * np.uint64(0x2545F4914F6CDD1D) + there)
            k *= 2
        chosen = minimizers(hashes, at + k <= ends, w)
        chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
        gap = at[chosen[1:]] - at[chosen[:-1]]
        pair = (hashes[chosen[1:]] == hashes[chosen[:-1]]) & (ends[chosen[1:]] == ends[chosen[:-1]]) & (gap > w) & (gap <= 2 * w)
        yield w, at[chosen[:-1][pair]], gap[pair]
        w *= 2


def _equal_until(ids: np.ndarray, at: int, d: int, end: int) -> int:
    """The first place from ``at`` whose word differs from that d on, or the last place that has one."""
    last, block = end - d, 64
    while at < last:
        n = min(block, last - at)
        differs = ids[at : at + n] != ids[at + d : at + d + n]
        if differs.any():
            return at + int(differs.argmax())
        at, block = at + n, block * 2
    return last


def _equal_from(ids: np.ndarray, at: int, d: int, begin: int) -> int:
    """The first place of the stretch before ``at`` whose words equal those d on."""
    block = 64
    while at > begin:
        n = min(block, at - begin)
        differs = ids[at - n : at] != ids[at - n + d : at + d]
        if differs.any():
            return at - int(differs[::-1].argmax())
        at, block = at - n, block * 2
    return begin


def runs_of(ids: np.ndarray, bounds: np.ndarray, min_length: int = 6, exponent: int = 4) -> np.ndarray:
    """(text, start, length, period) of every run of texts lying one after the other, in this order of columns."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    found = []
    for q in range(1, min(DIRECT, len(ids) - 1) + 1):
        mask = (ids[q:] == ids[:-q]) & (ends[q:] == ends[:-q])
        first, after = _stretches(mask)
        enough = after - first >= max(min_length, exponent * q) - q
        for a, b in zip(first[enough].tolist(), after[enough].tolist(), strict=True):
            if q == 1 or not has_smaller_period(ids[a : a + q]):
                found.append((a, b - a + q, q))
    for _, places, gaps in seeds(ids, bounds, exponent):
        order = np.lexsort((places, gaps))
        done = (0, 0)  # distance and end of the stretch last extended
        for at, d in zip(places[order].tolist(), gaps[order].tolist(), strict=True):
            if done[0] == d and at < done[1]:
                continue
            text = int(np.searchsorted(bounds, at, side="right")) - 1
            a, b = _equal_from(ids, at, d, int(bounds[text])), _equal_until(ids, at, d, int(bounds[text + 1]))
            done = d, b
            if b - a >= max(min_length, exponent * d) - d and not has_smaller_period(ids[a : a + d]):
                found.append((a, b - a + d, d))
    if not found:
        return np.zeros((0, 4), np.int64)
    made = np.array(sorted(set(found), key=lambda r: (r[0], r[2])), np.int64)
    text = np.searchsorted(bounds, made[:, 0], side="right") - 1
    return np.stack([text, made[:, 0] - bounds[text], made[:, 1], made[:, 2]], axis=1)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run (start, length, period) keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _searched(texts: list[list[bytes]], min_length: int, exponent: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text's words: its runs, and the kept words joined by a space."""
    number = defaultdict(count().__next__)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
    ids = np.concatenate([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in texts])
    runs = runs_of(ids, bounds, min_length, exponent)
    cuts = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    for i, w in enumerate(texts):
        own = runs[cuts[i] : cuts[i + 1], 1:]
        if len(own):
            keep = kept_words(len(w), own)
            w = [w[j] for j in np.flatnonzero(keep).tolist()]
        yield own, b" ".join(w)


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None, min_length: int = 6,
              min_exponent: int = 4) -> DataFrame:
    """(keep..., n_words, runs, collapsed): the runs of every text and the text without their repetitions.

    ``runs`` has (start, length, period) in words from 0, by start, then
    period; ``collapsed`` joins by one space the words that no run repeats.
    """
    if min_exponent < 4:
        raise ValueError("minimizers are sure to meet runs of four periods or more")
    made = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    names = [f.name for f in made]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]

    def search(batch: pa.RecordBatch):
        held, n, sizes, runs, left = [], 0, [], [], []

        def flush():
            for own, joined in _searched(held, min_length, min_exponent):
                runs.append(own)
                left.append(joined)

        for value in batch.column(0).cast(pa.binary()):
            said = (value.as_py() or b"").split()  # bytes split at ASCII white space only
            if n and n + len(said) > TOGETHER:
                flush()
                held, n = [], 0
            held.append(said)
            n += len(said)
            sizes.append(len(said))
        flush()
        every = np.concatenate(runs)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
        parts = pa.StructArray.from_arrays([pa.array(every[:, i], pa.int64()) for i in range(3)], fields=list(RUN))
        return [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts),
                pa.array(left, pa.binary()).cast(pa.string())]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                arrays = [batch.column(i + 1) for i in range(len(kept))] + search(batch)
                yield pa.RecordBatch.from_arrays(arrays, names=kept + names)

    said = "__".join(["text", *docs.columns])  # a name no column has
    schema = T.StructType([docs.schema[c] for c in kept] + made)
    return docs.select(F.col(text).alias(said), *[F.col(c) for c in kept]).mapInArrow(run, schema)
