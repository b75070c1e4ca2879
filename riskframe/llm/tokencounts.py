"""Token counts by a two-tier lookup of pre-token lengths, without encoding whole texts.

1. Every task counts its pre-tokens in a bounded summary of frequent items
   (Misra-Gries); the summaries, one row each, are merged in two steps. What
   occurs in more than 1/``SUMMARY`` of all pre-tokens is sure to be kept.
2. The ``TABLE`` most frequent pre-tokens are encoded once, and their token
   counts go to every task as one joined text and one array of lengths.
3. A text's count is the sum over its pre-tokens: looked up in that table, then
   in the worker's cache, then encoded by the library. No pre-token is shuffled.

The byte-level library encodes every pre-token by itself, so the sum is exact.
Its pattern and this module's regular expressions know different versions of
Unicode: a text with a character that they class differently (found by
comparing the two over all code points) is encoded whole.

Contract for unusual input: a null text counts as the empty text, which has no
bytes and no tokens; nulls elsewhere pass through; rows that repeat are counted
each; strings of special tokens inside a text count as the library reads them
by default, one token each; empty tables stay empty; columns whose names clash
with an output are replaced by it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

#: Entries of a task's summary, and of the broadcast table.
SUMMARY = 1 << 14
TABLE = 1 << 15
#: Pre-tokens a worker remembers besides the table, and the longest it remembers.
CACHE, LONGEST = 1 << 17, 64
#: Summaries merged by one task.
FAN = 256
#: Longer texts are cut before white space, where no pre-token crosses.
PIECE = 1 << 16
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_PARTS = "part int, names string, ends binary, counts binary"


def _letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on, in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Splitter:
    """How one tokenizer file cuts a text: special tokens first, then pre-tokens."""

    def __init__(self, file: str, pattern: str):
        self.library = Tokenizer.from_file(file)
        kinds = [a for a in self.library.get_added_tokens_decoder().values()]
        plain = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in kinds)
        if self.library.normalizer is not None or not plain:
            raise ValueError("pre-token lengths add up only without a normalizer and with plain special tokens")
        names = sorted((a.content for a in kinds), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.pattern = regex.compile(pattern)
        self.letters = _letters()

    def encoded(self, texts: list[str]) -> list[int]:
        """The library's own counts."""
        return [len(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def length(self, piece: str) -> int:
        """Tokens of one pre-token, by the library's merges alone."""
        return len(self.library.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Lists of consecutive pre-tokens of a text without special tokens."""
        at = 0
        while len(text) - at > PIECE:
            cut = _CUT.search(text, at + PIECE)
            if cut is None:
                break
            yield self.pattern.findall(text[at : cut.start()])
            at = cut.start()
        yield self.pattern.findall(text[at:] if at else text)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """How many special tokens there are, and the texts between them."""
        if self.special is None or not self.special.search(text):
            return 0, [text]
        between = self.special.split(text)
        return len(between) - 1, between


@lru_cache(maxsize=4)
def splitter(file: str, pattern: str) -> Splitter:
    """One per Python process."""
    return Splitter(file, pattern)


@lru_cache(maxsize=4)
def disagreements(file: str, pattern: str) -> tuple[str, str] | None:
    """The least code point that the library's split and the pattern class differently, and a class of all of them."""
    s = splitter(file, pattern)

    def differ(anchor: str, points: str) -> bool:
        """Characters of one class after an anchor of that class are one pre-token."""
        return len(s.library.pre_tokenizer.pre_tokenize_str(anchor + points)) > 1

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = []
    for anchor, kind in (("a", r"\p{L}"), ("1", r"\p{N}"), ("\n", r"\s"), (".", r"[^\s\p{L}\p{N}]")):
        own = "".join(regex.findall(kind, every))
        stack = [own[i : i + 4096] for i in range(0, len(own), 4096)]
        while stack:
            points = stack.pop()
            if differ(anchor, points):
                half = len(points) // 2
                if half:
                    stack += [points[half:], points[:half]]
                else:
                    found.append(ord(points))
    found.sort()
    runs = []
    for c in found:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return (chr(found[0]), "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]") if runs else None


def lessened(counts: Counter, size: int) -> Counter:
    """At most ``size`` items: all counts less the largest of those left out (Misra and Gries)."""
    if len(counts) <= size:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    off = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return Counter({k: n - off for k, n in counts.items() if n > off})


def _packed(part: int, counts: Counter) -> dict:
    names = list(counts)
    ends = np.cumsum([len(k) for k in names], dtype=np.int64)
    return {"part": [part], "names": ["".join(names)], "ends": [ends.tobytes()],
            "counts": [np.fromiter(counts.values(), np.int64, len(names)).tobytes()]}


def unpacked(names: str, ends: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, int]]:
    at = 0
    for end, value in zip(ends.tolist(), values.tolist(), strict=True):
        yield names[at:end], value
        at = end


def frequent(docs: DataFrame, text: str, file: str, pattern: str, size: int = TABLE) -> list[tuple[str, int]]:
    """The most frequent pre-tokens of all texts and their counts, which err by at most total / ``SUMMARY`` each merge."""

    def count(batches):
        s, held = splitter(file, pattern), Counter()
        for batch in batches:
            for value in batch.column(0):
                for between in s.parts(value.as_py() or "")[1]:
                    for found in s.pieces(between):
                        long = max(map(len, found), default=0) > LONGEST
                        held.update([k for k in found if len(k) <= LONGEST] if long else found)
                if len(held) > 16 * SUMMARY:
                    held = lessened(held, SUMMARY)
        held = lessened(held, SUMMARY)
        task = TaskContext.get()
        yield pa.RecordBatch.from_pydict(_packed(task.partitionId() // FAN if task else 0, held),
                                         schema=pa.schema([("part", pa.int32()), ("names", pa.string()),
                                                           ("ends", pa.binary()), ("counts", pa.binary())]))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        held = Counter()
        for r in rows.itertuples():
            for k, n in unpacked(r.names, np.frombuffer(r.ends, np.int64), np.frombuffer(r.counts, np.int64)):
                held[k] += n
            if len(held) > 16 * SUMMARY:
                held = lessened(held, 4 * SUMMARY)
        return pd.DataFrame(_packed(int(rows["part"].iloc[0]) // FAN, lessened(held, 4 * SUMMARY)))

    level = docs.select(text).mapInArrow(count, _PARTS)
    for _ in range(3):  # enough for FAN ** 3 tasks
        level = level.groupBy("part").applyInPandas(merge, _PARTS)
    held = Counter()
    for r in level.collect():  # one summary, of at most 4 * SUMMARY short items
        held.update(dict(unpacked(r["names"], np.frombuffer(r["ends"], np.int64), np.frombuffer(r["counts"], np.int64))))
    return sorted(held.items(), key=lambda p: (-p[1], p[0]))[:size]


class Lengths(dict):
    """Token counts by pre-token: the broadcast table, then what this worker has met."""

    def __init__(self, s: Splitter, names: str, ends: np.ndarray, lengths: np.ndarray):
        super().__init__(unpacked(names, ends, lengths))
        self.splitter, self.most = s, len(self) + CACHE
        self.table = names, ends, lengths

    def __missing__(self, piece: str) -> int:
        n = self.splitter.length(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(unpacked(*self.table))
            self[piece] = n
        return n


def count_tokens(docs: DataFrame, file: str, pattern: str, text: str = "text", limit: int = 512,
                 keep: list[str] | None = None) -> DataFrame:
    """(keep..., n_bytes, n_tokens, over_limit): for each text, and whether its tokens exceed ``limit``.

    ``keep`` names the columns that go along; without it, all do.
    """
    made = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType())]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in made}]
    top = [k for k, _ in frequent(docs, text, file, pattern)]
    s = splitter(file, pattern)
    table = ("".join(top), np.cumsum([len(k) for k in top], dtype=np.int64),
             np.array(s.encoded(top) if top else [], dtype=np.int16))
    odd = disagreements(file, pattern)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # TABLE pre-tokens of at most LONGEST characters

    def run(batches):
        s = splitter(file, pattern)
        lengths = Lengths(s, *shared.value)
        beyond, differs = (re.compile(f"[{odd[0]}-\U0010ffff]"), re.compile(odd[1])) if odd else (None, None)
        for batch in batches:
            counts = []
            for value in batch.column(0):
                said = value.as_py() or ""
                if beyond and beyond.search(said) and differs.search(said):
                    counts.append(s.encoded([said])[0])
                    continue
                n, between = s.parts(said)
                for part in between:
                    for found in s.pieces(part):
                        n += sum(map(lengths.__getitem__, found))
                counts.append(n)
            n = pa.array(counts, pa.int64())
            arrays = [batch.column(i + 1) for i in range(len(kept) + 1)]
            yield pa.RecordBatch.from_arrays([*arrays, n], names=[*kept, "n_bytes", "n_tokens"])

    schema = T.StructType([docs.schema[c] for c in kept] + made[:2])
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    said = "__".join(["text", *docs.columns])  # a name no column has
    counted = docs.select(F.col(text).alias(said), *[F.col(c) for c in kept], n_bytes).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
