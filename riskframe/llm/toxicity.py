"""Toxicity by nearest labelled examples under exact weighted TF-IDF cosine.

The vector space has every word of every text, each weighted by its document
frequency over *all* documents; words whose shares of the two classes of examples
surely differ weigh more, by the logarithm of their ratio (``telling``), so that the
nearest examples are those of a text's tone and not of its subject. The labelled examples form an inverted index of
all their words: the ``COMMON`` words that most examples have lie in dense blocks
of examples, with the largest weight of every word in every block, and all other
words in postings. A document's products over the postings are added first; with
the maxima they bound its products with a block, blocks are read from the highest
bound on and skipped once the bound is below the document's k-th product, so the
neighbours found are exact. A document's words that no example has only lengthen
its vector: their frequencies are counted in hash buckets (``other_lengths``). The
neighbours' votes, weighted by distance, are calibrated on the examples themselves
(each without itself).

At most ``per_class`` examples of either class are indexed (a parameter).

Contract for unusual input: a null or empty text, or one without a word of the
examples, has no neighbour and gets the calibrated score of "no evidence"; labels
other than 0 and 1 and null ids take no part; without examples of both classes
every score is the share of class 1 (0.5 without any); equally near examples
are taken in index order; repeated rows are scored each; empty tables give no
rows; further columns of either table are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import words
from riskframe.llm.frames import (
    TABLE_SCHEMA, fold, labelled_sample, logistic, map_column, platt, summed, table_rows, trimmed,
)
from riskframe.session import durable

PER_CLASS = 3000
#: Words whose weights lie in dense blocks; all others have postings.
COMMON = 1024
NEIGHBOURS = 15
EXAMPLES_IN_BLOCK = 64
ROWS_AT_ONCE = 256
#: The same for the examples themselves, in the driver.
FEW_ROWS = 64
POSTINGS_AT_ONCE = 1 << 21
#: Standard errors between the shares of a word in the two classes that make the difference sure, among some 100,000 words.
SURE = 5
#: Documents (a power of two) that ask for the frequencies of their other words together.
ASK_BITS = 12


def counted(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs by row and key, and how often each occurs."""
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    return rows[at], keys[at], np.diff(np.append(at, len(rows)))


def term_counts(column: pa.Array, terms: np.ndarray):
    """Per chunk: its rows, and of all rows the (row, place, count) of the (sorted) terms and (row, hash, count) of other words."""
    for t in words.tokens(column, words.WORDS_AND_MARKS):
        at = np.searchsorted(terms, t.hashes)
        known = np.zeros(len(at), dtype=bool)
        inside = at < len(terms)
        known[inside] = terms[at[inside]] == t.hashes[inside]
        row = t.row_of()
        pairs, n = np.unique(row[known] * max(len(terms), 1) + at[known], return_counts=True)
        yield t.rows, (pairs // max(len(terms), 1), pairs % max(len(terms), 1), n), counted(row[~known], t.hashes[~known])


@dataclass(frozen=True)
class Index:
    """Words, their idf times what they tell, and the examples' weights: common words by block, with block maxima, others in postings."""

    terms: np.ndarray
    idf: np.ndarray
    blocks: list[np.ndarray]
    maxima: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    slope: float
    offset: float
    nothing: float
    #: Every word's column in the blocks, or -1: then its postings are starts[word]:starts[word + 1].
    column: np.ndarray | None = None
    starts: np.ndarray | None = None
    members: np.ndarray | None = None
    weights: np.ndarray | None = None

    def nearest(self, q: np.ndarray, k: int, own: np.ndarray | None = None,
                rest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k best positive products of every row and their examples (-1: fewer).

        ``q`` has the weights of the common words, ``rest`` the products over the others.
        """
        n, edges = len(q), np.cumsum([0, *(b.shape[1] for b in self.blocks)])
        bounds = q @ self.maxima.T
        if rest is not None and len(self.blocks):
            bounds += np.maximum.reduceat(rest, edges[:-1], axis=1)
        found, top, least = np.zeros((n, edges[-1])), np.zeros((n, k)), np.zeros(n)
        for b in np.argsort(-bounds.max(axis=0, initial=0), kind="stable"):
            # A little below the k-th, so that rounding loses no equally near example.
            live = np.flatnonzero(bounds[:, b] >= np.maximum(least * (1 - 1e-9), 1e-9))
            if not len(live):
                continue
            product = (q if len(live) == n else q[live]) @ self.blocks[b]
            if rest is not None:
                product += rest[live, edges[b] : edges[b + 1]]
            if own is not None:
                product[own[live][:, None] == np.arange(edges[b], edges[b + 1])] = 0
            found[live, edges[b] : edges[b + 1]] = product
            better = product.max(axis=1) > least[live]
            if better.any():
                both = np.concatenate([top[live[better]], product[better]], axis=1)
                top[live[better]] = np.partition(both, -k, axis=1)[:, -k:]
                least[live[better]] = top[live[better]].min(axis=1)
        row, at = np.nonzero((found >= least[:, None] * (1 - 1e-9)) & (found > 1e-9))
        order = np.lexsort((at, -np.round(found[row, at], 9), row))
        row, at = row[order], at[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best, which = np.zeros((n, k)), np.full((n, k), -1)
        some = place < k
        best[row[some], place[some]] = found[row[some], at[some]]
        which[row[some], place[some]] = at[some]
        return best, which

    def parts(self, n: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ``nearest``: the rows' weights of common words, and their products over the other words' postings."""
        q, rest = np.zeros((n, self.maxima.shape[1])), np.zeros(n * len(self.labels))
        column = self.column[term]
        common = column >= 0
        q[row[common], column[common]] = weight[common]
        row, term, weight = row[~common], term[~common], weight[~common]
        size = self.starts[term + 1] - self.starts[term]
        ends = np.cumsum(size)
        low = 0
        while low < len(row):
            before = ends[low] - size[low]
            high = max(low + 1, int(np.searchsorted(ends, before + POSTINGS_AT_ONCE, side="right")))
            own = size[low:high]
            at = np.arange(own.sum()) + np.repeat(self.starts[term[low:high]] - (ends[low:high] - own - before), own)
            cell = np.repeat(row[low:high] * len(self.labels), own) + self.members[at]
            rest += np.bincount(cell, weights=np.repeat(weight[low:high], own) * self.weights[at], minlength=len(rest))
            low = high
        return q, rest.reshape(n, len(self.labels))

    def votes(self, best: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of the votes for class 1, and whether there is any; a vote weighs more the nearer it is."""
        weight = np.where(which >= 0, 1 / (1.02 - np.minimum(best, 1)), 0)
        total = weight.sum(axis=1)
        return (weight * self.labels[which]).sum(axis=1) / np.maximum(total, 1e-12), total > 0

    def products(self, column: pa.Array, k: int):
        """Per chunk: the texts' k best products and their examples, squared length over known words, other words."""
        for rows, (row, term, count), other in term_counts(column, self.terms):
            weight = (1 + np.log(count)) * self.idf[term]
            length = np.bincount(row, weights=weight * weight, minlength=rows)
            best, which = np.zeros((rows, k)), np.full((rows, k), -1)
            for low in range(0, rows if self.blocks else 0, ROWS_AT_ONCE):
                high = min(low + ROWS_AT_ONCE, rows)
                own = slice(*np.searchsorted(row, [low, high]))
                q, rest = self.parts(high - low, row[own] - low, term[own], weight[own])
                best[low:high], which[low:high] = self.nearest(q, k, rest=rest)
            yield best, which, length, other


EVIDENCE = "array<struct<doc_id:long,label:int,cosine:double>>"
OTHER = np.dtype([("hash", np.uint64), ("count", np.float64)])


def document_frequency(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""

    def run(batches):
        count = np.zeros(len(terms) + 1)
        for batch in batches:
            for rows, (_, term, _), _ in term_counts(batch.column(0), terms):
                count[:-1] += np.bincount(term, minlength=len(terms))
                count[-1] += rows
        yield from table_rows(count)
        trimmed()

    total = summed(docs.select(text).mapInArrow(run, TABLE_SCHEMA), len(terms) + 1)
    return total[:-1], int(total[-1])


def inverse(df: np.ndarray, n: int) -> np.ndarray:
    return np.log((1 + n) / (1 + df)) + 1


def telling(row: np.ndarray, term: np.ndarray, y: np.ndarray, terms: int) -> np.ndarray:
    """A factor for every term: 1, and where its shares of the classes surely differ, the logarithm of their ratio more.

    ``row`` and ``term`` are the distinct pairs of an example and a term, ``y`` the examples' classes, of both kinds.
    """
    size = np.bincount(y, minlength=2)
    held = np.stack([np.bincount(term[y[row] == c], minlength=terms) for c in (0, 1)])
    share, whole = held / size[:, None], held.sum(axis=0) / size.sum()
    error = np.sqrt(whole * (1 - whole) * (1 / size).sum())
    ratio = np.log((held[1] + 0.5) / (size[1] + 1)) - np.log((held[0] + 0.5) / (size[0] + 1))
    return 1 + np.where(np.abs(share[1] - share[0]) > SURE * error, np.abs(ratio), 0)


def fit(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS,
        k: int = NEIGHBOURS, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of a bounded sample of labelled examples, weighted by the whole corpus."""
    sample, all_labels = labelled_sample(labels, doc_id, label, per_class)
    texts = docs.select(doc_id, text).join(F.broadcast(durable(sample)), doc_id)

    def words_of(column: pa.Array) -> list:
        keys, counts = [], []
        for t in words.tokens(column, words.WORDS_AND_MARKS):
            row, key, n = counted(t.row_of(), t.hashes)
            cut = np.searchsorted(row, np.arange(1, t.rows))
            keys += [x.tobytes() for x in np.split(key, cut)]
            counts += [x.astype(np.int32).tobytes() for x in np.split(n, cut)]
        return [pa.array(keys, pa.binary()), pa.array(counts, pa.binary())]

    # Distinct words only, so that an example's size is that of its vocabulary.
    found = map_column(texts.withColumn(doc_id, F.col(doc_id).cast("long")), text, [doc_id, "label"],
                       [("words", T.BinaryType()), ("counts", T.BinaryType())], words_of)
    rows = sorted((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in found.toLocalIterator())
    y, ids = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 0))
    row = np.repeat(np.arange(len(y)), [len(r[2]) // 8 for r in rows])
    said = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
    count = np.frombuffer(b"".join(r[3] for r in rows), np.int32)
    del rows
    total = sum(all_labels.values())
    share = all_labels[1] / total if total else 0.5
    terms, term = np.unique(said, return_inverse=True)
    del said
    if len(set(y)) < 2 or not len(terms):
        return Index(terms[:0], np.zeros(0), [], np.zeros((0, 0)), np.zeros(0, np.int64), ids[:0], 0.0, 0.0, share)
    df, n = document_frequency(docs, text, terms)
    idf = inverse(df, n) * telling(row, term, y, len(terms))
    weight = (1 + np.log(count)) * idf[term]
    weight /= np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(y)))[row]
    held = np.bincount(term, minlength=len(terms))
    common = np.lexsort((terms, -held))[:COMMON]
    column = np.full(len(terms), -1)
    column[common] = np.arange(len(common))
    dense = column[term] >= 0
    # Examples with the same leading common word share blocks, which keeps the maxima low.
    lead = np.zeros(len(y), np.int64)
    at = np.lexsort((column[term[dense]], -weight[dense], row[dense]))
    own, first = np.unique(row[dense][at], return_index=True)
    lead[own] = column[term[dense]][at][first]
    order = np.lexsort((y, lead))
    place = np.argsort(order)
    y, ids, row = y[order], ids[order], place[row]
    by_row = np.argsort(row, kind="stable")
    row, term, weight, dense = row[by_row], term[by_row], weight[by_row], dense[by_row]
    blocks = []
    for low in range(0, len(y), EXAMPLES_IN_BLOCK):
        own = slice(*np.searchsorted(row, [low, low + EXAMPLES_IN_BLOCK]))
        some = dense[own]
        block = np.zeros((len(common), min(EXAMPLES_IN_BLOCK, len(y) - low)))
        block[column[term[own][some]], row[own][some] - low] = weight[own][some]
        blocks.append(block)
    by_term = np.lexsort((row[~dense], term[~dense]))
    starts = np.searchsorted(term[~dense][by_term], np.arange(len(terms) + 1))
    index = Index(terms, idf, blocks, np.stack([b.max(axis=1) for b in blocks]), y, ids, 0.0, 0.0, share,
                  column, starts, row[~dense][by_term].astype(np.int32), weight[~dense][by_term])
    best, which = np.zeros((len(y), k)), np.full((len(y), k), -1)
    for low in range(0, len(y), FEW_ROWS):
        high = min(low + FEW_ROWS, len(y))
        own = slice(*np.searchsorted(row, [low, high]))
        q, rest = index.parts(high - low, row[own] - low, term[own], weight[own])
        best[low:high], which[low:high] = index.nearest(q, k, np.arange(low, high), rest)
    votes, some = index.votes(best, which)
    weight = np.array([all_labels[c] / max((y == c).sum(), 1) for c in (0, 1)])[y] / total * len(y)
    slope, offset = platt(votes[some] - 0.5, y[some], weight[some]) if some.any() else (0.0, 0.0)
    none = ~some
    nothing = float(((weight * y)[none].sum() + share) / (weight[none].sum() + 1))
    return replace(index, slope=slope, offset=offset, nothing=nothing)


def other_lengths(found: DataFrame) -> DataFrame:
    """(row, other_length): squared length of every document over the words that no example has.

    Blocks of documents send each bucket of hashes their distinct words once, with the number of
    their documents that have it, and get the sums over all blocks back; so a word in every
    document makes one entry a block.
    """
    size = OTHER.itemsize
    n, entries = found.agg(F.count("*"), F.sum(F.length("other"))).first()
    buckets = max(4, int((entries or 0) // size) >> 19)

    def ask(batches):
        for batch in batches:
            block = batch.column(1).to_numpy() >> ASK_BITS
            pieces = [np.frombuffer(x.as_py(), OTHER)["hash"] for x in batch.column(0)]
            own, keys, count = counted(np.repeat(block, [len(p) for p in pieces]), np.concatenate([np.zeros(0, np.uint64), *pieces]))
            # All bits of a word's hash are mixed; the low ones name its bucket.
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((own, bucket))
            own, keys, count, bucket = own[order], keys[order], count[order], bucket[order]
            new = np.ones(len(own), dtype=bool)
            new[1:] = (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])
            cut = np.flatnonzero(new)
            spans = list(zip(cut, np.append(cut[1:], len(own)), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut].astype(np.int32)), pa.array(own[cut]),
                 pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([count[a:b].astype(np.int64).tobytes() for a, b in spans], pa.binary())],
                names=["bucket", "block", "keys", "counts"],
            )
        trimmed()

    def answer(asked: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(b, np.uint64) for b in asked["keys"]]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        df = np.bincount(at, weights=np.concatenate([np.frombuffer(b, np.int64) for b in asked["counts"]]))[at]
        cut = np.cumsum([0, *(len(x) for x in keys)])
        return pd.DataFrame({"block": asked["block"], "keys": asked["keys"],
                             "df": [df[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]})

    def lengths(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys, first = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(b, np.uint64) for b in known["keys"])]),
                                return_index=True)
        df = np.concatenate([np.zeros(0), *(np.frombuffer(b) for b in known["df"])])[first]
        own = [np.frombuffer(b, OTHER) for b in docs["other"]]
        said = np.concatenate([np.zeros(0, OTHER), *own])
        weight = (1 + np.log(said["count"])) * inverse(df[np.searchsorted(keys, said["hash"])], n)
        place = np.repeat(np.arange(len(own)), [len(x) for x in own])
        return pd.DataFrame({"row": docs["row"], "other_length": np.bincount(place, weights=weight * weight, minlength=len(own))})

    some = found.where(F.length("other") > 0).select("other", "row")
    answers = (
        some.mapInArrow(ask, "bucket int, block long, keys binary, counts binary")
        .groupBy("bucket").applyInPandas(answer, "block long, keys binary, df binary")
    )
    return (
        some.select(F.col("row").alias("row"), F.col("other").alias("other"), F.shiftright("row", ASK_BITS).alias("block"))
        .groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(lengths, "row long, other_length double")
    )


def score(docs: DataFrame, index: Index, keep: list[str], k: int = NEIGHBOURS, text: str = "text",
          out: tuple[str, str] = ("score", "evidence")) -> DataFrame:
    """(keep..., score, evidence): calibrated probability of class 1 and the three nearest examples.

    ``docs`` are all the documents of ``fit``; what is kept of them is stored, so keep narrow columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most 2 * per_class examples, all their words
    light = docs.sparkSession.sparkContext.broadcast(
        replace(index, terms=None, idf=None, blocks=[], maxima=None, column=None, starts=None, members=None, weights=None)
    )
    kind = T._parse_datatype_string(EVIDENCE)

    def neighbours(column: pa.Array) -> list:
        best, which, length, other = [], [], [], []
        for b, w, own, (row, key, count) in shared.value.products(column, k):
            best += [x.tobytes() for x in b]
            which += [x.tobytes() for x in w.astype(np.int32)]
            length.append(own)
            said = np.empty(len(row), OTHER)
            said["hash"], said["count"] = key, count
            cut = np.searchsorted(row, np.arange(len(own) + 1))
            other += [said[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
        return [pa.array(best, pa.binary()), pa.array(which, pa.binary()),
                pa.array(np.concatenate(length) if length else np.zeros(0), pa.float64()), pa.array(other, pa.binary())]

    def judge(batches):
        own = light.value
        for batch in batches:
            best, which, length = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            best = np.frombuffer(b"".join(best.to_pylist())).reshape(len(batch), k)
            which = np.frombuffer(b"".join(which.to_pylist()), np.int32).reshape(len(batch), k)
            best = np.minimum(best / np.sqrt(np.maximum(length, 1e-300))[:, None], 1)
            share, some = own.votes(best, which) if len(own.labels) else (np.zeros(len(batch)), np.zeros(len(batch), bool))
            scores = np.where(some, logistic(own.slope * (share - 0.5) + own.offset), own.nothing)
            evidence = [
                [{"doc_id": int(own.ids[i]), "label": int(own.labels[i]), "cosine": float(c)} for c, i in zip(b, w, strict=True) if i >= 0]
                for b, w in zip(best[:, :3], which[:, :3], strict=True)
            ]
            fields = pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                batch.columns[3:] + [pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(fields))], names=[*keep, *out],
            )
        trimmed()

    made = [("best", T.BinaryType()), ("which", T.BinaryType()), ("length", T.DoubleType()), ("other", T.BinaryType())]
    plain = [f"kept_{i}" for i in range(len(keep))]
    renamed = docs.select(F.col(text).alias("text"), *[F.col(c).alias(p) for c, p in zip(keep, plain, strict=True)])
    found = durable(map_column(renamed, "text", plain, made, neighbours)).withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out[0], T.DoubleType()), T.StructField(out[1], kind)])
    return found.drop("other").join(other_lengths(found), "row", "left").select(
        "best", "which", (F.col("length") + F.coalesce("other_length", F.lit(0.0))).alias("length"), *plain,
    ).mapInArrow(judge, schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held: int = 1,
             threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every document; held-out labels are not read."""
    index = fit(docs, labels.where(fold(doc_id, folds) != held), label, doc_id=doc_id, text=text)
    return score(docs, index, [doc_id], text=text).select(
        doc_id, (fold(doc_id, folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence",
    )
