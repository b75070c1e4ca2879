"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

1. Words of all training documents are counted in buckets of their hashes; the
   most frequent ones (``HEAD`` at most) are known to every task, the others stay
   in their buckets and are joined there.
2. The ``MODEL`` most frequent words are clustered by the words they follow, over
   all training bigrams; the end of a text is a class, and the other words form
   four classes by their form. P(word | history) = P(class | history) *
   P(word | class). The latter is the word's smoothed share of the class's count
   and is not learnt: it does not depend on the history.
3. P(class | history) is a log-linear model over n-gram and skip features of the
   last three words, in a hashed table. Tasks run gradient steps over their part of
   the corpus; their tables are averaged, each row by how often a task met it.
   ``ROUNDS`` slices of the training documents make one pass over all of them.
4. Every document is scored in numpy batches from the table.

Contract for unusual input: a null text is empty; an empty text is just an end;
rows that repeat an id are scored (and learned from) each; a null id counts as
the empty text in the fold; with no training document every token is unknown;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words
from riskframe.llm.frames import TABLE_SCHEMA, fold, renewed, summed, table_rows
from riskframe.session import durable

HEAD = 1 << 16
MODEL = 1 << 13
CLASSES = 32
END_CLASS, TAILS = 27, 28
CONTEXTS = 64
HASHED = 1 << 14
ROUNDS = 3
STEP = 8192
RATE = 0.15
ADDED = 0.1
END = np.uint64(0xE4D00000E4D00000)
START = np.uint64(0x57A2700057A27000)
#: Rows of the table: constant, last word, the one before it, hashed n-grams and skips.
_SLOTS = MODEL + 6
ROWS = 1 + 2 * _SLOTS + HASHED
FEATURES = 6


def keyed(column: pa.Array):
    """Chunk by chunk: (first row, word keys with an end after every text, bounds by row).

    The two lowest bits of a key tell a word's form: whether it has bytes over
    0x7F, and whether its last byte is a mark.
    """
    for t in words.tokens(column, words.SPACED, forms=True):
        rows = t.rows
        keys = np.insert((t.hashes & ~np.uint64(3)) | t.forms.astype(np.uint64), t.bounds[1:], END)
        yield t.first, keys, t.bounds + np.arange(rows + 1)


def buckets_for(total: int) -> int:
    """Bits of the hash that name a bucket, for about 2^18 words in each."""
    return max(4, int(np.ceil(np.log2(max(total, 1) / (1 << 18) + 1))))


def packed(bucket: np.ndarray, *columns: np.ndarray):
    """(bucket, blob per column) for each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    edges = np.append(cut, len(bucket))
    arrays = [pa.array(bucket[cut].astype(np.int32))]
    arrays += [pa.array([c[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()) for c in columns]
    return arrays


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights=counts, minlength=len(found)).astype(np.int64)


def count_words(train: DataFrame, text: str, bits: int) -> DataFrame:
    """(bucket, keys, counts): sorted keys and counts of all training tokens, in hash buckets."""

    def run(batches):
        held, n = [], 0

        def flush():
            keys, counts = merged(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
            return pa.RecordBatch.from_arrays(packed(bucket, keys, counts), names=["bucket", "keys", "counts"])

        for batch in batches:
            for _, keys, _ in keyed(batch.column(0)):
                held.append(np.unique(keys, return_counts=True))
                n += len(held[-1][0])
                if n > 1 << 22:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merged(np.concatenate([np.frombuffer(b, np.uint64) for b in rows["keys"]]),
                              np.concatenate([np.frombuffer(b, np.int64) for b in rows["counts"]]))
        return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "keys": [keys.tobytes()], "counts": [counts.tobytes()]})

    schema = "bucket int, keys binary, counts binary"
    return durable(train.select(text).mapInArrow(run, schema).groupBy("bucket").applyInPandas(add, schema))


@dataclass(frozen=True)
class Vocabulary:
    """Head words in key order with counts, their class and model number, and totals of all words."""

    keys: np.ndarray
    counts: np.ndarray
    number: np.ndarray
    classes: np.ndarray
    total: int
    distinct: int
    mass: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the head words, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def head_words(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int, np.ndarray]:
    """(keys, counts) of the end and at most HEAD frequent words; all tokens, all words, and both by form."""
    fine = 4

    def weigh(batches):
        table = np.zeros(64 * fine + 2 + 8)
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys, counts = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                table[: 64 * fine] += np.bincount((np.log2(counts) * fine).astype(int), minlength=64 * fine)
                table[64 * fine] += counts.sum()
                table[64 * fine + 1] += len(keys)
                form = (keys & np.uint64(3)).astype(int)
                table[64 * fine + 2 : 64 * fine + 6] += np.bincount(form, weights=counts, minlength=4)
                table[64 * fine + 6 :] += np.bincount(form, minlength=4)
        yield from table_rows(table)

    table = summed(counted.select("keys", "counts").mapInArrow(weigh, TABLE_SCHEMA), 64 * fine + 10)
    above = np.cumsum(table[: 64 * fine][::-1])[::-1]
    least = int(np.argmax(above <= HEAD)) if (above <= HEAD).any() else 64 * fine

    def pick(batches):
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys, counts = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                some = ((np.log2(counts) * fine).astype(int) >= least) | (keys == END)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[some].tobytes()], pa.binary()), pa.array([counts[some].tobytes()], pa.binary())],
                    names=["keys", "counts"],
                )

    rows = counted.select("keys", "counts").mapInArrow(pick, "keys binary, counts binary").collect()
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(bytes(r[0]), np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(bytes(r[1]), np.int64) for r in rows)])
    order = np.argsort(keys)
    return keys[order], counts[order], int(table[64 * fine]), int(table[64 * fine + 1]), table[64 * fine + 2 :]


def vocabulary(train: DataFrame, counted: DataFrame, text: str) -> Vocabulary:
    """Head words with classes found from the words they follow, over all training bigrams."""
    keys, counts, total, distinct, by_form = head_words(counted)
    order = np.lexsort((keys, -counts))
    order = order[keys[order] != END][:MODEL]
    number = np.full(len(keys) + 1, -1)  # the last one stands for words not found
    number[order] = np.arange(len(order))
    context = np.full(len(keys) + 1, CONTEXTS - 1)
    context[order[: CONTEXTS - 2]] = np.arange(min(CONTEXTS - 2, len(order)))
    blank = Vocabulary(keys, counts, number, number, total, distinct, np.zeros(0))
    shared = train.sparkSession.sparkContext.broadcast((blank, context))  # HEAD words at most

    def follow(batches):
        vocab, context = shared.value
        table = np.zeros(MODEL * CONTEXTS, np.float32)
        for batch in batches:
            for _, keys, bounds in keyed(batch.column(0)):
                at = vocab.find(keys)
                before = np.concatenate([[CONTEXTS - 2], context[at[:-1]]])
                before[bounds[:-1]] = CONTEXTS - 2
                n = vocab.number[at]
                some = n >= 0
                table += np.bincount(n[some] * CONTEXTS + before[some], minlength=len(table)).astype(np.float32)
        yield from table_rows(table)

    follows = summed(train.select(text).mapInArrow(follow, TABLE_SCHEMA), MODEL * CONTEXTS, np.float32)
    cluster = clustered(follows.reshape(MODEL, CONTEXTS)[: len(order)], END_CLASS)
    classes = np.where(number >= 0, 0, TAILS + (np.append(keys, END) & np.uint64(3)).astype(int))
    classes[order] = cluster
    classes[:-1][keys == END] = END_CLASS
    mass = np.zeros(CLASSES)
    # A tail class holds all words of its form but the model's, and one unknown word.
    modelled = classes[:-1] < TAILS
    mass[:TAILS] = np.bincount(classes[:-1][modelled], weights=counts[modelled] + ADDED, minlength=TAILS)[:TAILS]
    form = (keys[modelled] & np.uint64(3)).astype(int)
    mass[TAILS:] = (by_form[:4] - np.bincount(form, weights=counts[modelled], minlength=4)
                    + ADDED * (by_form[4:] - np.bincount(form, minlength=4) + 1))
    return Vocabulary(keys, counts, number, classes, total, distinct, np.maximum(mass, ADDED))


def clustered(follows: np.ndarray, groups: int, steps: int = 12) -> np.ndarray:
    """Spherical k-means of the words' distributions over the words before them."""
    if len(follows) <= groups:
        return np.arange(len(follows))
    x = np.sqrt(follows / np.maximum(follows.sum(axis=1, keepdims=True), 1))
    common = np.sqrt(follows.sum(axis=0) / max(follows.sum(), 1))
    x = x - common
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    weight = np.log1p(follows.sum(axis=1))
    # Start from words far from all chosen so far, frequent ones first.
    centres = [x[0]]
    nearest = x @ x[0]
    for _ in range(groups - 1):
        centres.append(x[int(np.argmax((1 - nearest) * weight))])
        nearest = np.maximum(nearest, x @ centres[-1])
    centres = np.stack(centres)
    for _ in range(steps):
        own = (x @ centres.T).argmax(axis=1)
        for g in range(groups):
            if (own == g).any():
                c = (x[own == g] * weight[own == g, None]).sum(axis=0)
                centres[g] = c / max(np.linalg.norm(c), 1e-9)
    return (x @ centres.T).argmax(axis=1)


def features(vocab: Vocabulary, keys: np.ndarray, bounds: np.ndarray):
    """(table rows of every token's history, place among the head words)."""
    at = vocab.find(keys)
    form = (keys & np.uint64(3)).astype(np.int64)
    number = vocab.number[at]
    slot = np.where(number >= 0, number, MODEL + form)
    inside = np.arange(len(keys)) - np.repeat(bounds[:-1], np.diff(bounds))
    back_slot, back_key = [], []
    for k in (1, 2, 3):
        s, w = np.full(len(keys), MODEL + 4), np.full(len(keys), START)
        ok = np.flatnonzero(inside >= k)
        s[ok], w[ok] = slot[ok - k], keys[ok - k]
        back_slot.append(s)
        back_key.append(w)

    def hashed(salt: int, *parts: np.ndarray) -> np.ndarray:
        x = np.full(len(keys), np.uint64(salt))
        for p in parts:
            x = words.mixed(x * np.uint64(0x2545F4914F6CDD1D) + p)
        return 1 + 2 * _SLOTS + (x % np.uint64(HASHED)).astype(np.int64)

    one, two, three = back_key
    rows = np.stack([
        np.zeros(len(keys), np.int64), 1 + back_slot[0], 1 + _SLOTS + back_slot[1],
        hashed(1, one, two), hashed(2, one, three), hashed(3, one, two, three),
    ], axis=1)
    return rows, at


def target(vocab: Vocabulary, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The class of every token."""
    tail = TAILS + (keys & np.uint64(3)).astype(np.int64)
    found = np.where(at >= 0, vocab.classes[at], tail)
    return np.where(keys == END, END_CLASS, found)


def log_softmax(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = np.take(table, rows[:, 0], axis=0)
    for j in range(1, rows.shape[1]):
        z += np.take(table, rows[:, j], axis=0)
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def learn(table: np.ndarray, batches, vocab: Vocabulary):
    """Gradient steps from ``table``: (change of every row times its uses, uses)."""
    own, squares = table.copy(), np.full(ROWS, 1e-2, np.float32)
    uses = np.zeros(ROWS, np.float32)
    for batch in batches:
        for _, keys, bounds in keyed(batch.column(0)):
            rows, at = features(vocab, keys, bounds)
            y = target(vocab, keys, at)
            for low in range(0, len(keys), STEP):
                r, t = rows[low : low + STEP], y[low : low + STEP]
                g = np.exp(log_softmax(own, r))
                g[np.arange(len(t)), t] -= 1
                # The constant is in every history; 16-bit rows are sorted by radix.
                flat = r[:, 1:].astype(np.uint16).ravel()
                order = np.argsort(flat, kind="stable")
                flat = flat[order]
                starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
                touched = np.append(flat[starts], 0).astype(np.int64)
                n = np.append(np.diff(np.append(starts, len(flat))), len(t)).astype(np.float32)
                sums = np.add.reduceat(np.take(g, order // (FEATURES - 1), axis=0), starts, axis=0)
                step = np.concatenate([sums, g.sum(axis=0, keepdims=True)]) / np.sqrt(n)[:, None]
                squares[touched] += (step * step).mean(axis=1)
                own[touched] -= RATE * step / np.sqrt(squares[touched])[:, None]
                uses[touched] += n
    return (own - table) * uses[:, None], uses


def train_table(train: DataFrame, vocab: Vocabulary, text: str, doc_id: str, rounds: int = ROUNDS) -> np.ndarray:
    """The table after one pass over all training documents, in ``rounds`` slices."""
    spark = train.sparkSession
    table = np.zeros((ROWS, CLASSES), np.float32)
    share = np.bincount(vocab.classes[:-1], weights=vocab.counts, minlength=CLASSES)[:CLASSES]
    table[0] = np.log((share + 1) / (share.sum() + CLASSES))
    for n in range(rounds):
        shared = spark.sparkContext.broadcast((table, vocab))

        def run(batches, shared=shared):
            table, vocab = shared.value
            change, uses = learn(table, batches, vocab)
            yield from table_rows(np.concatenate([change, uses[:, None]], axis=1).astype(np.float32))

        part = train.where(F.pmod(F.xxhash64(doc_id), F.lit(rounds)) == n).select(text)
        total = summed(part.mapInArrow(run, TABLE_SCHEMA), ROWS * (CLASSES + 1), np.float32).reshape(ROWS, CLASSES + 1)
        table = table + total[:, :-1] / np.maximum(total[:, -1:], 1)
        shared.unpersist()
    return table


def score_heads(docs: DataFrame, vocab: Vocabulary, table: np.ndarray, doc_id: str, text: str, held) -> DataFrame:
    """Per document: sums over its head words and class probabilities, and the keys of its other words."""
    shared = docs.sparkSession.sparkContext.broadcast((table, vocab))

    def run(batches):
        table, vocab = shared.value
        word = np.log10(np.append(vocab.counts, 0) + ADDED)
        share = np.log10(np.maximum(vocab.mass, 1e-300))
        for batch in batches:
            out = [[], [], [], [], []]
            for _, keys, bounds in keyed(batch.column(0)):
                rows, at = features(vocab, keys, bounds)
                y = target(vocab, keys, at)
                log_class = np.concatenate([
                    log_softmax(table, rows[i : i + STEP])[np.arange(len(y[i : i + STEP])), y[i : i + STEP]]
                    for i in range(0, len(keys), STEP)
                ]).astype(np.float64) / np.log(10)
                head = at >= 0
                count = np.where(head, word[at], 0)
                # Without any training document the end is unknown too, and counted here.
                lost = (keys == END) & ~head
                count[lost] = np.log10(ADDED)
                starts = bounds[:-1]
                out[0].append(np.diff(bounds))
                out[1].append(np.add.reduceat(head.astype(np.int64), starts))
                out[2].append(np.add.reduceat(count, starts))
                out[3].append(np.add.reduceat(log_class - share[y], starts))
                rest = ~head & ~lost
                cut = np.concatenate([[0], np.cumsum(np.add.reduceat(rest.astype(np.int64), starts))])
                tails = keys[rest]
                out[4] += [tails[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2)]
                + [pa.array(np.concatenate(o) if o else np.zeros(0), t)
                   for o, t in zip(out[:4], (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
                + [pa.array(out[4], pa.binary())],
                names=["doc_id", "held_out", "n_tokens", "head_known", "head_sum", "model_sum", "tail"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, head_known long, head_sum double, model_sum double, tail binary"
    return docs.select(text, F.col(doc_id).cast("long"), held.alias("held_out")).mapInArrow(run, schema)


def tail_sums(scored: DataFrame, counted: DataFrame, bits: int) -> DataFrame:
    """(row, tail_known, tail_sum): the other words, joined with their counts in hash buckets.

    Numbers travel packed: a block of documents sends a bucket one row, and gets one back.
    """

    def send(batches):
        for batch in batches:
            row = batch.column(1).to_numpy()
            tails = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(0)]
            keys = np.concatenate([np.zeros(0, np.uint64), *tails])
            owner = np.repeat(row, [len(t) for t in tails])
            # One block of at most 4096 documents of one partition, one bucket.
            pair = np.stack([(keys >> np.uint64(64 - bits)).astype(np.int64), owner >> 12], axis=1)
            order = np.lexsort((pair[:, 1], pair[:, 0]))
            pair, keys, owner = pair[order], keys[order], owner[order]
            cut = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]).any(axis=1)])) if len(pair) else np.zeros(0, int)
            edges = np.append(cut, len(pair))
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[cut, 0].astype(np.int32)), pa.array(pair[cut, 1]),
                 pa.array([owner[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary())],
                names=["bucket", "docs", "rows", "tail"],
            )

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(b, np.uint64) for b in known["keys"])])
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(b, np.int64) for b in known["counts"])])
        out = []
        for docs, rows, tail in zip(asked["docs"], asked["rows"], asked["tail"], strict=True):
            rows, tail = np.frombuffer(rows, np.int64), np.frombuffer(tail, np.uint64)
            at = np.minimum(np.searchsorted(keys, tail), max(len(keys) - 1, 0))
            c = np.where(keys[at] == tail, counts[at], 0) if len(keys) else np.zeros(len(tail), np.int64)
            own, place = np.unique(rows, return_inverse=True)
            out.append((docs, own.tobytes(), np.bincount(place, weights=c > 0).astype(np.int64).tobytes(),
                        np.bincount(place, weights=np.log10(c + ADDED)).tobytes()))
        return pd.DataFrame(out, columns=["docs", "rows", "known", "sums"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        own, place = np.unique(np.concatenate([np.frombuffer(b, np.int64) for b in rows["rows"]]), return_inverse=True)
        known = np.concatenate([np.frombuffer(b, np.int64) for b in rows["known"]])
        sums = np.concatenate([np.frombuffer(b) for b in rows["sums"]])
        return pd.DataFrame({"row": own, "tail_known": np.bincount(place, weights=known).astype(np.int64),
                             "tail_sum": np.bincount(place, weights=sums)})

    asked = scored.where(F.length("tail") > 0).select("tail", "row").mapInArrow(
        send, "bucket int, docs long, rows binary, tail binary"
    )
    return (
        asked.groupBy("bucket").cogroup(renewed(counted).groupBy("bucket"))
        .applyInPandas(answer, "docs long, rows binary, known binary, sums binary")
        .groupBy("docs").applyInPandas(gather, "row long, tail_known long, tail_sum double")
    )


def score(docs: DataFrame, folds: int = 10, held: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    is_held = fold(doc_id, folds) == held
    train = docs.where(~is_held).select(doc_id, text)
    length = train.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    bits = buckets_for(length // 60)
    counted = count_words(train, text, bits)
    vocab = vocabulary(train, counted, text)
    table = train_table(train, vocab, text, doc_id)
    scored = durable(score_heads(docs, vocab, table, doc_id, text, is_held)).withColumn("row", F.monotonically_increasing_id())
    tails = tail_sums(scored, counted, bits)
    below = float(np.log10(vocab.total + ADDED * (vocab.distinct + 1)))
    words_sum = F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0))
    return scored.join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (words_sum - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (words_sum + F.col("model_sum")).alias("score"),
    )
