"""The language model's scores from its table, token by token in plain Python."""

import math

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, spaced
from test_texts import prose

from riskframe.llm import maxent
from riskframe.llm.frames import fold

FULL = (1 << 64) - 1


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & FULL
    return x ^ (x >> 31)


def place(salt, *keys):
    x = salt
    for k in keys:
        x = mixed((x * 0x2545F4914F6CDD1D + k) & FULL)
    return 1 + 2 * maxent._SLOTS + x % maxent.HASHED


def class_logs(table, history, slot):
    """log P(class | history); the last word of the history is its last item."""
    start = int(maxent.START)
    back = [history[-k] if len(history) >= k else None for k in (1, 2, 3)]
    at = [maxent.MODEL + 4 if b is None else slot(b) for b in back]
    one, two, three = (start if b is None else b for b in back)
    rows = [0, 1 + at[0], 1 + maxent._SLOTS + at[1], place(1, one, two), place(2, one, three), place(3, one, two, three)]
    z = table[rows].astype(np.float64).sum(axis=0)
    return z - z.max() - math.log(np.exp(z - z.max()).sum())


def test_scores_equal_a_dense_model_whose_words_add_up_to_one(spark):
    rows = prose()
    docs = documents(spark, rows).coalesce(1)
    train = docs.where(fold("doc_id", 10) != 0)
    vocab = maxent.vocabulary(train, maxent.count_words(train, "text", 4), "text")
    table = maxent.train_table(train, vocab, "text", "doc_id")
    known = {int(k): (int(c), int(n), int(g)) for k, c, n, g in
             zip(vocab.keys, vocab.counts, vocab.number, vocab.classes)}
    end = int(maxent.END)
    keys_of = {}

    def key(word):
        if word not in keys_of:
            keys_of[word] = int(next(iter(maxent.keyed(pa.array([word]))))[1][0])
        return keys_of[word]

    def slot(k):
        return known[k][1] if known.get(k, (0, -1))[1] >= 0 else maxent.MODEL + (k & 3)

    def kind(k):
        return known[k][2] if k in known else maxent.TAILS + (k & 3)

    # Inside every class that has words, its words and (in a tail class) the unknown one add up to 1.
    within = np.zeros(maxent.CLASSES)
    for k, (c, _, g) in known.items():
        within[g] += (c + maxent.ADDED) / vocab.mass[g]
    for form in range(4):
        within[maxent.TAILS + form] += maxent.ADDED / vocab.mass[maxent.TAILS + form]
    used = {g for _, _, g in known.values()} | set(range(maxent.TAILS, maxent.CLASSES))
    assert all(within[g] == pytest.approx(1) for g in used)

    got = {r["doc_id"]: r["score"] for r in maxent.score(docs).collect()}
    for i, text in rows[::3]:
        history, total = [], 0.0
        for k in [key(w) for w in spaced(text)] + [end]:
            logs = class_logs(table, history, slot)
            assert np.exp(logs).sum() == pytest.approx(1)
            share = (known.get(k, (0,))[0] + maxent.ADDED) / vocab.mass[kind(k)]
            total += logs[kind(k)] / math.log(10) + math.log10(share)
            history.append(k)
        assert got[i] == pytest.approx(total, rel=1e-4)
