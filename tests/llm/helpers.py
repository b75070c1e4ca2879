"""Small tables and plain-Python counterparts for the operators' tests."""

import math
import re
from collections import Counter

from pyspark.sql import types as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows, extra=()):
    """(doc_id, text, extra...) rows; extra columns are strings."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in extra]
    )
    return spark.createDataFrame([(*r, *[c for c in extra]) for r in rows], schema)


def labels(spark, rows, label):
    return spark.createDataFrame(rows, f"doc_id long, {label} int")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size):
    w = spaced(text)
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(nodes, links):
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def cosines_by_hand(rows, examples):
    """Per row: the cosines to all examples that have a word in common with it, over all words of all texts."""
    said = [Counter(re.findall(r"[0-9a-z\x80-\U0010ffff]+|[^\x00-\x20\x7f0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER))) for _, t in rows]
    df = Counter(w for c in said for w in c)
    idf = {w: math.log((1 + len(rows)) / (1 + n)) + 1 for w, n in df.items()}
    x = [{w: (1 + math.log(n)) * idf[w] for w, n in c.items()} for c in said]
    length = [math.sqrt(sum(v * v for v in r.values())) for r in x]
    out = []
    for r, size in zip(x, length, strict=True):
        both = {j: sum(v * x[j][w] for w, v in r.items() if w in x[j]) for j in examples}
        out.append({j: v / (size * length[j]) for j, v in both.items() if v})
    return out
