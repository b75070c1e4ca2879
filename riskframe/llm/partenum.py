"""N-gram Jaccard self-join by PartEnum signatures, and its components.

1. Documents with equal shingle sets form one class; only classes are compared.
2. Sizes fall into bands; a class takes part in its own band and in the next
   one if a set there can be similar enough. Within a band, similar sets differ
   in at most k shingles. The shingle domain is cut into groups of cells, and a
   signature is made for every subset of cells of a group that must agree in
   one group at least. Spare groups let signatures over fewer than ``STRONG``
   shingles be left out without losing a pair; a class with too many weak
   groups emits all of them.
3. Classes that share a signature are looked at closer: each has its size and a
   parity sketch, a bit for every bucket of shingles that says whether it holds an
   odd number of them. Two sketches differ in at most as many bits as the sets
   differ in shingles, so a pair beyond the allowed difference is ruled out and
   no similar pair is. Only signatures that several classes share are kept, and
   the sketches go to them by a join. What passes is joined into trees: a
   signature never yields all its pairs.
4. Candidate trees give candidate components. Inside these, sets are compared
   exactly, in blocks of bounded size. A component larger than a block has blocks
   by size: its members meet their own block and ``PIVOTS`` members first, and
   only those not yet joined to its largest part meet the other blocks whose
   sizes are in reach. Every pair of different final components
   has thus been ruled out by a missing signature or by an exact comparison.

Contract for unusual input: null texts and texts without words have an empty
set and link with nothing; a text of fewer words than a shingle is one shingle;
rows with a null id are left out; rows that repeat an id count each, with their
own sets; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm import words
from riskframe.llm.frames import released, renewed, small_if_counted, trimmed
from riskframe.llm.graph import components
from riskframe.session import durable

STRONG = 2
BLOCK = 1024
PIVOTS = 16
BLOCKED = ["home", "block", "class", "coarse", "n", "features"]
LINK = "a long, b long"
#: Bits of a sketch at least; larger sets have three bits for every four shingles, or more. With one for every two, so many
#: pairs of unlike sets passed at 80 % that those of about 1,024 shingles made one candidate component, growing with the input.
SKETCH = 512
#: Groups of at most so many classes are compared all at once.
FEW = 16
#: Signatures a task holds before it sends them on.
HELD = 1 << 21
#: About so many shingles, and hardly more signatures, per shuffled bucket.
PER_BUCKET = 1 << 21


def sets_of(column: pa.Array, size: int):
    """Chunk by chunk: first row, sorted distinct shingles of its rows one after the other, bounds."""
    for t in words.tokens(column):
        made, bounds = words.shingles(t, size)
        own = [np.unique(made[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        sizes = np.array([len(x) for x in own])
        yield t.first, np.concatenate(own) if own else made, np.concatenate([[0], np.cumsum(sizes)])


def class_ids(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty set."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(words.mixed(features ^ np.uint64(0x6A09E667F3BCC909)))])
    sizes = np.diff(bounds)
    return np.where(sizes > 0, words.mixed(total[bounds[1:]] - total[bounds[:-1]] + sizes.astype(np.uint64)), 0)


class Bands:
    """Size bands and their signature schemes for 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent, self.low = percent, [1]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.low[-1] <= sizes.max(initial=1):
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return np.searchsorted(self.low, sizes, side="right") - 1

    def reaches_next(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Whether a set of the next band can be similar enough."""
        lows = np.array([*self.low, self.low[-1] * 100 // self.percent + 1])
        return 100 * sizes >= self.percent * lows[band + 1]

    def scheme(self, band: int) -> tuple[int, int, int, int]:
        """(groups, cells in a group, cells that may differ, spare groups); no groups if only equal sets link."""
        highest = self.low[band] * 100 // self.percent
        k = 2 * highest * (100 - self.percent) // (100 + self.percent)
        if k == 0:
            return 0, 0, 0, 0
        if k <= 3:
            return (1, *{1: (3, 1), 2: (5, 2), 3: (6, 3)}[k], 0)
        spare = -(-3 * (k // 2 + 1) // 20)
        return k // 2 + 1 + spare, 3, 1, spare


def signatures(features: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of every set."""
    sizes = np.diff(bounds)
    own = bands.of(sizes)
    out_s, out_r = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    digest = words.mixed(features ^ np.uint64(0xBB67AE8584CAA73B))
    for step in (0, 1):
        take = sizes > 0 if step == 0 else (sizes > 0) & bands.reaches_next(sizes, own)
        for band in np.unique(own[take] + step):
            groups, cells, differ, spare = bands.scheme(int(band))
            if not groups:
                continue
            rows = np.flatnonzero(take & (own + step == band))
            n = groups * cells
            at = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows])
            row = np.repeat(np.arange(len(rows)), sizes[rows])
            # Sorted hashes fall into cells in order, so a cell is a run.
            cell = row * n + ((features[at] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            sums, counts = np.zeros(len(rows) * n, np.uint64), np.zeros(len(rows) * n, np.int64)
            sums[cell[starts]] = np.add.reduceat(digest[at], starts)
            counts[cell[starts]] = np.diff(np.append(starts, len(cell)))
            sums, counts = sums.reshape(-1, groups, cells), counts.reshape(-1, groups, cells)
            subsets = [list(c) for c in combinations(range(cells), cells - differ)]
            held = np.stack([counts[:, :, c].sum(axis=2) for c in subsets], axis=2)
            strong = held >= STRONG
            strong |= ((~strong).any(axis=2).sum(axis=1) > spare)[:, None, None]
            group = np.arange(groups, dtype=np.uint64)[None, :]
            for i, c in enumerate(subsets):
                x = np.full(sums.shape[:2], np.uint64(band) << np.uint64(8) | np.uint64(i))
                x = words.mixed(x * np.uint64(0x2545F4914F6CDD1D) + group)
                for j in c:
                    x = words.mixed(x * np.uint64(0x2545F4914F6CDD1D) + sums[:, :, j])
                good = strong[:, :, i]
                out_s.append(x[good])
                out_r.append(np.broadcast_to(rows[:, None], good.shape)[good])
    return np.concatenate(out_s), np.concatenate(out_r)


def sketches(features: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The parity sketch of each set: ``SKETCH`` bits, doubled until there are three for every four shingles."""
    sizes = np.diff(bounds)
    wide = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(sizes, 2) * 0.75)).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(wide)])
    hashed = words.mixed(features ^ np.uint64(0x3C6EF372FE94F82B))
    bit = (hashed & (np.repeat(wide, sizes) - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(at[:-1], sizes) + bit, minlength=int(at[-1])) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def folded(sketch: bytes, width: int) -> np.ndarray:
    """A sketch as 64-bit words of a smaller number of bits: parities of the joined buckets."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, width // 64), axis=0)


def may_link(sa, na, sb, nb, percent: int) -> np.ndarray:
    """Whether sets of these sketches and sizes can be similar enough; broadcasts over the leading axes."""
    differ = np.bitwise_count(sa ^ sb).sum(axis=-1, dtype=np.int64)
    return (100 + percent) * np.maximum(differ, np.abs(na - nb)) <= (100 - percent) * (na + nb)


class Forest:
    """Disjoint sets of numbers."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            self.parent[x] = x = self.parent[up]

    def root(self, x: int) -> int:
        while (up := int(self.parent[x])) != x:
            self.parent[x] = self.parent[up]
            x = up
        return x

    def joins(self, a: int, b: int) -> bool:
        """Join two sets; whether they were apart."""
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def shared(signature: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct groups of two or more members with one signature: members, and bounds of the groups."""
    order = np.lexsort((member, signature))
    s, m = signature[order], member[order]
    fresh = np.concatenate([[True], (s[1:] != s[:-1]) | (m[1:] != m[:-1])]) if len(s) else np.zeros(0, bool)
    s, m = s[fresh], m[fresh]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    size = np.diff(np.append(start, len(s)))
    # Near copies share many signatures; a group of the same members counts once.
    name = np.add.reduceat(words.mixed(m + np.uint64(0x510E527FADE682D1)), start) if len(s) else s
    name = np.where(size > 1, words.mixed(name + size.astype(np.uint64)), np.uint64(0))
    _, first = np.unique(name, return_index=True)
    first = np.sort(first[size[first] > 1])
    return _runs(m, start[first], size[first]), np.concatenate([[0], np.cumsum(size[first])])


def _runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` one after the other."""
    before = np.cumsum(sizes) - sizes
    return values[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


def passing(members: np.ndarray, bounds: np.ndarray, sketch: list[bytes], size: np.ndarray, percent: int):
    """(i, j): trees over the numbered classes that join all pairs of a group whose sketches may link."""
    forest = Forest(len(size))
    width = np.array([len(b) * 8 for b in sketch])
    least = width.min(initial=1 << 40)
    base = np.stack([folded(b, least) for b in sketch]) if len(sketch) else np.zeros((0, 8), np.uint64)
    counts = np.diff(bounds)
    out = []
    for m in range(2, FEW + 1):
        first = bounds[:-1][counts == m]
        x, y = np.triu_indices(m, 1)
        for part in np.array_split(first, max(1, len(first) * len(x) // (1 << 18))):
            i, j = members[part[:, None] + x].ravel(), members[part[:, None] + y].ravel()
            pairs = np.unique(np.stack([i, j], axis=1), axis=0)
            pairs = pairs[forest.roots(pairs[:, 0]) != forest.roots(pairs[:, 1])]
            pairs = pairs[may_link(base[pairs[:, 0]], size[pairs[:, 0]], base[pairs[:, 1]], size[pairs[:, 1]], percent)]
            for a, b in pairs.tolist():
                if width[a] == least or width[b] == least or _wider(sketch[a], size[a], sketch[b], size[b], percent):
                    if forest.joins(a, b):
                        out.append((a, b))
    for g in np.flatnonzero(counts > FEW).tolist():
        own = members[bounds[g] : bounds[g + 1]]
        own = own[np.argsort(size[own], kind="stable")]
        common = int(width[own].min())
        held = base[own] if common == least else np.stack([folded(sketch[i], common) for i in own])
        n = size[own]
        # A later set of size r can only be similar enough while percent * r <= 100 * its own.
        reach = np.searchsorted(n, 100 * n // percent, side="right")
        for i in range(len(own) - 1):
            near = np.arange(i + 1, reach[i])
            near = near[forest.roots(own[near]) != forest.root(int(own[i]))]
            near = near[may_link(held[near], n[near], held[i], n[i], percent)]
            a = int(own[i])
            for b in own[near].tolist():
                narrow = width[a] == common or width[b] == common
                if (narrow or _wider(sketch[a], size[a], sketch[b], size[b], percent)) and forest.joins(a, b):
                    out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def _wider(a: bytes, na: int, b: bytes, nb: int, percent: int) -> bool:
    """The same test at the width of the narrower of two sketches."""
    width = 8 * min(len(a), len(b))
    return bool(may_link(folded(a, width), na, folded(b, width), nb, percent))


def thinned(rising: np.ndarray) -> bytes:
    """Rising 32-bit numbers as bytes of their steps, high bytes together, which compress well."""
    steps = np.diff(rising, prepend=np.uint32(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def thickened(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def indexed(members: np.ndarray) -> bytes:
    """64-bit names as the distinct ones and places among them."""
    names, places = np.unique(members, return_inverse=True)
    wide = np.uint16 if len(names) <= 1 << 16 else np.uint32
    return len(names).to_bytes(8, "little") + names.tobytes() + places.astype(wide).tobytes()


def looked_up(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    names = np.frombuffer(packed, np.uint64, n, 8)
    return names[np.frombuffer(packed, np.uint16 if n <= 1 << 16 else np.uint32, offset=8 + 8 * n)]


def candidates(base: DataFrame, docs: DataFrame, text: str, size: int, percent: int, shingle_total: int) -> DataFrame:
    """(a, b): edges that connect every two similar classes.

    ``base`` has the class, n_shingles and sketch of every document.
    """
    bits = max(5, int(np.ceil(np.log2(max(shingle_total, 1) / PER_BUCKET + 1))))

    def sent(held_s, held_m):
        """One row (bucket, signatures, members) for each bucket."""
        s, m = np.concatenate(held_s), np.concatenate(held_m)
        order = np.argsort(s)
        s, m = s[order], m[order]
        bucket = (s >> np.uint64(64 - bits)).astype(np.int64)
        short = (s << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(s) else np.zeros(0, int)
        parts = [slice(a, b) for a, b in zip(cut, np.append(cut[1:], len(s)), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut].astype(np.int32)), pa.array([thinned(short[at]) for at in parts], pa.binary()),
             pa.array([indexed(m[at]) for at in parts], pa.binary())],
            names=["bucket", "x", "y"],
        )

    def run(batches):
        bands, seen, held_s, held_m, n = Bands(percent), set(), [], [], 0
        for batch in batches:
            for _, features, bounds in sets_of(batch.column(0), size):
                names = class_ids(features, bounds)
                sizes = np.diff(bounds)
                fresh = []
                for i, c in enumerate(names.tolist()):
                    if c and c not in seen:
                        seen.add(c)
                        fresh.append(i)
                if not fresh:
                    continue
                part = np.concatenate([features[bounds[i] : bounds[i + 1]] for i in fresh])
                s, r = signatures(part, np.concatenate([[0], np.cumsum(sizes[fresh])]), bands)
                held_s.append(s)
                held_m.append(names[fresh][r])
                n += len(s)
                if n >= HELD:
                    yield sent(held_s, held_m)
                    held_s, held_m, n = [], [], 0
        if n:
            yield sent(held_s, held_m)
        del held_s, held_m, seen
        trimmed()

    def met(rows: pd.DataFrame) -> pd.DataFrame:
        """Of a bucket: the groups of classes under one signature, by their places among the distinct names."""
        members, bounds = shared(np.concatenate([thickened(b) for b in rows["x"]]),
                                 np.concatenate([looked_up(b) for b in rows["y"]]))
        names, places = np.unique(members, return_inverse=True)
        trimmed()
        return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "names": [names.view(np.int64)],
                             "places": [places.astype(np.int32).tobytes()], "bounds": [bounds.astype(np.int64).tobytes()]})

    packed = docs.select(text).mapInArrow(run, "bucket int, x binary, y binary")
    groups = durable(packed.groupBy("bucket").applyInPandas(met, "bucket int, names array<long>, places binary, bounds binary"))
    del packed
    released(docs.sparkSession)
    classes = base.where("class <> 0").select("class", "n_shingles", "sketch").dropDuplicates(["class"])
    known = groups.select("bucket", F.explode("names").alias("class")).join(classes, "class")

    def compared(group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        pairs = np.zeros((0, 2), np.int64)
        if len(group) and len(known):
            row = group.iloc[0]
            known = known.sort_values("class")
            names = known["class"].to_numpy()
            # Names stand in unsigned order in the groups.
            place = np.searchsorted(names, np.asarray(row["names"], np.int64))
            members = place[np.frombuffer(row["places"], np.int32)]
            found = passing(members, np.frombuffer(row["bounds"], np.int64), known["sketch"].tolist(),
                            known["n_shingles"].to_numpy(), percent)
            pairs = names[found]
        trimmed()
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}).astype("int64")

    held = groups.select("bucket", F.lit(0).cast("long").alias("class"), "names", "places", "bounds")
    found = renewed(held).groupBy("bucket").cogroup(known.select("bucket", "class", "n_shingles", "sketch").groupBy("bucket"))
    return found.applyInPandas(compared, LINK).distinct()


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with 100 * intersection >= percent * union, by exact counts."""
    na, nb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    value = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate([na, nb]))
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    place = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]]))
    n = int(place[-1]) + 1 if len(place) else 0
    in_left = owner < len(left)
    # A set compared with its own block finds each of its shingles there; only shared ones can link two sets.
    fewest = 1 if left is right else 0
    both = (np.bincount(place[in_left], minlength=n) > fewest) & (np.bincount(place[~in_left], minlength=n) > 0)
    keep = both[place]
    column = (np.cumsum(both) - 1)[place[keep]]
    owner, total = owner[keep], int(both.sum())
    common = np.zeros((len(left), len(right)), np.float32)
    wide = 2048
    for low in range(0, total, wide):
        some = slice(*np.searchsorted(column, [low, low + wide]))
        m = np.zeros((len(left) + len(right), min(wide, total - low)), np.float32)
        m[owner[some], column[some] - low] = 1
        common += m[: len(left)] @ m[len(left) :].T
    common = np.rint(common).astype(np.int64)
    return np.nonzero(100 * common >= percent * (na[:, None] + nb[None, :] - common))


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    return rows["class"].to_numpy(), [np.frombuffer(b, np.uint64) for b in rows["features"]]


def _spanning(names_a, names_b, i, j) -> pd.DataFrame:
    """Of all links found in a block, a forest that joins the same sets."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(names_a[i].tolist(), names_b[j].tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[a] = b
            out.append((x, y))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def verified(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join every truly linked class of the candidate components.

    ``members``: class, coarse, n_coarse, features; checkpointed by the caller.
    """
    members = members.withColumn("n", (F.length("features") / 8).cast("int"))
    small = members.where(F.col("n_coarse") <= BLOCK)
    shared = max(1, -(-small.count() // (BLOCK // 2)))
    # Small candidate components share blocks; a large one has blocks of its own, by size.
    together = small.select(*BLOCKED[2:], F.pmod(F.xxhash64("coarse"), F.lit(shared)).alias("home"), F.lit(-1).alias("block"))

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        names, sets = _unpacked(rows.drop_duplicates("class"))
        i, j = linked(sets, sets, percent)
        del sets
        trimmed()
        return _spanning(names, names, i[i < j], j[i < j])

    large = members.where(F.col("n_coarse") > BLOCK)
    if large.isEmpty():
        return together.groupBy("home", "block").applyInPandas(inside, LINK)
    sizes = large.groupBy("coarse", "n").agg(F.count("*").alias("same"))
    upto = F.sum("same").over(Window.partitionBy("coarse").orderBy("n"))
    sizes = small_if_counted(durable(sizes.withColumn("before", upto - F.col("same"))))
    spread = F.pmod(F.xxhash64("class", F.lit(1)), F.lit(1 << 20)) / (1 << 20)
    large = large.join(sizes, ["coarse", "n"]).withColumn(
        "block", F.floor((F.col("before") + spread * F.col("same")) / BLOCK).cast("int")
    ).withColumn("home", F.col("coarse")).select(*BLOCKED)
    ranges = durable(large.groupBy("coarse", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")))

    def in_reach(low: Column, high: Column) -> Column:
        """Whether sets of these sizes can be similar enough to some in a block."""
        return (100 * F.col("high") >= percent * low) & (100 * high >= percent * F.col("low"))

    # The smallest hashes of each block, then of each component: never all members in one group.
    least = F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64("class"), "class"))), 1, PIVOTS)
    ranked = large.groupBy("coarse", "block").agg(least.alias("p")).select("coarse", F.explode("p.class").alias("class"))
    chosen = ranked.groupBy("coarse").agg(least.alias("p")).select(F.explode("p.class").alias("class"))
    pivots = large.join(small_if_counted(durable(chosen)), "class").drop("block")
    pivots = pivots.join(small_if_counted(ranges), "coarse").where(in_reach(F.col("n"), F.col("n"))).select(*BLOCKED)
    first = durable(
        together.select(*BLOCKED).unionByName(large).unionByName(pivots).groupBy("home", "block").applyInPandas(inside, LINK)
    )
    label = components(first).withColumnsRenamed({"node": "class", "component": "label"})
    labelled = large.join(small_if_counted(label), "class", "left").withColumn("label", F.coalesce("label", "class"))
    counted = durable(labelled.groupBy("coarse", "label").agg(F.count("*").alias("n_label")))
    main = counted.groupBy("coarse").agg(F.max_by("label", F.struct("n_label", "label")).alias("main"))
    rest = labelled.join(small_if_counted(durable(main)), "coarse").where(F.col("label") != F.col("main"))
    # Pairs of blocks whose sizes are in reach of each other; one block has been compared with itself.
    asking = rest.select("coarse", "block").distinct().join(ranges, ["coarse", "block"]).select(
        "coarse", F.col("block").alias("rest_block"), F.col("low").alias("l"), F.col("high").alias("h")
    )
    pairs = durable(
        asking.join(ranges, "coarse").where(in_reach(F.col("l"), F.col("h")) & (F.col("rest_block") != F.col("block")))
        .select("coarse", "rest_block", "block")
    )
    keys, columns = ["coarse", "rest_block", "block"], ["class", "label", "features"]
    rest = rest.withColumnRenamed("block", "rest_block").join(small_if_counted(pairs), ["coarse", "rest_block"])
    others = labelled.join(small_if_counted(pairs), ["coarse", "block"])

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        (names_a, a), (names_b, b) = _unpacked(left), _unpacked(right)
        i, j = linked(a, b, percent)
        new = left["label"].to_numpy()[i] != right["label"].to_numpy()[j]
        return _spanning(names_a, names_b, i[new], j[new])

    second = (
        rest.select(*keys, *columns).groupBy(*keys)
        .cogroup(renewed(others.select(*keys, *columns)).groupBy(*keys))
        .applyInPandas(across, LINK)
    )
    return first.unionByName(second)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep..., n_shingles, component_id): every document and the smallest id its links reach.

    ``keep`` names columns that go along, such as one that tells rows of one id apart.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(text, F.col(doc_id).cast("long").alias("doc_id"), *keep)
    made = "n_shingles long, class long, sketch binary"
    kept = [f"__{i}" for i in range(len(keep))]
    schema = ", ".join(["doc_id long", *[f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(kept, keep, strict=True)], made])

    def sized(batches):
        for batch in batches:
            n, names, packed = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], []
            for _, features, bounds in sets_of(batch.column(0), size):
                n.append(np.diff(bounds))
                names.append(class_ids(features, bounds))
                packed += sketches(features, bounds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.concatenate(n)), pa.array(np.concatenate(names).view(np.int64)),
                 pa.array(packed, pa.binary())],
                names=["doc_id", *kept, "n_shingles", "class", "sketch"],
            )
        trimmed()

    base = durable(rows.mapInArrow(sized, schema))
    total = base.agg(F.sum("n_shingles")).first()[0] or 0
    coarse = components(candidates(base, rows, text, size, percent, total)).withColumnsRenamed(
        {"node": "class", "component": "coarse"}
    )
    heads = base.where(F.col("n_shingles") > 0).groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    wanted = durable(coarse.join(heads, "class"))
    counts = wanted.groupBy("coarse").agg(F.count("*").alias("n_coarse"))
    wanted = wanted.join(counts, "coarse").select("doc_id", F.col("class").alias("wanted"), "coarse", "n_coarse")

    def with_sets(batches):
        for batch in batches:
            packed, names = [], [np.zeros(0, np.uint64)]
            for _, features, bounds in sets_of(batch.column(0), size):
                packed += [features[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                names.append(class_ids(features, bounds))
            own = np.concatenate(names).view(np.int64) == batch.column(1).to_numpy(zero_copy_only=False)
            made = pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3), pa.array(packed, pa.binary())],
                names=["class", "coarse", "n_coarse", "features"],
            )
            yield made.filter(pa.array(own))
        trimmed()

    members = durable(
        rows.select(text, "doc_id").join(small_if_counted(wanted), "doc_id").select(text, "wanted", "coarse", "n_coarse")
        .mapInArrow(with_sets, "class long, coarse long, n_coarse long, features binary")
    )
    label = components(verified(members, percent)).withColumnsRenamed({"node": "class", "component": "label"})
    out = ["doc_id", *kept, "n_shingles"]
    whole = base.where(F.col("n_shingles") > 0).join(label, "class", "left").select(
        *out, F.coalesce("label", "class").alias("label")
    )
    least = whole.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    every = whole.join(least, "label").select(*out, "component_id").unionByName(
        base.where(F.col("n_shingles") == 0).select(*out, F.col("doc_id").alias("component_id"))
    )
    return every.withColumnsRenamed(dict(zip(kept, keep, strict=True)))
