"""CHAID classification tree for a 0/1 target and categorical predictors.

Spark gathers one contingency table per tree level for all open nodes at once and
merges the categories of every (node, variable) pair in parallel, in numpy; the
driver sees one chosen split per node.  The work on a pair grows with the square
of its categories and the memory with their number, neither with the rows, so
bin a numeric predictor with very many values first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.columns import unpivot
from riskframe.session import durable


@dataclass
class Node:
    n: float
    n1: float
    rule: tuple = ()  # ((variable, (level, ...)), ...)
    split_on: str | None = None
    log_p: float | None = None
    children: list[Node] = field(default_factory=list)
    id: int = 0

    def condition(self) -> Column:
        out = F.lit(True)
        for variable, levels in self.rule:
            out &= F.col(variable).cast("string").isin(*levels)
        return out


@dataclass
class ChaidTree:
    root: Node
    variables: tuple[str, ...]

    def __post_init__(self):
        # Depth-first numbers, root first.
        for i, node in enumerate(self.nodes(), 1):
            node.id = i

    def nodes(self) -> list[Node]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            out.append(node)
            todo += reversed(node.children)
        return out

    def leaves(self) -> list[Node]:
        return [n for n in self.nodes() if not n.children]

    def node_expr(self) -> Column:
        """Terminal node id; null for a category the tree has not seen where it splits."""

        def walk(node: Node) -> Column:
            if not node.children:
                return F.lit(node.id)
            out = None
            for child in node.children:
                hit = F.col(node.split_on).cast("string").isin(*child.rule[-1][1])
                below = walk(child)
                out = F.when(hit, below) if out is None else out.when(hit, below)
            return out

        return walk(self.root)


def fit_chaid(
    df: DataFrame,
    y: str,
    variables,
    max_height: int = 4,
    alpha_merge: float = 0.05,
    alpha_split: float = 0.05,
    min_split: int = 20,
    min_bucket: int = 7,
    min_prob: float = 0.01,
    counts: tuple[str, str] | None = None,
) -> ChaidTree:
    """Grow a tree level by level.

    Rows first collapse to distinct predictor combinations.  In every open node
    each predictor's categories merge pairwise while the least different pair
    is not significant; the predictor with the smallest Bonferroni-adjusted p
    splits the node, provided each child keeps ``min_bucket`` rows and the
    ``min_prob`` share of all rows.  ``counts`` names the row and event count
    columns of a table that is grouped already, used instead of ``y``.
    """
    variables = tuple(variables)
    complete = df.dropna("any", subset=list(variables))
    if counts:
        n, n1 = (F.sum(c) for c in counts)
    else:
        complete = complete.where(F.col(y).isNotNull())
        n, n1 = F.count("*"), F.sum(F.col(y).cast("double"))
    grouped = complete.groupBy(*variables)
    patterns = durable(grouped.agg(n.cast("long").alias("_n"), n1.cast("long").alias("_n1")))
    total = patterns.agg(F.sum("_n").alias("n"), F.sum("_n1").alias("n1")).first()
    if not total.n:
        raise ValueError("no complete rows to grow a tree on")
    root = Node(total.n, total.n1)
    floor = max(min_bucket, min_prob * total.n)
    open_nodes = [root]
    for _ in range(max_height):
        open_nodes = [n for n in open_nodes if n.n >= min_split and 0 < n.n1 < n.n]
        if not open_nodes:
            break
        following = []
        for i, (log_p, variable, groups) in _best_splits(
            _contingency(patterns, open_nodes, variables), variables, alpha_merge, alpha_split, floor
        ).items():
            node = open_nodes[i]
            node.log_p, node.split_on = log_p, variable
            node.children = [
                Node(n, n1, (*node.rule, (node.split_on, levels))) for levels, n, n1 in groups
            ]
            following += node.children
        open_nodes = following
    return ChaidTree(root, variables)


def _contingency(patterns: DataFrame, nodes: list[Node], variables) -> DataFrame:
    """(_node, variable, level, n, n1) for the open nodes, from one grouped job."""
    where = None
    for i, node in enumerate(nodes):
        cond = node.condition()
        where = F.when(cond, i) if where is None else where.when(cond, i)
    tagged = patterns.withColumn("_node", where).where(F.col("_node").isNotNull())
    return (
        unpivot(tagged, variables, keep=["_node", "_n", "_n1"])
        .groupBy("_node", "variable", "level")
        .agg(F.sum("_n").alias("n"), F.sum("_n1").alias("n1"))
    )


#: Categories of all open nodes and predictors together that are merged in place, without tasks of their own.
FEW_CELLS = 2000

_MERGED = (
    "_node int, variable string, log_p double, parts int, smallest long, "
    "groups array<struct<levels:array<string>,n:long,n1:long>>"
)


def _best_splits(
    counts: DataFrame, variables, alpha_merge: float, alpha_split: float, floor: float
) -> dict[int, tuple]:
    """{node: (log p, variable, groups)} of the admissible split with the smallest p."""

    few = counts.limit(FEW_CELLS + 1).toPandas()
    if len(few) <= FEW_CELLS:
        return _best_of_few(few, variables, alpha_merge, alpha_split, floor)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        groups, log_p = _merged_rows(rows, alpha_merge)
        return pd.DataFrame(
            {
                "_node": [rows["_node"].iloc[0]],
                "variable": [rows["variable"].iloc[0]],
                "log_p": [log_p],
                "parts": [len(groups)],
                "smallest": [min(g[1] for g in groups)],
                "groups": [[{"levels": list(v), "n": n, "n1": n1} for v, n, n1 in groups]],
            }
        )

    order = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("variable"))
    best = (
        counts.groupBy("_node", "variable")
        .applyInPandas(merged, _MERGED)
        .where((F.col("parts") >= 2) & (F.col("smallest") >= floor))
        .where(F.col("log_p") <= math.log(alpha_split))
        .groupBy("_node")
        .agg(F.min_by(F.struct("log_p", "variable", "groups"), F.struct("log_p", order)).alias("b"))
    )
    # One row per open node, with the categories that become its rules.
    return {
        r["_node"]: (
            r["b"]["log_p"],
            r["b"]["variable"],
            [(tuple(g["levels"]), g["n"], g["n1"]) for g in r["b"]["groups"]],
        )
        for r in sorted(best.collect(), key=lambda r: r["_node"])
    }


def _merged_rows(rows: pd.DataFrame, alpha_merge: float):
    rows = rows.sort_values("level")
    return merge_categories(rows["level"].tolist(), rows["n"].to_numpy(), rows["n1"].to_numpy(), alpha_merge)


def _best_of_few(cells: pd.DataFrame, variables, alpha_merge: float, alpha_split: float, floor: float) -> dict[int, tuple]:
    """The same choice over a table of at most ``FEW_CELLS`` categories, where starting tasks would cost more."""
    best = {}
    for node, own in cells.groupby("_node", sort=True):
        found = []
        for variable, rows in own.groupby("variable"):
            groups, log_p = _merged_rows(rows, alpha_merge)
            if len(groups) >= 2 and min(g[1] for g in groups) >= floor and log_p <= math.log(alpha_split):
                found.append((log_p, variables.index(variable), variable, groups))
        if found:
            log_p, _, variable, groups = min(found)
            best[int(node)] = (log_p, variable, groups)
    return best


def merge_categories(levels: list[str], n, n1, alpha: float):
    """Merge the least different pair of categories until all pairs differ.

    Returns the groups as (levels, n, n1) in order of their first level, and the
    log of the adjusted p value.  Categories of one rate do not differ at all and
    go together first, so the work grows with the square of the distinct
    rates, not of the categories.  Each group then remembers its least different later
    group, so a merge compares the new group with all others and renews only
    those that had pointed at the merged two.
    """
    categories = len(levels)
    size, events, names = _same_rates(levels, np.array(n, np.int64), np.array(n1, np.int64), alpha)
    start = len(names)
    alive = np.ones(start, dtype=bool)

    def statistics(i: int, others: np.ndarray) -> np.ndarray:
        na, nb, ka, kb = size[i], size[others], events[i], events[others]
        whole, hits = na + nb, ka + kb
        below = na * nb * hits * (whole - hits)
        gap = ka * nb - kb * na
        return np.where(below > 0, gap * gap * whole / np.where(below > 0, below, 1), 0.0)

    nearest, least = np.full(start, -1), np.full(start, np.inf)

    def renew(i: int) -> None:
        later = np.flatnonzero(alive[i + 1 :]) + i + 1
        if len(later):
            found = statistics(i, later)
            at = int(found.argmin())
            nearest[i], least[i] = later[at], found[at]
        else:
            nearest[i], least[i] = -1, np.inf

    for i in range(start):
        renew(i)
    count = start
    while count > 1:
        a = int(least.argmin())
        if log_chi2_tail(float(least[a]), 1) <= math.log(alpha):
            break
        b = int(nearest[a])
        names[a] = sorted(names[a] + names[b])
        size[a] += size[b]
        events[a] += events[b]
        alive[b], least[b] = False, np.inf
        count -= 1
        renew(a)
        for i in np.flatnonzero(alive & ((nearest == a) | (nearest == b))):
            if i != a:
                renew(int(i))
        before = np.flatnonzero(alive[:a])
        if len(before):
            closer = statistics(a, before)
            better = (closer < least[before]) | ((closer == least[before]) & (a < nearest[before]))
            nearest[before[better]], least[before[better]] = a, closer[better]
    groups = [(tuple(names[i]), int(size[i]), int(events[i])) for i in np.flatnonzero(alive)]
    if len(groups) < 2:
        return groups, 0.0
    statistic = pearson(groups)
    return groups, min(0.0, log_chi2_tail(statistic, len(groups) - 1) + _log_ways(categories, len(groups)))


def _same_rates(levels: list[str], n: np.ndarray, n1: np.ndarray, alpha: float):
    """Rows, events and names of the groups of categories with one rate, in order of their first level."""
    if not len(n) or alpha >= 1:
        return n.astype(float), n1.astype(float), [[v] for v in levels]
    common = np.gcd(n, n1)
    rates = np.stack([n // common, n1 // common], axis=1)
    _, first, own = np.unique(rates, axis=0, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    own = rank[own.ravel()]
    names: list[list[str]] = [[] for _ in first]
    for level, group in zip(levels, own.tolist()):
        names[group].append(level)
    size, events = (np.bincount(own, weights=x, minlength=len(first)) for x in (n, n1))
    return size, events, [sorted(v) for v in names]


def pearson(groups) -> float:
    """Chi-square of groups by target, from (levels, n, n1) triples."""
    n = sum(g[1] for g in groups)
    n1 = sum(g[2] for g in groups)
    if n1 in (0, n):
        return 0.0
    rate = n1 / n
    return sum((g[2] - g[1] * rate) ** 2 / (g[1] * rate * (1 - rate)) for g in groups if g[1])


def _log_ways(categories: int, groups: int) -> float:
    """Log of the number of ways to form the groups (Bonferroni multiplier)."""
    ways = sum(
        (-1) ** i * math.comb(groups, i) * (groups - i) ** categories for i in range(groups)
    )
    return math.log(ways // math.factorial(groups))


def log_chi2_tail(x: float, df: int) -> float:
    """Log upper tail of chi-square with whole degrees of freedom, by its finite sum."""
    if x <= 0:
        return 0.0
    h = x / 2
    parts = []
    if df % 2:
        # log erfc, with its leading asymptotic term where erfc underflows
        root = math.sqrt(h)
        parts.append(
            math.log(math.erfc(root))
            if root < 25
            else -h - math.log(root * math.sqrt(math.pi)) + math.log1p(-1 / (2 * h))
        )
        first = 0.5
    else:
        first = 0.0
    steps = df // 2
    parts += [-h + (first + i) * math.log(h) - math.lgamma(first + i + 1) for i in range(steps)]
    top = max(parts)
    return min(0.0, top + math.log(sum(math.exp(p - top) for p in parts)))


def assign_node(df: DataFrame, tree: ChaidTree, out: str = "node") -> DataFrame:
    return df.withColumn(out, tree.node_expr())


def tree_score(df: DataFrame, tree: ChaidTree, p0: str = "P_0", p1: str = "P_1") -> DataFrame:
    """Class probabilities of the terminal node of each row."""
    rates = F.create_map(
        *[F.lit(v) for leaf in tree.leaves() for v in (leaf.id, leaf.n1 / leaf.n)]
    )
    node = tree.node_expr()
    scored = df.withColumn(p1, F.when(node.isNotNull(), F.element_at(rates, node)))
    return scored.withColumn(p0, 1 - F.col(p1))


def tree_rules(spark: SparkSession, tree: ChaidTree) -> DataFrame:
    """One row per node: rule, size, events, rate, depth, split variable."""
    rows = []
    for node in tree.nodes():
        rule = " & ".join(f"{v} in {{{', '.join(levels)}}}" for v, levels in node.rule)
        rows.append(
            (
                node.id,
                len(node.rule),
                rule or "all",
                int(node.n),
                int(node.n1),
                node.n1 / node.n,
                node.split_on,
                not node.children,
            )
        )
    return spark.createDataFrame(
        rows,
        "node int, depth int, rule string, n long, n1 long, rate double, "
        "split_on string, leaf boolean",
    )
