"""Growing trees over binned rows: wide nodes level by level on all executors, small ones in one task.

Rows are kept as blocks of bin codes. While a node has many rows, each task sums the slopes of its rows
by node, entry and bin, Spark adds up those sums, and the driver gets one row for each pair of node and
entry. A node whose rows fit one task goes there with them, and the task grows all that lies below it.
Sums are whole numbers and both ways choose by the same function, so a tree does not depend on the
partitioning, on repeated tasks, or on where a node was grown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 22
"""A pass sums into this many cells (nodes by entries by bins); a wider level takes several passes."""
LOCAL_ROWS = 1 << 16
LOCAL_CODES = 1 << 25
"""A node of at most this many rows and codes is finished in one task."""
EXACT_BITS = 53 - 16
"""Slopes below 2^EXACT_BITS sum exactly over a block, and over the rows of one task."""
STATE = "codes binary, label binary, weight binary, margin binary, key binary"
COLUMNS = ("label", "weight", "margin", "key")

Block = tuple[np.ndarray, ...]
"""codes (rows by entries; 0 is missing, then the bins), label, weight, margin and key of some rows."""
Slopes = Callable[[Block, int], tuple[np.ndarray, np.ndarray, np.ndarray]]
"""Of a block and the number of a tree: which rows take part, and their whole slopes g and h."""


@dataclass
class Tree:
    """Nodes in the order they were made. ``entry`` is -1 for a leaf; ``low`` takes values below ``cut``."""

    entry: list[int] = field(default_factory=lambda: [-1])
    code: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    missing_low: list[bool] = field(default_factory=lambda: [False])
    low: list[int] = field(default_factory=lambda: [0])
    high: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, entry: int, code: int, missing_low: bool) -> tuple[int, int]:
        """Make ``node`` a split; the numbers of its two new leaves."""
        low = len(self.entry)
        self.entry[node], self.code[node], self.missing_low[node] = entry, code, missing_low
        self.low[node], self.high[node] = low, low + 1
        for _ in range(2):
            self.entry.append(-1)
            self.code.append(0)
            self.cut.append(0.0)
            self.missing_low.append(False)
            self.low.append(0)
            self.high.append(0)
            self.value.append(0.0)
        return low, low + 1

    def graft(self, node: int, other: Tree) -> None:
        """Put ``other`` in the place of a leaf."""
        shift = len(self.entry) - 1
        names = ("entry", "code", "cut", "missing_low", "value")
        for name in names:
            mine, own = getattr(self, name), getattr(other, name)
            mine[node] = own[0]
            mine.extend(own[1:])
        for name in ("low", "high"):
            mine, own = getattr(self, name), [x + shift if x else 0 for x in getattr(other, name)]
            mine[node] = own[0]
            mine.extend(own[1:])

    def leaves(self, values: np.ndarray, coded: bool) -> np.ndarray:
        """The leaf of every row of ``values``: codes of bins (0 is missing), or numbers (NaN is)."""
        entry, low, high = (np.array(x) for x in (self.entry, self.low, self.high))
        limit = np.array(self.code if coded else self.cut)
        missing_low = np.array(self.missing_low)
        node = np.zeros(len(values), np.int64)
        at = np.arange(len(values))
        while len(at):
            at = at[entry[node[at]] >= 0]
            of = node[at]
            x = values[at, entry[of]]
            absent = x == 0 if coded else np.isnan(x)
            # a cut at infinity has all values below it
            below = x <= limit[of] if coded else (x < limit[of]) | np.isposinf(limit[of])
            node[at] = np.where(np.where(absent, missing_low[of], below), low[of], high[of])
        return node


@dataclass(frozen=True)
class Rules:
    """When a node is split, and what a leaf is worth: -G / (H + ridge) times ``rate``.

    ``depth`` None grows until nothing is gained. ``fraction`` looks at so many of the entries at each
    node, chosen by a hash of ``seed`` and the node's place; if none of those gains, at the next in turn.
    ``classes`` is for slopes g = -label, h = 1 of labels 0 and 1: a node of one class is not split.
    ``empty`` is what a leaf without rows is worth.
    """

    depth: int | None = 6
    ridge: float = 1.0
    least_gain: float = 1e-6
    least_weight: float = 1.0
    rate: float = 1.0
    fraction: float | None = None
    seed: int = 0
    classes: bool = False
    empty: float = 0.0

    def value(self, g: float, h: float) -> float:
        return -g / (h + self.ridge) * self.rate if h + self.ridge > 0 else self.empty


def mixed(x: np.ndarray | int) -> np.ndarray:
    """64 bits well mixed from 64 bits."""
    with np.errstate(over="ignore"):
        z = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def child_key(key: int, high: bool) -> int:
    """What names a node's child; names do not depend on the order in which nodes are made."""
    return int(mixed((key * 2 + 1 + high) & 0xFFFFFFFFFFFFFFFF))


def turns(keys: Sequence[int], entries: int) -> np.ndarray:
    """For every node the turn of each entry, by a hash of both."""
    with np.errstate(over="ignore"):
        seeds = np.array(keys, np.uint64)[:, None] + np.arange(entries, dtype=np.uint64) * np.uint64(0x9E37)
        drawn = mixed(mixed(seeds))
    return np.argsort(np.argsort(drawn, axis=1, kind="stable"), axis=1, kind="stable")


def block(codes: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row of the state."""
    data = [np.ascontiguousarray(c).tobytes() for c in (codes, *columns)]
    return pa.RecordBatch.from_arrays([pa.array([d], pa.binary()) for d in data], names=["codes", *COLUMNS])


def blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for parts in zip(*(batch.column(n) for n in ("codes", *COLUMNS))):
        codes, label, weight, margin, key = (p.as_py() for p in parts)
        labels = np.frombuffer(label, float)
        rows = np.frombuffer(codes, np.uint16).reshape(len(labels), -1)
        yield rows, labels, np.frombuffer(weight, float), np.frombuffer(margin, float), np.frombuffer(key, np.uint64)


@dataclass
class _Node:
    """A leaf that may still be split, with the sums of its rows once they are known."""

    tree: int
    node: int
    depth: int
    key: int
    n: int
    g: int = 0
    h: int = 0


def grow_trees(
    state: DataFrame,
    slopes: Slopes,
    count: int,
    cuts: list[np.ndarray],
    rules: Rules,
    scale: float,
    rows: int,
    local_rows: int = LOCAL_ROWS,
) -> list[Tree]:
    """``count`` trees over the ``rows`` rows of ``state``; slopes are whole multiples of 1 / scale."""
    trees = [Tree() for _ in range(count)]
    starts = np.concatenate([[0], np.cumsum([len(c) + 2 for c in cuts])]).astype(np.int64)
    keys = mixed(mixed(rules.seed) ^ np.arange(count, dtype=np.uint64))
    frontier = [_Node(t, 0, 0, int(k), rows) for t, k in enumerate(keys)]
    local_rows = min(local_rows, LOCAL_CODES // len(cuts))
    small: list[_Node] = []
    while frontier:
        small += [one for one in frontier if one.n <= local_rows]
        wide = [one for one in frontier if one.n > local_rows]
        frontier = []
        portion = max(1, CELLS // int(starts[-1]))
        for k in range(0, len(wide), portion):
            some = wide[k : k + portion]
            for one, found in zip(some, _wide_splits(state, slopes, trees, some, starts, rules, scale)):
                one.n, one.g, one.h, best = found
                deep = rules.depth is not None and one.depth >= rules.depth
                if best is None or deep:
                    trees[one.tree].value[one.node] = rules.value(one.g / scale, one.h / scale)
                    continue
                entry, code, missing_low, low_n = best
                sides = trees[one.tree].split(one.node, entry, code, missing_low)
                for node, high in zip(sides, (False, True)):
                    n = one.n - low_n if high else low_n
                    frontier.append(_Node(one.tree, node, one.depth + 1, child_key(one.key, high), n))
    if small:
        for one, grown in zip(small, _finished(state, slopes, trees, small, starts, rules, scale)):
            trees[one.tree].graft(one.node, grown)
    for tree in trees:
        for node, entry in enumerate(tree.entry):
            if entry >= 0:
                edges, code = cuts[entry], tree.code[node]
                tree.cut[node] = float(edges[code - 1]) if code <= len(edges) else float("inf")
    return trees


def _places(trees: Sequence[Tree], nodes: Sequence[_Node]) -> dict[int, np.ndarray]:
    """For each tree with nodes in question: the place of every leaf among ``nodes``, or -1."""
    out: dict[int, np.ndarray] = {}
    for k, one in enumerate(nodes):
        if one.tree not in out:
            out[one.tree] = np.full(len(trees[one.tree].entry), -1, np.int64)
        out[one.tree][one.node] = k
    return out


SUMS = "node int, entry int, code int, g long, h long, n long"
BEST = "node int, entry int, gain double, code int, missing_low boolean, low_n long, g long, h long, n long"


def _wide_splits(
    state: DataFrame,
    slopes: Slopes,
    trees: list[Tree],
    nodes: list[_Node],
    starts: np.ndarray,
    rules: Rules,
    scale: float,
) -> list[tuple]:
    """For each node n, g, h and its best split (entry, code, missing_low, rows below), or None."""
    places, cells, entries = _places(trees, nodes), int(starts[-1]), len(starts) - 1
    known = {t: trees[t] for t in places}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((3, len(nodes) * cells), np.int64)
        for batch in batches:
            for one in blocks(batch):
                for t, place in places.items():
                    at = place[known[t].leaves(one[0], coded=True)]
                    use, g, h = slopes(one, t)
                    mine = use & (at >= 0)
                    key = (at[mine] * cells)[:, None] + starts[:-1] + one[0][mine]
                    for k in range(entries):
                        totals[2] += np.bincount(key[:, k], minlength=totals.shape[1])
                        for total, v in zip(totals, (g, h)):
                            total += np.bincount(key[:, k], v[mine], totals.shape[1]).astype(np.int64)
        used = np.flatnonzero(totals[2])
        node, cell = np.divmod(used, cells)
        entry = np.searchsorted(starts, cell, side="right") - 1
        yield _batch(SUMS, [node, entry, cell - starts[entry], *totals[:, used]])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition holds some pairs of node and entry, and at most CELLS rows
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            columns = [rows.column(n).to_numpy() for n in ("node", "entry", "code", "g", "h", "n")]
            yield _batch(BEST, best_by_entry(columns, rules, scale))

    # tasks have summed already, so one shuffle serves the sums over tasks and the order of the bins
    placed = state.mapInArrow(run, SUMS).repartition("node", "entry").groupBy("node", "entry", "code")
    summed = placed.agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
    found = summed.mapInArrow(choose, BEST).toArrow()
    columns = [found.column(n).to_numpy(zero_copy_only=False) for n in _names(BEST)]
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    picked = best_by_node(columns, turns([n.key for n in nodes], entries), rules, entries)
    out: list[tuple] = [(0, 0, 0, None)] * len(nodes)
    for k in picked:
        node, entry, gain, code, missing_low, low_n, g, h, n = (c[k] for c in columns)
        best = (int(entry), int(code), bool(missing_low), int(low_n)) if gain > 0 else None
        out[int(node)] = int(n), int(g), int(h), best
    return out


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _batch(schema: str, columns: Sequence[np.ndarray]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    arrays = [pa.array(np.asarray(c), t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_names(schema))


def best_by_entry(columns: list[np.ndarray], rules: Rules, scale: float) -> list[np.ndarray]:
    """The columns of BEST: the best split of every node by every entry, gain 0 if there is none.

    ``columns`` are node, entry, code and the sums g, h and n. Of equal gains the lowest cut wins, and
    missing rows go to the high side.
    """
    order = np.lexsort((columns[2], columns[1], columns[0]))
    node, entry, code, *sums = (c[order] for c in columns)
    change = np.ones(len(node), bool)
    change[1:] = (node[1:] != node[:-1]) | (entry[1:] != entry[:-1])
    starts = np.flatnonzero(change)
    group = np.cumsum(change) - 1
    low, whole, absent = [], [], []
    for v in sums:
        upto = np.cumsum(v)
        low.append(upto - (upto[starts] - v[starts])[group])
        whole.append(np.add.reduceat(v, starts)[group])
        absent.append(np.where(code[starts] == 0, v[starts], 0)[group])
    gains, counts = [], []
    for missing_low in (False, True):
        g, h, n = low if missing_low else [a - b for a, b in zip(low, absent)]
        real_g, real_h = g / scale, h / scale
        rest_g, rest_h = (whole[0] - g) / scale, (whole[1] - h) / scale
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = real_g**2 / (real_h + rules.ridge) + rest_g**2 / (rest_h + rules.ridge)
            gain -= (whole[0] / scale) ** 2 / (whole[1] / scale + rules.ridge)
        fits = (code > 0) & (n > 0) & (n < whole[2]) & (real_h >= rules.least_weight)
        fits &= (rest_h >= rules.least_weight) & (gain / 2 > rules.least_gain)
        if missing_low:
            fits &= absent[2] > 0
        if rules.classes:
            fits &= (whole[0] != 0) & (whole[0] != -whole[1])
        # a gain that is enough is above zero here, also where splits may gain nothing
        gains.append(np.where(fits, gain - 2 * min(rules.least_gain, 0.0), 0.0))
        counts.append(n)
    both = np.maximum(*gains)
    best = np.maximum.reduceat(both, starts)
    at = np.minimum.reduceat(np.where(both == best[group], np.arange(len(both)), len(both)), starts)
    missing_low = gains[1][at] > gains[0][at]
    below = np.where(missing_low, counts[1][at], counts[0][at])
    totals = [w[starts] for w in whole]
    return [node[starts], entry[starts], best, code[at], missing_low, below, *totals]


def best_by_node(columns: list[np.ndarray], turn: np.ndarray, rules: Rules, entries: int) -> np.ndarray:
    """The place of each node's best row among ``columns`` (of BEST, by node and entry)."""
    node, entry, gain = columns[:3]
    if not len(node):
        return np.empty(0, np.int64)
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    group = np.cumsum(np.append(0, node[1:] != node[:-1]))
    if rules.fraction is not None:
        own = turn[node, entry]
        looked = max(1, int(rules.fraction * entries))
        # the entries looked at; where none of them gains, the first in turn that does
        inside = np.where(own < looked, gain, 0.0)
        some = np.maximum.reduceat(inside, starts)[group] > 0
        first = np.minimum.reduceat(np.where(gain > 0, own, entries), starts)[group]
        gain = np.where(some, inside, np.where(own == first, gain, 0.0))
    best = np.maximum.reduceat(gain, starts)[group]
    at = np.minimum.reduceat(np.where(gain == best, np.arange(len(gain)), len(gain)), starts)
    columns[2] = gain
    return at


PARTS = "slot int, codes binary, g binary, h binary"
DONE = (
    "slot int, entry array<int>, code array<int>, missing_low array<boolean>, low array<int>, "
    "high array<int>, value array<double>"
)


def _finished(
    state: DataFrame,
    slopes: Slopes,
    trees: list[Tree],
    nodes: list[_Node],
    starts: np.ndarray,
    rules: Rules,
    scale: float,
) -> list[Tree]:
    """What grows below each of ``nodes``; the rows of one meet in one task, at most LOCAL_ROWS of them."""
    places = _places(trees, nodes)
    known = {t: trees[t] for t in places}
    facts = [(one.key, one.depth) for one in nodes]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in blocks(batch):
                for t, place in places.items():
                    at = place[known[t].leaves(one[0], coded=True)]
                    use, g, h = slopes(one, t)
                    mine = np.flatnonzero(use & (at >= 0))
                    mine = mine[np.argsort(at[mine], kind="stable")]
                    edges = np.flatnonzero(np.append(True, at[mine][1:] != at[mine][:-1])) if len(mine) else []
                    for part in np.split(mine, edges[1:]) if len(mine) else ():
                        data = [one[0][part].tobytes(), *(np.asarray(v[part], np.int64).tobytes() for v in (g, h))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([at[part[0]]], pa.int32()), *(pa.array([d], pa.binary()) for d in data)],
                            names=_names(PARTS),
                        )

    def finish(parts: pa.Table) -> pa.Table:
        slot = parts.column("slot")[0].as_py()
        g, h = (
            np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in parts.column(n)]) for n in ("g", "h")
        )
        codes = np.concatenate([np.frombuffer(b.as_py(), np.uint16) for b in parts.column("codes")])
        key, depth = facts[slot]
        tree = local_tree(codes.reshape(len(g), -1), g, h, starts, rules, scale, key, depth)
        names = ("entry", "code", "missing_low", "low", "high", "value")
        kinds = dict(zip(names, (pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.float64())))
        lists = [pa.array([getattr(tree, n)], pa.list_(kinds[n])) for n in names]
        return pa.table([pa.array([slot], pa.int32()), *lists], names=["slot", *names])

    dealt = state.mapInArrow(deal, PARTS)
    out = [Tree(value=[rules.value(0.0, 0.0)]) for _ in nodes]
    for row in dealt.groupBy("slot").applyInArrow(finish, DONE).toArrow().to_pylist():
        slot = row.pop("slot")
        out[slot] = Tree(cut=[0.0] * len(row["entry"]), **row)
    return out


def local_tree(
    codes: np.ndarray,
    g: np.ndarray,
    h: np.ndarray,
    starts: np.ndarray,
    rules: Rules,
    scale: float,
    key: int,
    depth: int = 0,
) -> Tree:
    """The tree over a few rows, all nodes of a level at once."""
    tree, entries = Tree(), len(starts) - 1
    frontier, keys = np.array([0]), [key]
    rows, at = np.arange(len(g)), np.zeros(len(g), np.int64)
    cells = int(starts[-1])
    while len(frontier):
        sums = _sparse_sums(codes[rows], g[rows], h[rows], at, starts, cells)
        found = best_by_entry(sums, rules, scale)
        picked = best_by_node(found, turns(keys, entries), rules, entries)
        deep = rules.depth is not None and depth >= rules.depth
        following, names = [], []
        low, high = np.full(len(frontier), -1), np.full(len(frontier), -1)
        chosen = {}
        for k in picked:
            place, entry, gain, code, missing_low, _, total_g, total_h, _ = (c[k] for c in found)
            node = int(frontier[place])
            if deep or not gain > 0:
                tree.value[node] = rules.value(int(total_g) / scale, int(total_h) / scale)
                continue
            sides = tree.split(node, int(entry), int(code), bool(missing_low))
            low[place], high[place] = len(following), len(following) + 1
            chosen[int(place)] = (int(entry), int(code), bool(missing_low))
            following += sides
            names += [child_key(keys[place], False), child_key(keys[place], True)]
        if not following:
            break
        entry, code = np.zeros(len(frontier), np.int64), np.zeros(len(frontier), np.int64)
        missing = np.zeros(len(frontier), bool)
        for place, (e, c, m) in chosen.items():
            entry[place], code[place], missing[place] = e, c, m
        stay = low[at] >= 0
        rows, at = rows[stay], at[stay]
        x = codes[rows, entry[at]]
        below = np.where(x == 0, missing[at], x <= code[at])
        at = np.where(below, low[at], high[at])
        frontier, keys, depth = np.array(following), names, depth + 1
    return tree


def _sparse_sums(
    codes: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, starts: np.ndarray, cells: int
) -> list[np.ndarray]:
    """node, entry, code, g, h and n of every cell that has rows."""
    key = ((at * cells)[:, None] + starts[:-1] + codes).ravel()
    entries = codes.shape[1]
    order = np.argsort(key, kind="stable")
    key = key[order]
    edges = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    row = order // entries
    sums = [np.add.reduceat(v[row], edges) for v in (g, h)]
    node, cell = np.divmod(key[edges], cells)
    entry = np.searchsorted(starts, cell, side="right") - 1
    return [node, entry, cell - starts[entry], *sums, np.diff(np.append(edges, len(key)))]
